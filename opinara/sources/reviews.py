"""Reading, conforming and writing review tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from opinara.operators.prep import complete
from opinara.settings import REVIEW_SCHEMA

# Plain CSV with one quoted line break makes a file unsplittable, so large tables are written as many files.
ROWS_PER_FILE = 1_000_000
# What a null is written as in CSV; an empty text is written as "".
CSV_NULL = r"\N"
# Escaped CSV: each pair is undone in reverse order. After the first step a backslash is always followed by
# a b, so neither the marks of line breaks nor the one of null can come from a text.
ESCAPES = (("\\", r"\b"), ("\n", r"\n"), ("\r", r"\r"))
ESCAPED = "esc"  # how the names of such files end
FORMATS = ("parquet", "csv")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Let every core work on a table that arrives in fewer splits than there are cores.

    For plain scans ahead of costly text work. A table of many splits, as any large one is,
    stays as it is; only one in few files (or in unsplittable ones) is redistributed by key.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= wanted else scan.repartition(wanted, key)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_file_key(scan: DataFrame, key: str, root: str = "") -> DataFrame:
    """Give rows of a Parquet scan a key: the file's path below ``root`` and the row's position in it.

    The path, not the name: folders of a partitioned table repeat the names of their files.
    """
    path = F.col("_metadata.file_path")
    if root:
        below = F.substring_index(path, root.rstrip("/"), -1)
        path = F.when(below == "", F.col("_metadata.file_name")).otherwise(F.ltrim(below, F.lit("/")))
    return scan.withColumn(key, F.concat_ws(":", path, F.col("_metadata.row_index")))


def _each_text(df: DataFrame, change) -> DataFrame:
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({name: change(F.col(name)) for name in texts}) if texts else df


def escaped(text: Column) -> Column:
    """On one line, whatever the text holds, and never like the mark of null."""
    for plain, mark in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    for plain, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str = REVIEW_SCHEMA,
    header: bool = False,
    multiline: bool = True,
    escapes: bool = False,
) -> DataFrame:
    """Reviews from CSV: fixed schema, ``"`` as quote and as escape.

    Files written with ``escapes`` hold one row a line, so each is read by as many tasks as it is large. In plain
    CSV, texts with line breaks need ``multiline``, which reads each file in one task: many
    moderate files are read in parallel. Turn it off only for data known to have none.
    An empty text is a quoted empty field, a null is ``\\N``, as ``write_reviews`` writes them; in files from
    elsewhere a field with nothing at all between two commas is read as null, too.
    """
    found = spark.read.csv(
        path,
        schema=schema,
        header=header,
        quote='"',
        escape='"',
        nullValue=CSV_NULL,
        multiLine=multiline and not escapes,
        lineSep="\n" if escapes else None,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return _each_text(found, unescaped) if escapes else found


def format_of(path: str, fmt: str | None = None) -> str:
    """The format given, else Parquet for paths that end in ``.parquet`` and CSV for all others."""
    if fmt is not None and fmt not in FORMATS:
        raise ValueError(f"Unknown format: {fmt}. Choose parquet or csv")
    return fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")


def read_reviews(
    spark: SparkSession, path: str, schema: str = REVIEW_SCHEMA, header: bool = False,
    fmt: str | None = None, multiline: bool = True,
) -> DataFrame:
    """Pick the reader by ``fmt`` or the path's ending, separately for each path.

    Whether CSV is escaped is told by the names of its files. Raises where a path to be read as CSV holds
    Parquet files, or files of both kinds.
    """
    if format_of(path, fmt) == "parquet":
        return read_parquet(spark, path)
    found = read_csv(spark, path, schema=schema, header=header, multiline=multiline)
    names = found.inputFiles()
    if any(name.endswith(".parquet") for name in names):
        raise ValueError(f"{path} holds Parquet files; give the format")
    kinds = {name.endswith(f".{ESCAPED}") for name in names}
    if len(kinds) > 1:
        raise ValueError(f"{path} holds both plain and escaped files; read them one by one")
    return read_csv(spark, path, schema, header, escapes=True) if kinds == {True} else found


def conform(df: DataFrame) -> DataFrame:
    """Upstream layout ``label`` 0/1, ``content`` to ``polarity`` 1/2, ``text``."""
    return (
        df.withColumnRenamed("content", "text")
        .withColumn("polarity", F.col("label").cast("int") + 1)
        .drop("label")
    )


def expect_count(df: DataFrame, expected: int, what: str = "rows") -> DataFrame:
    """Return ``df`` if it has the expected number of rows, else raise."""
    check_count(df.count(), expected, what)
    return df


def check_count(found: int, expected: int, what: str = "rows") -> None:
    if found != expected:
        raise ValueError(f"Expected {expected:,} {what}, got {found:,}")


def counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df``, whose next write or other action also counts its ``rows`` and what ``counts`` names.

    ``Observation.get`` then has the numbers, without a scan of their own. ``df`` should come from a session
    of its own (``spark.newSession()``): one that has observed can no longer send out a linear model just
    fitted in it, whose training summary holds on to the session.
    """
    seen = Observation()
    whole = {"rows": F.count(F.lit(1)), **counts}
    return df.observe(seen, *[count.alias(name) for name, count in whole.items()]), seen


def counted_null_drop(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``drop_nulls`` that counts: the action on the result also gives ``rows`` before and ``rows_after``."""
    whole = F.lit(True)
    for condition in complete(df):
        whole = whole & condition
    observed, seen = counted(df, rows_after=F.count(F.when(whole, 1)))
    return observed.filter(whole), seen


def write_reviews(
    df: DataFrame, path: str, fmt: str = "parquet", header: bool = False,
    rows_per_file: int = ROWS_PER_FILE, escapes: bool = True,
) -> str:
    """Write as Parquet or CSV, to be read back in parallel.

    CSV keeps every text as it is, line breaks and the mark of null included, by escapes that
    ``read_reviews`` undoes. Without ``escapes`` it is plain CSV for other programs, where a text that is
    just that mark reads as a null.
    """
    writer = df.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        if escapes:
            writer = _each_text(df, escaped).write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file)
            writer = writer.option("extension", ESCAPED).option("lineSep", "\n")
        writer.csv(
            path,
            header=header,
            quote='"',
            escape='"',
            nullValue=CSV_NULL,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    else:
        raise ValueError(f"Unknown format: {fmt}. Choose parquet or csv")
    return path


def first_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by key: a preview that does not depend on file order."""
    return df.orderBy(key).limit(n)


def null_drop_counts(df: DataFrame) -> DataFrame:
    """Rows before and after ``drop_nulls``, in one pass."""
    whole = F.lit(True)
    for condition in complete(df):
        whole = whole & condition
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count(F.when(whole, 1)).alias("rows_after"),
    )
