import pytest
from pyspark.sql import functions as F

from opinara.operators.prep import drop_nulls, guarded_input, prepare, with_split
from opinara.plans.loading import load_splits
from opinara.settings import REVIEW_SCHEMA, SessionSettings, SourceSettings
from opinara.sources import reviews as sources


def test_settings():
    assert SessionSettings().driver_memory is None
    assert SourceSettings().sample_fraction == 1.0
    assert [part.split()[0] for part in REVIEW_SCHEMA.split(", ")] == ["polarity", "title", "text"]


def test_csv_with_newlines_and_quotes(spark, tmp_path):
    (tmp_path / "r.csv").write_text('1,"t","line one\nline two ""q"""\n2,"u","ok"\n')
    rows = sources.read_reviews(spark, str(tmp_path / "r.csv")).orderBy("polarity").collect()
    assert [tuple(row) for row in rows] == [(1, "t", 'line one\nline two "q"'), (2, "u", "ok")]


def test_csv_header_is_explicit(spark, tmp_path):
    (tmp_path / "r.csv").write_text("polarity,title,text\n2,u,ok\n")
    rows = sources.read_reviews(spark, str(tmp_path / "r.csv"), header=True).collect()
    assert [tuple(row) for row in rows] == [(2, "u", "ok")]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_written_reviews_come_back(spark, tmp_path, fmt):
    texts = [" padded ", 'say "hi"', "a,b", "two\nlines", "tab\there", "back\\slash", "é ü"]
    df = spark.createDataFrame([(1 + i % 2, f"t{i}", t) for i, t in enumerate(texts)], REVIEW_SCHEMA)
    path = sources.write_reviews(df, str(tmp_path / f"out.{fmt}"), fmt, rows_per_file=3)
    back = sources.read_reviews(spark, path)
    assert sorted(back.collect()) == sorted(df.collect())
    assert len(back.inputFiles()) > 1


def test_csv_tells_empty_from_null(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", ""), (2, "", "x"), (None, None, "y"), (1, "", None)], REVIEW_SCHEMA)
    path = sources.write_reviews(df, str(tmp_path / "out"), "csv")
    assert sorted(map(str, sources.read_reviews(spark, path).collect())) == sorted(map(str, df.collect()))


def test_parquet_is_not_read_as_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", "x")], REVIEW_SCHEMA)
    path = sources.write_reviews(df, str(tmp_path / "reviews"))
    with pytest.raises(ValueError, match="Parquet"):
        sources.read_reviews(spark, path)
    assert sources.read_reviews(spark, path, fmt="parquet").collect() == df.collect()
    with pytest.raises(ValueError, match="Unknown format"):
        sources.read_reviews(spark, path, fmt="xml")


def test_keys_differ_across_partition_folders(spark, tmp_path):
    for folder in ("day=1", "day=2"):
        spark.range(2).coalesce(1).write.parquet(str(tmp_path / "t" / folder))
        (part,) = (tmp_path / "t" / folder).glob("part-*")
        part.rename(part.with_name("part-0.parquet"))
    rows = sources.with_file_key(spark.read.parquet(str(tmp_path / "t")), "key", str(tmp_path / "t")).collect()
    assert sorted(r.key for r in rows) == [f"day={d}/part-0.parquet:{i}" for d in (1, 2) for i in (0, 1)]


def test_null_counts_agree_with_dropping(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, t string")
    assert sources.null_drop_counts(df).first() == (4, drop_nulls(df).count())


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="Unknown format"):
        sources.write_reviews(spark.range(1), str(tmp_path / "x"), "xml")


def test_conform_and_expect_count(spark):
    upstream = spark.createDataFrame([(0, "a", "b"), (1, "c", "d")], "label long, title string, content string")
    conformed = sources.conform(upstream)
    assert dict(conformed.dtypes) == {"title": "string", "text": "string", "polarity": "int"}
    assert sorted(row.polarity for row in conformed.collect()) == [1, 2]
    assert sources.expect_count(conformed, 2) is conformed
    with pytest.raises(ValueError, match="Expected 3 train rows, got 2"):
        sources.expect_count(conformed, 3, "train rows")


def test_nulls_are_dropped_and_labels_mapped(spark):
    rows = [(1, "A", "B"), (2, "C", ""), (3, "E", "F"), (None, "x", "y"), (1, None, "y"), (1, "x", None)]
    df = spark.createDataFrame(rows, REVIEW_SCHEMA)
    assert sources.null_drop_counts(df).first() == (6, 3)
    assert drop_nulls(df).count() == 3
    prepared = {row.polarity: row for row in prepare(df).collect()}
    assert {p: row.label for p, row in prepared.items()} == {1: 0.0, 2: 1.0, 3: 1.0}
    assert prepared[1].combined_text == "a b"
    assert prepared[2].combined_text == "c "


def test_guard_rejects_blank_and_cuts(spark):
    df = spark.createDataFrame([(1, " \n\t"), (2, "x" * 600), (3, "")], "id int, text string")
    kept = guarded_input(df).collect()
    assert [(row.id, len(row.model_input)) for row in kept] == [(2, 512)]


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    one, many = (with_split(df.repartition(n), "id").filter("split = 'test'") for n in (1, 7))
    assert sorted(one.collect()) == sorted(many.collect())
    assert 300 < one.count() < 500


def test_spread_only_where_splits_are_few(spark, small_dir):
    scan = spark.read.parquet(f"{small_dir}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert sources.spread(scan, "doc_id").rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores + 3).withColumn("x", F.lit(1))
    assert sources.spread(wide, "id") is wide


def test_first_rows(spark):
    assert [r.id for r in sources.first_rows(spark.range(50).repartition(5), "id", 3).collect()] == [0, 1, 2]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_load_splits(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1 + i % 2, f"T{i}", f"Text {i}") for i in range(400)], REVIEW_SCHEMA)
    paths = {}
    for split, ids in (("train", "title < 'T2'"), ("test", "title >= 'T2'")):
        paths[split] = sources.write_reviews(df.filter(ids), str(tmp_path / f"{split}.{fmt}"), fmt, rows_per_file=30)
    whole = SourceSettings(paths["train"], paths["test"])
    train, test = load_splits(spark, whole)
    assert train.count() + test.count() == 400
    assert {"polarity", "title", "text", "review_id", "combined_text", "label"} == set(train.columns)
    assert train.select("review_id").distinct().count() == train.count()
    assert train.first().combined_text.startswith("t")
    part, _ = load_splits(spark, SourceSettings(paths["train"], paths["test"], sample_fraction=0.3))
    ids = {r.review_id for r in part.collect()}
    assert 0 < len(ids) < train.count()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again, _ = load_splits(spark, SourceSettings(paths["train"], paths["test"], sample_fraction=0.3))
        assert {r.review_id for r in again.collect()} == ids
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_null_conditions_reach_the_scan(spark, small_dir):
    scan = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    plan = drop_nulls(scan)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), IsNotNull(text)]" in plan
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    assert drop_nulls(df).count() == df.na.drop("any").count() == 1


ODD_TEXTS = [
    r"\N", "\\", r"\n", r"\b", r"\\N", "a\nb", "a\r\nb\r", '"', '"\n"', "", " ", "a,b", r"\"N", "\n", r"\bn", "ü\u2028x\u0085", "#", None,
]


@pytest.mark.parametrize("header", [False, True])
def test_csv_keeps_every_text(spark, tmp_path, header):
    """The mark of null, line breaks, backslashes and quotes survive as texts; a null stays one."""
    rows = [(i, text, other) for i, (text, other) in enumerate((t, o) for t in ODD_TEXTS for o in ODD_TEXTS)]
    df = spark.createDataFrame(rows, "polarity int, title string, text string")
    path = sources.write_reviews(df, str(tmp_path / "out"), "csv", header=header)
    read = sources.read_reviews(spark, path, header=header)
    assert {tuple(r) for r in read.collect()} == set(rows)
    assert read.count() == len(rows)


def test_escaped_csv_is_read_by_several_tasks(spark, tmp_path):
    df = spark.range(4000).select(F.lit(1).alias("polarity"), F.lit("t\nu").alias("title"), F.repeat(F.lit("long text\n"), 50).alias("text"))
    paths = [sources.write_reviews(df.coalesce(1), str(tmp_path / str(e)), "csv", escapes=e) for e in (True, False)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300_000)
    try:
        tasks = [sources.read_reviews(spark, path, fmt="csv").select(F.spark_partition_id()).distinct().count() for path in paths]
        assert sources.read_reviews(spark, paths[0], fmt="csv").distinct().collect() == df.distinct().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks[0] > 3 and tasks[1] == 1


def test_plain_and_escaped_files_do_not_mix(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", "x")], "polarity int, title string, text string")
    for escapes in (True, False):
        sources.write_reviews(df, str(tmp_path / f"part={escapes}"), "csv", escapes=escapes)
    with pytest.raises(ValueError, match="both plain and escaped"):
        sources.read_reviews(spark, f"{tmp_path}/*", fmt="csv")


def test_counts_come_with_the_write(spark, tmp_path):
    """Rows are read once: by the write, which counts them on the way."""
    scans = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    rows = [(1, "t", "x"), (2, None, "y"), (None, "u", "z")]
    df = spark.newSession().createDataFrame(rows, "polarity int, title string, text string")
    kept, seen = sources.counted_null_drop(df.mapInArrow(count, df.schema))
    path = sources.write_reviews(kept, str(tmp_path / "out"))
    assert seen.get == {"rows": 3, "rows_after": 1} and scans.value == 3
    assert sources.read_reviews(spark, path, fmt="parquet").collect() == [(1, "t", "x")]
