"""Substring dedup by hashing units: a sentence that was seen before, anywhere, is cut out.

A unit ends with its line, or after a full stop, exclamation or question mark before a blank; so a
passage is found wherever in a line it stands, by the sentences it holds whole. Units are normalised (lower case,
runs of blanks as one, trimmed) and digested; all but empty ones take part, however short. A digest's
earliest unit by (doc_id, number) stays; every later one goes. Digests are combined per
task before the shuffle, so a unit that fills a third of the corpus costs one row per task; the
way back is a plain join whose skewed partitions Spark can split. Texts move once, to meet the
numbers of their removed units.

What goes are the unit's own characters, given by their offsets in the original text; line breaks stay.
``passage_words`` tells repeated passages from a common sentence here or there: it counts the words
in runs of neighbouring removed units that have at least ``PASSAGE_WORDS`` together.

Nulls count as empty texts. A null key ranks before all others. Of rows that agree in the key, that of the least digest
of its text ranks first, and of equal rows any one, so a unit stays in exactly one place. An empty table gives an
empty result; a text of any length is read whole. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opinara.llm.frames import documents_of, map_batches, store

PASSAGE_WORDS = 25
BLANKS = r"[ \t\r\x0B\x0C\n]+"
# Where one unit ends and the next begins; no character is between them.
BOUNDARY = r"(?<=\n)|(?<=[.!?])(?=[ \t])"
CUT_SCHEMA = "doc_id long, n_units long, n_removed long, removed_words long, passage_words long, spans string, kept string"


def normalised(unit: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(unit), BLANKS, " "))


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, text, version, row``: row is the key where that names each row, else a number given here."""
    rows = documents_of(docs, key, text)
    doubled = rows.groupBy("doc_id").count().filter("doc_id is null or count > 1")
    if doubled.isEmpty():
        return rows.withColumns({"version": F.lit(0).cast("long"), "row": F.col("doc_id")})
    rows = rows.withColumns({"version": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    return store(rows, "numbered")  # written out, so that both sides of the joins read the same numbers


def removed_units(rows: DataFrame) -> DataFrame:
    """``row, removed``: numbers of the units to cut, only for rows of ``keyed`` that have some."""
    units = (
        rows.select("doc_id", "version", "row", F.posexplode(F.split("text", BOUNDARY)).alias("unit_no", "unit"))
        .withColumn("unit", normalised(F.col("unit")))
        .filter("unit <> ''")
        .select("doc_id", "version", "row", "unit_no", F.unhex(F.md5("unit")).alias("digest"))
    )
    place = F.struct("doc_id", "unit_no", "version", "row")
    firsts = units.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = firsts.filter("n > 1").select("digest", F.col("first.row").alias("first_row"), F.col("first.unit_no").alias("first_unit"))
    return (
        units.select("row", "unit_no", "digest").join(repeated, "digest")
        .filter((F.col("row") != F.col("first_row")) | (F.col("unit_no") != F.col("first_unit")))
        .groupBy("row")
        .agg(F.collect_set("unit_no").alias("removed"))
    )


def cut_text(text: str, numbers: set[int], least: int = PASSAGE_WORDS) -> tuple[int, int, int, int, str, str]:
    """Units, removed ones, their words, those in passages, spans in code points, and the text without them."""
    units = re.split(BOUNDARY, text)
    at, spans, rest, words, passages, run = 0, [], [], 0, 0, 0
    for number, unit in enumerate(units):
        body = unit.removesuffix("\n")
        if number in numbers:
            spans.append(f"{at}:{at + len(body)}")
            rest.append(unit[len(body) :])
            run += len(body.split())
        else:
            rest.append(unit)
            if unit.strip():  # an empty line does not part a passage
                words, passages, run = words + run, passages + run * (run >= least), 0
        at += len(unit)
    return len(units), len(spans), words + run, passages + run * (run >= least), ",".join(spans), "".join(rest)


def cut_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [column.split()[0] for column in CUT_SCHEMA.split(", ")]
    for batch in batches:
        texts, gone = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        cut = [cut_text(text, set(numbers or ())) for text, numbers in zip(texts, gone, strict=True)]
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string()]
        columns = [pa.array([row[i] for row in cut], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)


def cut_repeated_units(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """One row per document: ``doc_id, n_units, n_removed, removed_words, passage_words, spans, kept`` (the text that stays)."""
    rows = keyed(docs, key, text)
    gone = removed_units(rows).withColumnRenamed("row", "of")
    found = rows.join(gone, F.col("row") == F.col("of"), "left").select("doc_id", "text", "removed")
    return map_batches(found, cut_units, CUT_SCHEMA)
