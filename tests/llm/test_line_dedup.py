"""Dedup of units against a plain pass in rank order."""

import re

from pyspark.sql import functions as F

from opinara.llm import line_dedup


def units_of(text):
    """Units letter by letter."""
    units = [""]
    for i, letter in enumerate(text):
        units[-1] += letter
        if letter == "\n" or (letter in ".!?" and text[i + 1 : i + 2] in (" ", "\t")):
            units.append("")
    return units


def norm(unit):
    return re.sub(r"[ \t\r\x0b\x0c\n]+", " ", unit.lower()).strip(" ")


def brute_force(rows, least=line_dedup.PASSAGE_WORDS):
    first, out = {}, []
    for doc, text in rows:
        for number, unit in enumerate(units_of(text or "")):
            place = (doc is not None, doc or 0, number)
            first[norm(unit)] = min(first.get(norm(unit), place), place)
    for doc, text in rows:
        units, at, spans, kept, runs = units_of(text or ""), 0, [], "", [0]
        for number, unit in enumerate(units):
            body = unit[:-1] if unit.endswith("\n") else unit
            if norm(unit) and first[norm(unit)] < (doc is not None, doc or 0, number):
                spans.append(f"{at}:{at + len(body)}")
                kept += unit[len(body) :]
                runs[-1] += len(norm(unit).split(" "))
            else:
                kept += unit
                if norm(unit):
                    runs.append(0)
            at += len(unit)
        out.append((doc, len(units), len(spans), sum(runs), sum(r for r in runs if r >= least), ",".join(spans), kept))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_the_plain_pass_on_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = result(line_dedup.cut_repeated_units(docs))
    assert got == brute_force(rows) and sum(r[2] for r in got) > 20


def test_odd_rows(spark):
    line = "one two three four"
    rows = [
        (3, line), (2, f"x\n{line.upper()}  \n\n{line}"), (None, f"é\n{line}"), (4, None), (5, ""), (6, "\n\n"), (8, " \t. !  ?\n.\r\n"),
        (7, f"{line} nine\n{line}. {line}! And\tmore.\n{line}?\tx"), (9, "Yes. Yes. No?\nYes."), (10, "漢字漢字\n漢字漢字"), (11, "a.b. c.\u00a0d"),
        (12, "Long sentence here. " * 20_000 + line),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("line", "unit", "row", "removed", "of", "digest", "n")})
    assert result(line_dedup.cut_repeated_units(docs)) == brute_force(rows)
    assert line_dedup.cut_repeated_units(docs.limit(0)).count() == 0


def test_short_and_unsegmented_units_go(spark):
    rows = [(i, f"own{i} words.\nfive words in a line\n漢字漢字漢字") for i in range(9)]
    got = line_dedup.cut_repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_removed for r in got] == [0] + [2] * 8
    assert got[1].kept == "own1 words.\n\n"


def test_passages_are_told_from_common_sentences(spark):
    passage = " ".join(f"{' '.join(f'p{i}w{j}' for j in range(9))}." for i in range(7))
    rows = [(0, f"First comes this. {passage} Then ends it all."), (1, f"Another begins, {passage} and goes on"), (2, "Quite its own. Then ends it all. And more of it.")]
    got = line_dedup.cut_repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_removed for r in got] == [0, 6, 1]
    assert [r.passage_words for r in got] == [0, 54, 0]
    assert [r.removed_words for r in got] == [0, 54, 4]


def test_one_occurrence_stays_under_shared_keys(spark):
    line = "one two three four five six seven eight"
    rows = [(None, f"{line}\na"), (None, f"{line}\nb"), (None, f"{line}\nbb"), (1, f"{line} nine\nc"), (1, f"{line} nine\nd"), (2, f"{line} ten"), (2, f"{line} ten")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(line_dedup.cut_repeated_units(docs))
    kept = [(row[0], part) for row in got for part in row[-1].split("\n")]
    assert len(got) == len(rows) and sum(r[2] for r in got) == 4
    for doc, repeated in ((None, line), (1, f"{line} nine"), (2, f"{line} ten")):
        assert kept.count((doc, repeated)) == 1
    assert result(line_dedup.cut_repeated_units(docs.repartition(5))) == got
