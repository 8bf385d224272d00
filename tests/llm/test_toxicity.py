"""Toxicity: held-out accuracy, misspellings, folds, gradients, and rows out of the ordinary."""

import random
import zlib

import numpy as np

from opinara.llm import toxicity


def corpus(spark, count=900, seed=1):
    dice = random.Random(seed)
    syllables = ["ba", "lo", "mi", "ter", "sen", "ka", "ru", "pol", "den", "is"]
    word = lambda: "".join(dice.choice(syllables) for _ in range(dice.randint(1, 4)))
    docs, labels = [], []
    for i in range(count):
        words = [word() for _ in range(dice.choice([8, 40, 200]))]
        bad = i % 4 == 0
        if bad:
            for _ in range(max(1, len(words) // 40)):
                words[dice.randrange(len(words))] = dice.choice(["gruxxen", "gruxxer", "vaxgrux", "Gruxx!"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_documents_and_misspellings(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels)
    rows = toxicity.scored(docs, model).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 100 and sum(r.predicted == r.toxic for r in held) / len(held) > 0.95
    unseen = spark.createDataFrame([(1, "balo mi terka grruxxen lo sen"), (2, "balo mi terka polden lo sen")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.scored(unseen, model).collect()}
    assert scores[1] > 0.5 > scores[2]


def test_query_learns_nothing_from_held_out_labels(spark):
    docs, labels = corpus(spark, 300)
    turned = labels.withColumn("toxic", (toxicity.fold("doc_id") == 0).cast("int").bitwiseXOR(labels.toxic))
    one, two = (toxicity.fit(docs, l) for l in (labels, turned))
    assert np.array_equal(one.rows, two.rows) and one.bias == two.bias


def test_fold_is_the_crc_of_the_key(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, 123456789, -5)], "doc_id long")
    for row in rows.select("doc_id", toxicity.fold("doc_id").alias("fold")).collect():
        assert row.fold == zlib.crc32(str(row.doc_id).encode()) % 5


def test_every_word_has_its_grams_and_itself():
    rows, counts = toxicity.subwords(["abc", "a", "abcdefgh"])
    # Marked words of 5, 3 and 10 characters: their 3- to 5-grams, and the word.
    assert list(counts) == [3 + 2 + 1 + 1, 1 + 1, 8 + 7 + 6 + 1] and len(rows) == sum(counts)
    assert list(toxicity.subwords(["abc"])[0]) == list(rows[:7])


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 2), (2, "", 2), (None, "!!! 12", 2), (3, "word " * 50_000, 2), (3, "word " * 50_000, 2)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0)):
        rows = toxicity.scored(docs, toxicity.fit(docs, given)).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_one_long_text_does_not_take_the_sample(spark):
    docs, labels = corpus(spark, 300)
    long = spark.createDataFrame([(10_000 + i, "word " * 40_000, i % 2) for i in range(40)], "doc_id long, text string, toxic int")
    more, known = docs.union(long.select("doc_id", "text")), labels.union(long.select("doc_id", "toxic"))
    small = {r.id for r in toxicity.sample(docs, labels).collect()}
    taken = {r.id for r in toxicity.sample(more, known, rows=400, size=600_000).collect()}
    assert small <= taken and not (taken - small) & set(range(300))


def test_a_class_has_half_of_the_bytes_and_what_the_other_leaves(spark):
    rows = [(i, "x" * 100, int(i % 20 == 0)) for i in range(2000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    count = lambda size: [sum(r.label == c for r in toxicity.sample(docs, labels, rows=1000, size=size).collect()) for c in (0, 1)]
    toxic = toxicity.learnable(labels).filter("label = 1").count()
    assert count(8_000) == [40, 40]
    assert count(20_000) == [200 - toxic, toxic] and toxic < 100


def test_one_row_of_a_shared_key_is_learned_from(spark):
    docs, labels = corpus(spark, 300)
    key = toxicity.learnable(labels).agg({"id": "max"}).first()[0]
    many = spark.range(20_000).selectExpr(f"cast({key} as long) doc_id", "concat('word ', id) text")
    taken = toxicity.sample(docs.union(many), labels)
    assert taken.count() == taken.select("id").distinct().count() == toxicity.learnable(labels).count()
