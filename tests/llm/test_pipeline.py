"""The pipeline, stage by stage, against plain Python."""

import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from opinara.llm import mixing, pii, toxicity
from test_jaccard import brute_force


@pytest.fixture(scope="module")
def kept(spark, small_dir, tmp_path_factory):
    """The result of each stage, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    tables = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small_dir).write.parquet(str(folder / name))
        docs = tables[name] = spark.read.parquet(str(folder / name))
    return tables


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_columns_stay(kept):
    for name in ("toxicity", "near_copies", "pii", "mixing"):
        assert kept[name].dtypes == kept["documents"].dtypes


def test_toxic_documents_go(spark, kept, small_dir):
    docs, labels = kept["documents"], spark.read.parquet(f"{small_dir}/labels.parquet")
    clean = toxicity.scored(docs, toxicity.fit(docs, labels)).filter("predicted = 0").select("doc_id")
    assert rows(kept["toxicity"]) == rows(docs.join(clean, "doc_id").select(docs.columns))


def test_one_of_each_group_stays(kept):
    texts = {r.doc_id: r for r in kept["toxicity"].collect()}
    groups = brute_force([(i, r.text) for i, r in texts.items()], percent=80, size=5)
    expected = sorted(tuple(texts[i]) for i, (_, group) in groups.items() if i == group)
    assert rows(kept["near_copies"]) == expected
    assert len(expected) < len(texts)


def test_texts_are_masked(kept):
    expected = sorted((r.doc_id, pii.masked(r.text), r.lang, r.source, len(pii.masked(r.text))) for r in kept["near_copies"].collect())
    assert rows(kept["pii"]) == expected


def test_rows_come_in_mixed_order(kept):
    places = {r.doc_id: r.position for r in mixing.mix(kept["pii"]).collect()}
    order = [r.doc_id for r in kept["mixing"].collect()]
    assert rows(kept["mixing"]) == rows(kept["pii"]) and sorted(order, key=places.get) == order


def test_tokens_equal_the_library(kept):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    expected = []
    for row in kept["mixing"].collect():
        ids = library.encode(row.text, add_special_tokens=False).ids
        expected.append((row.doc_id, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    assert rows(kept["bpe"]) == sorted(expected)


def test_run_equals_the_stages(spark, kept, small_dir):
    assert rows(corpus_pipeline.run(spark, small_dir)) == rows(kept["bpe"])


def test_odd_rows(spark, tmp_path):
    texts = [(1, None, "en", "a", None), (2, "", None, "a", 0), (None, "some words here", "en", None, 15), (3, "mail a@b.co now please today", "en", "a", 27)]
    texts += [(4, "one and the same text for all of us", "en", "b", 1)] * 2 + [(5, "one and the same text for all of us", "en", "b", 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(((r.doc_id, r.n_tokens > 0) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, False), (2, False), (None, True), (3, True), (4, True)], key=str)


def test_empty_documents_and_further_columns(spark, tmp_path):
    texts = [(i, f"text {i} of a few words, mail a@b.co", "en", "ab"[i % 2], 30, i, "n", i) for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long, position int, component_id string, score int")
    for name, table in (("full", docs), ("empty", docs.limit(0))):
        folder = f"{tmp_path}/{name}"
        table.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, folder).columns == docs.columns
        assert corpus_pipeline.run(spark, folder).count() == table.count()
    assert sorted(r.position for r in corpus_pipeline.hide_pii(spark, docs, "").collect()) == list(range(20))
