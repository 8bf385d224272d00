from pyspark.sql import functions as F

from opinara.catalog.tables import KEY
from opinara.plans.models import full_pipeline
from opinara.settings import FeatureSettings
from opinara.streaming.scoring import BATCH, COUNTS, REJECTED, BatchWriter, read_sink, review_stream, score_stream, verdicts


def test_stream_equals_batch_and_resumes(spark, small_reviews, small_dir, tmp_path):
    model = full_pipeline("count_vectorizer", "naive_bayes", FeatureSettings(min_df=3)).fit(small_reviews)
    documents = spark.read.parquet(f"{small_dir}/documents.parquet").select(KEY, "text")
    blank = spark.createDataFrame([(-1, "  \n")], documents.schema)
    source, sink, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))

    def run():
        stream = review_stream(spark, source, documents.schema, files_per_batch=2)
        score_stream(stream, model, KEY, sink, progress).awaitTermination()
        return {tuple(row) for row in read_sink(spark, sink).drop(BATCH).collect()}

    first, second = documents.filter(F.col(KEY) < 100), documents.filter(F.col(KEY) >= 100)
    first.unionByName(blank).repartition(5).write.parquet(source)
    batch = {tuple(row) for row in verdicts(first, model, KEY).collect()}
    assert run() == batch and len(batch) == 100

    second.write.mode("append").parquet(source)
    assert run() == {tuple(row) for row in verdicts(documents, model, KEY).collect()}
    assert read_sink(spark, sink).count() == documents.count()
    assert [r[KEY] for r in read_sink(spark, sink, REJECTED).collect()] == [-1]
    counts = read_sink(spark, sink, COUNTS).agg(*[F.sum(c) for c in ("n_read", "n_scored", "n_rejected")]).first()
    assert tuple(counts) == (documents.count() + 1, documents.count(), 1)


def test_a_replayed_batch_changes_nothing(spark, small_reviews, small_dir, tmp_path):
    model = full_pipeline("count_vectorizer", "naive_bayes", FeatureSettings(min_df=3)).fit(small_reviews)
    own = spark.newSession()
    documents = own.read.parquet(f"{small_dir}/documents.parquet").select(KEY, "text")
    odd = own.createDataFrame([(-1, None), (-2, ""), (-3, " \t")], documents.schema)
    batches = [documents.filter(F.col(KEY) % 2 == i).unionByName(odd.limit(i)) for i in (0, 1)] + [odd]
    sink = str(tmp_path / "out")
    write = BatchWriter(model, KEY, sink)

    def state():
        names = ("verdicts", REJECTED, COUNTS)
        return [sorted(map(str, read_sink(spark, sink, name).collect())) for name in names]

    for number, batch in enumerate(batches):
        write(batch, number)
    before = state()
    for number in (1, 0, 2, 1):
        write(batches[number].repartition(3), number)
    assert state() == before
    counts = {r[BATCH]: (r.n_read, r.n_scored, r.n_rejected) for r in read_sink(spark, sink, COUNTS).collect()}
    assert counts[2] == (3, 0, 3) and all(read == scored + rejected for read, scored, rejected in counts.values())
