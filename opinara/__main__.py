"""``spark-submit``/``python -m opinara JOB ...``: run one of the jobs by path."""

from __future__ import annotations

import argparse

from opinara import jobs
from opinara.plans.studies import PARALLEL, default_grid
from opinara.session import session
from opinara.settings import FeatureSettings, SourceSettings


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="opinara", description=__doc__)
    commands = top.add_subparsers(dest="job", required=True)
    for name in ("profile", "train", "scaling", "errors"):
        command = commands.add_parser(name)
        command.add_argument("--train", default=SourceSettings.train_path)
        command.add_argument("--test", default=SourceSettings.test_path)
        command.add_argument("--fraction", type=float, default=1.0, help="share of rows to use")
        command.add_argument("--format", choices=["parquet", "csv"], help="default: by the paths' endings")
        command.add_argument("--header", action="store_true", help="CSV files begin with column names")
        command.add_argument("--single-line", action="store_true", help="no text in CSV holds a line break")
        command.add_argument("--out", required=True)
        if name == "errors":
            command.add_argument("--model", required=True)
        if name in ("train", "scaling"):
            command.add_argument("--vocab-size", type=int, default=FeatureSettings.vocab_size, help="terms, or hash slots")
            command.add_argument("--min-df", type=float, default=FeatureSettings.min_df, help="documents, below 1 their share")
            command.add_argument("--ngram", type=int, default=FeatureSettings.ngram, help="words of an n-gram")
        if name == "train":
            command.add_argument("--tree-vocab-size", type=int, help="terms for the tree models, if not as many")
            command.add_argument("--parallel", type=int, default=PARALLEL, help="runs that share the cluster")
    export = commands.add_parser("export")
    export.add_argument("--model", required=True)
    export.add_argument("--out", required=True)
    upstream = commands.add_parser("conform")
    upstream.add_argument("--source", required=True)
    upstream.add_argument("--out", required=True)
    upstream.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    upstream.add_argument("--expect", type=int, help="fail unless there are this many rows")
    return top


def main(arguments: list[str] | None = None) -> object:
    given = parser().parse_args(arguments)
    spark = session()
    if given.job == "conform":
        return jobs.conform_job(spark, given.source, given.out, given.format, given.expect)
    if given.job == "export":
        return jobs.export_job(spark, given.model, given.out)
    sources = SourceSettings(
        given.train, given.test, sample_fraction=given.fraction,
        fmt=given.format, header=given.header, multiline=not given.single_line,
    )
    if given.job == "errors":
        return jobs.error_job(spark, sources, given.model, given.out)
    if given.job == "profile":
        return jobs.profile_job(spark, sources, given.out)
    settings = FeatureSettings(given.vocab_size, given.min_df, given.ngram)
    if given.job == "scaling":
        return jobs.scaling_job(spark, sources, given.out, settings=settings)
    trees = FeatureSettings(given.tree_vocab_size, given.min_df, given.ngram) if given.tree_vocab_size else None
    return jobs.train_job(spark, sources, given.out, default_grid(settings, trees), parallel=given.parallel)


if __name__ == "__main__":
    print(main())
