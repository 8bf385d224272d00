"""Plain settings objects. Every operator also takes its parameters directly."""

from __future__ import annotations

from dataclasses import dataclass, field

# The defaults every run is compared under.
SEED = 42
REVIEW_SCHEMA = "polarity INT, title STRING, text STRING"


@dataclass(frozen=True)
class SessionSettings:
    app_name: str = "opinara"
    # None leaves what spark-submit was given.
    driver_memory: str | None = None
    executor_memory: str | None = None
    extra: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class SourceSettings:
    train_path: str = "data/train.parquet"
    test_path: str = "data/test.parquet"
    schema: str = REVIEW_SCHEMA
    sample_fraction: float = 1.0
    # None picks the format by each path's ending.
    fmt: str | None = None
    header: bool = False
    multiline: bool = True


@dataclass(frozen=True)
class FeatureSettings:
    vocab_size: int = 65_536
    min_df: float = 5
    ngram: int = 2

