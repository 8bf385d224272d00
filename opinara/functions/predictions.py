"""Column expressions over a prediction table."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F


def positive_probability(probability: str = "probability") -> Column:
    """Probability of class 1, read from the vector without a Python worker."""
    return F.get(vector_to_array(F.col(probability)), F.lit(1))


def is_correct() -> Column:
    return (F.col("label") == F.col("prediction")).cast("int")


def verdict(prediction: Column) -> Column:
    return F.when(prediction == 1, "Positive").otherwise("Negative")


def confidence(positive: Column) -> Column:
    """Probability of the likelier class."""
    return F.greatest(positive, 1 - positive)
