"""Review-text profiling, classification and evaluation as Spark DataFrame operators."""
