"""Operators for preparing large text collections for model training."""
