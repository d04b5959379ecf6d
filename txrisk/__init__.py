"""Scoring of imbalanced transaction data on Spark, in batch and in streams."""
