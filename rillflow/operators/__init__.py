"""Operators: DataFrame -> DataFrame building blocks of a batch."""
