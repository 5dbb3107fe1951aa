"""Operators for preparing training data: one module per operator, all of them DataFrame in, DataFrame out."""
