"""Operators of a training-data pipeline, each a Spark job over a table of texts, pages or vectors.

Nothing outside this package imports it; ``queries`` registers one query per operator.
"""
