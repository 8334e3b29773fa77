"""Fitted tables applied to a stream: stateless joins with small static tables, nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tributary.operators.encode import ordinal


def encode_stream(stream: DataFrame, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """Ordinal codes for a streaming table from fitted dictionaries; unseen values get -1."""
    for column, fitted in dictionaries.items():
        stream = ordinal(stream, column, fitted)
    return stream
