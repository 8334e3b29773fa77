"""Standardising names and replacing key identifiers with hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: SHA-256 of the empty string: what a missing key becomes with null_key="keep".
EMPTY_HASH = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def rename_keys(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename source keys to canonical ones; absent names are ignored."""
    return df.withColumnsRenamed(names)


def prefix_columns(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    """Prefix every column that isn't a key, in one projection."""
    return df.select(*[F.col(f"`{c}`").alias(c if c in keys else f"{prefix}_{c}") for c in df.columns])


def hashed(key: Column, key_type: str = "string", null_key: str = "keep", salt: str = "") -> Column:
    """SHA-256 of a key cast to a declared type first, so that 1 and 1.0 of two sources agree.

    null_key: "keep" hashes a missing key as the empty string, so all missing keys are equal; "null" leaves it null.
    """
    text = key.cast(key_type).cast("string")
    digest = F.sha2(F.concat_ws("", F.lit(salt), text), 256)
    return digest if null_key == "keep" else F.when(text.isNotNull() & (text != ""), digest)


def pseudonymise(df: DataFrame, keys: list[str], key_types: dict[str, str] | None = None, null_key: str = "keep", salt: str = "") -> DataFrame:
    """Replace each key by <key>_hashed."""
    types = key_types or {}
    added = {f"{k}_hashed": hashed(F.col(k), types.get(k, "string"), null_key, salt) for k in keys if k in df.columns}
    return df.withColumns(added).drop(*keys)


def standardise_provider(df: DataFrame, prefix: str, names: dict[str, str], hashed_keys: list[str], key_types: dict[str, str] | None = None, null_key: str = "keep") -> tuple[DataFrame, DataFrame]:
    """(standard table, anonymous table): rename keys, prefix the rest, hash the given keys."""
    standard = prefix_columns(rename_keys(df, names), prefix, list(names.values()))
    return standard, pseudonymise(standard, hashed_keys, key_types, null_key)
