"""Salted hashing of personal identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK_PATTERN = "^[0-9a-f]{32}$"


def mask(value: str, salt: str) -> Column:
    """First 32 hex digits of SHA-256 over ``salt:value``; NULL stays NULL."""
    return F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), F.col(value).cast("string")), 256), 1, 32)


def masked_key(df: DataFrame, salt: str, column: str = "user_id") -> DataFrame:
    """``df`` with a personal key masked; equal keys and salts give equal masks, so masked tables still join."""
    return df.withColumn(column, mask(column, salt))


def short_id(value: str, salt: str, prefix: str) -> Column:
    """``prefix`` and the first 12 hex digits of the mask."""
    return F.concat(F.lit(prefix), F.substring(mask(value, salt), 1, 12))
