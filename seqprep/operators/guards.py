"""Checks on a table before it is used."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

ENCODED_COLUMNS = ("input_ids", "attention_mask", "labels")


def require_columns(df: DataFrame, columns: Sequence[str] = ENCODED_COLUMNS, strict: bool = True) -> DataFrame:
    """Schema check without a job: raise, or only warn when not ``strict``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        message = f"missing columns {missing}; found {df.columns}"
        if strict:
            raise ValueError(message)
        warnings.warn(message, stacklevel=2)
    return df


def is_empty(df: DataFrame) -> bool:
    """True when the table has no row (stops at the first one)."""
    return df.isEmpty()


def nan_in(scores: Column) -> Column:
    """True when the array is NULL or holds a NaN or a NULL."""
    return F.coalesce(F.exists(scores, lambda x: F.isnan(x) | x.isNull()), F.lit(True))


def has_nan(df: DataFrame, col: str, name: str = "has_nan") -> DataFrame:
    """One row: does any array of the column hold a NaN?"""
    return df.agg(F.coalesce(F.bool_or(nan_in(F.col(col))), F.lit(False)).alias(name))
