"""Hashes of whole rows, whatever their columns hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_holds_map(f.dataType) for f in kind.fields)


def _leaves(value: Column, kind: T.DataType) -> list[Column]:
    """Columns a hash function takes, with a flag for each NULL, which hash functions skip."""
    if isinstance(kind, T.StructType):
        return [value.isNull(), *(leaf for f in kind.fields for leaf in _leaves(value.getField(f.name), f.dataType))]
    if isinstance(kind, T.MapType) and not _holds_map(kind.valueType):
        value = F.array_sort(F.map_entries(value))  # a map has no order
    if isinstance(kind, (T.MapType, T.ArrayType)):
        return [value.isNull(), F.to_json(F.struct(value.alias("v")))]
    return [value.isNull(), value]


def row_leaves(df: DataFrame) -> list[Column]:
    """Every column of ``df`` as columns that can be hashed."""
    return [leaf for f in df.schema.fields for leaf in _leaves(df[f"`{f.name}`"], f.dataType)]


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """64 bits of a row's contents; rows with equal contents have equal hashes."""
    return F.xxhash64(F.lit(seed), *row_leaves(df))


def multiset_fingerprint(df: DataFrame) -> str:
    """A value that changes with any row and with how often it occurs; one pass of partial sums.

    The row count and two sums of independent row hashes, which unlike XOR do
    not cancel for a row that occurs twice.
    """
    sums = [F.sum(row_hash(df, seed).cast("decimal(20,0)")).alias(f"s{seed}") for seed in (1, 2)]
    found = df.agg(F.count("*").alias("n"), *sums).head()
    return "-".join([str(found["n"]), *(f"{int(found[s] or 0) % 2**128:032x}" for s in ("s1", "s2"))])
