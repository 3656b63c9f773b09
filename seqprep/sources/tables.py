"""Vector tables, metric records and the sample report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType

from seqprep.operators.sampling import Key, _keys, head_rows
from seqprep.session import write_shared


def read_vectors(
    spark: SparkSession, path: str, id_col: str = "token_id", vector_col: str = "embedding"
) -> DataFrame:
    """Token vectors as ``token_id, embedding``; other columns are not read."""
    return spark.read.parquet(path).select(
        F.col(id_col).cast("long").alias("token_id"), F.col(vector_col).cast("array<float>").alias("embedding")
    )


def read_parameters(
    spark: SparkSession, path: str, tensor_col: str = "tensor", values_col: str = "values", trainable_col: str | None = "trainable"
) -> DataFrame:
    """Named parameter tensors as ``tensor, trainable, values``; other columns are not read.

    A tensor may lie in many rows, each with a part of its values; nested arrays
    are laid end to end. Without a column that says so every tensor is trainable.
    """
    table = spark.read.parquet(path)
    values, kind = F.col(values_col), table.schema[values_col].dataType
    while isinstance(kind, ArrayType) and isinstance(kind.elementType, ArrayType):
        values, kind = F.flatten(values), kind.elementType
    trainable = F.lit(True) if trainable_col is None else F.col(trainable_col).cast("boolean")
    return table.select(F.col(tensor_col).cast("string").alias("tensor"), trainable.alias("trainable"), values.cast("array<float>").alias("values"))


def write_metrics(df: DataFrame, path: str, kind: str, fmt: str = "json") -> None:
    """Append a metrics record (one row) under its kind, "train" or "eval"."""
    if fmt not in ("json", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    record = df.withColumn("kind", F.lit(kind)).withColumn("logged_at", F.current_timestamp())
    record.coalesce(1).write.mode("append").format(fmt).save(path)


def failed_metrics(spark: SparkSession, names: tuple[str, ...] = ("bleu", "gen_len", "bp", "eval_loss")) -> DataFrame:
    """The record of a failed evaluation: NaN for every metric, columns as in the report."""
    return spark.range(1).select(*[F.lit(float("nan")).alias(n) for n in names])


def sample_report(src: DataFrame, ref: DataFrame, pred: DataFrame, n: int = 5, key: Key = "id") -> DataFrame:
    """Source, reference and prediction of the first ``n`` rows side by side.

    The rows are picked first and written once; only those few keys are then
    looked up in the other two tables, so neither is shuffled.
    """
    keys = _keys(key)
    first = write_shared(head_rows(src, n, keys), "sample")
    wanted = F.broadcast(first.select(*keys))  # n rows
    found = [other.join(wanted, keys) for other in (ref, pred)]
    return first.join(found[0], keys, "left").join(found[1], keys, "left")
