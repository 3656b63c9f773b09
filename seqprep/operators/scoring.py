"""User-supplied Python on every row, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed value: what a failed row shows instead of a translation.
FAILED = "[Translation failed]"


def score(
    df: DataFrame,
    col: str,
    predictor_factory: Callable[[], Callable[[str], str]],
    on_error: str = FAILED,
    out: str = "translation",
) -> DataFrame:
    """Apply a text-to-text predictor to a column, row by row.

    The predictor is built once per task. A row that fails gets ``on_error``
    and its message in ``error``; the others go on. Only the text column
    travels to Python.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = predictor_factory()

        def guarded(text):
            try:
                return predict(text), None
            except Exception as error:  # noqa: BLE001 - any failure is the row's own
                return on_error, f"{type(error).__name__}: {error}"

        for texts in batches:
            yield pd.DataFrame([guarded(t) for t in texts], columns=[out, "error"], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    scored = F.pandas_udf(run, f"`{out}` string, error string")
    return df.withColumn("_scored", scored(F.col(col))).select(
        *df.columns, F.col(f"_scored.{out}").alias(out), F.col("_scored.error").alias("error")
    )


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, batch_rows: int = 1024
) -> DataFrame:
    """Apply a function to Arrow batches of at most ``batch_rows`` rows."""
    if batch_rows < 1:
        raise ValueError("batch_rows must be at least 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                yield fn(batch.slice(start, batch_rows))

    return df.mapInArrow(run, schema)
