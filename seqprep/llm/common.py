"""What several operators of this folder share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Words are runs of anything but ASCII white space (fixed pattern).
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def worker_cache(key: str, build: Callable[[], Any]) -> Any:
    """Built once per Python worker process, not once per task.

    The functions of this package travel by value, so their module globals are
    new in every task; the cache hangs on a module of its own. It holds one
    thing: a worker that goes on to another operator lets go of the last one's.
    """
    store = sys.modules.setdefault("_seqprep_worker_cache", types.ModuleType("_seqprep_worker_cache"))
    if getattr(store, "key", None) != key:
        store.key, store.value = None, None
        store.value = build()
        store.key = key
    return store.value


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what a step builds from a batch stays small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def append_struct(df: DataFrame, made: Column) -> DataFrame:
    """The fields of the struct column ``made`` after ``doc_id``, other columns dropped.

    Extra columns of the input can have any name: only ``doc_id`` and what
    ``made`` reads are looked at.
    """
    return df.select("doc_id", made.alias("_made")).select("doc_id", "_made.*")
