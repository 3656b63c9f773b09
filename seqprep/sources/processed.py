"""Processed sets: written once under a key, reused while the options match."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from seqprep.options import PrepOptions

PROCESSED_SPLITS = ("train", "val")


def _paths(root: str, key: str) -> tuple[str, str]:
    base = f"{root.rstrip('/')}/{key.replace('/', '_')}"
    return f"{base}/data", f"{base}/manifest"


def write_processed(df: DataFrame, root: str, key: str, manifest: dict[str, str] | None = None) -> str:
    """Write encoded rows by split; returns the folder.

    The old manifest is emptied first and the new one written last, so a run
    that dies in between leaves no set that looks complete.
    """
    data, note = _paths(root, key)
    spark = df.sparkSession
    _write_manifest(spark, note, {})
    df.write.partitionBy("split").mode("overwrite").parquet(data)
    _write_manifest(spark, note, {"complete": "true", **(manifest or {})})
    return data


def _write_manifest(spark: SparkSession, path: str, entries: dict[str, str]) -> None:
    rows = spark.createDataFrame(sorted(entries.items()), "name string, value string")
    rows.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, root: str, key: str) -> dict[str, str]:
    """The manifest of a processed set; empty when there is none."""
    try:
        rows = spark.read.schema("name string, value string").json(_paths(root, key)[1]).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["name"]: r["value"] for r in rows}


def read_processed(spark: SparkSession, root: str, key: str) -> DataFrame:
    """Scan of a processed set."""
    return spark.read.parquet(_paths(root, key)[0])


def load_or_prepare(
    spark: SparkSession,
    opts: PrepOptions,
    root: str,
    build: Callable[[], DataFrame],
    fingerprint: str = "",
) -> DataFrame:
    """The processed set, built when it is missing or no longer matches.

    A match takes a complete set with rows in both splits, the same options
    and the same vocabulary ``fingerprint``. A reused set is not subset again.
    ``opts.overwrite_cache`` always rebuilds.
    """
    key = opts.cache_key
    wanted = {**opts.manifest(), "vocabulary": fingerprint}
    if not opts.overwrite_cache:
        found = read_manifest(spark, root, key)
        if found.pop("complete", None) == "true" and found == wanted:
            cached = read_processed(spark, root, key)
            if all(not cached.filter(F.col("split") == s).isEmpty() for s in PROCESSED_SPLITS):
                return cached
    write_processed(build(), root, key, wanted)
    return read_processed(spark, root, key)
