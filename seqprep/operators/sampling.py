"""Order, index, subset, cap and selection.

``key`` names the column (or columns) that identify a row. Nothing here sorts
in a single task: positions come from bucket or partition counts, and only
those counts (a bounded number of small rows) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from seqprep.functions.hashing import row_hash
from seqprep.session import write_shared

Key = str | Sequence[str]

# One hash bucket is sorted by one task; buckets are split until they are about
# this small. Four hexadecimal digits bound the number of buckets to 65,536.
ROWS_PER_BUCKET = 65_536
MAX_DIGITS = 4

# Largest top-k that may be held in memory; longer prefixes use the index.
TOP_K_LIMIT = 65_536


def _keys(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def order_hash(seed: int, key: Key) -> Column:
    """The pseudo-random but reproducible sort value of a row."""
    keys = [F.col(k).cast("string") for k in _keys(key)]
    if len(keys) > 1:  # with their lengths, so that no two keys give the same text
        keys = [F.coalesce(F.concat(F.char_length(k).cast("string"), F.lit("="), k), F.lit("-")) for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *keys))


def small_table(df: DataFrame, **columns: Iterable) -> DataFrame:
    """Driver-side columns as a table; Arrow keeps it out of any task."""
    types = {"_bucket": pa.string()}
    return df.sparkSession.createDataFrame(
        pa.table({name: pa.array(list(values), types.get(name, pa.int64())) for name, values in columns.items()})
    )


# --- global index ---------------------------------------------------------


def hash_index(df: DataFrame, seed: int, key: Key, name: str = "shuffle_idx") -> DataFrame:
    """Position of each row (from 0) in the order of its hash.

    The hash is uniform, so a fixed prefix of it cuts the rows into even
    buckets. One pass over the key counts the buckets, a second shuffles each
    row once to its bucket and numbers it there. No boundary is sampled, hence
    a recomputed partition is always the same one.
    """
    keys = _keys(key)
    hashed = order_hash(seed, keys)
    counted = df.groupBy(F.substring(hashed, 1, MAX_DIGITS).alias("bucket")).count().collect()
    total = sum(r["count"] for r in counted)
    digits = 1
    while digits < MAX_DIGITS and total > ROWS_PER_BUCKET * 16**digits:
        digits += 1
    sizes: dict[str, int] = {}
    for row in sorted(counted, key=lambda r: r["bucket"]):
        prefix = row["bucket"][:digits]
        sizes[prefix] = sizes.get(prefix, 0) + row["count"]
    starts = accumulate(sizes.values(), initial=0)
    offsets = small_table(df, _bucket=sizes, _start=list(starts)[:-1])
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", *keys))
    return (
        df.withColumn("_hash", hashed)
        .withColumn("_bucket", F.substring("_hash", 1, digits))
        .join(F.broadcast(offsets), "_bucket")  # at most 16**MAX_DIGITS rows
        .withColumn(name, F.col("_start") + place - 1)
        .drop("_bucket", "_hash", "_start")
    )


def sorted_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx") -> DataFrame:
    """Position of each row (from 0) in the given order.

    Range partitioning samples its boundaries, so the sorted rows are written
    to the shared folder once, each with its partition and place in it; the
    partition counts (one small row per partition) then turn that into a
    global position. One shuffle, no window.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    table = write_shared(placed, "sorted")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counted = sorted(table.groupBy(part.alias("part")).count().collect())
    starts = accumulate((r["count"] for r in counted), initial=0)
    offsets = small_table(df, _part=[r["part"] for r in counted], _start=list(starts)[:-1])
    return (
        table.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(name, F.col("_start") + place)
        .drop("_part", "_start", "_at")
    )


def shuffle(df: DataFrame, seed: int = 42, key: Key = "id") -> DataFrame:
    """Reproducible shuffle: the new position is the column ``shuffle_idx``."""
    return hash_index(df, seed, key)


# --- subsets --------------------------------------------------------------


def subset_size(length: int, fraction: float) -> int:
    """Rows to keep: the truncated product, at least 1 and at most all."""
    if length == 0 or fraction <= 0:
        return 0
    return min(max(int(length * fraction), 1), length)


def subset_predicate(df: DataFrame, fraction: float, seed: int = 42, key: Key = "id") -> Column:
    """The filter that keeps exactly ``subset_size`` rows of ``df``.

    The n rows with the smallest hash are the ones below a single hash value.
    That value is found by counting hash prefixes, three digits deeper each
    time, until its prefix is small: every step reads only the key and shuffles
    at most 4,096 counts per task. The subset itself is then a plain filter,
    with no shuffle of the data.
    """
    if fraction <= 0:
        return F.lit(False)
    if fraction >= 1:
        return F.lit(True)
    hashed = order_hash(seed, key)
    hashes = df.select(hashed.alias("hash"))
    prefix, need, size = "", None, None
    while size is None or size > TOP_K_LIMIT:
        if len(prefix) >= 30:
            raise ValueError(f"{key!r} does not identify a row: one value holds {size} rows")
        deeper = F.substring("hash", 1, len(prefix) + 3).alias("prefix")
        counted = sorted(hashes.filter(F.col("hash").startswith(prefix)).groupBy(deeper).count().collect())
        if need is None:
            total = sum(r["count"] for r in counted)
            need = subset_size(total, fraction)
            if need == 0:
                return F.lit(False)
            if need == total:
                return F.lit(True)
        for row in counted:
            prefix, size = row["prefix"], row["count"]
            if need <= size:
                break
            need -= size
    edge = hashes.filter(F.col("hash").startswith(prefix)).orderBy("hash").offset(need - 1).limit(2).collect()
    if len(edge) == 2 and edge[0]["hash"] == edge[1]["hash"]:
        raise ValueError(f"{key!r} does not identify a row")
    return hashed <= F.lit(edge[0]["hash"])


def get_subset(df: DataFrame, fraction: float, seed: int = 42, key: Key = "id") -> DataFrame:
    """An exact, reproducible share of the rows; smaller shares lie in larger ones."""
    return df.filter(subset_predicate(df, fraction, seed, key))


def max_samples(df: DataFrame, n: int | None, key: Key = "id") -> DataFrame:
    """The first ``n`` rows by key, exactly; None keeps all.

    Rows that share the n-th key are taken in the order of their contents' hash
    (any column type); rows with equal contents are interchangeable, and as many
    of them as are still wanted are made from one. Only keys and hashes are
    sorted; the rows are cut by filters, whatever n is, and none is shuffled.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    keys = _keys(key)
    found = _nth(df.select(*keys), keys, n)
    if found is None:
        return df
    last, before = found
    edge = F.struct(*[F.lit(last[k]).cast(df.schema[k].dataType).alias(k) for k in keys])
    own, tied = F.struct(*keys), df.filter(F.struct(*keys) == edge)
    hashes = [row_hash(tied, seed) for seed in (1, 2)]
    marked = tied.select(*[h.alias(f"_h{i}") for i, h in enumerate(hashes)])
    found = _nth(marked, marked.columns, n - before)
    if found is None:
        return df.filter(own <= edge)
    last, ahead = found
    place = F.struct(*[h.alias(f"_h{i}") for i, h in enumerate(hashes)])
    here = F.struct(*[F.lit(h).cast("long").alias(f"_h{i}") for i, h in enumerate(last)])
    copies = F.explode(F.sequence(F.lit(1), F.lit(n - before - ahead).cast("long")))
    equal = tied.filter(place == here).limit(1).withColumn("_copy", copies).repartition("_copy").drop("_copy")
    return df.filter(own < edge).unionByName(tied.filter(place < here)).unionByName(equal)


def _nth(rows: DataFrame, keys: Sequence[str], n: int):
    """The n-th row by key (from 1) and the number of rows with a smaller key; None when there are fewer."""
    indexed = sorted_index(rows, list(keys), "_idx")
    last = indexed.filter(F.col("_idx") == n - 1).select(*keys).head()
    if last is None:
        return None
    edge = F.struct(*[F.lit(last[k]).cast(rows.schema[k].dataType).alias(k) for k in keys])
    return last, indexed.filter(F.struct(*keys) < edge).count()


def nth_largest(df: DataFrame, col: str, n: int) -> tuple[int, int] | None:
    """The n-th largest value (from 1) of a column of whole numbers from 0, and how many rows are above it.

    None when there are fewer rows. One pass counts the rows per order of
    magnitude and leading twelve bits, at most 4,096 counts per task for values
    below 4,096 and 2,048 for each power of two above; those values are found by
    it, larger ones twelve bits deeper each time. No task or driver ever holds n
    rows.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    value = F.col(col).cast("long")
    level = F.greatest(F.length(F.bin(value)) - 12, F.lit(0))
    groups = level.alias("shift"), F.call_function("shiftright", value, level).alias("digits")
    inside, above = df.filter(value.isNotNull()), 0
    while True:
        for row in sorted(inside.groupBy(*groups).count().collect(), reverse=True):
            if above + row["count"] >= n:
                break
            above += row["count"]
        else:
            return None
        if not row["shift"]:
            return row["digits"], above
        inside = inside.filter(F.shiftright(value, row["shift"]) == row["digits"])
        shift = max(row["shift"] - 12, 0)
        groups = F.lit(shift).alias("shift"), F.shiftright(value, shift).alias("digits")


def head_rows(df: DataFrame, n: int = 5, key: Key = "id") -> DataFrame:
    """The first rows by key, for a report."""
    return df.orderBy(*_keys(key)).limit(n)


# --- run history ----------------------------------------------------------


def best_run(
    df: DataFrame, group: Key, metric: str, step: str = "step", greater_is_better: bool = False
) -> DataFrame:
    """Per group the step with the best metric; ties go to the lowest step.

    NaN metrics never win. One partial and one final aggregate.
    """
    value = F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double"))
    rank = F.struct((-value if greater_is_better else value).alias("v"), F.col(step).alias("s"))
    best = F.min(F.when(value.isNotNull(), rank))
    score = best["v"]
    return df.groupBy(*_keys(group)).agg(
        best["s"].alias(f"best_{step}"),
        (-score if greater_is_better else score).alias(f"best_{metric}"),
    )


def keep_last(df: DataFrame, group: Key, order: str, n: int = 3) -> DataFrame:
    """The newest ``n`` rows per group.

    Spark limits each group before the shuffle, so a huge group sends at most
    ``n`` rows per input partition.
    """
    rank = F.row_number().over(Window.partitionBy(*_keys(group)).orderBy(F.desc(order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def every_nth(df: DataFrame, step: str = "step", n: int = 10) -> DataFrame:
    """Every ``n``-th step of a logged series."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return df.filter(F.col(step) % n == 0)
