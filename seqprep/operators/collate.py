"""Batches for a training feed: assignment, dynamic padding, teacher forcing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from seqprep.functions import arrays as A
from seqprep.operators.guards import require_columns
from seqprep.operators.sampling import MAX_DIGITS, Key, _keys, hash_index, order_hash, small_table, sorted_index
from seqprep.options import BOS_ID, IGNORE_ID, PAD_ID
from seqprep.session import group_by_group, write_shared

COLLATED_COLUMNS = ("src_tokens", "tgt_tokens_input", "tgt_tokens_target", "attention_mask")


def assign_batches(
    df: DataFrame,
    batch_size: int,
    devices: int = 1,
    accum: int = 1,
    key: Key = "id",
    seed: int | None = None,
    measure: Sequence[str] = (),
) -> DataFrame:
    """Adds ``batch_id`` and ``pos_in_batch``; the last batch may be short.

    Rows are taken in key order, or shuffled when a ``seed`` is given. The
    effective batch is ``batch_size * devices * accum``. ``measure`` names
    array columns whose longest length per batch is wanted as well
    (``longest_<column>``), which spares ``pad_batch`` its shuffle.

    Only keys and lengths are ordered and numbered; the wide rows meet their
    place in one equi-join by a tag, so rows with equal or NULL keys each keep a
    place of their own. The tagged rows are written to the shared folder, which
    also spares evaluating ``df`` anew for each pass. Shuffled rows that need no
    lengths are numbered directly.
    """
    size = batch_size * devices * accum
    if size < 1:
        raise ValueError("the effective batch size must be at least 1")
    keys = _keys(key)
    if seed is not None and not measure:
        return _place(hash_index(df, seed, keys, "_idx"), size)
    tagged = write_shared(df.withColumn("_row", F.monotonically_increasing_id()), "tagged")
    narrow = tagged.select("_row", *keys, *[F.size(c).alias(_longest(c)) for c in measure])
    order = sorted_index(narrow, [*keys, "_row"], "_idx") if seed is None else hash_index(narrow, seed, keys, "_idx")
    placed = _place(order, size).drop(*keys)
    if measure:
        batch = Window.partitionBy("batch_id")
        placed = placed.withColumns({_longest(c): F.max(_longest(c)).over(batch) for c in measure})
    # The places, a few numbers a row, are hashed, so the wide rows needn't be sorted to meet them.
    return tagged.join(placed.hint("shuffle_hash"), "_row").drop("_row")


def clustered_batches(
    df: DataFrame,
    batch_size: int,
    devices: int = 1,
    accum: int = 1,
    key: Key = "id",
    seed: int | None = 42,
    batches_per_part: int = 64,
) -> DataFrame:
    """``assign_batches`` with whole batches side by side: adds ``feed_part`` as well.

    A part holds ``batches_per_part`` batches in a row (more when there would be
    over ``MOST_PARTS`` parts) and lies in one task, sorted by batch and place.
    Padding and stacking need no further shuffle, and a reader finds batch ``b``
    in part ``b div batches_per_part`` (``write_feed``, ``read_batches``).

    Shuffled rows travel once. Their order is that of a uniform hash, so the
    rows that start a part can be looked up first: rows are counted per hash
    prefix, and only hashes and tags are sorted, prefix by prefix. The starts, at
    most ``MOST_PARTS`` of them, then tell every row its part, and a row's number
    within the part its batch. Rows in key order are placed by ``assign_batches``
    and moved to their part in a second shuffle.
    """
    size = batch_size * devices * accum
    if size < 1 or batches_per_part < 1:
        raise ValueError("the effective batch size and the batches per part must be at least 1")
    keys = _keys(key)
    if seed is None:
        return cluster_batches(assign_batches(df, batch_size, devices, accum, keys), batches_per_part)
    tagged = write_shared(df.withColumn("_row", F.monotonically_increasing_id()), "tagged")
    hashed = tagged.withColumn("_hash", order_hash(seed, keys)).withColumn("_bucket", F.substring("_hash", 1, MAX_DIGITS))
    counted = sorted(hashed.groupBy("_bucket").count().collect())  # 16**MAX_DIGITS rows at most
    total = sum(r["count"] for r in counted)
    per_part = size * max(batches_per_part, -(-total // (size * MOST_PARTS)))
    # Parts that start before and inside each bucket.
    before, first, at = [], [], 0
    for row in counted:
        before.append(-(-at // per_part))
        first.append(-at % per_part + 1)
        at += row["count"]
    buckets = small_table(df, _bucket=[r["_bucket"] for r in counted], _before=before, _first=first)
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", "_row"))
    narrow = hashed.select("_bucket", "_hash", "_row").withColumn("_place", place).join(F.broadcast(buckets), "_bucket")
    starts = narrow.filter((F.col("_place") >= F.col("_first")) & ((F.col("_place") - F.col("_first")) % per_part == 0))
    inside = starts.groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct("_hash", "_row"))).alias("_starts"))
    known = write_shared(buckets.join(inside, "_bucket", "left").select("_bucket", "_before", "_starts"), "starts")
    reached = F.size(F.filter(F.coalesce("_starts", F.array().cast(known.schema["_starts"].dataType)), lambda s: s <= F.struct("_hash", "_row")))
    parted = hashed.join(F.broadcast(known), "_bucket").withColumn("feed_part", F.col("_before") + reached - 1)
    number = F.row_number().over(Window.partitionBy("feed_part").orderBy("_hash", "_row"))
    placed = _place(parted.withColumn("_idx", F.col("feed_part") * per_part + number - 1), size)
    return placed.drop("_row", "_hash", "_bucket", "_before", "_starts")


#: Parts of a feed.
MOST_PARTS = 65_536


def cluster_batches(df: DataFrame, batches_per_part: int = 64, by: str = "batch_id") -> DataFrame:
    """Rows with a batch, moved so that each part of that many batches lies in one task, in order."""
    part = F.floor(F.col(by) / batches_per_part).cast("long")
    return df.withColumn("feed_part", part).repartition("feed_part").sortWithinPartitions("feed_part", by, "pos_in_batch")


def _batch_columns(df: DataFrame, by: str) -> list[str]:
    """What identifies a batch; with its part the rows are known to lie together."""
    return [*(c for c in ("feed_part",) if c in df.columns), by]


def _longest(col: str) -> str:
    return f"longest_{col}"


def _place(indexed: DataFrame, size: int) -> DataFrame:
    return indexed.withColumns(
        {
            "batch_id": F.floor(F.col("_idx") / size).cast("long"),
            "pos_in_batch": (F.col("_idx") % size).cast("int"),
        }
    ).drop("_idx")


def pad_batch(df: DataFrame, cols: str | Sequence[str], pad: int = PAD_ID, by: str = "batch_id") -> DataFrame:
    """Pad array columns to the longest array of that column in the batch.

    Lengths measured by ``assign_batches`` are used and dropped; otherwise one
    shuffle by batch finds them, whatever the number of columns, and none when
    the rows are clustered. A batch is small by definition.
    """
    names = [cols] if isinstance(cols, str) else list(cols)
    padded = {c: A.pad_to(F.col(c), F.col(_longest(c)), pad) for c in names}
    return _measured(df, names, by).withColumns(padded).drop(*[_longest(c) for c in names])


def _measured(df: DataFrame, names: Sequence[str], by: str) -> DataFrame:
    """The rows with the longest length per batch of each named column."""
    order = ["pos_in_batch"] if "pos_in_batch" in df.columns else [by]
    whole = Window.partitionBy(*_batch_columns(df, by)).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({_longest(c): F.max(F.size(c)).over(whole) for c in names if _longest(c) not in df.columns})


def stack_batches(df: DataFrame, cols: Sequence[str] = COLLATED_COLUMNS, by: str = "batch_id") -> DataFrame:
    """One row per batch; each column becomes a matrix in batch order.

    Padded and clustered rows lie sorted by batch, so a task holds one batch at a time.
    """
    group_by_group(df.sparkSession)
    rows = F.sort_array(F.collect_list(F.struct("pos_in_batch", *cols)))
    columns = _batch_columns(df, by)
    stacked = df.groupBy(*columns).agg(rows.alias("_rows"))
    return stacked.select(*columns, *[F.col(f"_rows.{c}").alias(c) for c in cols])


def collate(
    df: DataFrame, bos: int = BOS_ID, pad: int = PAD_ID, alignment: str = "reference", by: str = "batch_id"
) -> DataFrame:
    """Encoded rows with a batch to model inputs, padded per batch.

    ``alignment="reference"`` shifts the target one further than the input
    (target i is label i+1); ``"aligned"`` makes target i the label i.
    """
    if alignment not in ("reference", "aligned"):
        raise ValueError(f"unknown alignment {alignment!r}")
    require_columns(df, ("input_ids", "attention_mask", "labels", by, "pos_in_batch"))
    names = ["input_ids", "labels"]
    measured = _measured(df, names, by)
    source, labels = F.col(_longest("input_ids")), F.col(_longest("labels"))
    target, length = (A.target_tail(F.col("labels")), labels - 1) if alignment == "reference" else (F.col("labels"), labels)
    # A batch may be mostly padding, so only a row's own ids are masked one by one.
    return measured.select(
        *[c for c in df.columns if c not in ("input_ids", "attention_mask", "labels", *map(_longest, names))],
        A.pad_to(F.col("input_ids"), source, pad).alias("src_tokens"),
        A.shift_right(A.pad_to(F.col("labels"), labels, pad), bos).alias("tgt_tokens_input"),
        A.pad_to(A.ignore_mask(target, pad), length, IGNORE_ID).alias("tgt_tokens_target"),
        A.pad_to(F.col("attention_mask"), F.when(F.col("input_ids").isNotNull(), source), 0).alias("attention_mask"),
    )


def non_pad(df: DataFrame, col: str, pad: int = PAD_ID, key: Key = "id") -> DataFrame:
    """One row per position that is not padding."""
    return df.select(*_keys(key), F.posexplode(col).alias("pos", "token_id")).filter(F.col("token_id") != pad)


# --- stored feeds -----------------------------------------------------------


def feed_map(feed: DataFrame, by: str = "batch_id") -> DataFrame:
    """One row per part: its first and last batch and its rows."""
    return feed.groupBy("feed_part").agg(F.min(by).alias("first_batch"), F.max(by).alias("last_batch"), F.count("*").alias("n_rows"))


def write_feed(feed: DataFrame, path: str) -> None:
    """Store clustered batches, a folder per part, with their map."""
    rows, found = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/map"
    feed.write.partitionBy("feed_part").mode("overwrite").parquet(rows)
    stored = feed.sparkSession.read.parquet(rows).select("feed_part", "batch_id")
    feed_map(stored).coalesce(1).write.mode("overwrite").parquet(found)  # MOST_PARTS rows at most


def read_batches(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """Batches ``first`` to ``last`` of a stored feed; only the folders of their parts are read."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows")
    wanted = F.col("batch_id") >= first
    found = spark.read.parquet(f"{path.rstrip('/')}/map").filter(F.col("last_batch") >= first)
    if last is not None:
        wanted, found = wanted & (F.col("batch_id") <= last), found.filter(F.col("first_batch") <= last)
    parts = found.agg(F.min("feed_part").alias("a"), F.max("feed_part").alias("b")).head()
    if parts["a"] is None:
        return rows.limit(0)
    return rows.filter(F.col("feed_part").between(parts["a"], parts["b"]) & wanted)
