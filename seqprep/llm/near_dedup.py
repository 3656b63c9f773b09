"""MinHash near-duplicates with odd sketches.

1. Every text becomes a set of word shingles; 200 MinHash samples of it are cut
   into 40 bands of 5 and also folded into a parity bitmap (odd sketch) of 512
   bits. Texts with the same set (equal 128-bit fingerprint) are one class from
   here on, so exact copies cost nothing more.
2. Classes that share a band value are in one bucket. Small buckets give their
   pairs; a large bucket gives pairs with one pivot only. The population count
   of two odd sketches' XOR estimates the similarity, and pairs estimated far
   below the threshold are dropped. Every surviving class keeps its best pair
   first.
3. Pairs are confirmed on the full sets; links give connected components.
4. Pairs that still join different components are confirmed next, and members of
   large buckets outside the bucket's largest component with a pivot of it.
5. Large buckets with common members form crowds. Those of a crowd that are still
   outside its largest component are held against all of the crowd, block by
   block: a task takes two blocks of full sets, counts all intersections as
   products of 0/1 matrices, and returns a spanning forest of the links it found,
   fewer rows than it got. So no pair is ever a row, and texts that share bands
   but lie just below the threshold cost products, not rows.

What is guaranteed: links are exact, as they are confirmed on full sets. A pair
at the threshold 0.8 shares no band with probability 1.3e-7, and outside crowds
its estimate is cut off (below 0.6) with probability under 1e-8; both fall quickly
above it. Every pair that shares a band is tried, unless its ends are connected
already; within a crowd pairs without a common band are tried as well.

Skew: a bucket's pivot is a minimum that is combined before the shuffle; joins
with pivots have one row per key on that side and can be split; a group of many
near copies is linked through its pivots and never meets in one task. A crowd is
dealt to blocks of at most about ``CROWD_ROWS`` sets and ``CROWD_BYTES`` bytes; its
work is the number of members outside the largest component times that of all.
Texts are shuffled once, narrow.

Defined results: a null or empty text or one without words has an empty set, and
is linked with nothing; rows without ``doc_id`` are returned unlinked, with a null
component; rows that share a ``doc_id`` are documents of their own; repeated rows
are one class; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.llm.common import slices, worker_cache
from seqprep.llm.components import components, merged
from seqprep.llm.shingles import Shingler, blocks, common, mix
from seqprep.session import write_shared

BANDS, ROWS = 40, 5
SAMPLES = BANDS * ROWS
SKETCH_LONGS = 8
SKETCH_BITS = 64 * SKETCH_LONGS
#: Pairs whose estimated similarity is below this are not confirmed.
LEAST_ESTIMATE = 0.6
#: A bucket of at most this many classes gives all its pairs: with 40 bands a class is in 300 of them at most.
SMALL = 16
#: Larger buckets of the first bands give pairs with a pivot; near copies share most bands, so a few do.
PIVOT_BANDS = 12
#: Sets of a crowd in a block, their bytes, and elements compared at a time.
CROWD_ROWS, CROWD_BYTES, ELEMENTS = 512, 8 << 20, 4096

#: Documents sketched at a time.
ROWS_AT_ONCE = 512

# --- sketches ---------------------------------------------------------------------


class Sampler:
    """MinHash samples, band values and odd sketch of a set of hashes."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(1, 2**63, (SAMPLES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = rng.integers(0, 2**63, (SAMPLES, 1), dtype=np.uint64)
        self.salt = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64))
        self.band_salt = mix(np.arange(1001, 1001 + BANDS, dtype=np.uint64))

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(SAMPLES, np.iinfo(np.uint64).max)
        for part in blocks(hashes, 1024):
            least = np.minimum(least, (self.factor * part + self.shift).min(axis=1))
        return least

    def bands(self, samples: np.ndarray) -> np.ndarray:
        rows = samples.reshape(BANDS, ROWS)
        value = self.band_salt
        for k in range(ROWS):
            value = mix(value ^ rows[:, k])
        return value.view(np.int64)

    def sketch(self, samples: np.ndarray) -> np.ndarray:
        bits = np.zeros(SKETCH_BITS, np.uint8)
        places, times = np.unique(mix(samples ^ self.salt) % np.uint64(SKETCH_BITS), return_counts=True)
        bits[places.astype(np.intp)] = times & 1
        return np.packbits(bits).view(np.int64)


SKETCHES = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sketch array<long>"


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """One row per document; without words no fingerprint, bands or sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_cache(f"shingler_{width}", lambda: Shingler(width))
        sampler = Sampler()
        names = [p.split()[0] for p in SKETCHES.split(", ")]
        types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
        for batch in slices(batches, ROWS_AT_ONCE):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = shingler.shingles(text) if text else np.zeros(0, np.uint64)
                if len(hashes):
                    samples = sampler.samples(hashes)
                    rows.append((doc_id, len(hashes), *fingerprint(hashes), sampler.bands(samples), sampler.sketch(samples)))
                else:
                    rows.append((doc_id, 0, None, None, None, None))
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sketch, SKETCHES)


def most_differing_bits() -> int:
    """The expected population count at the least estimate: n/2 (1 - exp(-4k(1-J)/n))."""
    return int(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - LEAST_ESTIMATE) / SKETCH_BITS)))


def differing(a: Column, b: Column) -> Column:
    bits = F.lit(0)
    for k in range(SKETCH_LONGS):
        bits = bits + F.bit_count(a[k].bitwiseXOR(b[k]))
    return bits


# --- pairs ------------------------------------------------------------------------


def estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b, bits) that the odd sketches let pass."""
    once = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    own = nodes.select(F.col("node"), "sketch")
    joined = once.join(own.toDF("a", "sa"), "a").join(own.toDF("b", "sb"), "b")
    return joined.select("a", "b", differing(F.col("sa"), F.col("sb")).alias("bits")).filter(F.col("bits") <= most_differing_bits())


def bucket_pairs(members: DataFrame, small: int) -> DataFrame:
    """``members``: key, node, group, size, band. Pairs of different groups: all of a small bucket, with the pivot of a large one."""
    few = members.filter(F.col("size") <= small).select("key", "node", "group")
    every = few.toDF("key", "a", "_ga").join(few.toDF("key", "b", "_gb"), "key").filter("a < b and _ga <> _gb").select("a", "b")
    many = members.filter((F.col("size") > small) & (F.col("band") < PIVOT_BANDS))
    order = F.xxhash64("key", "node")
    pivots = many.groupBy("key").agg(F.min(F.struct(order.alias("o"), "node", "group")).alias("p")).select("key", "p.node", "p.group")
    star = with_row_of_key(many.select("key", "node", "group"), pivots.toDF("key", "b", "_gb"))
    return every.unionByName(star.filter("node <> b and group <> _gb").select(F.col("node").alias("a"), "b"))


def sized(rows: DataFrame, label: str) -> DataFrame:
    """``key, node, group, band`` with the bucket's size, buckets with more than one group only."""
    found = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("group").alias("_lo"), F.max("group").alias("_hi"))
    mixed = found.filter("_lo <> _hi").select("key", "size")
    return write_shared(with_row_of_key(rows, mixed), label)


def with_main(members: DataFrame) -> DataFrame:
    """Members (``key, node, group``) with the largest group of their key (``main``)."""
    counts = members.groupBy("key", "group").agg(F.count("*").alias("n"))
    most = counts.groupBy("key").agg(F.max(F.struct("n", "group")).alias("m"))
    return with_row_of_key(members, most.select("key", F.col("m.group").alias("main")))


#: Groups over which the members of one key are spread.
SALTS = 16


def with_row_of_key(members: DataFrame, rows: DataFrame) -> DataFrame:
    """Members (``key, node``) with the one row of their key, a key's members spread over ``SALTS`` groups."""
    salted = rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    return members.withColumn("_salt", salt).join(salted, ["key", "_salt"]).drop("_salt")


def outsider_stars(members: DataFrame) -> DataFrame:
    """Each member outside its bucket's largest group with a pivot of that group."""
    outside = members.filter("group <> main").select("key", "node")
    order = F.xxhash64("key", "node")
    pivots = members.filter("group = main").groupBy("key").agg(F.min(F.struct(order.alias("o"), "node")).alias("p"))
    return with_row_of_key(outside, pivots.select("key", F.col("p.node").alias("b"))).select(F.col("node").alias("a"), "b")


def regrouped(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, node, band`` with the component of the node as group."""
    known = labels.select("node", F.col("label").alias("_label"))
    return rows.select("key", "node", "band").join(known, "node", "left").select("key", "node", "band", F.coalesce("_label", "node").alias("group"))


# --- crowds -----------------------------------------------------------------------


def crowds(buckets: DataFrame) -> DataFrame:
    """``key, node``: the members (``key, node``) of buckets that are connected through common members, under one key."""
    hubs = buckets.groupBy("key").agg(F.min("node").alias("b"))
    spokes = with_row_of_key(buckets, hubs).select(F.col("node").alias("a"), "b").filter("a <> b").distinct()
    return components(spokes).select(F.col("label").alias("key"), "node")


def forest(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (a[x], b[y])."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while parent.setdefault(node, node) != node:
            parent[node] = node = parent[parent[node]]
        return node

    kept = []
    for k, (left, right) in enumerate(zip(a[x].tolist(), b[y].tolist())):
        one, other = root(left), root(right)
        if one != other:
            parent[one] = other
            kept.append(k)
    return a[x[kept]], b[y[kept]]


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    sizes = [len(s) for s in (*left, *right)]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, element, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    shared = times[element] > 1  # the others are in one set only
    renumbered = np.cumsum(times > 1) - 1
    owner, element = owner[shared], renumbered[element[shared]]
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(element[-1]) + 1 if len(element) else 0, ELEMENTS):
        a, b = np.searchsorted(element, [lo, lo + ELEMENTS])
        cells = np.zeros((len(sizes), ELEMENTS), np.float32)
        cells[owner[a:b], element[a:b] - lo] = 1
        both += cells[: len(left)] @ cells[len(left) :].T
    return both.astype(np.int64)


def crowd_links(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect members outside their crowd's largest group with any member of the crowd.

    ``crowd``: key, node, group. A member outside meets every block of its crowd
    once; each pair of blocks gives a spanning forest of its links.
    """
    members = with_main(crowd).join(sets, "node").withColumn("outside", F.col("group") != F.col("main"))

    def blocks_of(count: Column, size: Column) -> Column:
        return F.greatest(F.ceil(count / CROWD_ROWS), F.ceil(size / CROWD_BYTES)).cast("int")

    size = F.octet_length("hashes").cast("long")
    asked = F.when(F.col("outside"), 1)
    figures = members.groupBy("key").agg(
        blocks_of(F.count("*"), F.sum(size)).alias("all"),
        blocks_of(F.count(asked), F.coalesce(F.sum(F.when(F.col("outside"), size)), F.lit(0))).alias("asking"),
    )
    dealt = with_row_of_key(members, figures.filter("asking > 0"))
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    columns = ["node", "group", "hashes"]
    asking = dealt.filter("outside").select("key", block("asking").alias("i"), F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("j"), *columns, F.lit(True).alias("asks"))
    asked_of = dealt.select("key", F.explode(F.sequence(F.lit(0), F.col("asking") - 1)).alias("i"), block("all").alias("j"), *columns, F.lit(False).alias("asks"))

    def link(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        node, group = table.column("node").to_numpy(), table.column("group").to_numpy()
        held = [np.frombuffer(v.as_buffer(), np.uint64) for chunk in table.column("hashes").chunks for v in chunk]
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        x = y = np.zeros(0, np.int64)
        if len(left) and len(right):
            both = intersections([held[k] for k in left], [held[k] for k in right])
            sizes = np.array([len(s) for s in held], np.int64)
            together = sizes[left][:, None] + sizes[right][None, :] - both
            linked = (100 * both >= percent * together) & (group[left][:, None] != group[right][None, :])
            x, y = np.nonzero(linked)
        a, b = forest(node[left], node[right], x, y) if len(x) else (x, y)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return asking.unionByName(asked_of).groupBy("key", "i", "j").applyInArrow(link, "a long, b long")


def full_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node, hashes`` (sorted 64-bit numbers) of the wanted nodes, from one text of each."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_cache(f"shingler_{width}", lambda: Shingler(width))
        for batch in slices(batches, ROWS_AT_ONCE):
            sets = [shingler.shingles(t or "") for t in batch.column(0).to_pylist()]
            keys = [fingerprint(s) for s in sets]
            columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "hashes"])

    chosen = nodes.select("node", "k1", "k2", "first_id").join(wanted, "node", "left_semi")
    texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), "text").join(chosen.select("first_id").distinct(), "first_id", "left_semi")
    made = texts.select("text").mapInArrow(make, "k1 long, k2 long, hashes binary")
    return chosen.join(made, ["k1", "k2"]).select("node", "hashes").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union on full sets."""

    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left, right):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = common(x, y) if percent * max(len(x), len(y)) <= 100 * min(len(x), len(y)) else 0
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    joined = pairs.select("a", "b").join(sets.toDF("a", "_x"), "a").join(sets.toDF("b", "_y"), "b")
    return joined.filter(similar("_x", "_y")).select("a", "b")


# --- all together -------------------------------------------------------------------


def near_duplicates(docs: DataFrame, width: int = 2, percent: int = 80, small: int = SMALL) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    drawn = write_shared(sketches(docs, width), "sketches")
    classes = drawn.filter("k1 is not null and doc_id is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    nodes = write_shared(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "nodes")
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "key"), F.col("node").alias("group"))
    members = sized(keyed, "buckets")

    pairs = write_shared(estimated(bucket_pairs(members, small), nodes), "pairs")
    crowded = members.filter(F.col("size") > small).select("key", "node", "band")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowded.select("node")).distinct()
    sets = write_shared(full_sets(docs, nodes, wanted, width), "sets")

    ends = pairs.select(F.col("a").alias("node"), "a", "b", "bits").union(pairs.select("b", "a", "b", "bits"))
    best = ends.groupBy("node").agg(F.min(F.struct("bits", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    links = write_shared(confirmed(best, sets, percent), "links")
    labels = components(links)

    # Pairs between different components that have not been tried; members outside a large bucket's largest component with a pivot of it.
    own = labels.select("node", "label")
    rest = pairs.join(own.toDF("a", "_la"), "a", "left").join(own.toDF("b", "_lb"), "b", "left")
    rest = rest.filter(F.coalesce("_la", "a") != F.coalesce("_lb", "b")).join(best, ["a", "b"], "left_anti").select("a", "b")
    mixed = with_main(sized(regrouped(crowded, labels), "crowded"))
    stars = estimated(outsider_stars(mixed), nodes).select("a", "b")
    tried = write_shared(confirmed(rest.union(stars).distinct(), sets, percent), "links")
    labels = write_shared(merged(labels, tried), "labels")

    # Those that are still outside, with all of their crowd.
    mixed = sized(regrouped(crowded, labels), "crowded")
    found = regrouped(crowds(mixed.select("key", "node")).withColumn("band", F.lit(0)), labels)
    labels = write_shared(merged(labels, write_shared(crowd_links(found, sets, percent), "links")), "labels")

    named = labels.join(nodes.select("node", "first_id"), "node").select("node", F.col("label").alias("key"), "first_id")
    smallest = named.groupBy("key").agg(F.min("first_id").alias("component_id"))
    linked = with_row_of_key(named.select("key", "node"), smallest).select("node", "component_id")
    component = nodes.select("node", "k1", "k2", "first_id").join(linked, "node", "left")
    by_class = component.select("k1", "k2", F.coalesce("component_id", "first_id").alias("component_id"))
    found = drawn.select("doc_id", "n_shingles", "k1", "k2").join(by_class, ["k1", "k2"], "left")
    id_of = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", id_of.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without the near-duplicates of a smaller doc_id; columns as given.

    Of rows with the same doc_id and words, all stay or all go together.
    """
    judged = near_duplicates(docs, width, percent)
    gone = judged.filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
