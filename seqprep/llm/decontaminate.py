"""Benchmark decontamination with SimHash windows and a multi-index over Hamming blocks.

Texts become arrays of word hashes (lower-cased runs of letters and digits). A
window as long as a benchmark item can only be similar to it if the two share a
shingle, and the similarity of an item with all windows of its length is largest
at a window that begins or ends with a shared shingle; those windows are formed.
Each gets a 64-bit SimHash of its words. Fingerprints within ``RADIUS`` bits of
an item's agree in at least one of ``RADIUS + 1`` blocks, so an equi-join on
(length, block, value) finds all of them. Pairs found are verified by the exact
weighted similarity of their shingles: sum of smaller counts over sum of larger
counts, at least ``percent``/100.

DataFrame functions only. The corpus is read once per block of the benchmark and
not shuffled: shared shingles are a set test inside the row. Only windows that
passed verification are shuffled, to pick the best per document and item. The
benchmark is worked through in blocks of bounded size, and only a block's tables
are sent to the tasks. Long texts are cut into overlapping segments first.

Defined results: null or empty texts and items have no words and match nothing;
items with fewer words than a shingle are one shingle; documents shorter than an
item are one window; rows that share a ``doc_id`` give one row per item; of equal
windows the first is reported; empty tables give an empty table; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Fingerprints at the threshold differ in about 9.5 of 64 bits, with a deviation of 2.9.
RADIUS = 23
BLOCKS = RADIUS + 1
BITS = 64
#: Shingles of a block of the benchmark, and words of a segment.
MOST_SHINGLES = 20_000
SEGMENT = 4096
#: Words of an item, at most: counts of a bit fit a lane of 15 bits.
MOST_WORDS = 32_767

LANES, LANE = 4, 15


def word_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(words: str | Column, width: int) -> Column:
    """Hashes of the ``width``-word shingles of an array of word hashes."""
    words = F.col(words) if isinstance(words, str) else words
    count = F.size(words) - (width - 1)
    places = F.when(count > 0, F.sequence(F.lit(1), F.greatest(count, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice(words, i, width)))


def simhash(words: str) -> Column:
    """Bit b is set when more than half of the words' hashes have it.

    The counts of four bits share one number, a lane of 15 bits each.
    """
    spread = ", ".join(f"{sum(((v >> j) & 1) << (LANE * j) for j in range(LANES))}L" for v in range(1 << LANES))
    numbers = range(BITS // LANES)
    zero = ", ".join(f"'n{i}', 0L" for i in numbers)
    added = ", ".join(f"'n{i}', t.n{i} + get(array({spread}), cast(shiftright(w, {LANES * i}) & 15 as int))" for i in numbers)
    bits = " | ".join(
        f"if((shiftright(c.n{b // LANES}, {LANE * (b % LANES)}) & {(1 << LANE) - 1}) * 2 > size({words}), shiftleft(1L, {b}), 0L)" for b in range(BITS)
    )
    return F.expr(f"aggregate({words}, named_struct({zero}), (t, w) -> named_struct({added}), c -> {bits})")


def block_values(fingerprint: str) -> Column:
    """Array of the blocks' values; the first blocks are one bit longer than the last."""
    long_blocks = BITS % BLOCKS
    values, at = [], 0
    for k in range(BLOCKS):
        size = BITS // BLOCKS + (k < long_blocks)
        values.append(f"cast(shiftright({fingerprint}, {at}) & {(1 << size) - 1} as int)")
        at += size
    return F.expr(f"array({', '.join(values)})")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def shared_weight(a: Column, b: Column) -> Column:
    """Sum over distinct values of the smaller of their counts in two arrays."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    count = lambda values, x: F.size(F.filter(values, lambda y: y == x))
    counted = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))
    # A value that one side has once counts once.
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)


def benchmark_items(benchmark: DataFrame, width: int) -> DataFrame:
    """``item_id, words, width, shingles``; items without words are left out."""
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("words")).filter(F.size("words") > 0)
    return items.select("*", F.least(F.size("words"), F.lit(width)).alias("width"))


def find_in(docs: DataFrame, items: DataFrame, width: int, wanted: list[int], longest: int, percent: int) -> DataFrame:
    """Verified windows of one block: doc_id, item_id, shared, total, start, n_words."""
    items = items.withColumn("shingles", shingles("words", width))
    own = docs.select("doc_id", word_hashes(F.col("text")).alias("words"))
    begins = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(SEGMENT))
    segments = own.select(
        "doc_id", F.size("words").alias("doc_words"),
        F.explode(F.transform(begins, lambda o: F.struct(o.alias("at"), F.slice("words", o + 1, SEGMENT + longest).alias("words")))).alias("s"),
    ).select("doc_id", "doc_words", "s.at", "s.words")
    shingled = segments.withColumn("shingles", shingles("words", width))
    among = ", ".join(f"{v}L" if v > -(2**63) else "cast('-9223372036854775808' as long)" for v in wanted)
    places = F.expr(f"filter(transform(shingles, (x, i) -> if(x in ({among}), i, null)), i -> i is not null)")
    hit = shingled.withColumn("places", places).filter(F.size("places") > 0)

    lengths = F.broadcast(items.select(F.explode("shingles").alias("shingle"), F.size("words").alias("item_words")).distinct())
    anchors = hit.select("doc_id", "doc_words", "at", "words", "shingles", F.explode("places").alias("place"))
    anchors = anchors.withColumn("shingle", F.get("shingles", F.col("place"))).join(lengths, "shingle")
    size = F.least("item_words", "doc_words")
    last = F.size("words") - F.col("size")
    anchors = anchors.withColumn("size", size).filter(last >= 0)
    starts = F.array_distinct(F.array(F.least(F.col("place"), last), F.greatest(F.col("place") - (F.col("size") - width), F.lit(0))))
    windows = anchors.select("doc_id", "at", "words", "shingles", "item_words", "size", F.explode(starts).alias("start"))
    windows = windows.select(
        "doc_id", "item_words", "size", (F.col("at") + F.col("start")).alias("start"),
        F.slice("words", F.col("start") + 1, F.col("size")).alias("w"),
        F.slice("shingles", F.col("start") + 1, F.col("size") - (width - 1)).alias("window"),
    )
    marked = windows.select("doc_id", "item_words", "size", "start", "window", simhash("w").alias("print"))
    dealt = marked.select("*", F.posexplode(block_values("print")).alias("block", "value"))

    index = items.select("item_id", F.size("words").alias("item_words"), F.col("shingles").alias("item"), simhash("words").alias("item_print"))
    index = index.select("*", F.posexplode(block_values("item_print")).alias("block", "value"))
    met = dealt.join(F.broadcast(index), ["item_words", "block", "value"])
    # Once per pair: only at the first block in which the two agree.
    agreeing = F.array_position(F.zip_with(block_values("print"), block_values("item_print"), lambda x, y: x == y), True)
    met = met.filter((distance(F.col("print"), F.col("item_print")) <= RADIUS) & (agreeing == F.col("block") + 1))
    shared = met.withColumn("shared", shared_weight(F.col("window"), F.col("item")))
    total = F.size("window") + F.size("item") - F.col("shared")
    found = shared.select("doc_id", "item_id", "shared", total.alias("total"), "start", F.col("size").alias("n_words"))
    return found.filter(F.col("shared") * 100 >= F.col("total") * percent)


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, similarity, start_word, n_words."""
    items = benchmark_items(benchmark, width)
    counts = items.select("item_id", "width", F.size("words").alias("n")).orderBy("width", "n", "item_id").collect()  # one row per item
    if any(row["n"] > MOST_WORDS for row in counts):
        raise ValueError(f"items of more than {MOST_WORDS} words")
    found = None
    for own_width in sorted({row["width"] for row in counts}):
        # Blocks by length: boundaries in n, so that a block is a filter on the items.
        bounds, total = [0], 0
        ns = [row["n"] for row in counts if row["width"] == own_width]
        for n, after in zip(ns, [*ns[1:], None]):
            total += n
            if after is None or (total > MOST_SHINGLES and after != n):
                bounds.append(n)
                total = 0
        for low, high in zip(bounds, bounds[1:]):
            block = items.filter((F.col("width") == own_width) & (F.size("words") > low) & (F.size("words") <= high))
            rows = block.select(F.explode(shingles("words", own_width)).alias("s")).distinct().collect()  # bounded by the block
            part = find_in(docs, block, own_width, [r["s"] for r in rows], high, percent)
            found = part if found is None else found.unionByName(part)
    if found is None:
        kind = "doc_id long, item_id long, similarity double, start_word long, n_words long"
        return docs.sparkSession.createDataFrame([], kind)
    best = F.max(F.struct((F.col("shared") / F.col("total")).alias("similarity"), (-F.col("start")).alias("before"), "n_words")).alias("b")
    grouped = found.groupBy("doc_id", "item_id").agg(best)
    return grouped.select(
        "doc_id", "item_id", "b.similarity", (-F.col("b.before")).cast("long").alias("start_word"), F.col("b.n_words").cast("long").alias("n_words")
    )


def drop_leaking(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents that hold no benchmark item; columns as given."""
    gone = leaks(docs, benchmark, width, percent).select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti").select(*docs.columns)
