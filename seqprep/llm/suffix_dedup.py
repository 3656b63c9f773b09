"""Removal of repeated byte strings with suffix arrays.

A window is a string of ``WINDOW`` bytes; a window is a repeat if the same bytes
also start earlier (smaller doc_id, or the same document further left). Every
byte that a repeated window covers is removed.

1. Each window has an anchor: the smallest hash of its 32-byte strings, leftmost.
   Runs of windows with one anchor are segments. Equal windows have equal anchors, so
   only segments with one anchor need comparing. Equal segments of a batch of
   documents are combined before the shuffle: all but the first are repeats as they stand.
2. Segments meet by anchor, in order. Of equal segments all but the first are
   repeats. Anchors with one segment need nothing more; nine tenths of a corpus
   end here, as hashes. Different segments with one anchor are open.
3. The bytes of open segments are fetched and dealt to shards. A shard's suffix
   array (Larsson-Sadakane) and common prefixes (Kasai) show which windows are
   equal; the first of them stays. An anchor with very many open segments is
   spread over several shards, whose sorted windows are then merged by binary
   search.
4. The repeated windows of each document are united and its bytes removed.

Everything is compared by bytes or by 128 bits (anchor and segment hash).
Nothing is collected. Texts are shuffled twice, compressed; all else is narrow.

Defined results: a null text counts as empty; texts under ``WINDOW`` bytes lose
nothing; rows without ``doc_id`` take no part and lose nothing; rows that share a
``doc_id`` are ordered by a hash of their texts, and equal rows do not repeat each
other; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from seqprep.llm.suffix_array import common_prefixes, suffix_array
from seqprep.session import write_shared

WINDOW = 100
GRAM = 32
GRAMS = WINDOW - GRAM + 1
#: Bytes hashed at a time, and bytes of a shard's suffix array.
BLOCK, SHARD = 1 << 19, 1 << 20
#: Documents whose segments are combined, and documents whose bytes are fetched at a time.
COMBINED, FETCHED = 2500, 500
#: Open segments of an anchor in one shard.
CROWD = 2000

_FACTOR = 0x9E3779B97F4A7C15
_WORD = 2**64


# --- 1: segments ------------------------------------------------------------------


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of each ``GRAM``-byte string."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    size = 1
    while size < GRAM:
        h = h[:-size] * np.uint64(pow(_FACTOR, size, _WORD)) + h[size:]
        size *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest gram hash of each window and where it is, leftmost."""
    low = gram_hashes(raw)
    at = np.arange(len(low), dtype=np.int32)

    def either(low: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        later = low[step:] < low[:-step]
        return np.where(later, low[step:], low[:-step]), np.where(later, at[step:], at[:-step])

    size = 1
    while 2 * size <= GRAMS:
        low, at = either(low, at, size)
        size *= 2
    return either(low, at, GRAMS - size) if size < GRAMS else (low, at)


def segments(raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of texts that lie one after the other: anchor, hash, text, start in the text, windows."""
    data = np.frombuffer(raw, np.uint8)
    parts = []
    for lo in range(0, max(0, len(data) - WINDOW + 1), BLOCK):
        own, gram = window_anchors(data[lo : lo + BLOCK + WINDOW - 1])
        at = np.arange(lo, lo + len(own))
        text = np.searchsorted(ends, at, side="right")
        real = at + WINDOW <= ends[text]
        own, gram, at, text = own[real], gram[real], at[real], text[real]
        if len(own):
            new = np.flatnonzero((gram[1:] != gram[:-1]) | (text[1:] != text[:-1])) + 1
            begin = np.concatenate([[0], new])
            parts.append((own[begin], at[begin], text[begin], np.diff(np.append(begin, len(own)))))
    if not parts:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    anchor, at, text, windows = (np.concatenate(c) for c in zip(*parts))
    view, hash_of = memoryview(raw), xxhash.xxh3_64_intdigest
    hashed = np.array([hash_of(view[a:b]) for a, b in zip(at.tolist(), (at + windows + WINDOW - 1).tolist())], np.uint64)
    starts = np.concatenate([[0], ends[:-1]])
    return anchor, hashed, text, at - starts[text], windows


NAMES = ["anchor", "segment", "doc_id", "tie", "start", "windows"]
ROWS = "anchor long, segment long, doc_id long, tie long, start long, windows long"


def parts_of(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what a step builds from a batch stays small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _batch(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)


def joined_runs(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, windows: np.ndarray) -> list[np.ndarray]:
    """Runs of windows that follow each other in a document, as one."""
    if not len(doc):
        return [doc, tie, start, windows]
    order = np.lexsort((start, tie, doc))
    doc, tie, start, windows = doc[order], tie[order], start[order], windows[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] != start[:-1] + windows[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return [doc[at], tie[at], start[at], start[last] + windows[last] - start[at]]


def corpus_segments(docs: DataFrame) -> DataFrame:
    """Segments of all documents; those that repeat within their batch of documents have segment 0 and windows below 0."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, COMBINED):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
            doc_ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            anchor, hashed, text, start, windows = segments(b"".join(texts), np.cumsum([len(t) for t in texts], dtype=np.int64))
            doc, tie = doc_ids[text], ties[text]
            order = np.lexsort((start, tie, doc, hashed, anchor))
            a, h = anchor[order], hashed[order]
            again = np.zeros(len(a), bool)
            again[1:] = (a[1:] == a[:-1]) & (h[1:] == h[:-1])
            first, more = order[~again], order[again]
            yield _batch([anchor[first].view(np.int64), hashed[first].view(np.int64), doc[first], tie[first], start[first], windows[first]], NAMES)
            runs = joined_runs(doc[more], tie[more], start[more], windows[more])
            if len(runs[0]):
                spread = runs[0] * 31 + runs[2]
                yield _batch([spread, np.zeros(len(spread), np.int64), runs[0], runs[1], runs[2], -runs[3]], NAMES)

    return docs.mapInArrow(cut, ROWS)


# --- 2: segments by anchor ----------------------------------------------------------

OPEN = "open boolean, " + ROWS


def sifted(rows: DataFrame) -> DataFrame:
    """Repeated segments (not open) and open ones, from rows sorted by anchor, segment and place.

    Holds one batch and one row: the first segment of an anchor waits until a second one is seen.
    """

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] | None = None  # the first segment of the last anchor, not yet given out
        seen: tuple[int, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy() for k in range(6)]
            known = columns[5] < 0
            ready = [c[known] for c in columns]
            ready[5] = -ready[5]
            if not known.all():
                columns = [c[~known] for c in columns]
                anchor, segment = columns[:2]
                new_anchor = np.ones(len(anchor), bool)
                new_anchor[1:] = anchor[1:] != anchor[:-1]
                new_anchor[0] = seen is None or seen[0] != anchor[0]
                new_segment = np.ones(len(anchor), bool)
                new_segment[1:] = new_anchor[1:] | (segment[1:] != segment[:-1])
                new_segment[0] = new_anchor[0] or seen[1] != segment[0]
                repeats = [np.concatenate([c[~new_segment], r]) for c, r in zip(columns, ready)]
                if len(repeats[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(repeats[0]), bool)), *map(pa.array, repeats)], ["open", *NAMES])
                heads = [c[new_segment] for c in columns]
                lead = new_anchor[new_segment]
                if waiting is not None:
                    heads = [np.concatenate([w, c]) for w, c in zip(waiting, heads)]
                    lead = np.concatenate([[True], lead])
                followed = np.append(~lead[1:], False)
                give = ~lead | followed
                seen = (int(anchor[-1]), int(segment[-1]))
                waiting = [c[-1:] for c in heads] if len(lead) and lead[-1] else None
                if give.any():
                    yield pa.RecordBatch.from_arrays([pa.array(np.ones(int(give.sum()), bool)), *(pa.array(c[give]) for c in heads)], ["open", *NAMES])
            elif len(ready[0]):
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(ready[0]), bool)), *map(pa.array, ready)], ["open", *NAMES])

    return rows.repartition("anchor").sortWithinPartitions("anchor", "segment", "doc_id", "tie", "start").mapInArrow(sift, OPEN)


# --- 3: shards ------------------------------------------------------------------------


def packed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, tie, text`` with the texts' bytes compressed for the shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [press.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], ["doc_id", "tie", "text"])

    return docs.mapInArrow(pack, "doc_id long, tie long, text binary")


def with_bytes(open_segments: DataFrame, docs: DataFrame) -> DataFrame:
    """Open segments with their bytes."""
    spans = F.collect_list(F.struct("anchor", "shard", "parts", "start", "windows")).alias("spans")
    listed = open_segments.groupBy("doc_id", "tie").agg(spans)
    names = ["anchor", "shard", "parts", "doc_id", "tie", "start", "bytes"]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdDecompressor()
        for batch in parts_of(batches, FETCHED):
            rows = []
            for doc_id, tie, packed, own in zip(*(batch.column(k).to_pylist() for k in range(4))):
                raw = press.decompress(packed)
                rows += [(s["anchor"], s["shard"], s["parts"], doc_id, tie, s["start"], raw[s["start"] : s["start"] + s["windows"] + WINDOW - 1]) for s in own]
            columns = zip(*rows) if rows else [[]] * 7
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    joined = packed_texts(docs).join(listed, ["doc_id", "tie"]).select("doc_id", "tie", "text", "spans")
    return joined.mapInArrow(fetch, "anchor long, shard long, parts long, doc_id long, tie long, start long, bytes binary")


def equal_windows(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the pieces in suffix order: (piece, offset, number of the group of equal windows)."""
    text = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    order, rank = suffix_array(text, WINDOW)
    group = np.cumsum(common_prefixes(text, order, rank, WINDOW) < WINDOW)
    piece = np.searchsorted(ends, order, side="right")
    real = order + WINDOW <= ends[piece]
    piece = piece[real]
    return piece, order[real] - (ends - sizes)[piece], group[real]


def not_first(group: np.ndarray, doc: np.ndarray, tie: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by group and place, and which of the ordered are repeats of another place."""
    order = np.lexsort((start, tie, doc, group))
    g, d, t, s = group[order], doc[order], tie[order], start[order]
    lead = np.ones(len(g), bool)
    lead[1:] = g[1:] != g[:-1]
    head = np.maximum.accumulate(np.where(lead, np.arange(len(g)), 0))
    return order, (d != d[head]) | (t != t[head]) | (s != s[head])


SHARDED = "kind int, anchor long, part long, run long, doc_id long, tie long, start long, windows long, bytes binary"
SHARDED_NAMES = [p.split()[0] for p in SHARDED.split(", ")]


def shard_repeats(rows: DataFrame) -> DataFrame:
    """Per shard: runs of repeated windows (kind 0), and the first windows of spread anchors for the merge (kind 1)."""

    def solve(held: list[dict]) -> Iterator[pa.RecordBatch]:
        pieces = [r["bytes"] for r in held]
        column = {c: np.array([r[c] for r in held], np.int64) for c in ("anchor", "shard", "parts", "doc_id", "tie", "start")}
        piece, offset, group = equal_windows(pieces)
        place = column["start"][piece] + offset
        order, again = not_first(group, column["doc_id"][piece], column["tie"][piece], place)
        piece, offset, place = piece[order], offset[order], place[order]
        doc, tie = column["doc_id"][piece], column["tie"][piece]
        runs = joined_runs(doc[again], tie[again], place[again], np.ones(int(again.sum()), np.int64))
        n = len(runs[0])
        if n:
            blank = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), blank, blank, blank, *map(pa.array, runs), pa.nulls(n, pa.binary())], SHARDED_NAMES)
        g = group[order]
        lead = np.ones(len(g), bool)
        lead[1:] = g[1:] != g[:-1]
        spread = np.flatnonzero(lead & (column["parts"][piece] > 1))
        for some in (spread[k : k + 20_000] for k in range(0, len(spread), 20_000)):
            p = piece[some]
            raw = [pieces[i][o : o + WINDOW] for i, o in zip(p.tolist(), offset[some].tolist())]
            part = np.array([xxhash.xxh3_64_intdigest(w) >> 1 for w in raw], np.int64) % column["parts"][p]
            columns = [np.ones(len(some), np.int32), column["anchor"][p], part, column["shard"][p], doc[some], tie[some], place[some], np.ones(len(some), np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(raw, pa.binary())], SHARDED_NAMES)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size, key = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                own = (row["anchor"], row["shard"])
                if size > SHARD and own != key:  # only between anchors, so equal windows stay together
                    yield from solve(held)
                    held, size = [], 0
                held.append(row)
                size, key = size + len(row["bytes"]), own
        if held:
            yield from solve(held)

    return rows.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard").mapInArrow(shards, SHARDED)


def merged_repeats(firsts: DataFrame) -> DataFrame:
    """Runs of one anchor from several shards, merged by binary search: the windows that another shard has earlier."""

    def merge(table: pa.Table) -> pa.Table:
        run = table.column("run").to_numpy()
        window = np.array(table.column("bytes").to_pylist(), f"S{WINDOW}")
        place = np.stack([table.column(c).to_numpy() for c in ("doc_id", "tie", "start")], axis=1)
        repeated = np.zeros(len(run), bool)
        merged = np.zeros(0, np.int64)  # rows of the distinct windows so far, sorted by window
        for number in np.unique(run):
            own = np.flatnonzero(run == number)
            own = own[np.argsort(window[own], kind="stable")]
            at = np.searchsorted(window[merged], window[own])
            hit = np.zeros(len(own), bool)
            inside = at < len(merged)
            hit[inside] = window[merged[at[inside]]] == window[own[inside]]
            for mine, slot in zip(own[hit].tolist(), at[hit].tolist()):
                other = merged[slot]
                a, b = tuple(place[mine]), tuple(place[other])
                if a < b:
                    repeated[other], merged[slot] = True, mine
                elif b < a:
                    repeated[mine] = True
            merged = np.insert(merged, at[~hit], own[~hit])
        return table.select(["doc_id", "tie", "start", "windows"]).filter(pa.array(repeated))

    return firsts.groupBy("anchor", "part").applyInArrow(merge, "doc_id long, tie long, start long, windows long")


# --- 4: removal -----------------------------------------------------------------------


def removal(docs: DataFrame, repeats: DataFrame, keep_text: bool = False) -> DataFrame:
    """Documents with their repeated windows united and removed."""
    spans = F.collect_list(F.struct("start", "windows")).alias("spans")
    listed = repeats.groupBy("doc_id", "tie").agg(spans)
    joined = packed_texts(docs).join(listed, ["doc_id", "tie"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdDecompressor()
        for batch in parts_of(batches, FETCHED):
            rows = []
            for doc_id, packed, own in zip(*(batch.column(k).to_pylist() for k in range(3))):
                raw = press.decompress(packed)
                kept, at, removed, runs, end = [], 0, 0, 0, -1
                for start, stop in sorted((s["start"], s["start"] + s["windows"] + WINDOW - 1) for s in own or ()):
                    if start > end:
                        runs += 1
                        kept.append(raw[at:start])
                        removed += stop - start
                    else:
                        removed += max(0, stop - end)
                    end = max(end, stop)
                    at = end
                kept.append(raw[at:])
                left = b"".join(kept)
                rows.append((doc_id, len(raw), removed, runs, hashlib.sha256(left).hexdigest()) + (left,) * keep_text)
            types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * keep_text
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], [p.split()[0] for p in schema.split(", ")])

    return joined.mapInArrow(remove, schema)


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the remaining bytes)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    several = not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()
    tie = F.coalesce(F.xxhash64("text"), F.lit(0)) if several else F.lit(0).cast("long")
    docs = docs.select("doc_id", tie.alias("tie"), "text")
    known = docs.filter("doc_id is not null")
    known = known.dropDuplicates(["doc_id", "tie"]) if several else known

    found = write_shared(sifted(corpus_segments(known)), "segments")
    sure = found.filter("not open").select("doc_id", "tie", "start", "windows")
    unsure = found.filter("open")
    crowds = unsure.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD)
    parts = F.coalesce(F.ceil(F.col("n") / CROWD).cast("long"), F.lit(1))
    unsure = unsure.join(crowds, "anchor", "left").withColumn("parts", parts)
    unsure = unsure.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start"), F.col("parts")))
    shown = write_shared(shard_repeats(with_bytes(unsure, known)), "shards")
    sharded = shown.filter("kind = 0").select("doc_id", "tie", "start", "windows")
    merged = merged_repeats(shown.filter("kind = 1").select("anchor", "part", "run", "doc_id", "tie", "start", "windows", "bytes"))
    return removal(docs, sure.unionByName(sharded).unionByName(merged), keep_text)
