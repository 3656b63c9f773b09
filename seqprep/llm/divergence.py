"""Source divergence audit: how the sources of a language differ in their words.

1. Single-pass in-memory indexing. A task counts terms per (lang, source) and
   documents per (lang, term) until the block holds ``BLOCK`` entries; then the
   block leaves as a run: pages of term-sorted postings, dealt to hash shards.
   The empty term stands for the document itself, so that its postings are the
   groups, those without any term included.
2. A shard sorts its pages by their first term and merges them with a heap. A
   page is opened when the merge reaches its first term and closed after its
   last, so at most one page of each run is open. Terms of too few documents end
   here; the rest is the frequency table, written once.
3. Terms per group: share of the group against the share of the language, the
   highest differences of each group.
4. Pairs of sources: two groups without any term would be ``V * |p0 - q0|``
   apart; every term that one of them holds corrects that. The corrections are
   summed over a stream of term-sorted rows, in matrices of at most ``WIDTH``
   by ``WIDTH`` groups, one for each pair of blocks of groups and shard of terms.

Shares are integers from integers (``share``), sums are 64-bit integers.

Skew: a source or language with most of the rows sends one entry per term and
block, not one per word; its terms are dealt over all shards. Texts are never
shuffled. Memory is bounded by the block, the open pages and the matrices. A very
long text is counted in pieces.

Defined results: a null or empty text has no terms; null lang and source are '';
repeated rows count as often as they occur; ties go by the item's UTF-8 bytes; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from seqprep.operators.sampling import sorted_index
from seqprep.session import write_shared

#: Entries that a task holds before it lets go of a run, terms of a page, bytes of a text counted at a time.
BLOCK, PAGE, PIECE = 600_000, 512, 1 << 22
#: Groups on a side of a matrix of pairs, shards of the terms there, cells of a dense piece.
WIDTH, TERM_SHARDS, CELLS = 512, 64, 1 << 21

# Letters and everything beyond ASCII stay, A to Z in lower case; the rest separates.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

PAGES = "shard int, lang binary, first binary, names array<binary>, terms array<binary>, documents array<long>, sizes array<int>, sources array<int>, counts array<long>"
FREQUENCIES = "lang string, term string, documents long, total long, sources array<string>, counts array<long>"


def _arrow(ddl: str) -> pa.Schema:
    """The Arrow schema of a list of columns."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = []
    for part in ddl.split(", "):
        name, kind = part.split()
        fields.append((name, pa.list_(kinds[kind[6:-1]]) if kind.startswith("array") else kinds[kind]))
    return pa.schema(fields)


# --- 1: runs ------------------------------------------------------------------------


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time; pieces are cut between terms."""
    plain = text.translate(_TERMS)
    lo = 0
    while lo < len(plain):
        hi = plain.find(b" ", lo + size)
        hi = len(plain) if hi < 0 else hi
        yield plain[lo:hi].split()
        lo = hi


class Block:
    """Postings of a part of the documents, in memory."""

    def __init__(self) -> None:
        self.counts: dict[tuple[bytes, bytes], Counter[bytes]] = defaultdict(Counter)
        self.documents: dict[bytes, Counter[bytes]] = defaultdict(Counter)

    def add(self, lang: bytes, source: bytes, text: bytes) -> None:
        counts, seen = self.counts[lang, source], {b""}
        counts[b""] += 1
        for terms in pieces(text):
            counts.update(terms)
            seen.update(terms)
        self.documents[lang].update(seen)

    def __len__(self) -> int:
        return sum(map(len, self.counts.values())) + sum(map(len, self.documents.values()))

    def run(self, shards: int) -> Iterator[pa.RecordBatch]:
        """Pages of the run, each with ascending terms of one language and shard."""
        for lang, documents in self.documents.items():
            names = sorted(source for own, source in self.counts if own == lang)
            held = [self.counts[lang, source] for source in names]
            salt = zlib.crc32(lang)
            terms = sorted(documents)
            shard = np.fromiter((zlib.crc32(t, salt) % shards for t in terms), np.int64, len(terms))
            order = np.argsort(shard, kind="stable")
            shard = shard[order]
            place = np.empty(len(terms), np.int64)
            place[order] = np.arange(len(terms))
            number = dict(zip(terms, place.tolist()))
            terms = [terms[k] for k in order.tolist()]
            # Postings in the order of their terms, then of their sources.
            entries = sum(map(len, held))
            of_term = np.fromiter((number[t] for own in held for t in own), np.int64, entries)
            counts = np.fromiter((n for own in held for n in own.values()), np.int64, entries)
            sources = np.repeat(np.arange(len(held), dtype=np.int32), [len(own) for own in held])
            by_term = np.argsort(of_term, kind="stable")
            sizes = np.bincount(of_term, minlength=len(terms))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            # A page ends with its shard or after PAGE terms.
            starts = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1])
            cuts = np.concatenate([np.arange(a, b, PAGE) for a, b in zip(starts, np.append(starts[1:], len(terms)))])
            pages = np.append(cuts, len(terms))
            lists = lambda values, at: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))
            columns = [
                pa.array(shard[cuts], pa.int32()), pa.array([lang] * len(cuts), pa.binary()), pa.array([terms[k] for k in cuts.tolist()], pa.binary()),
                pa.array([names] * len(cuts), pa.list_(pa.binary())), lists(terms, pages),
                lists(np.fromiter(map(documents.__getitem__, terms), np.int64, len(terms)), pages), lists(sizes.astype(np.int32), pages),
                lists(sources[by_term], ends[pages]), lists(counts[by_term], ends[pages]),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_arrow(PAGES))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most ``size``."""
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _parts(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, size):
            yield batch.slice(lo, size)


def runs(docs: DataFrame, shards: int, block: int = BLOCK) -> DataFrame:
    """Pages of all runs of all tasks."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Block()
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for lang, source, text in zip(*(c.to_pylist() for c in batch.slice(lo, 64).columns)):
                    held.add(lang, source, text)
                if len(held) >= block:
                    yield from _parts(held.run(shards))
                    held = Block()
        yield from _parts(held.run(shards))

    raw = [F.coalesce(c, F.lit("")).cast("binary").alias(c) for c in ("lang", "source", "text")]
    return docs.select(*raw).mapInArrow(index, PAGES)


# --- 2: merge -----------------------------------------------------------------------


class Page:
    """An open page: its terms and a place among them. Postings are looked at for wanted terms only."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        one = {name: batch.column(name)[row] for name in ("names", "terms", "documents", "sizes", "sources", "counts")}
        self.names, self.terms, self.documents = (one[c].as_py() for c in ("names", "terms", "documents"))
        self.ends = np.concatenate([[0], np.cumsum(one["sizes"].values.to_numpy())])
        self.sources, self.counts = one["sources"].values.to_numpy(), one["counts"].values.to_numpy()
        self.at = 0

    def postings(self, at: int) -> Iterator[tuple[bytes, int]]:
        lo, hi = self.ends[at], self.ends[at + 1]
        return zip((self.names[k] for k in self.sources[lo:hi].tolist()), self.counts[lo:hi].tolist())


def merged_terms(pages: Iterator[Page], least: int) -> Iterator[tuple[bytes, int, Counter[bytes]]]:
    """Every term of a language and shard in at least ``least`` documents, with these and its counts.

    ``pages`` come in the order of their first terms. The empty term is always there.
    """
    heap: list[tuple[bytes, int, Page]] = []
    current, documents, places = None, 0, []

    def found() -> Iterator[tuple]:
        if current is not None and (documents >= least or not current):
            counts: Counter[bytes] = Counter()
            for page, at in places:
                for source, n in page.postings(at):
                    counts[source] += n
            yield current, documents, counts

    def step() -> Iterator[tuple]:
        nonlocal current, documents, places
        term, order, page = heap[0]
        if term != current:
            yield from found()
            current, documents, places = term, 0, []
        documents += page.documents[page.at]
        places.append((page, page.at))
        page.at += 1
        if page.at == len(page.terms):
            heapq.heappop(heap)
        else:
            heapq.heapreplace(heap, (page.terms[page.at], order, page))

    for order, page in enumerate(pages):
        while heap and heap[0][0] < page.terms[0]:
            yield from step()
        heapq.heappush(heap, (page.terms[0], order, page))
    while heap:
        yield from step()
    yield from found()


def frequencies(docs: DataFrame, least: int, shards: int | None = None, block: int = BLOCK) -> DataFrame:
    """The terms of at least ``least`` documents of their language, with their count in each source.

    The empty term lists the sources of each language with their number of documents.
    """
    shards = shards or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pages() -> Iterator[tuple[tuple[int, bytes], tuple[pa.RecordBatch, int]]]:
            for batch in batches:
                keys = zip(batch.column("shard").to_pylist(), batch.column("lang").to_pylist())
                yield from ((key, (batch, row)) for row, key in enumerate(keys))

        def kept() -> Iterator[tuple]:
            for (_, lang), own in groupby(pages(), key=lambda page: page[0]):
                for term, documents, counts in merged_terms((Page(*place) for _, place in own), least):
                    sources = sorted(counts)
                    yield lang, term, documents, sum(counts.values()), sources, [counts[s] for s in sources]

        yield from _batches(kept(), _arrow(FREQUENCIES), 512)

    dealt = runs(docs, shards, block).repartition("shard").sortWithinPartitions("shard", "lang", "first")
    return write_shared(dealt.mapInArrow(merge, FREQUENCIES), "frequencies")


# --- 3: shares ----------------------------------------------------------------------


def share(count: Column, n: Column, v: Column, unit: int = 1_000_000_000, extra: int = 5) -> Column:
    """1 + floor(unit * (count + extra) / (n + extra * v)), exactly."""
    above = F.lit(unit).cast("decimal(10,0)") * (count + extra).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, (n + extra * v).cast("decimal(20,0)"))


def group_figures(found: DataFrame) -> DataFrame:
    """One row per group: ``lang, source, g`` (number), ``n``, ``v``, ``p0`` (share of an absent term), ``lang_n`` and its language's first and last block."""
    groups = found.filter("term = ''").select("lang", F.explode("sources").alias("source"))
    terms = found.filter("term <> ''")
    sums = terms.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e")).groupBy("lang", "e.sources").agg(F.sum("e.counts").alias("n"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    numbered = write_shared(sorted_index(groups, ["lang", "source"], "g"), "groups")
    spans = numbered.groupBy("lang").agg(F.floor(F.min("g") / WIDTH).alias("lo"), F.floor(F.max("g") / WIDTH).alias("hi"))
    told = numbered.join(sums.withColumnRenamed("sources", "source"), ["lang", "source"], "left").join(langs, "lang", "left").join(spans, "lang")
    filled = told.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n", "v", "lang_n")})
    p0 = F.when(F.col("v") > 0, share(F.lit(0), F.col("n"), F.col("v"))).otherwise(F.lit(0))
    return write_shared(filled.withColumn("p0", p0), "figures")


def shares(found: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per term of a group: its share ``p`` there and ``q`` in the language."""
    flat = found.filter("term <> ''").select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    flat = flat.select("lang", "term", "total", F.col("e.sources").alias("source"), F.col("e.counts").alias("count"))
    both = flat.join(groups, ["lang", "source"])
    p, q = share(F.col("count"), F.col("n"), F.col("v")), share(F.col("total"), F.col("lang_n"), F.col("v"))
    return write_shared(both.select("lang", "source", "g", "lo", "hi", "term", p.alias("p"), q.alias("q")), "shares")


def ranked(rows: DataFrame, part: str, most: int | None) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    placed = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))
    return placed if most is None else placed.filter(F.col("rank") <= most)


def term_differences(marked: DataFrame, most: int = 50) -> DataFrame:
    """The terms whose share in a group exceeds that in the language, ``most`` per group."""
    return ranked(marked.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")), "term", most)


# --- 4: pairs -----------------------------------------------------------------------


class Matrix:
    """Distances between the groups of two blocks, over the terms of a shard."""

    def __init__(self, left: int, right: int, first: bool):
        self.left, self.right, self.first = left, right, first
        self.members: list[tuple[np.ndarray, np.ndarray]] = []
        self.ready = False
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def start(self) -> None:
        g, p0 = (np.concatenate(c) for c in zip(*self.members))
        order = np.argsort(g)
        self.g, self.p0 = g[order], p0[order]
        block = self.g // WIDTH
        self.i, self.j = np.flatnonzero(block == self.left), np.flatnonzero(block == self.right)
        self.apart = np.abs(self.p0[self.i][:, None] - self.p0[self.j][None, :])
        self.sums = np.zeros(self.apart.shape, np.int64)
        self.ready = True

    def add(self, term: np.ndarray, g: np.ndarray, p: np.ndarray) -> None:
        """Rows of whole terms; ``term`` numbers them from 0."""
        at = np.searchsorted(self.g, g)
        step = max(1, CELLS // len(self.g))
        for lo in range(0, int(term[-1]) + 1, step):
            a, b = np.searchsorted(term, [lo, lo + step])
            n = int(term[b - 1]) - lo + 1
            dense = np.repeat(self.p0[None, :], n, axis=0)
            dense[term[a:b] - lo, at[a:b]] = p[a:b]
            others = dense[:, self.j]
            for row, own in enumerate(self.i):
                self.sums[row] += np.abs(others - dense[:, own : own + 1]).sum(axis=0)
            self.sums -= n * self.apart

    def rows(self, v: int) -> Iterator[pa.RecordBatch]:
        """``a, b, part``: in the first shard every pair, with the distance of absent terms; elsewhere what differs from it."""
        sums = self.sums + v * self.apart if self.first else self.sums
        wanted = np.ones(sums.shape, bool) if self.first else sums != 0
        x, y = np.nonzero(wanted & (self.g[self.i][:, None] != self.g[self.j][None, :]))
        a, b, part = self.g[self.i][x], self.g[self.j][y], sums[x, y]
        if self.left != self.right:
            a, b, part = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([part, part])
        for lo in range(0, len(a), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + (1 << 16)]) for c in (a, b, part)], ["a", "b", "part"])


def pair_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per pair from rows sorted by matrix, term and group; a matrix's rows without a term name its groups."""
    key, matrix, v, rest = None, None, 0, None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:  # the last term of the batch before may go on
            table = pa.concat_tables([rest, table])
        columns = {c: table.column(c).combine_chunks() for c in table.column_names}
        coded = {c: columns[c].dictionary_encode() for c in ("lang", "term")}
        numbers = [coded["lang"].indices.to_numpy(), *(columns[c].to_numpy() for c in ("i", "j", "shard"))]
        new_key = np.zeros(table.num_rows, bool)
        for c in numbers:
            new_key[1:] |= c[1:] != c[:-1]
        new_key[:1] = True
        words = coded["term"].indices.to_numpy()
        new_term = new_key.copy()
        new_term[1:] |= words[1:] != words[:-1]
        last = int(np.flatnonzero(new_term)[-1])
        rest = table.slice(last)
        starts = np.append(np.flatnonzero(new_key[:last]), last)
        for lo, hi in zip(starts[:-1], starts[1:]):
            key, matrix, v, made = _feed(columns, new_term, lo, hi, key, matrix, v)
            yield from made
    if rest is not None:
        columns = {c: rest.column(c).combine_chunks() for c in rest.column_names}
        new_term = np.zeros(rest.num_rows, bool)
        new_term[0] = True
        key, matrix, v, made = _feed(columns, new_term, 0, rest.num_rows, key, matrix, v)
        yield from made
        yield from _finished(matrix, v)


def _finished(matrix: Matrix | None, v: int) -> Iterator[pa.RecordBatch]:
    if matrix is not None:
        if not matrix.ready:
            matrix.start()
        yield from matrix.rows(v)


def _feed(columns: dict[str, pa.Array], new_term: np.ndarray, lo: int, hi: int, key: tuple | None, matrix: Matrix | None, v: int) -> tuple:
    """Rows ``lo`` to ``hi`` of one matrix; returns the matrix to go on with and what a finished one gives."""
    own = tuple(columns[c][int(lo)].as_py() for c in ("lang", "i", "j", "shard"))
    made: list[pa.RecordBatch] = []
    if own != key:
        made = list(_finished(matrix, v))
        key, matrix = own, Matrix(own[1], own[2], own[3] == 0)
    g, p = columns["g"].to_numpy()[lo:hi], columns["p"].to_numpy()[lo:hi]
    members = hi - lo if not columns["term"][int(hi) - 1].as_py() else int(np.flatnonzero(new_term[lo:hi])[1]) if not columns["term"][int(lo)].as_py() else 0
    if members:
        matrix.members.append((g[:members], p[:members]))
        v = columns["v"][int(lo)].as_py()
    if members < hi - lo:
        if not matrix.ready:
            matrix.start()
        term = np.cumsum(new_term[lo + members : hi]) - 1
        term -= term[0]
        matrix.add(term, g[members:], p[members:])
    return key, matrix, v, made


def pair_distances(marked: DataFrame, groups: DataFrame) -> DataFrame:
    """Each other source of the language with the summed difference of all shares."""
    block = F.floor(F.col("g") / WIDTH).alias("block")
    other = F.explode(F.sequence("lo", "hi")).alias("other")
    sides = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    members = groups.select("lang", "g", F.col("p0").alias("p"), "v", block, other)
    members = members.select("lang", *sides, F.explode(F.sequence(F.lit(0), F.lit(TERM_SHARDS - 1))).alias("shard"), F.lit("").alias("term"), "g", "p", "v")
    shard = F.pmod(F.xxhash64("term"), F.lit(TERM_SHARDS)).cast("int").alias("shard")
    entries = marked.select("lang", "term", "g", "p", block, other).select("lang", *sides, shard, "term", "g", "p", F.lit(0).cast("long").alias("v"))
    matrix = ["lang", "i", "j", "shard"]
    rows = members.unionByName(entries).repartition(*matrix).sortWithinPartitions(*matrix, "term", "g")
    parts = rows.mapInArrow(pair_parts, "a long, b long, part long")
    sums = parts.groupBy("a", "b").agg(F.sum("part").alias("value"))
    named = sums.join(groups.select(F.col("g").alias("a"), "lang", "source"), "a").join(groups.select(F.col("g").alias("b"), F.col("source").alias("item")), "b")
    return ranked(named, "pair", None)


def divergence(docs: DataFrame, least: int = 30, most: int = 50, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: pairs of sources and outstanding terms of each group."""
    found = frequencies(docs, least, block=block)
    groups = group_figures(found)
    marked = shares(found, groups)
    return pair_distances(marked, groups).unionByName(term_differences(marked, most))
