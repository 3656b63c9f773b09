"""Best-fit packing of token sequences by length patterns.

1. Tokenize, cut what is too long, and write one narrow row per piece. Each row
   carries its task and its number among the task's pieces of that length.
2. The histogram of lengths (at most ``capacity`` numbers, whatever the corpus)
   comes to the driver. Patterns of up to three lengths that fill a sequence
   exactly are enumerated; non-negative least squares fits how often to repeat
   each pattern to the histogram; the counts are rounded, and what is left is
   packed best fit, longest first, on the histogram.
3. The plan says, for the k-th piece of each length, its sequence and offset.
   Pieces get k from their task's number and the counts of the tasks before
   (a table of tasks by lengths), and then their place in one Arrow pass.

No text is shuffled. The plan is bounded by the number of lengths, not of
documents; its size is checked before it is sent to the tasks. Nothing depends
on which documents have a length, so frequent lengths are as good as rare ones.

Defined results: a null or empty text is one end mark (length 1); repeated rows
are packed one by one; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from seqprep.llm.common import worker_cache
from seqprep.llm.token_counts import byte_alphabet
from seqprep.session import write_shared

#: The id that ends a document (fixed by the contract of the data).
END_ID = 0

# --- tokens ---------------------------------------------------------------------

#: tiktoken's matcher refuses white-space runs from about 1,000,000 characters; runs from this length do not pass it.
LONG_RUN = 100_000
#: White space of the splitting pattern: Python's without the four separators that are none in Unicode.
_BLANK = r"[^\S\x1c-\x1f]"


class Encoder:
    """Token ids of a byte-level BPE file as little-endian 32-bit bytes.

    The ids are those of the ``tokenizers`` library for the file. They are found
    by tiktoken, which takes the file's vocabulary as ranks (an id is the place
    of its merge) and needs a quarter of the time; the tests hold the two equal,
    over every code point, odd white space and special strings included. Very
    long white-space runs are cut out where the pattern splits them off for sure
    and merged without the pattern.
    """

    def __init__(self, name: str):
        import tiktoken

        with open(public_tokenizers.path(name), encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in specials}
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=specials)
        self.specials = tuple(specials)
        self.long_run = re.compile(rf"(?<!{_BLANK}){_BLANK}{{{LONG_RUN},}}")

    def encode(self, text: str) -> bytes:
        if len(text) < LONG_RUN:
            return self.encode_part(text)
        parts, at = [], 0
        for run in self.long_run.finditer(text):
            # The last blank goes with what follows, unless the text or its part before a special string ends here.
            begin, end = run.span()
            end -= end < len(text) and not text.startswith(self.specials, end)
            ids = self.encoding._encode_single_piece(text[begin:end])
            parts += [self.encode_part(text[at:begin]), np.array(ids, "<u4").tobytes()]
            at = end
        return b"".join([*parts, self.encode_part(text[at:])])

    def encode_part(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def token_pieces(docs: DataFrame, capacity: int, tokenizer: str, keep_ids: bool = False) -> DataFrame:
    """One row per piece, not yet placed."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"encoder_{tokenizer}", lambda: Encoder(tokenizer))
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            kept: list[np.ndarray] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text or "") + end
                total = len(ids) // 4
                start, first = 0, (total - 1) % capacity + 1
                for piece in range(-(-total // capacity)):
                    length = capacity if piece else first
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own), task, int(seen[length])))
                    if keep_ids:
                        kept.append(np.frombuffer(own, "<u4").astype(np.int32))
                    seen[length] += 1
                    start += length
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)]
            names = [p.split()[0] for p in PIECES.split(", ")]
            if keep_ids:
                columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES + (", ids array<int>" if keep_ids else ""))


# --- plan -----------------------------------------------------------------------


def full_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c, c or b and c may be 0, of present lengths that add up to ``capacity``."""
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    present[0] = True
    found = []
    for a in range(capacity, (capacity + 2) // 3 - 1, -1):
        if present[a]:
            b = np.arange((capacity - a + 1) // 2, min(a, capacity - a) + 1)
            b = b[present[b] & present[capacity - a - b]]
            found.append(np.stack([np.full(len(b), a), b, capacity - a - b], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def fit_repeats(histogram: np.ndarray, patterns: np.ndarray, rounds: int = 120, step: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative least squares by active sets: (patterns in use, their repeats).

    Each round lets in the patterns along which the squared misfit falls
    fastest and solves least squares on the set in use (conjugate gradients; a
    pattern touches three lengths); patterns that would turn negative leave.
    """
    size = len(histogram)
    target = histogram.astype(float)
    target[0] = 0

    def apply(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
        total = np.bincount(rows.ravel(), np.repeat(x, rows.shape[1]), size)
        total[0] = 0
        return total

    def slope(rows: np.ndarray, misfit: np.ndarray) -> np.ndarray:
        return misfit[rows].sum(axis=1)

    def solve(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
        misfit = target - apply(rows, x)
        g = slope(rows, misfit)
        d, norm = g.copy(), g @ g
        for _ in range(100):
            if norm < 1e-6:
                break
            image = apply(rows, d)
            scale = norm / max(image @ image, 1e-12)
            x, misfit = x + scale * d, misfit - scale * image
            g = slope(rows, misfit)
            norm, before = g @ g, norm
            d = g + norm / before * d
        return x

    used, x = np.zeros(0, int), np.zeros(0)
    for _ in range(rounds):
        gain = slope(patterns, target - apply(patterns[used], x))
        gain[used] = -1
        order = np.argsort(-gain, kind="stable")[: 20 * step]
        taken, fresh = np.zeros(size, bool), []
        for i in order:
            lengths = patterns[i][patterns[i] > 0]
            if gain[i] <= 1e-3 or len(fresh) == step:
                break
            if not taken[lengths].any():
                taken[lengths] = True
                fresh.append(i)
        if not fresh:
            break
        used, x = np.append(used, fresh), np.append(x, np.zeros(len(fresh)))
        while True:
            z = solve(patterns[used], x)
            low = z <= 1e-9
            if not low.any():
                x = z
                break
            # As far towards the solution as all stay non-negative; those at zero leave.
            with np.errstate(divide="ignore", invalid="ignore"):
                part = np.where(low & (x > z), x / (x - z), np.inf)
            x = x + min(1.0, part.min()) * (z - x)
            keep = (x > 1e-9) & ~(low & (x <= 1e-9))
            if keep.all():
                keep = ~low
            used, x = used[keep], x[keep]
            if not len(used):
                break
    return used, x


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: (lengths of a sequence, number of such sequences)."""
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms = np.zeros(capacity + 1, np.int64)  # open sequences by room
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            fitting = np.flatnonzero(rooms[length:])
            if len(fitting):
                room = length + int(fitting[0])
                lengths, many = by_room[room].pop()
                placed = min(n, many)
                if many > placed:
                    by_room[room].append((lengths, many - placed))
            else:
                room, lengths, placed = capacity, (), n
                rooms[room] += placed
            rooms[room] -= placed
            rooms[room - length] += placed
            by_room.setdefault(room - length, []).append(((*lengths, length), placed))
            n -= placed
    return [entry for entries in by_room.values() for entry in entries]


def plan(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) that use up the histogram."""
    left = histogram.copy()
    whole = int(left[capacity])
    left[capacity] = 0
    made: list[tuple[tuple[int, ...], int]] = [((capacity,), whole)] if whole else []
    patterns = full_patterns(np.flatnonzero(left), capacity)
    used, repeats = fit_repeats(left, patterns) if len(patterns) else (np.zeros(0, int), np.zeros(0))
    tried = [rounded(left, patterns[used], share * repeats, capacity) for share in SHARES]
    return made + min(tried, key=lambda entries: sum(n for _, n in entries))


#: What is left when every fitted repeat is used in full can lack short lengths, so smaller shares are tried too.
SHARES = (1.0, 0.97, 0.9, 0.75, 0.5)


def rounded(left: np.ndarray, patterns: np.ndarray, repeats: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with rounded repeats, as far as the histogram goes, and the rest by best fit."""
    left, made = left.copy(), []
    for i in np.argsort(-repeats, kind="stable"):
        lengths = tuple(int(v) for v in patterns[i] if v)
        n = min([int(np.rint(repeats[i])), *(int(left[v]) // lengths.count(v) for v in lengths)])
        if n > 0:
            made.append((lengths, n))
            for v in lengths:
                left[v] -= n
    return made + best_fit(left, capacity)


MOST_ENTRIES = 2_000_000


def places(made: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For every length, ranges of its pieces: first number, first sequence, offset; sorted."""
    rows, used, sequence = [], {}, 0
    for lengths, many in made:
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            rows.append((length, first, sequence, offset))
            used[length] = first + many
            offset += length
        sequence += many
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"the plan has {len(rows)} entries")
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "first": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack(docs: DataFrame, capacity: int = 2048, tokenizer: str = "byte_bpe_50k.json", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    pieces = write_shared(token_pieces(docs, capacity, tokenizer, keep_ids), "pieces")
    by_task = write_shared(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        histogram[row["length"]] = row["n"]
    spots = places(plan(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride = np.int64(1) << 40
        keys = spots["length"] * stride + spots["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("nth").to_numpy() + batch.column("base").to_numpy()
            at = np.searchsorted(keys, length * stride + number, side="right") - 1
            sequence = spots["sequence"][at] + number - spots["first"][at]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(spots["offset"][at])], [*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, " + "ids array<int>, " * keep_ids + "sequence_id long, offset long"
    return pieces.join(bases, ["task", "length"]).select(*names, "nth", "base").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., keep_ids=True)``: sequence_id, ids, doc_ids.

    A group is one sequence and so at most ``capacity`` ids.
    """
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(rows.alias("r")).select("sequence_id", F.flatten("r.ids").alias("ids"), F.col("r.doc_id").alias("doc_ids"))
