"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer file.

Two deterministic machines make up the tokenizer:

* ``LEXER`` reads character classes and emits word boundaries. A boundary can be
  known one character late, so a transition carries two marks: a boundary before
  this character, and one before the character ahead of it.
* ``WordMachine`` reads the bytes of one word. A state is a prefix together with
  the last token of its encoding; its transition on a byte is annotated with the
  change of the number of emitted tokens. States are made when a text first
  reaches them and forgotten when they are too many. What makes it exact: a
  token sequence is the encoding of its bytes if and only if each pair of
  neighbours is the encoding of its own bytes, so the encoding of a prefix is the
  encoding of a shorter prefix and one more token.

Texts of an Arrow batch are one stream of characters, cut into chunks of equal
length. Each chunk yields its state map (from every lexer state, the state at
the end), all chunks in step; the maps are composed by a parallel prefix scan,
which gives every chunk its true first state; a second pass in step emits the
boundaries. A very long text is many chunks; blocks bound the memory.

One Arrow pass, no shuffle. The tokenizer's tables (a few MB, read from its file
on each worker) are the only model.

Defined results: a null text counts as empty and has no tokens; repeated rows are
counted one by one; an empty table gives an empty table; other columns are
ignored. Special strings of the file count as one token each, wherever they are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.llm.common import append_struct, worker_cache

# --- lexer --------------------------------------------------------------------
# Character classes and states of the public splitting pattern (fixed values)
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+

END, SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, STMD, RV, E, L = range(11)
CLASSES = 11
(START, LETTERS, NUMBERS, OTHERS, ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK, QUOTED, QUOTED_RV, QUOTED_L, DONE) = range(12)
STATES = 12
HERE, BEFORE = 1, 2  # boundary before this character; before the one ahead of it


def lexer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks, by ``state * CLASSES + class``."""
    go = np.zeros((STATES, CLASSES), np.uint8)
    mark = np.zeros((STATES, CLASSES), np.uint8)
    letters = (LETTER, STMD, RV, E, L)
    fresh = {SPACE: ONE_SPACE, BLANK: ONE_BLANK, NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: QUOTED, END: START} | dict.fromkeys(letters, LETTERS)
    for state in range(STATES):
        for cls in range(CLASSES):
            go[state, cls], mark[state, cls] = fresh[cls], HERE
    stay = {LETTERS: letters, NUMBERS: (NUMBER,), OTHERS: (OTHER, QUOTE), QUOTED: (OTHER, QUOTE)}
    for state, classes in stay.items():
        for cls in classes:
            go[state, cls], mark[state, cls] = (OTHERS if state == QUOTED else state), 0
    joins = {NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: OTHERS} | dict.fromkeys(letters, LETTERS)
    for state in (ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK):
        run = state in (RUN_SPACE, RUN_BLANK)
        for cls, other in ((SPACE, RUN_SPACE), (BLANK, RUN_BLANK)):
            go[state, cls], mark[state, cls] = other, 0
        for cls, other in joins.items():
            if state in (ONE_SPACE, RUN_SPACE):
                go[state, cls], mark[state, cls] = other, BEFORE if run else 0
            else:
                mark[state, cls] = (HERE | BEFORE) if run else HERE
    # After a quote at the start of a word: a whole contraction, half of one, or no contraction.
    for cls, other in ((STMD, DONE), (RV, QUOTED_RV), (L, QUOTED_L)):
        go[QUOTED, cls], mark[QUOTED, cls] = other, 0
    for state, last in ((QUOTED_RV, E), (QUOTED_L, L)):
        for cls in range(CLASSES):
            mark[state, cls] = BEFORE | HERE
        for cls in letters:
            go[state, cls], mark[state, cls] = LETTERS, BEFORE
        go[state, last], mark[state, last] = DONE, 0
    return go.ravel(), mark.ravel()


def class_table() -> np.ndarray:
    """The class of every code point; one past the last is the end mark."""
    import regex

    table = np.full(0x110001, OTHER, np.uint8)
    every = "".join(map(chr, [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]))
    for pattern, cls in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        for m in regex.finditer(pattern + "+", every):
            shift = [c + 0x800 * (c >= 0xD800) for c in (m.start(), m.end() - 1)]
            table[shift[0] : shift[1] + 1] = cls
    for chars, cls in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("rv", RV), ("e", E), ("l", L)):
        for c in chars:
            table[ord(c)] = cls
    table[0x110000] = END
    return table


#: Characters per chunk, and chunks that are run in step.
CHUNK, LANES = 128, 1 << 13


def run_lexer(classes: np.ndarray, ahead: int, state: int, go: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, int]:
    """Boundaries (bool, one per character) of a block, and the state after it.

    ``ahead``: the class of the character after the block; ``state``: the state before it.
    """
    n = len(classes)
    lanes = -(-n // CHUNK)
    padded = np.zeros(lanes * CHUNK, np.uint8)
    padded[:n] = classes
    steps = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T)
    # State map of every chunk: from each of the states.
    maps = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], lanes, axis=1)
    for row in steps:
        maps = go[maps.astype(np.int16) * CLASSES + row]
    # Parallel prefix scan: after round k a map covers the 2^k chunks up to its own.
    reach = 1
    while reach < lanes:
        through = np.take_along_axis(maps[:, reach:], maps[:, :-reach].astype(np.intp), axis=0)
        maps = np.concatenate([maps[:, :reach], through], axis=1)
        reach *= 2
    now = np.empty(lanes, np.uint8)
    now[0], now[1:] = state, maps[state, :-1]
    marks = np.empty((CHUNK, lanes), np.uint8)
    for i, row in enumerate(steps):
        at = now.astype(np.int16) * CLASSES + row
        marks[i], now = mark[at], go[at]
        if i == (n - 1) % CHUNK:
            last = int(now[-1])
    flat = np.append(marks.T.ravel()[:n], mark[last * CLASSES + ahead])
    boundary = (flat[:-1] & HERE).astype(bool) | (flat[1:] & BEFORE).astype(bool)
    return boundary, last


# --- words --------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in the tokenizer file (fixed rule of the format)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class WordMachine:
    """Transducer over the bytes of a word, made state by state."""

    #: Bounds of the tables, by memory; beyond them a table is emptied and filled again.
    MOST_STATES = 1_000_000
    MOST_WORDS = 600_000
    MOST_PAIRS = 250_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        specials = {t["content"] for t in spec["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in specials}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {(raw(a), raw(b)): r for r, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.ids))
        # Lengths of the tokens that end with two given bytes, longest first.
        ends: dict[bytes, set[int]] = {}
        for token in self.ids:
            ends.setdefault(token[-2:], set()).add(len(token))
        self.widths = {end: sorted(found | {1}, reverse=True) for end, found in ends.items()}
        self.pair_fits: dict[tuple[bytes, bytes], bool] = {}
        self.words: dict[str, int] = {}
        self.forget_states()

    def forget_states(self, path: list[int] = []) -> list[int]:
        """Empty the tables but for the states of ``path``; returns their new numbers."""
        kept = [(self.last[s], self.count[s]) for s in path if s]
        # Transitions by ``state << 8 | byte``; per state its last token and the tokens so far. State 0 has read nothing.
        self.next: dict[int, int] = {}
        self.last: list[bytes] = [b"", *(token for token, _ in kept)]
        self.count: list[int] = [0, *(n for _, n in kept)]
        return [0] * (len(path) - len(kept)) + list(range(1, len(kept) + 1))

    def merged(self, text: bytes) -> list[bytes]:
        """Plain merging, lowest rank first, leftmost first."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def fits(self, left: bytes, right: bytes) -> bool:
        """True when the two tokens stay as they are side by side."""
        known = self.pair_fits.get((left, right))
        if known is None:
            if len(self.pair_fits) > self.MOST_PAIRS:
                self.pair_fits.clear()
            known = self.pair_fits[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def add(self, path: list[int], tail: bytes) -> int:
        """The new state after a prefix that ends with ``tail``; ``path``: the states after the prefixes before."""
        for width in self.widths.get(tail[-2:], (1,)):
            if width <= len(tail):
                token, before = tail[-width:], path[-width]
                if token in self.ids and self.fits(self.last[before], token):
                    self.last.append(token)
                    self.count.append(self.count[before] + 1)
                    return len(self.last) - 1
        raise ValueError(f"no token ends {tail!r}")

    def tokens(self, word: str) -> int:
        """Tokens of a word: the sum of the annotations along its path.

        Only as much of the word and of its path is looked at as the longest
        token needs, and the tables are emptied within a word too, so a word may
        be as long as it likes.
        """
        raw = word.encode("utf-8")
        path, emitted, room = [0], 0, self.longest
        for i, byte in enumerate(raw):
            state = path[-1]
            after = self.next.get(state << 8 | byte)
            if after is None:
                if len(self.last) > self.MOST_STATES:
                    path = self.forget_states(path[-room:])
                    state = path[-1]
                after = self.add(path, raw[max(0, i + 1 - room) : i + 1])
                self.next[state << 8 | byte] = after
            emitted += self.count[after] - self.count[state]
            path.append(after)
            if len(path) > 64 * room:
                path = path[-room:]
        if len(self.words) > self.MOST_WORDS:
            self.words.clear()
        if len(raw) <= 64:
            self.words[word] = emitted
        return emitted


class Counter:
    """Both machines; counts the tokens of many texts at a time."""

    def __init__(self, path: str):
        self.go, self.mark = lexer()
        self.classes = class_table()
        self.machine = WordMachine(path)

    def pieces(self, texts: list[str]) -> tuple[list[str], list[int], np.ndarray]:
        """Texts without special strings, the text each is of, and the number of special strings per text."""
        specials = np.zeros(len(texts), np.int64)
        out, of = [], []
        for i, text in enumerate(texts):
            parts = self.machine.specials.split(text) if self.machine.specials and self.machine.specials.search(text) else [text]
            specials[i] = len(parts) - 1
            for part in parts:
                if part:
                    out.append(part)
                    of.append(i)
        return out, of, specials

    def count(self, texts: list[str]) -> np.ndarray:
        pieces, of, totals = self.pieces(texts)
        word_counts = self.machine.words
        for begin, end in blocks(pieces):
            stream = "\0".join(pieces[begin:end]) + "\0"
            codes = np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), np.uint32)
            stops = np.cumsum([len(p) + 1 for p in pieces[begin:end]]) - 1
            classes = self.classes[codes]
            classes[stops] = END
            boundary, state = np.empty(len(codes), bool), START
            for lo in range(0, len(codes), CHUNK * LANES):
                hi = min(lo + CHUNK * LANES, len(codes))
                ahead = int(classes[hi]) if hi < len(codes) else END
                boundary[lo:hi], state = run_lexer(classes[lo:hi], ahead, state, self.go, self.mark)
            starts = np.flatnonzero(boundary)
            ends = np.append(starts[1:], len(codes))
            real = classes[starts] != END
            starts, ends = starts[real], ends[real]
            piece = np.searchsorted(stops, starts)
            counts = []
            for a, b in zip(starts.tolist(), ends.tolist()):
                word = stream[a:b]
                n = word_counts.get(word)
                if n is None:
                    n = self.machine.tokens(word)
                counts.append(n)
            np.add.at(totals, np.asarray(of, np.int64)[begin:end][piece], counts)
        return totals


BLOCK_CHARS = 4_000_000


def blocks(pieces: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of pieces of about ``BLOCK_CHARS`` characters."""
    begin = size = 0
    for i, piece in enumerate(pieces):
        size += len(piece) + 1
        if size >= BLOCK_CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(pieces):
        yield begin, len(pieces)


SCHEMA = "n_bytes long, n_tokens long, over_limit boolean"


def counts_column(text: Column, limit: int = 512, tokenizer: str = "byte_bpe_50k.json") -> Column:
    """Struct of the bytes and tokens of each text, and whether the tokens are more than ``limit``."""
    names, types = ["n_bytes", "n_tokens", "over_limit"], [pa.int64(), pa.int64(), pa.bool_()]

    @F.arrow_udf(SCHEMA)
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = worker_cache(f"token_counter_{tokenizer}", lambda: Counter(public_tokenizers.path(tokenizer)))
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            tokens = counter.count(texts)
            size = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64)
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip((size, tokens, tokens > limit), types)], names)

    return count(text)


def token_counts(docs: DataFrame, limit: int = 512, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``."""
    return append_struct(docs, counts_column(F.col("text"), limit, tokenizer))
