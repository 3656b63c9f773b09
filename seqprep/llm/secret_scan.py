"""Secret scans over a trigram index.

Each rule's regular expression is turned into a Boolean query over trigrams
that every match must contain. Per Arrow batch an inverted index (trigram to
documents) is built over the lower-cased bytes, only for the trigrams that some
rule asks for; postings are intersected and united as the query says, and the
rule's expression runs on the surviving documents alone. A rule without
mandatory trigrams runs on every document.

A row needs nothing but itself, so there is no shuffle, and the index of a
batch is dropped with the batch.

Defined results: a null text counts as empty and has no spans; offsets are code
points, ends exclusive; repeated rows are scanned one by one; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as C, _parser as P  # type: ignore[attr-defined]

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.llm.common import append_struct, worker_cache


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds, then well-known public credential formats.
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
RULES = BASE + (
    # The whole block: header lines, base64 text (line ends may be escaped) and, where it is there, the end line.
    Rule(
        "private_key",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
        r"(?:(?:[\x20\t\r\n]|\\[rn])*(?:[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9+/]{1,15}={1,2}|(?:Proc-Type|DEK-Info|Comment):[^\r\n]*))*"
        r"(?:(?:[\x20\t\r\n]|\\[rn])*[A-Za-z0-9+/]{0,76}={0,2}(?:[\x20\t\r\n]|\\[rn])*-----END [A-Z ]*PRIVATE KEY-----)?",
    ),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

# --- from expression to Boolean query ---------------------------------------
# A query is True (any document), a trigram (bytes), ("and", ...) or ("or", ...).

Query = bool | bytes | tuple
MOST_STRINGS = 64


def _both(*parts: Query) -> Query:
    kept = tuple(dict.fromkeys(p for p in parts if p is not True))
    return True if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def _any(*parts: Query) -> Query:
    if True in parts or not parts:
        return True
    kept = tuple(dict.fromkeys(parts))
    return kept[0] if len(kept) == 1 else ("or", *kept)


def _of_string(s: str) -> Query:
    raw = s.encode()
    return _both(*(raw[i : i + 3] for i in range(len(raw) - 2))) if len(raw) >= 3 else True


def _strings(op: object, arg: object) -> set[str] | None:
    """The lower-cased strings a node matches, if they are few."""
    if op is C.LITERAL:
        return {chr(arg).lower()} if arg < 128 else None
    if op is C.IN:
        found: set[str] = set()
        for kind, value in arg:
            if kind is C.LITERAL and value < 128:
                found.add(chr(value).lower())
            elif kind is C.RANGE and value[1] < 128:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= 5 else None
    if op is C.SUBPATTERN:
        return _sequence_strings(arg[-1])
    if op is C.BRANCH:
        parts = [_sequence_strings(p) for p in arg[1]]
        return set().union(*parts) if None not in parts else None
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] is not C.MAXREPEAT and arg[1] <= 5:
        once = _sequence_strings(arg[2])
        if once is None:
            return None
        found, power = set(), {""}
        for n in range(arg[1] + 1):
            found |= power if n >= arg[0] else set()
            power = {a + b for a in power for b in once}
            if len(power) > MOST_STRINGS:
                return None
        return found
    return None


def _sequence_strings(nodes: object) -> set[str] | None:
    found = {""}
    for op, arg in nodes:
        own = _strings(op, arg)
        if own is None or len(found) * len(own) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in own}
    return found


def _sequence_query(nodes: object) -> Query:
    parts: list[Query] = []
    run = {""}

    def flush() -> None:
        nonlocal run
        parts.append(_any(*(_of_string(s) for s in run)))
        run = {""}

    for op, arg in nodes:
        own = _strings(op, arg)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        flush()
        if own is not None:
            run = own
        elif op is C.SUBPATTERN:
            parts.append(_sequence_query(arg[-1]))
        elif op is C.BRANCH:
            parts.append(_any(*(_sequence_query(p) for p in arg[1])))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
            parts.append(_sequence_query(arg[2]))
    flush()
    return _both(*parts)


def trigram_query(pattern: str) -> Query:
    """What the lower-cased bytes of every text with a match must contain."""
    return _sequence_query(P.parse(pattern, re.ASCII))


def trigrams_of(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(trigrams_of, query[1:])) if isinstance(query, tuple) else set()


# --- index of a batch -------------------------------------------------------

BLOCK = 1 << 21


def postings(raw: np.ndarray, ends: np.ndarray, wanted: list[bytes], table: np.ndarray) -> np.ndarray:
    """Boolean matrix, trigram by document. ``ends``: where each text ends in ``raw``."""
    found = np.zeros((len(wanted), len(ends)), bool)
    for begin in range(0, max(0, len(raw) - 2), BLOCK):
        part = raw[begin : begin + BLOCK + 2].astype(np.uint32)
        part += ((part >= 65) & (part <= 90)).astype(np.uint32) * 32
        slots = table[(part[:-2] << 16) | (part[1:-1] << 8) | part[2:]]
        at = np.flatnonzero(slots)
        doc = np.searchsorted(ends, begin + at, side="right")
        inside = begin + at + 3 <= ends[doc]
        found[slots[at][inside] - 1, doc[inside]] = True
    return found


def documents_for(query: Query, found: np.ndarray, row: dict[bytes, int]) -> np.ndarray:
    if query is True:
        return np.ones(found.shape[1], bool)
    if isinstance(query, bytes):
        return found[row[query]]
    parts = [documents_for(q, found, row) for q in query[1:]]
    return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)


class Scanner:
    """Compiled rules with their queries and the table of wanted trigrams."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.compiled = [re.compile(r.pattern, re.ASCII) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.wanted = sorted(set().union(*map(trigrams_of, self.queries)))
        if len(self.wanted) > 65_000:
            raise ValueError("the rules ask for more than 65,000 trigrams")
        self.row = {t: i for i, t in enumerate(self.wanted)}
        self.table = np.zeros(1 << 24, np.uint16)
        for i, t in enumerate(self.wanted):
            self.table[int.from_bytes(t, "big")] = i + 1

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For every text its spans: (start, number of the rule, end), in order."""
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        ends = np.cumsum([len(b) for b in encoded], dtype=np.int64)
        found = postings(np.frombuffer(b"".join(encoded), np.uint8), ends, self.wanted, self.table)
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, compiled, query) in enumerate(zip(self.rules, self.compiled, self.queries)):
            for d in np.flatnonzero(documents_for(query, found, self.row)):
                for m in compiled.finditer(texts[d]):
                    a, b = m.span(rule.group)
                    if b - a >= rule.least:
                        spans[d].append((m.start(), k, m.end()))
        for own in spans:
            own.sort()
        return spans


def redact(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """The text with every stretch covered by a span replaced by one mask."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string"


def secrets_column(text: Column, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> Column:
    """Struct of counts, digest, spans and the text without the secrets (null where it is unchanged)."""
    names = [p.split()[0] for p in SCHEMA.split(", ")]
    types = [pa.int64()] * 3 + [pa.string()] * 3

    @F.arrow_udf(SCHEMA)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = worker_cache("secret_scanner_" + hashlib.sha1(repr(rules).encode()).hexdigest(), lambda: Scanner(rules))
        kinds = [r.kind for r in rules]
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            rows = []
            for text, spans in zip(texts, scanner.scan(texts)):
                shown = [(kinds[k], f"{kinds[k]}:{a}:{b}") for a, k, b in spans]
                base = [s for kind, s in shown if kind in ("assign", "access", "hex")]
                count = [sum(kind == base_kind for kind, _ in shown) for base_kind in ("assign", "access", "hex")]
                digest = hashlib.sha256(",".join(base).encode()).hexdigest()
                rows.append((*count, digest, ",".join(s for _, s in shown), redact(text, spans, mask) if spans else None))
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.StructArray.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    return scan(text)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: counts by base kind, digest, spans as text, and ``redacted`` (null: nothing found)."""
    return append_struct(docs, secrets_column(F.col("text"), rules))


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every secret masked; columns as given, ``n_chars`` counted anew."""
    made = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), secrets_column(F.col("text"), rules).alias("_made"))
    text = F.coalesce("_made.redacted", "_doc.text")
    fresh = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return made.select(*[fresh[c].alias(c) if c in fresh else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
