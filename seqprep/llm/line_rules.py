"""Quality rules, lines first.

Every line is judged by itself; lines that fail are removed; a document that
loses more than half of its word characters that way is rejected. Base figures
of the whole text (word counts, symbols, repeated windows) reject a document
at once.

One Arrow pass over the texts, no shuffle: a row needs nothing but itself.

Defined results: a null text counts as empty, an empty text has zero counts and
is rejected (fewer than ``min_words``); repeated rows are judged one by one; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from seqprep.llm.common import append_struct

# Characters that count as symbols, ASCII white space, boilerplate.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\v\f"
BOILERPLATE = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie policy|accept (all )?cookies"
    "|enable javascript|javascript is disabled|click here|sign up now|subscribe to our newsletter"
    "|share on (facebook|twitter)|lorem ipsum"
)
RUNS = "[#*$%&|<>!]{2,}"
SENTENCE_END = "[.!?:;…。]"

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_lines_removed long, removed_word_chars long, clean_text string"
)
FIELDS = [part.split()[0] for part in SCHEMA.split(", ")]
KEPT, CLEAN_TEXT = FIELDS.index("kept"), FIELDS.index("clean_text")

_boilerplate = re.compile(f"(?i:{BOILERPLATE})", re.ASCII)
_runs = re.compile(RUNS)
_sentence_end = re.compile(SENTENCE_END)


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, SPACES))


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that the text holds at least twice."""
    windows = list(zip(*(words[k:] for k in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple[bytes, ...], int] = {}
    hit = bytearray(len(words))
    mark = b"\x01" * width
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            hit[i : i + width] = mark
            hit[j : j + width] = mark
    return hit.count(1)


def line_fails(line: str, words: list[bytes]) -> bool:
    """True when a line with words is navigation, symbol noise, boilerplate or no sentence."""
    n = len(words)
    pipes = line.count("|")
    if pipes and 4 * pipes >= n:
        return True
    if "!!" in line or any(map(line.count, SYMBOLS)):
        runs = len(_runs.findall(line))
        if runs >= 2 and 4 * runs >= n:
            return True
    if n >= 12 and not _sentence_end.search(line):
        return True
    if n >= 10 and 2 * sum(map(bytes.__eq__, words, words[1:])) > n:
        return True
    return n <= 20 and _boilerplate.search(line) is not None


def judge(text: str, min_words: int, max_repeat_pct: int, max_lost_pct: int) -> tuple:
    words = text.encode("utf-8", "surrogatepass").split()
    chars = word_chars(text)
    repeats = repeated_window_words(words)
    failed = len(words) < min_words or 100 * repeats > max_repeat_pct * len(words)
    seen: set[str] = set()
    lines = text.split("\n")
    kept: list[str] = []
    duplicates = lost = 0
    for line in lines:
        own = line.encode("utf-8", "surrogatepass").split()
        if not own:
            kept.append(line)
            continue
        again = line in seen
        seen.add(line)
        duplicates += again
        if (again and len(own) >= 3) or line_fails(line, own):
            lost += word_chars(line)
        else:
            kept.append(line)
    verdict = not failed and 100 * lost <= max_lost_pct * chars
    symbols = sum(map(text.count, SYMBOLS))
    removed = len(lines) - len(kept)
    return (len(words), chars, symbols, duplicates, repeats, failed, verdict, len(lines), removed, lost, "\n".join(kept))


def rules_column(text: Column, min_words: int = 50, max_repeat_pct: int = 50, max_lost_pct: int = 50) -> Column:
    """Struct of the figures, the verdict and the text without its failing lines."""
    types = [pa.bool_() if f in ("base_failed", "kept") else pa.string() if f == "clean_text" else pa.int64() for f in FIELDS]

    @F.arrow_udf(SCHEMA)
    def rules(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [judge(t or "", min_words, max_repeat_pct, max_lost_pct) for t in texts.to_pylist()]
            columns = zip(*rows) if rows else [[]] * len(FIELDS)
            yield pa.StructArray.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], FIELDS)

    return rules(text)


def line_rules(docs: DataFrame, **options: int) -> DataFrame:
    """One row per document: ``doc_id``, the figures, ``kept`` and ``clean_text``."""
    return append_struct(docs, rules_column(F.col("text"), **options))


#: Documents judged at a time.
ROWS_AT_ONCE = 256


def keep_clean(docs: DataFrame, min_words: int = 50, max_repeat_pct: int = 50, max_lost_pct: int = 50) -> DataFrame:
    """The documents that are kept, with cleaned texts; columns as given, ``n_chars`` counted anew.

    One Arrow pass that judges a text and drops or cleans its row, so no rule
    runs twice.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields])
    names = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(lo, ROWS_AT_ONCE)
                judged = [judge(t or "", min_words, max_repeat_pct, max_lost_pct) for t in part.column(at).to_pylist()]
                kept = [j[KEPT] for j in judged]
                texts = [j[CLEAN_TEXT] for j in judged if j[KEPT]]
                columns = part.filter(pa.array(kept, pa.bool_())).columns
                columns[at] = pa.array(texts, columns[at].type)
                if "n_chars" in names:
                    columns[names.index("n_chars")] = pa.array(list(map(len, texts)), columns[names.index("n_chars")].type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(clean, schema)
