"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Features are figures of the text alone. Random Fourier features of the
standardised figures approximate a Gaussian kernel; each partition sums its part
of the normal equations and only those sums (``width`` rows of ``width``
numbers) meet; the driver solves one small system. A fold that the ridge has not
seen calibrates its raw scores: they are counted in fixed bins, and pooling
adjacent violators over the bins gives a monotone map into [0, 1].

The texts are read once; the figures (a few dozen floats per document) are
written to the shared folder and used for training and scoring. All labelled
rows take part, there is no sample.

Defined results: a null text counts as empty and gets a score like any text;
documents without label or with a null label are scored but not learned from;
several labels of one document are examples each; without any label of the
training folds every score is 0.5; repeated rows are scored one by one; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.session import write_shared

# --- figures ----------------------------------------------------------------------

FIGURES = (
    "log_chars log_words word_mean word_sd upper digits punctuation symbols pipes bangs other_bytes newlines "
    "distinct adjacent repeated_windows repeated_lines line_words ends title shouting runs short_words top_word "
    "longest_word long_lines sentences parentheses top_bigram"
).split()
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_PUNCTUATION = b".,;:?!'\"-"
_SYMBOLS = b"#*$%&<>@^~=+_\\/"
_PARENTHESES = b"()[]{}"
_HIGH = bytes(range(128, 256))


def figures(text: str) -> list[float]:
    """Figures of one text, all finite, shares per byte, word or line."""
    raw = text.encode("utf-8", "surrogatepass")
    size = max(1, len(raw))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    words = raw.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    windows = list(zip(words, words[1:], words[2:]))
    bigrams = Counter(zip(words, words[1:]))
    lines = [s for s in raw.split(b"\n") if s.strip()]
    n_lines = max(1, len(lines))
    count = Counter(words)
    runs = sum(raw.count(c * 2) for c in (b"#", b"*", b"$", b"%", b"&", b"!", b"=", b"-"))
    return [
        np.log1p(len(raw)), np.log1p(len(words)), lengths.mean(), lengths.std(),
        share(_UPPER), share(_DIGITS), share(_PUNCTUATION), share(_SYMBOLS), raw.count(b"|") / n, raw.count(b"!") / n,
        share(_HIGH), raw.count(b"\n") / n, len(count) / n, sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(windows)) / len(windows) if windows else 0.0, 1 - len(set(lines)) / n_lines if lines else 0.0,
        np.log1p(len(words) / n_lines), sum(s.rstrip()[-1:] in b".!?:" for s in lines) / n_lines,
        sum(w[:1] in _UPPER for w in words) / n, sum(w.isupper() for w in words) / n, runs / n,
        sum(k <= 3 for k in lengths) / n, max(count.values(), default=0) / n, np.log1p(lengths.max()),
        max((len(s) for s in lines), default=0) / size, sum(raw.count(c) for c in (b". ", b".\n", b"? ", b"! ")) / n,
        share(_PARENTHESES), max(bigrams.values(), default=0) / n,
    ]


def document_figures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and one float column per figure."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([figures(t or "") for t in batch.column(1).to_pylist()], np.float32).reshape(-1, len(FIGURES))
            columns = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(len(FIGURES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *FIGURES])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(measure, "doc_id long, " + ", ".join(f"{f} float" for f in FIGURES))


# --- kernel features and ridge -------------------------------------------------------


class Kernel:
    """Standardised figures, themselves and as random Fourier features, and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, width: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.frequencies = rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), width))
        self.phases = rng.uniform(0, 2 * np.pi, width)
        self.width = width + len(mean) + 1

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -5, 5)
        waves = np.cos(x @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([waves, x, np.ones((len(x), 1))], axis=1)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(f).to_numpy() for f in FIGURES], axis=1).astype(float)


ROWS_AT_ONCE = 4096


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(lo, ROWS_AT_ONCE)


def normal_equations(examples: DataFrame, kernel: Kernel) -> np.ndarray:
    """Sum over all examples of (features, label)^T (features, label).

    Each partition sends one row per feature; they are added up in two steps, so
    that no task adds more than a few hundred rows per feature and partition group.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kernel.width + 1, kernel.width + 1))
        for batch in batches:
            for part in _parts(batch):
                z = np.concatenate([kernel(_rows(part)), part.column("label").to_numpy().reshape(-1, 1)], axis=1)
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total])], ["i", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(r, float) for r in table.column("sums").to_pylist()], axis=0)
        return pa.table({"i": table.column("i").cast(pa.int32())[:1], "sums": pa.array([total.tobytes()])})

    sums = examples.mapInArrow(partial, "i int, sums binary").withColumn("_part", F.spark_partition_id() % 256)
    sums = sums.groupBy("i", "_part").applyInArrow(add, "i int, sums binary").groupBy("i").applyInArrow(add, "i int, sums binary")
    total = np.zeros((kernel.width + 1, kernel.width + 1))
    for row in sums.collect():  # kernel.width + 1 rows
        total[row["i"]] = np.frombuffer(row["sums"], float)
    return total


def ridge(total: np.ndarray, strength: float) -> np.ndarray:
    gram, right = total[:-1, :-1], total[:-1, -1]
    return np.linalg.solve(gram + strength * np.eye(len(gram)), right)


# --- calibration ----------------------------------------------------------------------

LOW, HIGH, BINS = -1.0, 2.0, 3000


def isotonic(counts: np.ndarray, positives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooling adjacent violators over bins: (bin centres of the blocks, shares of label 1)."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(counts):
        blocks.append([counts[i], positives[i], counts[i] * i])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    table = np.array(blocks)
    centre = LOW + (table[:, 2] / table[:, 0] + 0.5) * (HIGH - LOW) / BINS
    return centre, table[:, 1] / table[:, 0]


def raw_scores(rows: DataFrame, kernel: Kernel, weights: np.ndarray, extra: str = "") -> DataFrame:
    """``doc_id``, the ridge score and, if named, one more column."""
    kept = ["doc_id"] + [extra] * bool(extra)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                raw = np.clip(kernel(_rows(part)) @ weights, LOW, HIGH - 1e-9)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(raw)], [*kept, "raw"])

    return rows.mapInArrow(score, "doc_id long, " + f"{extra} double, " * bool(extra) + "raw double")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def quality_scores(docs: DataFrame, labels: DataFrame, width: int = 384, strength: float = 1e-2, threshold: float = 0.3) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    ``labels``: doc_id and ``quality`` (0 or 1). Folds 2 to 4 fit the ridge, fold
    1 calibrates, fold 0 is never looked at.
    """
    figures_of = write_shared(document_figures(docs), "figures")
    marked = labels.select("doc_id", F.col("quality").cast("double").alias("label")).filter("label is not null")
    examples = figures_of.join(marked.filter(fold(F.col("doc_id")) != 0), "doc_id")
    fitted = write_shared(examples, "examples")
    learn = fitted.filter(fold(F.col("doc_id")) > 1)
    moments = learn.agg(F.count("*").alias("n"), *[F.avg(f).alias(f"m_{f}") for f in FIGURES], *[F.stddev_pop(f).alias(f"s_{f}") for f in FIGURES]).first()
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    if not moments["n"]:
        score = F.lit(0.5)
        return figures_of.select("doc_id", held_out, score.alias("score"), F.lit(1).alias("predicted"))
    mean = np.array([moments[f"m_{f}"] for f in FIGURES], float)
    scale = np.array([moments[f"s_{f}"] for f in FIGURES], float)
    kernel = Kernel(mean, np.where(scale > 1e-9, scale, 1.0), width)
    total = normal_equations(learn, kernel)
    weights = ridge(total, strength * max(1.0, total[-2, -2]) / kernel.width)
    calibrate = raw_scores(fitted.filter(fold(F.col("doc_id")) == 1), kernel, weights, "label")
    bins = F.floor((F.col("raw") - LOW) * (BINS / (HIGH - LOW))).cast("int")
    counts, positives = np.zeros(BINS), np.zeros(BINS)
    for row in calibrate.groupBy(bins.alias("bin")).agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect():  # at most BINS rows
        counts[row["bin"]], positives[row["bin"]] = row["n"], row["ones"]
    centres, shares = isotonic(counts, positives) if counts.any() else (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    @F.arrow_udf("double")
    def calibrated(raw: pa.Array) -> pa.Array:
        return pa.array(np.clip(np.interp(raw.to_numpy(zero_copy_only=False), centres, shares), 0, 1))

    scored = raw_scores(figures_of, kernel, weights).select("doc_id", calibrated("raw").alias("score"))
    return scored.select("doc_id", held_out, "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
