"""URL filter: rules first, then gradient-boosted trees on lexical features.

1. One pass over the URLs takes them apart, finds the longest rule that fits and
   measures the URL: lengths, depth, digit ratio, entropy, parameters, labels.
   Of a page only its id and URL are read. The result, a few dozen numbers per
   page, is written once.
2. Suffix statistics over all pages: how many pages, and how many that a rule
   blocks or allows, have the host's last label, and its last two. Suffixes are
   counted in ``BUCKETS`` hash buckets, so the tables have a fixed size.
3. URLs that a rule decides are the labelled examples. Distinct ones, drawn by
   their hash to about ``most_examples`` at most, train the trees (the training
   of the ML library, which spreads rows over executors).
4. The rule's verdict stands; every other URL gets that of the trees.

Skew: equal URLs are combined before they train; counts per bucket are combined
before the shuffle; nothing is joined but tables of ``BUCKETS`` rows.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is judged by its features; of rules of equal length the one with
the longer host wins; without any labelled URL everything is allowed, and with
labels of one kind only that kind is the verdict; repeated rows are returned each;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from math import log2

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.llm.common import lower_ascii
from seqprep.session import write_shared

#: (verdict, host and path): a rule fits its host and all subdomains, on paths that start with its path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Hash buckets of the suffix statistics, labelled URLs that train at most (about).
BUCKETS, MOST_EXAMPLES = 4096, 500_000

FEATURES = (
    "length host_length path_length query_length depth longest_segment labels longest_label digits host_digits path_digits letters "
    "hyphens underscores percents dots parameters longest_parameter fragment scheme_secure port entropy host_entropy path_entropy"
).split()


# --- taking a URL apart ---------------------------------------------------------------


def host_and_path(url: str) -> tuple[str, str]:
    """Host, A to Z lower-cased, and path; both empty without ``://``."""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    cut = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    host, slash, path = rest[:cut].partition("/")
    return lower(host), slash + path


_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text: str) -> str:
    return text.translate(_LOWER)


def entropy(text: str) -> float:
    """Bits per character."""
    n = len(text)
    return -sum(c / n * log2(c / n) for c in Counter(text).values()) if n else 0.0


def lexical(url: str, host: str, path: str) -> list[float]:
    """The features of a URL, in the order of ``FEATURES``."""
    head, _, fragment = url.partition("#")
    query = head.partition("?")[2]
    parameters = [p for p in query.split("&") if p]
    labels, segments = host.split("."), [s for s in path.split("/") if s]
    size = max(1, len(url))
    ascii_digits = lambda text: sum(map(text.count, "0123456789"))
    letters = sum(c.isalpha() for c in url)
    return [
        len(url), len(host), len(path), len(query), len(segments), max(map(len, segments), default=0), len(labels), max(map(len, labels)),
        ascii_digits(url) / size, ascii_digits(host) / max(1, len(host)), ascii_digits(path) / max(1, len(path)), letters / size,
        url.count("-") / size, url.count("_") / size, url.count("%") / size, host.count("."), len(parameters), max(map(len, parameters), default=0),
        len(fragment), float(lower(url[:8]).startswith("https://")), float(":" in host), entropy(url), entropy(host), entropy(path),
    ]


class Rules:
    """The rules by host, longest first."""

    def __init__(self, rules: Sequence[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(lower(host), []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits, and its verdict."""
        best, found = (-1, -1), (None, None)
        labels = host.split(".")
        for k in range(len(labels)) if host else ():
            own = ".".join(labels[k:])
            for start, rule, verdict in self.by_host.get(own, ()):
                if path.startswith(start) and (len(rule), len(own)) > best:
                    best, found = (len(rule), len(own)), (rule, verdict)
        return found


def suffixes(host: str) -> tuple[str, str]:
    """The host's last label and its last two."""
    labels = host.split(".")
    return labels[-1], ".".join(labels[-2:])


PARTS = "page_id long, url string, host string, path string, rule string, verdict string, suffix1 string, suffix2 string, features array<float>"


def taken_apart(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per page: host, path, the longest rule with its verdict, the last labels, the features."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Rules(rules)
        types = [pa.int64()] + [pa.string()] * 7 + [pa.list_(pa.float32())]
        names = [p.split()[0] for p in PARTS.split(", ")]
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                rows = []
                for page_id, url in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    host, path = host_and_path(url or "")
                    rows.append((page_id, url, host, path, *known.find(host, path), *suffixes(host), lexical(url or "", host, path)))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(take, PARTS)


# --- suffix statistics ------------------------------------------------------------------


def bucket(suffix: str) -> Column:
    return F.pmod(F.xxhash64(suffix), F.lit(BUCKETS)).cast("int")


def suffix_statistics(parts: DataFrame, suffix: str) -> DataFrame:
    """At most ``BUCKETS`` rows: log of the pages in the bucket, share of labelled ones and, smoothed, of blocked ones among them."""
    blocked, allowed = (F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)) for v in ("block", "allow"))
    counts = parts.groupBy(bucket(suffix).alias(f"bucket_{suffix}")).agg(F.count("*").alias("n"), blocked.alias("b"), allowed.alias("a"))
    marked = F.col("a") + F.col("b")
    figures = F.array(F.log1p("n"), marked / F.col("n"), (F.col("b") + 1) / (marked + 2))
    return counts.select(f"bucket_{suffix}", figures.cast("array<float>").alias(f"figures_{suffix}"))


def with_statistics(parts: DataFrame) -> DataFrame:
    """The parts with one feature vector of all figures."""
    rows = parts
    for suffix in ("suffix1", "suffix2"):
        table = write_shared(suffix_statistics(parts, suffix), suffix)
        rows = rows.withColumn(f"bucket_{suffix}", bucket(suffix)).join(F.broadcast(table), f"bucket_{suffix}")  # BUCKETS rows at most
    vector = array_to_vector(F.concat("features", "figures_suffix1", "figures_suffix2").cast("array<double>"))
    return rows.withColumn("vector", vector).select(*parts.columns, "vector")


# --- trees ---------------------------------------------------------------------------------


def examples(rows: DataFrame, most: int) -> DataFrame:
    """Labelled URLs, each once, drawn by hash to about ``most``: ``vector, label`` (1: block)."""
    labelled = rows.filter("verdict is not null").select(F.xxhash64("url").alias("hash"), "url", "vector", (F.col("verdict") == "block").cast("double").alias("label"))
    n = labelled.agg(F.approx_count_distinct("hash").alias("n")).first()["n"]
    drawn = labelled if n <= most else labelled.filter(F.col("hash") < -(2**63) + int(2**64 * most / n))
    once = drawn.groupBy("url").agg(F.first("vector").alias("vector"), F.first("label").alias("label"))
    return write_shared(once.select("vector", "label"), "examples")


def trained(learn: DataFrame, trees: int, depth: int, seed: int):
    """The fitted trees, or the one verdict there is to learn."""
    labels = {r["label"] for r in learn.select("label").distinct().collect()}  # two at most
    if len(labels) < 2:
        return "block" if labels == {1.0} else "allow"
    return GBTClassifier(featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed).fit(learn)


def judged(rows: DataFrame, model) -> DataFrame:
    """The rows with the verdict of the model (``learned``)."""
    if isinstance(model, str):
        return rows.withColumn("learned", F.lit(model))
    made = model.setPredictionCol("_p").setRawPredictionCol("_raw").setProbabilityCol("_share").transform(rows)
    return made.withColumn("learned", F.when(F.col("_p") > 0.5, "block").otherwise("allow")).drop("_p", "_raw", "_share")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    most_examples: int = MOST_EXAMPLES,
    trees: int = 20,
    depth: int = 4,
    seed: int = 3,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, learned``."""
    rows = with_statistics(write_shared(taken_apart(pages, rules), "urls"))
    model = trained(examples(rows, most_examples), trees, depth, seed)
    return judged(rows, model).select("page_id", "host", "path", "rule", F.coalesce("verdict", "learned").alias("verdict"), "learned")
