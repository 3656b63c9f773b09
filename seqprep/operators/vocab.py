"""Vocabulary: word counts, ids by frequency, lookups."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seqprep.functions.hashing import multiset_fingerprint
from seqprep.functions.text import words
from seqprep.operators.sampling import max_samples, nth_largest, sorted_index
from seqprep.options import BOS_ID, SPECIAL_TOKENS
from seqprep.session import write_shared

VOCAB_SCHEMA = "token string, token_id int, freq long"


def special_rows(spark: SparkSession) -> DataFrame:
    """The special tokens as vocabulary rows."""
    ids = range(len(SPECIAL_TOKENS))
    rows = pa.table(
        {
            "token": pa.array(SPECIAL_TOKENS, pa.string()),
            "token_id": pa.array(ids, pa.int32()),
            "freq": pa.array([0 for _ in ids], pa.int64()),
        }
    )
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


def word_counts(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """How often each word occurs in the given text columns.

    Counts are combined before the shuffle, so a word that makes up a third of
    the corpus still sends one row per task.
    """
    texts = [words(F.col(c) if isinstance(c, str) else c) for c in cols]
    empty = F.array().cast("array<string>")
    every = F.concat(*[F.coalesce(t, empty) for t in texts])
    return df.select(F.explode(every).alias("token")).groupBy("token").agg(F.count("*").alias("freq"))


def most_frequent(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent words of ``token, freq``; equal frequencies by word.

    The n-th frequency is found by counting frequencies; what is above it stays,
    and of the words that have it as many as are still wanted.
    """
    if n < 1:
        return counts.limit(0)
    counts = write_shared(counts, "word-counts")
    found = nth_largest(counts, "freq", n)
    if found is None:
        return counts
    edge, above = found
    return counts.filter(F.col("freq") > edge).unionByName(max_samples(counts.filter(F.col("freq") == edge), n - above, "token"))


def build_vocab(
    df: DataFrame, cols: Sequence[str | Column], min_count: int = 1, max_size: int | None = None
) -> DataFrame:
    """Vocabulary rows: the special tokens, then words by falling frequency.

    ``max_size`` bounds the whole vocabulary, special tokens included. The
    result is a written table, so ids stay frozen however often it is read.
    """
    counts = word_counts(df, cols).filter(~F.col("token").isin(*SPECIAL_TOKENS))
    if min_count > 1:
        counts = counts.filter(F.col("freq") >= min_count)
    if max_size is not None:
        counts = most_frequent(counts, max(max_size - len(SPECIAL_TOKENS), 0))
    indexed = sorted_index(counts, [F.desc("freq"), F.asc("token")], "_idx")
    ids = (F.col("_idx") + len(SPECIAL_TOKENS)).cast("int")
    ranked = indexed.select("token", ids.alias("token_id"), "freq")
    return special_rows(df.sparkSession).unionByName(ranked)


def vocab_size(vocab: DataFrame) -> int:
    """Number of tokens, special ones included."""
    return vocab.count()


def resolve_bos(vocab: DataFrame, default: int = BOS_ID) -> int:
    """The start id of the vocabulary, or the default when it has none."""
    found = vocab.filter(F.col("token") == "<bos>").select("token_id").head()
    return default if found is None else found["token_id"]


def vocab_fingerprint(vocab: DataFrame) -> str:
    """A value that changes when any token or id of the vocabulary does."""
    return multiset_fingerprint(vocab.select("token", "token_id"))


def write_vocab(vocab: DataFrame, path: str) -> None:
    """Store a vocabulary, so that ids can be decoded later."""
    vocab.select("token", "token_id", "freq").write.mode("overwrite").parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A stored vocabulary."""
    return spark.read.schema(VOCAB_SCHEMA).parquet(path)


def first_token_id(df: DataFrame, col: str, vocab, **bounds: int) -> DataFrame:
    """Rows of ``df`` with the id of their first word; unknown words drop out.

    The first word of a text is among the most skewed keys there are, so it goes
    through the array lookup, where frequent words never take a join.
    """
    from seqprep.operators.encode import lookup_arrays

    first = F.slice(F.coalesce(words(F.col(col)), F.array().cast("array<string>")), 1, 1)
    found = lookup_arrays(df.withColumn("_first", first), {"_ids": "_first"}, vocab, "token", "token_id", None, **bounds)
    return found.withColumn("token_id", F.get("_ids", F.lit(0))).filter("token_id is not null").drop("_first", "_ids")
