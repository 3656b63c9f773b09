"""Corpus preparation: subset, normalise, vocabulary, encode, cache."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from seqprep.functions.hashing import multiset_fingerprint
from seqprep.functions.text import normalize
from seqprep.operators.encode import encode_pairs, select_pair
from seqprep.operators.guards import require_columns
from seqprep.operators.sampling import get_subset, max_samples, subset_predicate
from seqprep.operators.vocab import build_vocab, read_vocab, vocab_fingerprint, write_vocab
from seqprep.options import PrepOptions
from seqprep.sources.incremental import Changes, IncrementalSet, row_options
from seqprep.sources.parallel import eval_split_name, read_parallel
from seqprep.sources.processed import load_or_prepare


def selected_pairs(raw: DataFrame, opts: PrepOptions) -> DataFrame:
    """Both splits, cut to their share and projected to the language pair.

    The cut comes before any work on the text and is one filter over one scan.
    The evaluation split is called ``val`` from here on.
    """
    require_columns(raw, ("id", "split", "translation"))
    names = {"train": "train", eval_split_name(raw): "val"}
    caps = {"train": opts.max_train_samples, "val": opts.max_eval_samples}
    parts = {name: raw.filter(F.col("split") == name) for name in names}
    keep = F.lit(False)
    for name, part in parts.items():
        share = subset_predicate(part, opts.dataset_fraction, opts.seed)
        keep = keep | ((F.col("split") == name) & share)
    renamed = F.when(F.col("split") == "train", "train").otherwise("val")
    kept = raw.filter(F.col("split").isin(*names)).filter(keep).withColumn("split", renamed)
    if any(c is not None for c in caps.values()):
        train, val = [max_samples(kept.filter(F.col("split") == s), caps[s]) for s in ("train", "val")]
        kept = train.unionByName(val)
    return select_pair(kept, opts.source_lang, opts.target_lang)


def corpus_vocab(pairs: DataFrame, opts: PrepOptions) -> DataFrame:
    """One vocabulary for both sides, from the training rows."""
    texts = [F.col("source"), F.col("target")]
    if opts.normalize:
        texts = [normalize(t) for t in texts]
    return build_vocab(pairs.filter("split = 'train'"), texts, opts.min_count, opts.max_vocab_size)


def prepare(raw: DataFrame, opts: PrepOptions = PrepOptions(), vocab: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw pairs to encoded rows of both splits; also returns the vocabulary."""
    pairs = selected_pairs(raw, opts)
    vocab = corpus_vocab(pairs, opts) if vocab is None else vocab
    return encode_pairs(pairs, vocab, opts), vocab


def prepare_cached(
    spark: SparkSession, raw: DataFrame, root: str, opts: PrepOptions = PrepOptions(), vocab: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``prepare`` behind the processed-set cache: the rows and their vocabulary.

    The vocabulary is stored beside the set. A set is reused only for the same
    options, the same given vocabulary and the same input rows, each as often as
    before; telling that takes one pass over the rows. Input files that are added,
    changed or dropped are cheaper to follow with ``prepare_incremental``.
    """
    words = f"{root.rstrip('/')}/{opts.cache_key}/vocabulary"
    given = "" if vocab is None else vocab_fingerprint(vocab)

    def build() -> DataFrame:
        encoded, used = prepare(raw, opts, vocab)
        write_vocab(used, words)
        return encoded

    rows = load_or_prepare(spark, opts, root, build, f"{given};{multiset_fingerprint(raw)}")
    return rows, read_vocab(spark, words)


# --- following the input files ----------------------------------------------


def encoded_choice(encoded: DataFrame, opts: PrepOptions) -> DataFrame:
    """Train and evaluation rows of an encoded corpus: the splits, share and caps of ``selected_pairs``."""
    names = {"train": "train", eval_split_name(encoded): "val"}
    caps = {"train": opts.max_train_samples, "val": opts.max_eval_samples}
    chosen = []
    for name, new in names.items():
        part = get_subset(encoded.filter(F.col("split") == name), opts.dataset_fraction, opts.seed)
        chosen.append(max_samples(part, caps[new]).withColumn("split", F.lit(new)))
    return chosen[0].unionByName(chosen[1])


def prepare_incremental(
    spark: SparkSession,
    path: str,
    root: str,
    opts: PrepOptions = PrepOptions(),
    vocab: DataFrame | None = None,
    refresh_vocab: bool = False,
    **reading,
) -> tuple[DataFrame, DataFrame, Changes]:
    """Prepared rows of the corpus below ``path``, encoding only files that are new or changed.

    All rows are encoded with a frozen vocabulary: the given one, or the one the
    first run builds from its training rows (``refresh_vocab`` builds it again).
    The share and the caps of ``opts`` choose among the encoded rows, exactly as
    ``prepare`` does, so changing them encodes nothing. Another vocabulary or
    another option that shows in a row encodes every file again. ``reading`` goes
    to ``read_parallel``; formats without ids need an id column.
    """
    folder = f"{root.rstrip('/')}/{opts.cache_key}"
    stored = IncrementalSet(spark, folder)
    words = f"{folder}/vocabulary"
    if vocab is None and stored.generation() and not refresh_vocab and not opts.overwrite_cache:
        vocab = read_vocab(spark, words)
    else:
        vocab = corpus_vocab(selected_pairs(read_parallel(spark, path, **reading), opts), opts) if vocab is None else vocab
        write_vocab(vocab, words)
        vocab = read_vocab(spark, words)

    def encode(files: Sequence[str] | None) -> DataFrame:
        raw = read_parallel(spark, path, files=files, file_key=True, **reading)
        require_columns(raw, ("id", "split", "translation"))
        pairs = select_pair(raw, opts.source_lang, opts.target_lang, keep=("id", "split", "file"))
        return encode_pairs(pairs, vocab, opts, keep=("split", "file"))

    fingerprint = row_options(opts, vocab_fingerprint(vocab))
    if opts.overwrite_cache:
        fingerprint = f"{fingerprint} {uuid.uuid4().hex}"
    changes = stored.update(path, encode, fingerprint)
    return encoded_choice(stored.rows(), opts), vocab, changes
