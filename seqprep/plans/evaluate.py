"""Evaluation: score table or texts to the metrics report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seqprep.operators.collate import clustered_batches, collate
from seqprep.operators.encode import decode
from seqprep.operators.guards import is_empty, require_columns
from seqprep.operators.metrics import compute_metrics, decode_scores, judge_scores, mean_loss
from seqprep.options import BOS_ID, PAD_ID, PrepOptions
from seqprep.session import write_shared
from seqprep.sources.tables import failed_metrics, sample_report


def training_feed(
    encoded: DataFrame, opts: PrepOptions = PrepOptions(), shuffled: bool = True, bos: int = BOS_ID, batches_per_part: int = 64
) -> DataFrame:
    """Encoded rows to collated batches, shuffled for training.

    Each batch lies in one task, in order; ``feed_part`` tells which batches lie together.
    """
    seed = opts.seed if shuffled else None
    batches = clustered_batches(encoded, opts.batch_size, seed=seed, batches_per_part=batches_per_part)
    return collate(batches, bos, PAD_ID, opts.alignment)


def evaluate_scores(scores: DataFrame, vocab: DataFrame, stop_at_eos: bool = False) -> DataFrame:
    """``bleu, gen_len, bp`` of a score table; zeros when a score is NaN."""
    return compute_metrics(decode_scores(scores, vocab, stop_at_eos=stop_at_eos), nan_flag="has_nan")


def evaluation_report(scores: DataFrame, vocab: DataFrame, key: str = "id") -> DataFrame:
    """One row with loss and text metrics; NaN loss when there is nothing.

    The scores are read once: a position's best id, loss and flag are written to
    the shared folder, and text metrics, loss and emptiness come from there.
    """
    require_columns(scores, (key, "pos", "logits", "target"))
    judged = write_shared(judge_scores(scores.select(key, "pos", "logits", "target")), "judged")
    if is_empty(judged):
        return failed_metrics(scores.sparkSession)
    text = compute_metrics(decode_scores(judged, vocab, key), nan_flag="has_nan")
    return text.withColumn("eval_loss", mean_loss(judged).scalar())


def encoded_report(encoded: DataFrame, pred: DataFrame, vocab: DataFrame, n: int = 5, columns: Sequence[str] = ("source", "reference")) -> DataFrame:
    """Sample report of encoded rows: the texts are decoded for ``n`` rows only."""
    source, reference = columns
    first = encoded.select("id", "input_ids", "labels").orderBy("id").limit(n)
    texts = decode(first, {source: "input_ids", reference: "labels"}, vocab)
    return sample_report(texts.select("id", source), texts.select("id", reference), pred, n)
