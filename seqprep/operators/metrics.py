"""Translation quality and sequence metrics.

BLEU counts n-grams inside a row, so nothing has to meet across rows before
the final sums: the plan is one narrow pass and one aggregate of a few
counters, whatever the number of rows or the skew of any key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.functions.text import strip, tok13a, word_count
from seqprep.operators.sampling import Key, _keys
from seqprep.options import EOS_ID, IGNORE_ID, PAD_ID

MAX_ORDER = 4
_ORDERS = range(1, MAX_ORDER + 1)


# --- pairs ----------------------------------------------------------------


def align_predictions(pred: DataFrame, ref: DataFrame, on: Key = "id") -> DataFrame:
    """Predictions next to their references."""
    return pred.join(ref, _keys(on))


def valid_pair(prediction: Column, references: Column) -> Column:
    """True when neither the prediction nor its first reference is blank."""
    return (F.length(strip(prediction)) > 0) & (F.length(strip(F.try_element_at(references, F.lit(1)))) > 0)


def drop_empty_pairs(df: DataFrame) -> DataFrame:
    """Stripped pairs, without those that are blank on either side."""
    kept = df.filter(valid_pair(F.col("prediction"), F.col("references")))
    return kept.withColumns(
        {"prediction": strip(F.col("prediction")), "references": F.transform("references", strip)}
    )


# --- n-gram counts --------------------------------------------------------


#: Words whose n-grams are counted at a time; a row with more is counted alone.
WORDS_AT_ONCE = 1 << 17


def _count_matches(hyp: pa.Array, refs: pa.Array) -> pa.Array:
    """Clipped n-gram matches of every row of a batch, orders 1 to 4.

    The batch is worked through a run of rows at a time, so what is built from it
    stays small, however many rows Spark sends at once.
    """
    rows = len(hyp)
    before = np.cumsum([0, *refs.flatten().value_lengths().to_numpy(zero_copy_only=False)])
    ends = np.cumsum(refs.value_lengths().to_numpy(zero_copy_only=False))
    # Words of all rows up to and including each.
    total, cuts = np.cumsum(hyp.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64) + before[ends], [0]
    while cuts[-1] < rows:
        done = total[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(int(np.searchsorted(total, done + WORDS_AT_ONCE, "right")), cuts[-1] + 1))
    parts = [_run_matches(hyp.slice(lo, hi - lo), refs.slice(lo, hi - lo)) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    matches = np.concatenate([np.zeros((MAX_ORDER, 0), np.int64), *parts], axis=1)
    return pa.StructArray.from_arrays([pa.array(m) for m in matches], [f"m{n}" for n in _ORDERS])


def _run_matches(hyp: pa.Array, refs: pa.Array) -> np.ndarray:
    """The matches of some rows, an array per order.

    Words get integer codes; an n-gram's code comes from the code of its first
    n-1 words and of its last one, renumbered each time. Codes are exact (no
    hashing) and carry the row, so one sort per order counts all the rows.
    """
    rows = len(hyp)
    ref_words, ref_lens = refs.flatten(), refs.value_lengths().to_numpy(zero_copy_only=False)
    lists = len(ref_words)
    # An empty array may come without buffers, which concatenation rejects.
    parts = [a for a in (hyp.flatten(), ref_words.flatten()) if len(a)]
    flat = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(codes.max(initial=0)) + 1
    # Sequence number of each word, and the row each sequence belongs to.
    lengths = pa.concat_arrays([hyp.value_lengths(), ref_words.value_lengths()]).to_numpy(zero_copy_only=False)
    owner = np.concatenate([np.arange(rows), np.repeat(np.arange(rows), ref_lens)])
    seq = np.repeat(np.arange(rows + lists), lengths)
    start = np.arange(len(codes))
    gram = owner[seq] * width + codes
    matches = np.zeros((MAX_ORDER, rows), np.int64)
    for n in range(MAX_ORDER):
        if n:
            inside = start + n < len(codes)
            inside[inside] = seq[start[inside] + n] == seq[start[inside]]
            start, gram = start[inside], gram[inside] * width + codes[start[inside] + n]
        unique, gram = np.unique(gram, return_inverse=True)
        gram_row = np.zeros(len(unique), np.int64)
        gram_row[gram] = owner[seq[start]]
        from_hyp = seq[start] < rows
        in_hyp = np.bincount(gram[from_hyp], minlength=len(unique))
        # Highest count of the gram in any one reference.
        per_ref, times = np.unique(seq[start][~from_hyp] * max(len(unique), 1) + gram[~from_hyp], return_counts=True)
        in_ref = np.zeros(len(unique), np.int64)
        np.maximum.at(in_ref, per_ref % max(len(unique), 1), times)
        clipped = np.minimum(in_hyp, in_ref)
        matches[n] = np.bincount(gram_row, weights=clipped, minlength=rows)
    return matches


def ngram_counts(
    df: DataFrame, prediction: str = "prediction", references: str = "references", tokenize=tok13a
) -> DataFrame:
    """Per row: clipped matches ``m1..m4``, totals ``t1..t4`` and both lengths.

    With several references a match is clipped at the highest count in any of
    them, and the shortest one gives the reference length. Missing texts count
    as empty.
    """
    empty = F.array().cast("array<string>")
    hyp = F.coalesce(tokenize(F.col(prediction)), empty)
    refs = F.coalesce(
        F.transform(references, lambda r: F.coalesce(tokenize(r), empty)), F.array().cast("array<array<string>>")
    )
    kind = ",".join(f"m{n}:bigint" for n in _ORDERS)
    counted = df.withColumns({"_hyp": hyp, "_refs": refs}).withColumn(
        "_m", F.arrow_udf(_count_matches, f"struct<{kind}>")("_hyp", "_refs")
    )
    ref_len = F.array_min(F.transform("_refs", F.size))
    stats = {f"m{n}": F.col(f"_m.m{n}") for n in _ORDERS}
    stats |= {f"t{n}": F.greatest(F.size("_hyp") - (n - 1), F.lit(0)).cast("long") for n in _ORDERS}
    stats |= {"hyp_len": F.size("_hyp").cast("long"), "ref_len": F.coalesce(ref_len, F.lit(0)).cast("long")}
    return counted.withColumns(stats).drop("_hyp", "_refs", "_m")


COUNTERS = tuple(f"m{n}" for n in _ORDERS) + tuple(f"t{n}" for n in _ORDERS) + ("hyp_len", "ref_len")


def ngram_matches(df: DataFrame, by: Sequence[str] = (), **kwargs) -> DataFrame:
    """The counters of ``ngram_counts`` summed over the corpus (or per group)."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]
    return ngram_counts(df, **kwargs).groupBy(*by).agg(*sums)


# --- formulas over summed counters ----------------------------------------


def precision(n: int) -> Column:
    """Modified precision of order n, 0 when there is no n-gram at all."""
    matched, total = F.col(f"m{n}"), F.col(f"t{n}")
    return F.when(total > 0, matched / total).otherwise(F.lit(0.0))


def precisions(sums: DataFrame) -> DataFrame:
    """Columns ``p1..p4`` next to the summed counters."""
    return sums.withColumns({f"p{n}": precision(n) for n in _ORDERS})


def brevity() -> Column:
    """Brevity penalty over summed lengths; 0 when a side is empty."""
    hyp, ref = F.col("hyp_len"), F.col("ref_len")
    return (
        F.when((hyp == 0) | (ref == 0), F.lit(0.0))
        .when(hyp > ref, F.lit(1.0))
        .otherwise(F.exp(1 - ref / hyp))
    )


def brevity_penalty(sums: DataFrame) -> DataFrame:
    """Column ``bp`` next to the summed counters."""
    return sums.withColumn("bp", brevity())


def bleu() -> Column:
    """Unsmoothed BLEU over summed counters; 0 when any precision is 0."""
    some_zero = F.least(*[F.col(f"m{n}") for n in _ORDERS]) == 0
    mean_log = sum((F.ln(precision(n)) for n in _ORDERS), F.lit(0.0)) / MAX_ORDER
    return F.when(some_zero, F.lit(0.0)).otherwise(brevity() * F.exp(mean_log))


def round_metric(value: Column, digits: int = 4) -> Column:
    """Rounded; NULL and NaN become 0."""
    return F.round(F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0)), digits)


def _blank_pairs_masked(df: DataFrame) -> DataFrame:
    """Stripped texts in ``_pred`` and ``_texts``, NULL when the pair is blank.

    A masked pair adds nothing to any counter, which is what dropping it does,
    and costs no second evaluation of the texts in a filter.
    """
    ok = valid_pair(F.col("prediction"), F.col("references"))
    return df.withColumns(
        {
            "_pred": F.when(ok, strip(F.col("prediction"))),
            "_texts": F.when(ok, F.transform("references", strip)),
        }
    )


def corpus_bleu(df: DataFrame, by: Sequence[str] = (), **kwargs) -> DataFrame:
    """BLEU and brevity penalty of the non-blank pairs, per group if asked."""
    sums = ngram_matches(_blank_pairs_masked(df), by, prediction="_pred", references="_texts", **kwargs)
    return sums.select(*by, round_metric(bleu()).alias("bleu"), round_metric(brevity()).alias("bp"))


def mean_gen_len(df: DataFrame, by: Sequence[str] = (), prediction: str = "prediction") -> DataFrame:
    """Mean number of words of all predictions, blank ones included."""
    words = F.coalesce(word_count(F.col(prediction)), F.lit(0))
    return df.groupBy(*by).agg(round_metric(F.avg(words)).alias("gen_len"))


def compute_metrics(
    df: DataFrame, by: Sequence[str] = (), extra: Sequence[Column] = (), nan_flag: str | None = None, **kwargs
) -> DataFrame:
    """The evaluation report ``bleu, gen_len, bp`` in a single pass.

    Blank pairs count for the length but not for BLEU. ``nan_flag`` names a
    boolean column; one true value sets the report to zero. ``extra`` holds
    further aggregates to report next to it.
    """
    words = F.coalesce(word_count(F.col("prediction")), F.lit(0))
    masked = _blank_pairs_masked(df).withColumn("_words", words)
    counted = ngram_counts(masked, prediction="_pred", references="_texts", **kwargs)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]
    poisoned = F.bool_or(nan_flag) if nan_flag else F.lit(False)
    report = counted.groupBy(*by).agg(
        *sums, F.avg("_words").alias("gen_len"), F.coalesce(poisoned, F.lit(False)).alias("_nan"), *extra
    )
    shown = {"bleu": bleu(), "gen_len": F.col("gen_len"), "bp": brevity()}
    metrics = [F.when(F.col("_nan"), F.lit(0.0)).otherwise(round_metric(v)).alias(n) for n, v in shown.items()]
    used = {*COUNTERS, "_nan", *shown, *by}
    return report.select(*by, *metrics, *[c for c in report.columns if c not in used])


# --- score tables ---------------------------------------------------------


def token_accuracy(df: DataFrame, pred: str = "pred", target: str = "target", pad: int = PAD_ID) -> DataFrame:
    """Share of non-padding positions where the prediction is the target."""
    hit = (F.col(pred) == F.col(target)).cast("int")
    return df.filter(F.col(target) != pad).agg(F.avg(hit).alias("accuracy"))


#: Scores worked on at a time, in double precision.
CELLS = 1 << 20

SCORED = "struct<best: int, loss: double, unusable: boolean>"


def _judged_scores(logits: pa.Array, targets: pa.Array) -> pa.Array:
    """Best id, cross-entropy and unusability of every score array of a batch.

    Arrays of one width are worked on as matrices, so a batch of equal widths is
    a handful of vectorised steps. NULL scores are passed over by the best id and
    leave no loss; a NaN is the highest score.
    """
    n = len(logits)
    lengths = pc.fill_null(logits.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = logits.flatten()
    holes = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    target = pc.fill_null(targets.cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
    best, loss = np.zeros(n, np.int32), np.zeros(n)
    no_best, no_loss = np.ones(n, bool), np.ones(n, bool)
    unusable = logits.is_null().to_numpy(zero_copy_only=False).copy()
    for width in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == width)
        step = max(1, CELLS // width)
        for lo in range(0, len(rows), step):
            own = rows[lo : lo + step]
            cells = starts[own][:, None] + np.arange(width)
            block, hole = values[cells].astype(float), holes[cells]
            missing, broken = hole.any(axis=1), np.isnan(block).any(axis=1)  # NULL reads as NaN
            shown = np.where(hole, -np.inf, block) if missing.any() else block
            best[own], no_best[own], unusable[own] = shown.argmax(axis=1), hole.all(axis=1), broken
            with np.errstate(all="ignore"):
                top = block.max(axis=1)
                spread = top + np.log(np.exp(block - top[:, None]).sum(axis=1))
            inside = (target[own] >= 0) & (target[own] < width)
            loss[own] = spread - block[np.arange(len(own)), np.where(inside, target[own], 0)]
            no_loss[own] = ~inside | missing
    columns = [pa.array(best, mask=no_best), pa.array(loss, mask=no_loss), pa.array(unusable)]
    return pa.StructArray.from_arrays(columns, ["best", "loss", "unusable"])


def judge_scores(df: DataFrame, logits: str = "logits", target: str = "target") -> DataFrame:
    """The score array replaced by what every metric needs of it: ``best, loss, unusable``.

    One vectorised pass over the widest column there is: the first best id, the
    cross-entropy (NULL without a target inside the array or with a NULL score),
    and whether the array is NULL or holds a NaN or a NULL.
    """
    judged = F.arrow_udf(_judged_scores, SCORED)(F.col(logits), F.col(target).cast("long"))
    made = df.withColumn("_judged", judged).drop(logits)
    return made.select(*[c for c in made.columns if c != "_judged"], "_judged.*")


def mean_loss(judged: DataFrame, target: str = "target", ignore: Sequence[int] = (IGNORE_ID, PAD_ID)) -> DataFrame:
    """Mean cross-entropy of judged positions that are not ignored."""
    kept = judged.filter(~F.col(target).isin(*ignore)) if ignore else judged
    return kept.agg(F.avg("loss").alias("loss"))


def masked_xent(
    df: DataFrame, logits: str = "logits", target: str = "target", ignore: Sequence[int] = (IGNORE_ID, PAD_ID)
) -> DataFrame:
    """Mean cross-entropy over the positions that are not ignored."""
    kept = df.filter(~F.col(target).isin(*ignore)) if ignore else df
    return mean_loss(judge_scores(kept.select(logits, target), logits, target), target, ())


def decode_scores(
    df: DataFrame, vocab: DataFrame, key: str = "id", stop_at_eos: bool = False, pad: int = PAD_ID, **bounds: int
) -> DataFrame:
    """Score table to text: best id per position, regrouped and decoded.

    Input is one row per position (``id, pos, logits, target``, or judged
    already); the scores are reduced to one id before the shuffle. Output has
    ``prediction``, ``references`` and ``has_nan`` (some score of the text is NaN).
    """
    from seqprep.operators.encode import decode

    judged = df if "best" in df.columns else judge_scores(df.select(key, "pos", "logits", "target"))
    best = judged.select(
        key,
        "pos",
        F.col("best").alias("p"),
        F.when(F.col("target") == IGNORE_ID, F.lit(pad)).otherwise(F.col("target")).alias("t"),
        F.col("unusable").alias("nan"),
    )
    rows = F.sort_array(F.collect_list(F.struct("pos", "p", "t")))
    texts = best.groupBy(key).agg(rows.alias("_rows"), F.bool_or("nan").alias("has_nan"))
    pred, target = F.col("_rows.p"), F.col("_rows.t")
    if stop_at_eos:
        end = F.array_position(pred, EOS_ID)
        pred = F.when(end > 0, F.slice(pred, F.lit(1), end.cast("int") - 1)).otherwise(pred)
    ids = texts.select(key, "has_nan", pred.alias("_pred_ids"), target.alias("_ref_ids"))
    text = decode(ids, {"prediction": "_pred_ids", "_reference": "_ref_ids"}, vocab, **bounds)
    return text.select(key, "prediction", F.array("_reference").alias("references"), "has_nan")
