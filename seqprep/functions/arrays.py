"""Array functions over token ids, words and scores (Column in, Column out)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from seqprep.options import BOS_ID, EOS_ID, IGNORE_ID, PAD_ID


def _repeat(value: int, times: Column) -> Column:
    return F.array_repeat(F.lit(value), F.greatest(times, F.lit(0)))


# --- encoding -------------------------------------------------------------


def append_eos(ids: Column, eos: int = EOS_ID) -> Column:
    """The ids followed by the end-of-sequence id."""
    return F.concat(ids, F.array(F.lit(eos)))


def truncate(ids: Column, max_len: int, add_special: bool = True, eos: int = EOS_ID) -> Column:
    """At most ``max_len`` ids; with ``add_special`` the last one is the end id."""
    if max_len < 1:
        raise ValueError("max_len must be at least 1")
    if not add_special:
        return F.slice(ids, 1, max_len)
    return append_eos(F.slice(ids, 1, max_len - 1), eos)


def pad_to(ids: Column, length: Column | int, pad: int = PAD_ID) -> Column:
    """Fill up with ``pad`` to ``length``; longer arrays stay as they are."""
    length = length if isinstance(length, Column) else F.lit(length)
    return F.concat(ids, _repeat(pad, length - F.size(ids)))


def attention_mask(ids: Column, length: Column | int | None = None) -> Column:
    """1 for each of the ids, then 0 up to ``length``."""
    ones = F.when(ids.isNotNull(), _repeat(1, F.size(ids)))
    return ones if length is None else pad_to(ones, length, 0)


# --- teacher forcing ------------------------------------------------------


def shift_right(labels: Column, bos: int = BOS_ID) -> Column:
    """Start id, then the labels without their last element."""
    return F.concat(F.array(F.lit(bos)), F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0))))


def target_tail(labels: Column) -> Column:
    """The labels without their first element."""
    return F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(0)))


def ignore_mask(ids: Column, pad: int = PAD_ID) -> Column:
    """Padding becomes the ignored label."""
    return F.transform(ids, lambda x: F.when(x == pad, F.lit(IGNORE_ID)).otherwise(x))


def unmask(ids: Column, pad: int = PAD_ID) -> Column:
    """The ignored label becomes padding again."""
    return F.transform(ids, lambda x: F.when(x == IGNORE_ID, F.lit(pad)).otherwise(x))


def padding_mask(ids: Column, pad: int = PAD_ID) -> Column:
    """True where an id is padding."""
    return F.transform(ids, lambda x: x == pad)


def align_lengths(left: Column, right: Column) -> tuple[Column, Column]:
    """Both arrays cut to the shorter length."""
    n = F.least(F.size(left), F.size(right))
    return F.slice(left, 1, n), F.slice(right, 1, n)


# --- n-grams, scores, vectors ---------------------------------------------


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring words, joined by a blank."""
    if n < 1:
        raise ValueError("n must be at least 1")
    count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    shifted = [F.slice(tokens, k + 1, count) for k in range(n)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat_ws(" ", x, y)), shifted)


def argmax(scores: Column) -> Column:
    """Position of the first maximum, from 0. NaN is the guards' business."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def dot(left: Column, right: Column) -> Column:
    """Inner product in double precision."""
    product = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda total, x: total + x)


def log_sum_exp(scores: Column) -> Column:
    """log(sum(exp(scores))), shifted by the maximum so that exp cannot overflow."""
    top = F.array_max(scores).cast("double")
    total = F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - top))
    return top + F.ln(total)
