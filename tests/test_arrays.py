import math

import pytest
from pyspark.sql import functions as F

from seqprep.functions import arrays as A



def ids(*values):
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def evaluate(spark, column):
    return spark.range(1).select(column.alias("o")).head()["o"]


def test_teacher_forcing(spark):
    labels = ids(5, 6, 3, 0)
    assert evaluate(spark, A.shift_right(labels)) == [2, 5, 6, 3]
    assert evaluate(spark, A.ignore_mask(A.target_tail(labels))) == [6, 3, -100]
    assert evaluate(spark, A.ignore_mask(labels)) == [5, 6, 3, -100]
    assert evaluate(spark, A.unmask(ids(6, 3, -100))) == [6, 3, 0]


def test_short_labels(spark):
    assert evaluate(spark, A.shift_right(ids())) == [2]
    assert evaluate(spark, A.shift_right(ids(7))) == [2]
    assert evaluate(spark, A.target_tail(ids())) == []
    assert evaluate(spark, A.target_tail(ids(7))) == []


def test_truncate_and_pad(spark):
    assert evaluate(spark, A.truncate(ids(4, 5, 6), 3)) == [4, 5, 3]
    assert evaluate(spark, A.truncate(ids(4), 3)) == [4, 3]
    assert evaluate(spark, A.truncate(ids(4, 5), 1)) == [3]
    assert evaluate(spark, A.truncate(ids(4, 5, 6), 2, add_special=False)) == [4, 5]
    assert evaluate(spark, A.pad_to(ids(4), 3)) == [4, 0, 0]
    assert evaluate(spark, A.pad_to(ids(4, 5), 1)) == [4, 5]
    assert evaluate(spark, A.attention_mask(ids(4, 5), 4)) == [1, 1, 0, 0]
    assert evaluate(spark, A.attention_mask(ids())) == []
    assert evaluate(spark, A.attention_mask(F.lit(None).cast("array<int>"), 4)) is None
    with pytest.raises(ValueError):
        A.truncate(ids(4), 0)


def test_masks_and_alignment(spark):
    assert evaluate(spark, A.padding_mask(ids(4, 0))) == [False, True]
    left, right = A.align_lengths(ids(1, 2, 3), ids(4))
    assert (evaluate(spark, left), evaluate(spark, right)) == ([1], [4])


def test_argmax(spark):
    scores = F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))
    assert evaluate(spark, A.argmax(scores)) == 1


def test_ngrams(spark):
    words = F.split(F.lit("a b c"), " ")
    assert evaluate(spark, A.ngrams(words, 1)) == ["a", "b", "c"]
    assert evaluate(spark, A.ngrams(words, 2)) == ["a b", "b c"]
    assert evaluate(spark, A.ngrams(words, 3)) == ["a b c"]
    assert evaluate(spark, A.ngrams(words, 4)) == []
    assert evaluate(spark, A.ngrams(F.array().cast("array<string>"), 2)) == []
    with pytest.raises(ValueError):
        A.ngrams(words, 0)


def test_log_sum_exp_does_not_overflow(spark):
    scores = F.array(F.lit(1000.0), F.lit(1000.0))
    assert evaluate(spark, A.log_sum_exp(scores)) == pytest.approx(1000 + math.log(2))
