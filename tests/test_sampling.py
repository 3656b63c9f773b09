import hashlib

import pytest
from pyspark.sql import functions as F

from seqprep.operators import sampling as S


def frame(spark, n):
    return spark.range(n).withColumnRenamed("id", "id")


@pytest.mark.parametrize(
    "length, fraction, size",
    [(10, 0, 0), (10, 0.05, 1), (10, 0.25, 2), (10, 1.0, 10), (10, 1.5, 10), (10, -1, 0), (0, 0.5, 0)],
)
def test_subset_size(spark, length, fraction, size):
    assert S.subset_size(length, fraction) == size
    assert S.get_subset(frame(spark, length), fraction).count() == size


def hashed(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


def test_subset_is_the_lowest_hashes_and_nested(spark):
    df = frame(spark, 5000)
    order = sorted(range(5000), key=hashed)
    found = {f: {r["id"] for r in S.get_subset(df, f).collect()} for f in (0.1, 0.25)}
    assert found[0.1] == set(order[:500])
    assert found[0.1] < found[0.25]
    assert {r["id"] for r in S.get_subset(df, 0.1, seed=7).collect()} != found[0.1]


def test_subset_descends_more_than_one_level(spark, monkeypatch):
    monkeypatch.setattr(S, "TOP_K_LIMIT", 1)
    df = frame(spark, 20_000)
    order = sorted(range(20_000), key=hashed)
    assert {r["id"] for r in S.get_subset(df, 0.3).collect()} == set(order[:6000])


def test_subset_rejects_a_key_that_is_not_unique(spark, monkeypatch):
    df = spark.range(1000).select(F.lit(1).alias("id"))
    with pytest.raises(ValueError):
        S.get_subset(df, 0.5)
    monkeypatch.setattr(S, "TOP_K_LIMIT", 10)
    with pytest.raises(ValueError):
        S.get_subset(df, 0.5)


def test_subset_adds_no_shuffle(spark, capsys):
    S.get_subset(frame(spark, 100), 0.5).explain()
    assert "Exchange" not in capsys.readouterr().out


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_shuffle_index_does_not_depend_on_partitions(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = S.shuffle(frame(spark, 3000)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    order = sorted(range(3000), key=hashed)
    assert [r["id"] for r in sorted(rows, key=lambda r: r["shuffle_idx"])] == order


def test_shuffle_uses_more_digits_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 2)
    rows = S.shuffle(frame(spark, 3000)).collect()
    assert [r["id"] for r in sorted(rows, key=lambda r: r["shuffle_idx"])] == sorted(range(3000), key=hashed)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_sorted_index(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = frame(spark, 2000).withColumn("v", F.col("id") % 3)
        rows = S.sorted_index(df, [F.desc("v"), F.asc("id")]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = sorted(range(2000), key=lambda i: (-(i % 3), i))
    assert [r["id"] for r in sorted(rows, key=lambda r: r["idx"])] == want
    assert sorted(r["idx"] for r in rows) == list(range(2000))


def test_empty_frames(spark):
    empty = frame(spark, 0)
    assert S.shuffle(empty).count() == 0
    assert S.sorted_index(empty, ["id"]).count() == 0
    assert S.get_subset(empty, 0.5).count() == 0
    assert S.head_rows(empty).count() == 0


def test_max_samples(spark, monkeypatch):
    df = frame(spark, 300)
    assert S.max_samples(df, None).count() == 300
    assert sorted(r["id"] for r in S.max_samples(df, 7).collect()) == list(range(7))
    assert sorted(r["id"] for r in S.max_samples(df, 120).collect()) == list(range(120))


HISTORY = [("a", 1, 0.5), ("a", 2, 0.3), ("a", 3, 0.3), ("b", 1, float("nan")), ("b", 2, 0.9), ("c", 1, float("nan"))]


def test_best_run(spark):
    df = spark.createDataFrame(HISTORY, "run string, step long, loss double")
    best = {r["run"]: r["best_step"] for r in S.best_run(df, "run", "loss").collect()}
    assert best == {"a": 2, "b": 2, "c": None}
    top = {r["run"]: (r["best_step"], r["best_loss"]) for r in S.best_run(df, "run", "loss", greater_is_better=True).collect()}
    assert top == {"a": (1, 0.5), "b": (2, 0.9), "c": (None, None)}


def test_keep_last_limits_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame(HISTORY, "run string, step long, loss double")
    kept = S.keep_last(df, "run", "step", 2)
    assert {(r["run"], r["step"]) for r in kept.collect()} == {("a", 2), ("a", 3), ("b", 1), ("b", 2), ("c", 1)}
    kept.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_every_nth(spark):
    assert [r["step"] for r in S.every_nth(spark.range(25).toDF("step")).orderBy("step").collect()] == [0, 10, 20]
    with pytest.raises(ValueError):
        S.every_nth(spark.range(1).toDF("step"), n=0)


def test_max_samples_keeps_exactly_n_of_tied_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (2, "d"), (None, "e"), (3, "f")], "id long, text string")
    for n in range(8):
        assert S.max_samples(df, n).count() == min(n, 6)
    assert sorted(r["text"] for r in S.max_samples(df, 2).collect()) == ["a", "e"]


def test_hash_of_several_columns_tells_keys_apart(spark):
    df = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), (None, "c"), ("c", None)], "x string, y string")
    assert df.select(S.order_hash(1, ["x", "y"]).alias("h")).distinct().count() == 4
