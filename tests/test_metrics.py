import math
import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqprep.functions.text import words
from seqprep.operators import guards as G
from seqprep.operators import metrics as M
from seqprep.operators import vocab as V
from seqprep.plans import evaluate as EV

PAIR = "id long, prediction string, references array<string>"


def brute_force(pairs):
    """Summed counters straight from the definition."""
    sums = Counter()
    for hyp, refs in pairs:
        sums["hyp_len"] += len(hyp)
        sums["ref_len"] += min((len(r) for r in refs), default=0)
        for n in range(1, 5):
            grams = lambda w: Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
            best = Counter()
            for ref in refs:
                best |= grams(ref)
            sums[f"m{n}"] += sum((grams(hyp) & best).values())
            sums[f"t{n}"] += max(len(hyp) - n + 1, 0)
    return {c: sums[c] for c in M.COUNTERS}


@pytest.mark.parametrize("batch", ["1", "7", "4096"])
def test_counts_against_brute_force(spark, batch):
    rng = random.Random(5)
    text = lambda: [rng.choice("a b c d".split()) for _ in range(rng.randint(0, 14))]
    pairs = [(text(), [text() for _ in range(rng.randint(0, 3))]) for _ in range(300)]
    rows = [(i, " ".join(h), [" ".join(r) for r in refs]) for i, (h, refs) in enumerate(pairs)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, PAIR)
        assert M.ngram_matches(df, tokenize=words).head().asDict() == brute_force(pairs)
        per_row = {r["id"]: r for r in M.ngram_counts(df, tokenize=words).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    for i, pair in enumerate(pairs):
        assert {c: per_row[i][c] for c in M.COUNTERS} == brute_force([pair])


def test_memory_does_not_follow_the_batch():
    """A batch as large as Spark sends it by default needs little more than one of an eighth of its rows."""
    rng = random.Random(6)
    kind = pa.list_(pa.string())

    def counted(rows):
        texts = [[f"w{rng.randint(0, 5000)}" for _ in range(400)] for _ in range(rows)]
        hyp, refs = pa.array(texts, kind), pa.array([[t] for t in texts], pa.list_(kind))
        tracemalloc.start()
        out = M._count_matches(hyp, refs)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert out.field(0).to_pylist() == [400] * rows and out.field(3).to_pylist() == [397] * rows
        return peak

    assert counted(4000) < 2 * counted(500)


@pytest.mark.parametrize("at_once", [1, 5, 40])
def test_runs_of_rows_give_the_same_counts(monkeypatch, at_once):
    rng = random.Random(7)
    text = lambda: [rng.choice("a b c".split()) for _ in range(rng.randint(0, 12))]
    pairs = [(text(), [text() for _ in range(rng.randint(0, 3))]) for _ in range(80)]
    kind = pa.list_(pa.string())
    hyp, refs = pa.array([h for h, _ in pairs], kind), pa.array([r for _, r in pairs], pa.list_(kind))
    monkeypatch.setattr(M, "WORDS_AT_ONCE", at_once)
    for lo, hi in ((0, 80), (3, 50), (7, 7)):
        got = M._count_matches(hyp.slice(lo, hi - lo), refs.slice(lo, hi - lo)).to_pylist()
        assert got == [{f"m{n}": brute_force([p])[f"m{n}"] for n in range(1, 5)} for p in pairs[lo:hi]]


def test_nulls_count_as_empty(spark):
    df = spark.createDataFrame([(1, None, ["a"]), (2, "a", None), (3, "a", [None])], PAIR)
    row = M.ngram_matches(df).head()
    assert (row["hyp_len"], row["ref_len"], row["m1"]) == (2, 1, 0)
    assert M.compute_metrics(df).head().asDict() == {"bleu": 0.0, "gen_len": 0.6667, "bp": 0.0}


def test_identical_texts_score_one(spark):
    df = spark.createDataFrame([(1, "a b c d e", ["a b c d e"]), (2, "w x y z", ["w x y z"])], PAIR)
    assert M.compute_metrics(df).head().asDict() == {"bleu": 1.0, "gen_len": 4.5, "bp": 1.0}


def test_blank_predictions_give_zero(spark):
    df = spark.createDataFrame([(1, "  ", ["a"]), (2, "", ["b"])], PAIR)
    assert M.compute_metrics(df).head().asDict() == {"bleu": 0.0, "gen_len": 0.0, "bp": 0.0}
    assert M.drop_empty_pairs(df).count() == 0
    empty = M.compute_metrics(df.limit(0)).head().asDict()
    assert empty == {"bleu": 0.0, "gen_len": 0.0, "bp": 0.0}


def test_blank_pairs_count_for_length_only(spark):
    rows = [(1, "a b c d e", ["a b c d e"]), (2, "a b", [" "]), (3, "\n", ["a"])]
    got = M.compute_metrics(spark.createDataFrame(rows, PAIR)).head()
    assert (got["bleu"], got["bp"], got["gen_len"]) == (1.0, 1.0, round(7 / 3, 4))


def test_brevity_penalty(spark):
    df = spark.createDataFrame([(1, "a b c d", ["a b c d e f"])], PAIR)
    got = M.corpus_bleu(df).head()
    assert got["bp"] == round(math.exp(1 - 6 / 4), 4) and got["bleu"] == got["bp"]


def test_groups_nan_flag_and_extra(spark):
    rows = [(1, "a b c d", ["a b c d"]), (2, "x", ["y"])]
    df = spark.createDataFrame(rows, PAIR).withColumn("bad", F.col("id") == 2)
    by = {r["id"]: r for r in M.compute_metrics(df, by=["id"], extra=[F.count("*").alias("n")], nan_flag="bad").collect()}
    assert by[1]["bleu"] == 1.0 and by[1]["n"] == 1
    assert by[2]["gen_len"] == 0.0
    assert {r["id"]: r["bleu"] for r in M.corpus_bleu(df, by=["id"]).collect()} == {1: 1.0, 2: 0.0}


def test_bleu_has_no_wide_shuffle(spark, capsys):
    df = spark.createDataFrame([(1, "a", ["a"])], PAIR)
    M.compute_metrics(df).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan


def test_round_metric(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 0.123456)], "id int, v double")
    assert [r["o"] for r in df.orderBy("id").select(M.round_metric(F.col("v")).alias("o")).collect()] == [0.0, 0.0, 0.1235]


SCORES = "id long, pos int, logits array<float>, target int"


def test_token_accuracy_and_loss(spark):
    rows = [(1, 0, [0.0, 2.0, 0.0], 1), (1, 1, [5.0, 0.0, 0.0], 2), (1, 2, [9.0, 0.0, 0.0], 0), (1, 3, [1.0, 1.0, 1.0], -100)]
    df = spark.createDataFrame(rows, SCORES)
    pred = df.filter("target >= 0").withColumn("pred", F.expr("CASE pos WHEN 0 THEN 1 ELSE 0 END"))
    assert M.token_accuracy(pred).head()["accuracy"] == 0.5
    loss = lambda l, t: math.log(sum(math.exp(x) for x in l)) - l[t]
    want = (loss([0, 2, 0], 1) + loss([5, 0, 0], 2)) / 2
    assert M.masked_xent(df).head()["loss"] == pytest.approx(want)
    assert M.masked_xent(df.filter("target <= 0")).head()["loss"] is None
    big = spark.createDataFrame([(1, 0, [1000.0, 1000.0], 1)], SCORES)
    assert M.masked_xent(big).head()["loss"] == pytest.approx(math.log(2))


def one_hot(i, size=8):
    return [1.0 if k == i else 0.0 for k in range(size)]


@pytest.fixture(scope="module")
def small_vocab(spark):
    df = spark.createDataFrame([("a a a a b b b c c d",)], "t string")
    return V.build_vocab(df, ["t"])  # a 4, b 5, c 6, d 7


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0}])
def test_decode_scores(spark, small_vocab, bounds):
    rows = [(1, p, one_hot(i), t) for p, (i, t) in enumerate([(4, 4), (5, 5), (3, 6), (6, -100)])]
    rows += [(2, 0, one_hot(0), 7)]
    df = spark.createDataFrame(rows, SCORES)
    got = {r["id"]: r for r in M.decode_scores(df, small_vocab, **bounds).collect()}
    assert (got[1]["prediction"], got[1]["references"]) == ("a b c", ["a b c"])
    assert (got[2]["prediction"], got[2]["references"]) == ("", ["d"])
    cut = {r["id"]: r["prediction"] for r in M.decode_scores(df, small_vocab, stop_at_eos=True, **bounds).collect()}
    assert cut == {1: "a b", 2: ""}


def test_evaluation_report(spark, small_vocab):
    rows = [(1, p, one_hot(i), i) for p, i in enumerate([4, 5, 6, 7])]
    df = spark.createDataFrame(rows, SCORES)
    got = EV.evaluation_report(df, small_vocab).head()
    assert (got["bleu"], got["gen_len"], got["bp"]) == (1.0, 4.0, 1.0) and got["eval_loss"] > 0
    bad = df.withColumn("logits", F.array([F.lit(float("nan")).cast("float")] * 8))
    assert EV.evaluate_scores(bad, small_vocab).head().asDict() == {"bleu": 0.0, "gen_len": 0.0, "bp": 0.0}
    assert math.isnan(EV.evaluation_report(df.limit(0), small_vocab).head()["eval_loss"])


def test_guards(spark):
    df = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [1.0])], "id int, v array<double>")
    assert G.has_nan(df, "v").head()["has_nan"] is True
    assert G.has_nan(df.filter("id = 2"), "v").head()["has_nan"] is False
    assert G.has_nan(df.limit(0), "v").head()["has_nan"] is False
    assert G.is_empty(df.limit(0)) and not G.is_empty(df)
    with pytest.raises(ValueError):
        G.require_columns(df)
    with pytest.warns(UserWarning):
        assert G.require_columns(df, strict=False) is df


def test_align_predictions(spark):
    pred = spark.createDataFrame([(1, "x"), (2, "y")], "id int, prediction string")
    ref = spark.createDataFrame([(2, ["z"]), (3, ["w"])], "id int, references array<string>")
    assert [tuple(r) for r in M.align_predictions(pred, ref).collect()] == [(2, "y", ["z"])]


def judged_plainly(scores, target):
    """best, loss, unusable of one score array."""
    if scores is None:
        return None, None, True
    unusable = any(x is None or math.isnan(x) for x in scores)
    known = [(i, x) for i, x in enumerate(scores) if x is not None]
    nans = [i for i, x in known if math.isnan(x)]
    best = nans[0] if nans else max(known, key=lambda e: (e[1], -e[0]))[0] if known else None
    if not scores or target is None or not 0 <= target < len(scores) or len(known) < len(scores):
        return best, None, unusable
    if nans:
        return best, math.nan, unusable
    top = max(scores)
    return best, top + math.log(sum(math.exp(x - top) for x in scores)) - scores[target], unusable


@pytest.mark.parametrize("cells", [1 << 20, 1])
def test_judged_scores_equal_plain_ones(spark, monkeypatch, cells):
    monkeypatch.setattr(M, "CELLS", cells)
    rng = random.Random(2)
    rows = [(k, [rng.choice([0.0, 1.0, -3.5, 700.0, 2.25]) for _ in range(rng.choice([1, 3, 3, 8]))], rng.randint(-100, 9)) for k in range(80)]
    rows += [(100, None, 1), (101, [], 0), (102, [None, 1.0], 1), (103, [None, None], 0), (104, [1.0, math.nan, 3.0], 0), (105, [2.0, 2.0], None), (106, [math.nan, None], 1)]
    df = spark.createDataFrame(rows, "id long, logits array<float>, target int").repartition(3)
    made = {r["id"]: r for r in M.judge_scores(df).collect()}
    for k, scores, target in rows:
        best, loss, unusable = judged_plainly(scores, target)
        r = made[k]
        assert (r["best"], r["unusable"]) == (best, unusable)
        assert (r["loss"] is None) == (loss is None) and (loss is None or r["loss"] == pytest.approx(loss, nan_ok=True))


def test_evaluation_reads_the_scores_once(spark, small_vocab):
    rows = [(i, p, one_hot(p + 4), p + 4) for i in range(20) for p in range(4)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, SCORES)
    got = EV.evaluation_report(df.mapInArrow(counted, df.schema), small_vocab).collect()
    assert len(got) == 1 and got[0]["bleu"] == 1.0 and read.value == len(rows)


def test_wide_scores(spark):
    """The width of a real vocabulary."""
    df = spark.range(40).selectExpr("id", "transform(sequence(0, 31999), i -> cast(sin(i * (id + 1)) as float)) AS logits", "cast(id * 700 as int) AS target")
    made = {r["id"]: r for r in M.judge_scores(df).collect()}
    for k in (0, 17, 39):
        scores = [float(x) for x in df.filter(f"id = {k}").head()["logits"]]
        best, loss, _ = judged_plainly(scores, k * 700)
        assert made[k]["best"] == best and made[k]["loss"] == pytest.approx(loss)
