import re
import pytest
from pyspark.sql import functions as F

from seqprep import PrepOptions
from seqprep.operators import collate as C
from seqprep.plans import evaluate as EV

SCHEMA = "id long, input_ids array<int>, attention_mask array<int>, labels array<int>"
ROWS = [
    (1, [4, 5], [1, 1], [5, 6, 3]),
    (2, [4, 5, 6], [1, 1, 1], [5]),
    (3, [7], [1], []),
    (4, [0, 0], [0, 0], [0, 0]),
    (5, [8, 9, 10, 11], [1, 1, 1, 1], [9, 3]),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_assign_batches(spark, rows):
    got = by_id(C.assign_batches(rows, 2))
    assert [(got[i]["batch_id"], got[i]["pos_in_batch"]) for i in range(1, 6)] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
    wide = by_id(C.assign_batches(rows, 1, devices=2, accum=2))
    assert [wide[i]["batch_id"] for i in range(1, 6)] == [0, 0, 0, 0, 1]
    mixed = [(r["batch_id"], r["pos_in_batch"]) for r in C.assign_batches(rows, 2, seed=1).collect()]
    assert sorted(mixed) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
    with pytest.raises(ValueError):
        C.assign_batches(rows, 0)


def test_pad_batch(spark, rows):
    got = by_id(C.pad_batch(C.assign_batches(rows, 2), ["input_ids", "labels"]))
    assert got[1]["input_ids"] == [4, 5, 0] and got[2]["labels"] == [5, 0, 0]
    assert got[3]["labels"] == [0, 0] and got[5]["input_ids"] == [8, 9, 10, 11]


def test_collate_reference(spark, rows):
    got = by_id(C.collate(C.assign_batches(rows, 2)))
    assert got[1]["src_tokens"] == [4, 5, 0] and got[1]["attention_mask"] == [1, 1, 0]
    assert got[1]["tgt_tokens_input"] == [2, 5, 6] and got[1]["tgt_tokens_target"] == [6, 3]
    assert got[2]["tgt_tokens_input"] == [2, 5, 0] and got[2]["tgt_tokens_target"] == [-100, -100]
    assert got[4]["tgt_tokens_target"] == [-100]


def test_collate_aligned(spark, rows):
    got = by_id(C.collate(C.assign_batches(rows, 2), alignment="aligned"))
    assert got[1]["tgt_tokens_target"] == [5, 6, 3] and got[2]["tgt_tokens_target"] == [5, -100, -100]
    with pytest.raises(ValueError):
        C.collate(rows, alignment="other")
    with pytest.raises(ValueError):
        C.collate(rows)


def test_stack_batches(spark, rows):
    stacked = {r["batch_id"]: r for r in C.stack_batches(C.collate(C.assign_batches(rows, 2))).collect()}
    assert stacked[0]["src_tokens"] == [[4, 5, 0], [4, 5, 6]]
    assert stacked[0]["tgt_tokens_target"] == [[6, 3], [-100, -100]]
    assert len(stacked[2]["src_tokens"]) == 1


def test_one_shuffle_for_padding_and_stacking(spark, rows, capsys):
    placed = rows.withColumns({"batch_id": F.col("id") % 2, "pos_in_batch": F.col("id").cast("int")})
    C.stack_batches(C.collate(placed)).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


def test_non_pad(spark, rows):
    kept = C.non_pad(rows, "labels").collect()
    assert {(r["id"], r["pos"], r["token_id"]) for r in kept} == {(1, 0, 5), (1, 1, 6), (1, 2, 3), (2, 0, 5), (5, 0, 9), (5, 1, 3)}


@pytest.mark.parametrize("seed", [None, 1])
def test_measured_lengths_give_the_same_batches(spark, rows, seed):
    plain = C.collate(C.assign_batches(rows, 2, seed=seed))
    measured = C.collate(C.assign_batches(rows, 2, seed=seed, measure=("input_ids", "labels")))
    assert measured.columns == plain.columns
    assert sorted(map(str, measured.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("alignment, tail", [("reference", 2), ("aligned", 1)])
def test_padding_is_not_masked_id_by_id(spark, rows, capsys, alignment, tail):
    """The function that runs per id sees a row's own labels, not those filled up to the longest of the batch."""
    fed = C.collate(C.assign_batches(rows, 2, measure=("input_ids", "labels")), alignment=alignment)
    plan = plan_of(fed, capsys)
    masked = re.findall(r"transform\((.*?), lambdafunction", plan)
    assert masked and not any("array_repeat" in m or "tgt" in m for m in masked)
    padded = {r["id"]: r["labels"] for r in C.pad_batch(C.assign_batches(rows, 2), "labels").collect()}
    for row in fed.collect():
        labels = padded[row["id"]]
        want = None if labels is None else [-100 if x == 0 else x for x in labels[tail - 1 :]]
        assert row["tgt_tokens_target"] == want


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_training_feed_moves_the_wide_columns_once(spark, rows, tmp_path, capsys):
    rows.write.parquet(str(tmp_path / "rows"))
    feed = EV.training_feed(spark.read.parquet(str(tmp_path / "rows")), PrepOptions(batch_size=2))
    stacked = C.stack_batches(feed)
    for df in (feed, stacked):
        plan = plan_of(df, capsys)
        assert sum("attention_mask" in line for line in plan.splitlines() if "ReadSchema" in line) == 1
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


@pytest.mark.parametrize("per_part, n", [(1, 40), (3, 40), (64, 40), (2, 1)])
def test_batches_lie_in_one_task_in_order(spark, per_part, n, monkeypatch):
    df = spark.range(n).selectExpr("id", "transform(sequence(0, cast(id % 5 as int)), x -> x + 4) AS input_ids").withColumn("labels", F.col("input_ids"))
    df = df.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1))).repartition(3)
    plain = by_id(C.collate(C.assign_batches(df, 4, seed=42)))
    for shuffled in (True, False):
        feed = EV.training_feed(df, PrepOptions(batch_size=4), shuffled, batches_per_part=per_part)
        found = feed.withColumn("task", F.spark_partition_id()).collect()
        tasks, last = {}, {}
        for r in found:
            assert r["feed_part"] == r["batch_id"] // per_part
            assert tasks.setdefault(r["feed_part"], r["task"]) == r["task"]
            place = (r["batch_id"], r["pos_in_batch"])
            assert last.get(r["feed_part"], (-1, -1)) < place
            last[r["feed_part"]] = place
        if shuffled:
            assert {r["id"]: (r["batch_id"], r["pos_in_batch"], r["src_tokens"]) for r in found} == {
                i: (r["batch_id"], r["pos_in_batch"], r["src_tokens"]) for i, r in plain.items()
            }
        else:
            assert [r["id"] for r in sorted(found, key=lambda r: (r["batch_id"], r["pos_in_batch"]))] == list(range(n))


def test_number_of_parts_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(C, "MOST_PARTS", 3)
    made = C.clustered_batches(spark.range(100), 2, batches_per_part=1).collect()
    assert len({r["feed_part"] for r in made}) == 3
    assert sorted((r["batch_id"], r["pos_in_batch"]) for r in made) == [(k // 2, k % 2) for k in range(100)]


def test_stored_feed_is_read_by_part(spark, tmp_path, capsys):
    made = C.clustered_batches(spark.range(100).withColumn("input_ids", F.array(F.col("id").cast("int"))), 3, batches_per_part=4)
    C.write_feed(made, str(tmp_path))
    some = C.read_batches(spark, str(tmp_path), 9, 14)
    assert {r["batch_id"] for r in some.collect()} == set(range(9, 15)) and some.count() == 18
    assert len(some.inputFiles()) <= len(C.read_batches(spark, str(tmp_path)).inputFiles())
    assert "PartitionFilters: [isnotnull(feed_part" in plan_of(some, capsys)
    assert C.read_batches(spark, str(tmp_path), 1000).count() == 0 and C.read_batches(spark, str(tmp_path)).count() == 100


def test_clustered_repeated_and_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(1, [4, 5]), (1, [6]), (None, [7]), (None, [8, 9, 9])], "id long, input_ids array<int>")
    for seed in (None, 3):
        made = C.clustered_batches(df, 2, seed=seed, batches_per_part=1).collect()
        assert sorted(tuple(r.input_ids) for r in made) == [(4, 5), (6,), (7,), (8, 9, 9)]
        assert sorted((r.batch_id, r.pos_in_batch) for r in made) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert C.clustered_batches(df.limit(0), 2).count() == 0
    with pytest.raises(ValueError):
        C.clustered_batches(df, 0)


def test_repeated_and_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(1, [4, 5]), (1, [6]), (None, [7]), (None, [8, 9, 9])], "id long, input_ids array<int>")
    for seed in (None, 3):
        for measure in ((), ("input_ids",)):
            made = C.assign_batches(df, 2, seed=seed, measure=measure)
            assert sorted(tuple(r.input_ids) for r in made.collect()) == [(4, 5), (6,), (7,), (8, 9, 9)]
            assert sorted((r.batch_id, r.pos_in_batch) for r in made.collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_stacking_holds_one_batch_at_a_time(spark, capsys):
    """Sorted rows are aggregated in order: no hash table of whole batches, no second sort of the padded rows."""
    given = [(i % 7 or None, [4] * (i % 5), [5, 3]) for i in range(600)] + [(8, None, [6, 3]), (8, None, [6, 3]), (9, [4], None), (9, [4, None], [])]
    rows = spark.createDataFrame(given, "id long, input_ids array<int>, labels array<int>")
    rows = rows.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1)))
    for placed in (C.assign_batches(rows, 4), C.cluster_batches(C.assign_batches(rows, 4), 8)):
        fed = C.collate(placed)
        stacked = C.stack_batches(fed)
        plan = plan_of(stacked, capsys)
        assert "ObjectHashAggregate" not in plan and plan.count("SortAggregate") == 1
        assert plan[plan.index("SortAggregate") : plan.index("Window")].count("Sort ") == 0
        want = {}
        for r in sorted(fed.collect(), key=lambda r: (r["batch_id"], r["pos_in_batch"])):
            want.setdefault(r["batch_id"], []).append([r[c] for c in C.COLLATED_COLUMNS])
        got = {r["batch_id"]: [list(x) for x in zip(*(r[c] for c in C.COLLATED_COLUMNS), strict=True)] for r in stacked.collect()}
        assert got == want and len(got) == 151


@pytest.mark.parametrize("measure", [(), ("input_ids",)])
def test_wide_rows_are_not_sorted_to_meet_their_place(spark, rows, capsys, measure):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = C.assign_batches(rows.union(rows).withColumn("id", F.when(F.col("id") > 1, F.col("id"))), 2, measure=measure)
        plan = plan_of(placed, capsys)
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "BuildRight" in plan
        found = placed.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    places = sorted((r["batch_id"], r["pos_in_batch"]) for r in found)
    assert places == [(i // 2, i % 2) for i in range(2 * rows.count())]
    in_order = [r["id"] for r in sorted(found, key=lambda r: (r["batch_id"], r["pos_in_batch"]))]
    assert in_order == sorted(in_order, key=lambda i: -1 if i is None else i)
