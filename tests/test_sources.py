import math

import pytest
from pyspark.sql import functions as F

from seqprep import PrepOptions
from seqprep import session
from seqprep.operators.encode import select_pair
from seqprep.plans.prepare import prepare, prepare_cached, selected_pairs
from seqprep.sources import parallel as R
from seqprep.sources import processed as P
from seqprep.sources import tables as T

PAIRS = "id long, split string, translation struct<fr:string,en:string>"


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(i, "train" if i % 4 else "validation", (f"mot {i % 9} oui", f"word {i % 9} yes")) for i in range(200)]
    return spark.createDataFrame(rows, PAIRS)


def test_read_partitioned_parquet_and_json(spark, raw, tmp_path):
    for fmt in ("parquet", "json", "orc"):
        path = str(tmp_path / fmt)
        raw.write.partitionBy("split").format(fmt).save(path)
        got = R.read_parallel(spark, path, fmt, schema=PAIRS)
        assert got.columns == ["id", "split", "translation"]
        assert sorted(map(str, got.collect())) == sorted(map(str, raw.collect()))


def test_split_filter_prunes_folders(spark, raw, tmp_path, capsys):
    path = str(tmp_path / "pairs")
    raw.write.partitionBy("split").parquet(path)
    R.read_parallel(spark, path).filter("split = 'train'").explain()
    assert "PartitionFilters: [isnotnull(split" in capsys.readouterr().out


def test_read_flat_text_files(spark, tmp_path):
    rows = [(1, 'dit "non"', "says, no"), (2, "ligne\nneuve", "new line"), (3, "x", "y")]
    df = spark.createDataFrame(rows, "id long, fr string, en string")
    df.write.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    got = R.read_parallel(
        spark, str(tmp_path / "csv"), "csv", "id long, fr string, en string", languages={"fr": "fr", "en": "en"}, multi_line=True
    )
    assert sorted((r["id"], *r["translation"]) for r in got.collect()) == rows
    tsv = tmp_path / "pairs.tsv"
    tsv.write_text('id\tfr\ten\n7\t"oui\tyes\n')
    got = R.read_parallel(spark, str(tsv), "tsv", languages={"fr": "fr", "en": "en"}).head()
    assert tuple(got["translation"]) == ('"oui', "yes")


def test_read_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        R.read_parallel(spark, "x", "xml")
    spark.range(1).write.parquet(str(tmp_path / "flat"))
    with pytest.raises(ValueError):
        R.read_parallel(spark, str(tmp_path / "flat"))


def test_pairs_from_turns(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", "open"), (2, 0, "assistant", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = R.pairs_from_turns(df).collect()
    assert [(r["id"], r["split"], tuple(r["translation"])) for r in got] == [((1 << 32) + 1, "test", ("q", "a"))]


def test_eval_split(spark, raw):
    assert R.eval_split_name(raw) == "validation"
    renamed = raw.withColumn("split", F.when(F.col("split") == "train", "train").otherwise("test"))
    assert R.eval_split_name(renamed) == "test"
    assert R.resolve_eval_split(renamed).count() == 50
    assert {r["split"]: r["n_rows"] for r in R.split_counts(raw).collect()} == {"train": 150, "validation": 50}


def test_selected_pairs(spark, raw):
    got = selected_pairs(raw, PrepOptions(dataset_fraction=0.1))
    assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 15, "val": 5}
    capped = selected_pairs(raw, PrepOptions(dataset_fraction=1.0, max_train_samples=7, max_eval_samples=None))
    assert {r["split"]: r["count"] for r in capped.groupBy("split").count().collect()} == {"train": 7, "val": 50}


def test_cache_is_reused_only_on_a_match(spark, raw, tmp_path):
    root, built = str(tmp_path), []
    opts = PrepOptions(dataset_fraction=0.5, max_source_length=4, max_target_length=4)

    def build():
        built.append(1)
        return prepare(raw, opts)[0]

    first = P.load_or_prepare(spark, opts, root, build, "v1")
    assert first.count() == 100 and built == [1]
    again = P.load_or_prepare(spark, opts, root, build, "v1")
    assert built == [1] and sorted(map(str, again.collect())) == sorted(map(str, first.collect()))
    P.load_or_prepare(spark, opts, root, build, "v2")
    assert len(built) == 2
    P.load_or_prepare(spark, PrepOptions(**{**opts.__dict__, "max_source_length": 5}), root, build, "v2")
    assert len(built) == 3
    P.load_or_prepare(spark, PrepOptions(**{**opts.__dict__, "max_source_length": 5, "overwrite_cache": True}), root, build, "v2")
    assert len(built) == 4


def test_an_interrupted_write_is_not_reused(spark, raw, tmp_path):
    opts, root = PrepOptions(dataset_fraction=1.0), str(tmp_path)
    prepare_cached(spark, raw, root, opts)
    broken = select_pair(raw).withColumn("x", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        P.write_processed(broken, root, opts.cache_key)
    assert P.read_manifest(spark, root, opts.cache_key) == {}
    rows, vocab = prepare_cached(spark, raw, root, opts)
    assert rows.count() == 200 and vocab.count() > 4
    again, same = prepare_cached(spark, raw, root, opts)
    assert sorted(map(repr, same.collect())) == sorted(map(repr, vocab.collect()))
    assert prepare_cached(spark, raw.filter("id <> 5"), root, opts)[0].count() == 199


def test_cache_needs_both_splits(spark, raw, tmp_path):
    opts = PrepOptions(dataset_fraction=1.0)
    calls = []

    def build():
        calls.append(1)
        return prepare(raw, opts)[0].filter("split = 'train'")

    P.load_or_prepare(spark, opts, str(tmp_path), build)
    P.load_or_prepare(spark, opts, str(tmp_path), build)
    assert len(calls) == 2


def test_options():
    assert PrepOptions(tokenizer_name="a/b").cache_key == "wmt14_fr-en_tok_a_b"
    assert PrepOptions().manifest() == PrepOptions(overwrite_cache=True).manifest()
    for wrong in ({"alignment": "x"}, {"padding": "x"}, {"max_source_length": 0}):
        with pytest.raises(ValueError):
            PrepOptions(**wrong)


def test_metrics_records(spark, tmp_path):
    path = str(tmp_path / "metrics")
    T.write_metrics(spark.sql("SELECT 0.5D AS eval_loss"), path, "eval")
    T.write_metrics(T.failed_metrics(spark), path, "eval")
    got = spark.read.schema("kind string, eval_loss double").json(path).collect()
    assert sorted(str(r["eval_loss"]) for r in got) == ["0.5", "nan"] and {r["kind"] for r in got} == {"eval"}
    T.write_metrics(T.failed_metrics(spark, ("a", "b")), str(tmp_path / "pq"), "train", "parquet")
    assert math.isnan(spark.read.parquet(str(tmp_path / "pq")).head()["b"])
    with pytest.raises(ValueError):
        T.write_metrics(T.failed_metrics(spark), path, "eval", "xml")


def test_sample_report(spark):
    src = spark.range(100).select("id", F.concat(F.lit("s"), "id").alias("source"))
    ref = src.select("id", F.concat(F.lit("r"), "id").alias("reference"))
    pred = ref.filter("id <> 2").select("id", F.lit("p").alias("prediction"))
    got = [tuple(r) for r in T.sample_report(src, ref, pred).orderBy("id").collect()]
    assert got == [(i, f"s{i}", f"r{i}", None if i == 2 else "p") for i in range(5)]
    assert T.sample_report(src.limit(0), ref, pred).count() == 0


def test_read_vectors(spark, tmp_path, capsys):
    path = str(tmp_path / "vectors")
    spark.sql("SELECT 1 AS vec, array(1.0D) AS e, 'x' AS other").write.parquet(path)
    df = T.read_vectors(spark, path, "vec", "e")
    assert df.schema.simpleString() == "struct<token_id:bigint,embedding:array<float>>"
    df.explain()
    assert "ReadSchema: struct<vec:int,e:array<double>>" in capsys.readouterr().out


def test_read_parameters(spark, tmp_path, capsys):
    spark.sql(
        "SELECT * FROM VALUES ('w', array(array(1.0D, 2.0D), array(3.0D)), 1, 'x'), ('w', array(array(4.0D)), 1, 'x'), ('b', NULL, 0, 'x') AS t(name, v, learned, other)"
    ).write.parquet(str(tmp_path / "p"))
    df = T.read_parameters(spark, str(tmp_path / "p"), "name", "v", "learned")
    assert df.schema.simpleString() == "struct<tensor:string,trainable:boolean,values:array<float>>"
    assert sorted(map(tuple, df.collect()), key=repr) == [("b", False, None), ("w", True, [1.0, 2.0, 3.0]), ("w", True, [4.0])]
    df.explain()
    assert "other" not in capsys.readouterr().out
    assert {r["trainable"] for r in T.read_parameters(spark, str(tmp_path / "p"), "name", "v", None).collect()} == {True}


def test_copies_of_an_application_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    assert session.write_shared(spark.range(3), "x").count() == 3
    session.write_shared(spark.range(3), "y")
    assert len(list(tmp_path.glob("seqprep-*/*"))) == 2
    session.remove_shared(spark)
    assert not list(tmp_path.iterdir())


def test_shared_folder(spark, monkeypatch):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured

    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default: default)

        class sparkContext:  # noqa: N801
            master = "yarn"

    for master in ("yarn", "local-cluster[2,1,1024]"):
        Cluster.sparkContext.master = master
        with pytest.raises(RuntimeError):
            session.shared_dir(Cluster)


def test_missing_evaluation_split_is_an_error(spark):
    with pytest.raises(ValueError, match="neither"):
        R.eval_split_name(spark.createDataFrame([("train",)], "split string"))


def test_parquet_without_ids_gets_reproducible_ones(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(50).selectExpr("named_struct('fr', string(id), 'en', string(id)) AS translation").repartition(3).write.parquet(path)
    first, again = (sorted(map(repr, R.read_parallel(spark, path).collect())) for _ in range(2))
    assert first == again and R.read_parallel(spark, path).select("id").distinct().count() == 50


def test_ids_of_turns_are_unique(spark):
    rows = [(1, 100, "user", "a"), (1, 101, "assistant", "b"), (2, 0, "user", "c"), (2, 1, "assistant", "d")]
    made = R.pairs_from_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert made.select("id").distinct().count() == 2


def test_csv_ids_are_numbers(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,fr,en\n10,a,b\n9,c,d\n")
    made = R.read_parallel(spark, str(path), "csv", languages={"fr": "fr", "en": "en"})
    assert dict(made.dtypes)["id"] == "bigint"


def test_written_copies_leave_no_shuffle_files(spark):
    import time

    from seqprep import session

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = lambda: {f.getName() for f in _listed(disk.getAllFiles()) if f.getName().startswith("shuffle_")}
    name = session._CLEANUP
    before, setting = names(), spark.conf.get(name, None)
    with session.shuffles_freed(spark):
        session.write_shared(spark.range(1000).repartition(7, "id"), "dealt")
        assert spark.conf.get(name) == "true"  # the inner one leaves it to the outer one
    until = time.time() + 20
    while names() - before and time.time() < until:
        time.sleep(0.2)
    assert not names() - before
    assert spark.conf.get(name, None) == setting


def _listed(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_remove_copies(spark, tmp_path):
    from seqprep import session

    a, b = (session.write_shared(spark.range(n), "x") for n in (2, 3))
    spark.range(4).write.parquet(f"{tmp_path}/own")
    own = spark.read.parquet(f"{tmp_path}/own")
    session.remove_copies(a.union(b).union(own), but=b)
    assert own.count() == 4 and b.count() == 3  # what was not written as a copy stays
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|NOT_FOUND"):
        a.collect()
