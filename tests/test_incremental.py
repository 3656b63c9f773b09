import pytest
from pyspark.sql import functions as F

from seqprep import PrepOptions
from seqprep.functions.hashing import multiset_fingerprint, row_hash
from seqprep.operators import encode as E
from seqprep.operators import sampling as S
from seqprep.plans import prepare as P
from seqprep.sources import parallel as R
from seqprep.sources.incremental import IncrementalSet

PAIRS = "id long, split string, translation struct<fr:string,en:string>"
OPTS = PrepOptions(max_source_length=4, max_target_length=4)


def rows(first, last, word="mot"):
    return [(i, "train" if i % 4 else "validation", (f"{word} {i % 9} oui", f"word {i % 9} yes")) for i in range(first, last)]


def put(spark, path, name, data):
    """One file per split below ``path``, always under the same names."""
    df = spark.createDataFrame(data, PAIRS)
    for split in ("train", "validation"):
        part = df.filter(F.col("split") == split).drop("split").toPandas()
        folder = path / f"split={split}"
        folder.mkdir(parents=True, exist_ok=True)
        part.to_parquet(folder / f"{name}.parquet", index=False)


def listing(df):
    return sorted(map(str, df.select("id", "split", "input_ids", "attention_mask", "labels").collect()))


def fresh(spark, path, vocab, opts=OPTS):
    return listing(P.prepare(R.read_parallel(spark, str(path)), opts, vocab)[0])


def test_only_changed_files_are_encoded(spark, tmp_path, monkeypatch):
    source, root = tmp_path / "in", str(tmp_path / "out")
    for k in range(3):
        put(spark, source, f"f{k}", rows(100 * k, 100 * k + 40))
    read = []
    encode_pairs = P.encode_pairs
    monkeypatch.setattr(P, "encode_pairs", lambda pairs, *a, **k: read.append(pairs.count()) or encode_pairs(pairs, *a, **k))

    def run(opts=OPTS, **more):
        made, vocab, changes = P.prepare_incremental(spark, str(source), root, opts, **more)
        assert listing(made) == fresh(spark, source, vocab, opts)
        return changes.kept, changes.encoded, changes.dropped

    assert run() == (0, 6, 0) and read.pop(0) == 120 and read.pop()
    assert run() == (6, 0, 0)
    put(spark, source, "f9", rows(900, 910))  # new
    read.clear()
    assert run() == (6, 2, 0) and read[0] == 10
    put(spark, source, "f1", rows(100, 141, "autre"))  # changed
    read.clear()
    assert run() == (6, 2, 2) and read[0] == 41
    for split in ("train", "validation"):  # dropped
        (source / f"split={split}" / "f2.parquet").unlink()
    read.clear()
    assert run() == (6, 0, 2) and read == [90 + 1]  # only the comparison encodes
    # Another share chooses among the rows; another length shows in them.
    assert run(PrepOptions(max_source_length=4, max_target_length=4, dataset_fraction=0.3, max_train_samples=7)) == (6, 0, 0)
    assert run(PrepOptions(max_source_length=3, max_target_length=4)) == (0, 6, 6)
    assert run(PrepOptions(max_source_length=3, max_target_length=4), refresh_vocab=True) == (0, 6, 6)


def test_a_run_that_dies_leaves_the_last_generation(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    put(spark, source, "a", rows(0, 20))
    made, vocab, _ = P.prepare_incremental(spark, str(source), root, OPTS)
    before = listing(made)
    stored = IncrementalSet(spark, f"{root}/{OPTS.cache_key}")
    put(spark, source, "b", rows(20, 40))

    def lost(files):
        return E.select_pair(R.read_parallel(spark, str(source), files=files, file_key=True)).withColumn("file", F.raise_error(F.lit("lost")))

    with pytest.raises(Exception, match="lost"):
        stored.update(str(source), lost, "other")
    assert stored.generation() == 1 and listing(P.encoded_choice(stored.rows(), OPTS)) == before
    # A generation with a missing row does not count.
    stored._manifest(1).limit(1).write.parquet(f"{stored.folder}/manifest/generation=2")
    assert stored.generation() == 1
    assert P.prepare_incremental(spark, str(source), root, OPTS)[2].encoded == 2


def test_compaction_keeps_the_rows_and_removes_the_rest(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    for word in ("a", "b", "c"):
        put(spark, source, "f", rows(0, 20, word))
        made, vocab, _ = P.prepare_incremental(spark, str(source), root, OPTS)
    want = listing(made)
    stored = IncrementalSet(spark, f"{root}/{OPTS.cache_key}")
    stored.compact()
    assert len(list((tmp_path / "out" / OPTS.cache_key / "pieces").iterdir())) == 1
    assert listing(P.encoded_choice(stored.rows(), OPTS)) == want
    assert P.prepare_incremental(spark, str(source), root, OPTS)[2].encoded == 0


def test_fingerprint_sees_repeated_rows(spark):
    def of(*values):
        return multiset_fingerprint(spark.createDataFrame([(v,) for v in values], "a string"))

    assert of("a", "a", "x") != of("b", "b", "x") and of("a", "x", "a") == of("a", "a", "x")
    assert of("a", "a") != of("a") and of(None) != of("") and of() != of(None)
    two = [spark.createDataFrame([r], "a string, b string") for r in (("x", None), (None, "x"))]
    assert multiset_fingerprint(two[0]) != multiset_fingerprint(two[1])


def test_hash_of_any_column(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m, named_struct('x', CAST(NULL AS INT), 'y', 1) AS s, array(map(1, 2)) AS l, 1 AS `a.b`")
    swapped = spark.sql("SELECT map('b', 2, 'a', 1) AS m, named_struct('x', CAST(NULL AS INT), 'y', 1) AS s, array(map(1, 2)) AS l, 1 AS `a.b`")
    other = spark.sql("SELECT map('b', 2, 'a', 1) AS m, named_struct('x', 1, 'y', CAST(NULL AS INT)) AS s, array(map(1, 2)) AS l, 1 AS `a.b`")
    first, again, third = (d.select(row_hash(d)).head()[0] for d in (df, swapped, other))
    assert first == again != third


def test_changed_repeated_row_rebuilds_the_cache(spark, tmp_path):
    base = rows(0, 8)
    for word in ("a", "b"):
        raw = spark.createDataFrame(base + [(50, "train", (word, word))] * 2, PAIRS)
        made, vocab = P.prepare_cached(spark, raw, str(tmp_path), OPTS)
        assert vocab.filter(F.col("token") == word).count() == 1


def test_max_samples_takes_map_columns_and_repeated_rows(spark):
    df = spark.sql("SELECT id % 3 AS id, map('fr', string(id % 2)) AS translation FROM range(30)")
    for n in (1, 7, 10, 11, 25, 30, 31):
        made = S.max_samples(df, n).collect()
        assert sorted(r["id"] for r in made) == sorted(i % 3 for i in range(30))[:n]
    whole = sorted(map(str, df.collect()))
    assert sorted(map(str, S.max_samples(df, 30).collect())) == whole
    assert sorted(map(str, S.max_samples(df.repartition(7), 13).collect())) == sorted(map(str, S.max_samples(df, 13).collect()))


def test_max_samples_has_no_top_k_of_rows(spark, capsys):
    S.max_samples(spark.range(100).withColumn("wide", F.lit("x")), 10).explain()
    assert "TakeOrdered" not in capsys.readouterr().out


@pytest.mark.parametrize("fmt", ["json", "csv", "tsv", "orc"])
def test_ids_from_contents(spark, tmp_path, fmt):
    data = [(f"t{i % 7}", "x" if i % 2 else None, "train" if i % 3 else "test") for i in range(60)]
    df = spark.createDataFrame(data, "fr string, en string, split string").repartition(5)
    name, options = R._FORMATS[fmt]
    df.write.partitionBy("split").format(name).options(**options).save(str(tmp_path / fmt))

    def read():
        schema = "fr string, en string, split string"
        return R.read_parallel(spark, str(tmp_path / fmt), fmt, schema, languages={"fr": "fr", "en": "en"})

    made = read().collect()
    assert sorted(map(str, made)) == sorted(map(str, read().collect()))
    assert len({r["id"] for r in made}) == 60
    groups = {}
    for r in made:
        groups.setdefault((r["split"], *r["translation"]), []).append(r["id"].split(":"))
    for found in groups.values():
        assert len({h for h, _ in found}) == 1 and sorted(int(k) for _, k in found) == list(range(len(found)))
    assert len({found[0][0] for found in groups.values()}) == len(groups)


def test_split_filter_reaches_the_files_below_content_ids(spark, tmp_path, capsys):
    spark.createDataFrame(rows(0, 30), PAIRS).drop("id").write.partitionBy("split").json(str(tmp_path / "j"))
    R.read_parallel(spark, str(tmp_path / "j"), "json", PAIRS.replace("id long, ", "")).filter("split = 'train'").explain()
    assert "PartitionFilters: [isnotnull(split" in capsys.readouterr().out


def test_equal_file_names_in_two_splits(spark, tmp_path):
    put(spark, tmp_path, "0000", rows(0, 40))
    for f in tmp_path.glob("*/*.parquet"):
        import pandas as pd

        pd.read_parquet(f).drop(columns="id").to_parquet(f, index=False)
    made = R.read_parallel(spark, str(tmp_path))
    assert made.count() == made.select("id").distinct().count() == 40
    assert sorted(map(str, made.collect())) == sorted(map(str, R.read_parallel(spark, str(tmp_path)).collect()))


def test_content_ids_of_maps_equal_those_of_structs(spark, tmp_path):
    spark.createDataFrame(rows(0, 9), PAIRS).drop("id").coalesce(1).write.json(str(tmp_path / "j"))
    a = R.read_parallel(spark, str(tmp_path / "j"), "json", "split string, translation struct<fr:string,en:string>")
    b = R.read_parallel(spark, str(tmp_path / "j"), "json", "split string, translation map<string,string>")
    assert sorted(r["id"] for r in a.collect()) == sorted(r["id"] for r in b.collect())
