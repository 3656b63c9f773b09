
import pytest
from pyspark.sql import functions as F

from seqprep import PrepOptions
from seqprep.operators import encode as E
from seqprep.operators import vocab as V

JOINED = {"max_rows": 0}  # forces the path of a vocabulary too large to broadcast


@pytest.fixture(autouse=True)
def few_hot_elements(monkeypatch):
    """Two frequent elements only, so that the joined path has a tail to join."""
    monkeypatch.setattr(E, "HOT_ELEMENTS", 2)


@pytest.fixture(scope="module")
def vocab(texts):
    return V.build_vocab(texts, ["text"])


def by_id(df, col):
    return {r["id"]: r[col] for r in df.collect()}


def test_vocab_order_and_size(spark, texts, vocab):
    rows = [(r["token"], r["token_id"], r["freq"]) for r in vocab.orderBy("token_id").collect()]
    assert rows[:4] == [("<pad>", 0, 0), ("<unk>", 1, 0), ("<bos>", 2, 0), ("<eos>", 3, 0)]
    assert rows[4:7] == [("the", 4, 6), ("cat", 5, 2), ("!!!", 6, 1)]
    assert [r[1] for r in rows] == list(range(len(rows)))
    assert V.vocab_size(vocab) == len(rows)
    assert V.vocab_size(V.build_vocab(texts, ["text"], min_count=2)) == 6
    capped = V.build_vocab(texts, ["text"], max_size=5)
    assert [r["token"] for r in capped.orderBy("token_id").collect()][4:] == ["the"]
    assert V.vocab_size(V.build_vocab(texts, ["text"], max_size=2)) == 4


def test_capped_vocab_is_a_prefix_of_the_full_one(spark, texts, vocab):
    full = [tuple(r) for r in vocab.orderBy("token_id").collect()]
    for size in (3, 6, 8, len(full) + 1):
        capped = V.build_vocab(texts, ["text"], max_size=size).orderBy("token_id")
        assert [tuple(r) for r in capped.collect()] == full[: max(size, 4)]


def test_capped_vocab_has_no_top_k(spark, texts, capsys):
    V.build_vocab(texts, ["text"], max_size=6).explain()
    V.most_frequent(V.word_counts(texts, ["text"]), 2).explain()
    assert "TakeOrdered" not in capsys.readouterr().out


def test_nth_largest(spark):
    from seqprep.operators.sampling import nth_largest

    for values in ([5], [0, 0, 7, 7, 7, 4095, 4096, 4097, 1 << 40], list(range(30)) * 2):
        df = spark.createDataFrame([(v,) for v in values], "v long")
        order = sorted(values, reverse=True)
        for n in {1, len(values) // 2 or 1, len(values)}:
            assert nth_largest(df, "v", n) == (order[n - 1], sum(v > order[n - 1] for v in values))
        assert nth_largest(df, "v", len(values) + 1) is None
    assert nth_largest(spark.createDataFrame([], "v long"), "v", 1) is None


def test_very_long_hot_elements_take_no_join(spark, monkeypatch):
    """A long word that makes up half of the positions is decided inside the rows, known or not."""
    for known in (True, False):
        monkeypatch.setattr(E, "HOT_ELEMENTS", 1)
        long = "x" * 5000
        df = spark.createDataFrame([(k, f"{long} w{k} {long} v") for k in range(20)], "id long, text string")
        vocab = V.build_vocab(df, ["text"]).filter(F.col("token") != long if not known else F.lit(True))
        both = [by_id(E.encode(df, "text", vocab, **bounds), "ids") for bounds in ({}, JOINED)]
        assert both[0] == both[1]
        counted = []
        original = E._hot_entries
        monkeypatch.setattr(E, "_hot_entries", lambda *a: counted.append(original(*a)) or counted[-1])
        E.encode(df, "text", vocab, **JOINED).count()
        assert counted[-1].num_rows == 1 and len(counted[-1].column(0)[0].as_py()) == 65
        monkeypatch.setattr(E, "_hot_entries", original)


def test_lookup_is_sent_once_and_freed(spark, texts, vocab, monkeypatch):
    sent = []
    original = E._send
    monkeypatch.setattr(E, "_send", lambda *a: sent.append(1) or original(*a))
    want = by_id(E.encode(texts, "text", vocab), "ids")
    sent.clear()
    with E.vocab_lookup(vocab) as lookup:
        for _ in range(3):
            assert by_id(E.encode(texts, "text", lookup), "ids") == want
        assert len(sent) == 1
        with pytest.raises(ValueError, match="lookup gives"):
            E.decode(texts.select("id", F.array(F.lit(4)).alias("ids")), "ids", lookup)
    assert lookup.sent is None
    with E.vocab_lookup(vocab, max_rows=0) as lookup:
        assert by_id(E.encode(texts, "text", lookup), "ids") == want


def test_null_elements_of_both_paths(spark, vocab):
    df = spark.createDataFrame([(1, ["the", None, "zz"]), (2, None), (3, [None])], "id long, w array<string>")
    made = [by_id(E.lookup_arrays(df, {"ids": "w"}, vocab, "token", "token_id", 1, **b), "ids") for b in ({}, JOINED)]
    assert made[0] == made[1] == {1: [4, 1, 1], 2: None, 3: [1]}


def test_empty_vocab_and_bos(spark, texts, vocab):
    nothing = V.build_vocab(texts.limit(0), ["text"])
    assert nothing.count() == 4
    assert V.resolve_bos(vocab) == 2
    assert V.resolve_bos(vocab.filter("token_id > 3"), default=9) == 9


def test_special_tokens_in_the_text_keep_their_ids(spark):
    df = spark.createDataFrame([(1, "a <eos> a <pad>")], "id long, text string")
    vocab = V.build_vocab(df, ["text"])
    assert vocab.count() == 5
    assert by_id(E.encode(df, "text", vocab, add_special=False), "ids") == {1: [4, 3, 4, 0]}


def test_fingerprint(spark, texts, vocab):
    assert V.vocab_fingerprint(vocab) == V.vocab_fingerprint(vocab.repartition(3))
    assert V.vocab_fingerprint(vocab) != V.vocab_fingerprint(vocab.filter("token_id <> 5"))


@pytest.mark.parametrize("bounds", [{}, JOINED])
def test_encode(spark, texts, vocab, bounds):
    known = vocab.filter("token <> 'unknown'")
    ids = by_id(E.encode(texts, "text", known, max_len=4, padding="max_length", **bounds), "ids")
    assert len(ids) == 7
    assert ids[2] == [3, 0, 0, 0] and ids[3] is None
    assert ids[4] == [4, 5, 4, 3]
    assert ids[5][1:] == [1, 4, 3]
    assert ids[1][2:] == [3, 0]
    open_ended = by_id(E.encode(texts, "text", known, add_special=False, **bounds), "ids")
    assert open_ended[2] == [] and len(open_ended[0]) == 6


@pytest.mark.parametrize("bounds", [{}, JOINED])
def test_round_trip(spark, texts, vocab, bounds):
    coded = E.encode(texts, "text", vocab, **bounds)
    text = by_id(E.decode(coded, "ids", vocab, **bounds), "text")
    assert text[0] == "the cat sat on the mat" and text[4] == "the cat the"
    assert text[2] == "" and len(text) == 7
    shown = by_id(E.decode(coded, "ids", vocab, skip_special=False, **bounds), "text")
    assert shown[1] == "the dog <eos>"


def test_joined_path_keeps_other_columns(spark, texts, vocab):
    df = texts.withColumn("tag", F.concat(F.lit("t"), "id"))
    small = E.encode(df, "text", vocab)
    large = E.encode(df, "text", vocab, **JOINED)
    assert large.columns == small.columns
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))


@pytest.mark.parametrize("hot", [0, 1, 3, 100])
def test_joined_path_with_a_hot_unknown_word(spark, monkeypatch, hot):
    """A third of all tokens is one word, and it is not in the vocabulary."""
    monkeypatch.setattr(E, "HOT_ELEMENTS", hot)
    df = spark.range(600).select("id", F.expr("concat('hot w', id % 50, ' w', id % 7)").alias("text"))
    vocab = V.build_vocab(df, ["text"]).filter("token <> 'hot'")
    small = by_id(E.encode(df, "text", vocab), "ids")
    assert by_id(E.encode(df, "text", vocab, **JOINED), "ids") == small
    assert all(ids[0] == 1 for ids in small.values())


@pytest.mark.parametrize("bounds", [{}, JOINED])
def test_encode_pairs(spark, bounds):
    rows = [(1, "train", ("Le chat!", "the cat")), (2, "val", ("Le", None))]
    raw = spark.createDataFrame(rows, "id long, split string, translation struct<fr:string,en:string>")
    pairs = E.select_pair(raw)
    vocab = V.build_vocab(pairs, [F.lower("source"), "target"])
    opts = PrepOptions(max_source_length=4, max_target_length=3, normalize=True)
    out = {r["id"]: r for r in E.encode_pairs(pairs, vocab, opts, **bounds).collect()}
    assert out[1]["attention_mask"] == [1, 1, 1, 0] and len(out[1]["labels"]) == 3
    assert out[2]["attention_mask"] == [1, 1, 0, 0] and out[2]["labels"] is None
    assert out[2]["split"] == "val"
    loose = E.encode_pairs(pairs, vocab, PrepOptions(padding=None), **bounds)
    assert loose.columns == ["id", "split", "input_ids", "attention_mask", "labels"]


def test_select_pair_from_a_map_and_swapped(spark):
    df = spark.sql("SELECT 1L AS id, map('fr', 'oui', 'en', 'yes') AS translation")
    assert E.select_pair(df).head().asDict() == {"id": 1, "source": "oui", "target": "yes"}
    assert E.select_pair(df, "en", "fr").head()["source"] == "yes"


def test_token_labels(spark, texts, vocab):
    coded = E.encode(texts.filter("id = 1"), "text", vocab)
    labels = [(r["pos"], r["token"]) for r in E.token_labels(coded, "ids", vocab).orderBy("pos").collect()]
    assert labels == [(0, "the"), (1, "dog"), (2, "<eos>")]


def test_first_token_id(spark, vocab):
    probes = ["hello", "the", "cat sat", "bonjour", ""]
    df = spark.createDataFrame([(w,) for w in probes], "word string")
    found = {r["word"]: r["token_id"] for r in V.first_token_id(df, "word", vocab).collect()}
    assert found == {"the": 4, "cat sat": 5}


def test_encode_adds_no_shuffle(spark, texts, vocab, capsys):
    E.encode(texts, "text", vocab, max_len=8).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_both_sides_of_the_bounds_give_the_same_rows(spark, vocab):
    rows = [(2, "the cat"), (2, "dog dog the mat"), (None, "zebra the sat"), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    wide = E.encode(df, "text", vocab)
    joined = E.encode(df, "text", vocab, max_rows=0, hot_elements=1)
    shown = lambda d: sorted(map(repr, d.select("id", "text", "ids").collect()))
    assert shown(wide) == shown(joined)
    back = [E.decode(d, "ids", vocab, **b) for d, b in ((wide, {}), (joined, {"max_rows": 0, "hot_elements": 1}))]
    assert sorted(map(repr, back[0].select("id", "text").collect())) == sorted(map(repr, back[1].select("id", "text").collect()))


def test_joined_path_sends_an_element_once_a_block(spark, monkeypatch):
    """Not once a position: 400 rows of eleven words in two blocks are eleven rows of the join each."""
    monkeypatch.setattr(E, "HOT_ELEMENTS", 0)
    written = {}
    original = E.write_shared
    monkeypatch.setattr(E, "write_shared", lambda df, label, *a: written.setdefault(label, original(df, label, *a)))
    df = spark.range(400, numPartitions=2).select("id", F.expr("repeat(concat('the w', id % 10, ' '), 30)").alias("text"))
    vocab = V.build_vocab(df, ["text"])
    coded = E.encode(df, "text", vocab, **JOINED)
    assert written["found"].count() == 2 * 11
    written.clear()
    ids = E.decode(coded.select("id", "ids"), "ids", vocab, keep=["id"], **JOINED)
    assert written["found"].count() <= coded.rdd.getNumPartitions() * 11
    assert by_id(ids, "text") == {r["id"]: r["text"].strip() for r in df.collect()}


@pytest.mark.parametrize("elements, size", [(1, 1 << 20), (5, 1 << 20), (1000, 1), (1000, 100)])
def test_blocks_of_any_size_give_the_same_rows(spark, vocab, monkeypatch, elements, size):
    rows = [("the cat zz the", "mat", 1), (None, "dog the", 2), ("", None, 2), (None, None, None), ("cat " * 9, "the", 3)] * 2
    df = spark.createDataFrame(rows, "a string, b string, id long").coalesce(1)
    df = df.withColumn("at", F.timestamp_seconds("id")).withColumn("m", F.create_map("b", F.array("id")) if elements == 5 else F.lit(1))
    df = df.withColumns({"x": F.split("a", " "), "y": F.split("b", " ")}).withColumn("y", F.when(F.col("id") == 2, F.array(F.lit(None), F.lit("the"))).otherwise(F.col("y")))
    df = df.filter("b is not null") if elements == 5 else df
    arrays = {"s": "x", "x": "y"}  # one of them takes the place of a column
    made = []
    for bounds in ({}, {"max_rows": 0, "hot_elements": 1}):
        if bounds:
            for name, value in (("BLOCK_ELEMENTS", elements), ("BLOCK_BYTES", size), ("OUT_BYTES", size)):
                monkeypatch.setattr(E, name, value)
        found = E.lookup_arrays(df, arrays, vocab, "token", "token_id", 1, **bounds)
        few = E.lookup_arrays(df, arrays, vocab, "token", "token_id", None, keep=["id", "y"], **bounds)
        assert few.columns == ["id", "x", "y", "s"]
        made.append((found.columns, [t for _, t in found.dtypes], sorted(map(repr, found.collect())), sorted(map(repr, few.collect()))))
    assert made[0] == made[1]


def test_joined_path_keeps_columns_that_arrow_has_no_type_for(spark, texts, vocab):
    df = texts.withColumn("m", F.expr("make_ym_interval(0, cast(id as int))"))
    shown = [sorted(map(repr, E.encode(df, "text", vocab, **b).withColumn("m", F.col("m").cast("string")).collect())) for b in ({}, JOINED)]
    assert shown[0] == shown[1] and len(shown[0]) == 7


def test_nth_largest_of_small_values_reads_the_table_once(spark):
    from seqprep.operators.sampling import nth_largest

    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def noted(value):
        read.add(1)
        return value

    df = spark.range(50).select(noted.asNondeterministic()("id").alias("v"))
    assert nth_largest(df, "v", 10) == (40, 9)
    assert read.value == 50


@pytest.mark.parametrize("hot", [0, 1, 2, 100])
def test_only_the_frequent_elements_of_a_block_are_counted(spark, monkeypatch, hot):
    written = {}
    original = E.write_shared
    monkeypatch.setattr(E, "write_shared", lambda df, label, *a: written.setdefault(label, original(df, label, *a)))
    monkeypatch.setattr(E, "remove_copies", lambda *a, **k: None)
    df = spark.range(200, numPartitions=2).select("id", F.expr("concat('the the odd w', id % 10, ' v', id)").alias("text"))
    vocab = V.build_vocab(df.filter("id > 5"), ["text"]).filter("token <> 'odd'")
    coded = E.encode(df, "text", vocab, hot_elements=hot, **JOINED)
    blocks = written["blocks"].select("_block").distinct().count()
    assert written["element-counts"].count() <= blocks * hot
    assert by_id(coded, "ids") == by_id(E.encode(df, "text", vocab), "ids")


def test_a_lookup_and_its_reverse_measure_the_table_once(spark, vocab, monkeypatch):
    measured = []
    original = E._fits
    monkeypatch.setattr(E, "_fits", lambda *a: measured.append(a) or original(*a))
    rows = [(1, "the cat"), (1, "the cat"), (None, "zebra the"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    shown = []
    for bounds in ({}, JOINED):
        measured.clear()
        ids = E.vocab_lookup(vocab, **bounds)
        labels = E.token_labels(E.encode(df, "text", ids, keep=["id"]), "ids", ids.reversed())
        shown.append(sorted(map(repr, labels.collect())))
        assert len(measured) == 1
    assert shown[0] == shown[1] and len(shown[0]) == 3 + 3 + 3 + 1


def test_token_labels_query_writes_no_text_again(spark, tmp_path, monkeypatch):
    from catalog import encoding

    rows = [(1, "The cat, the cat!", "en"), (1, "The cat, the cat!", "en"), (2, None, None), (3, "", "en"), (4, " -- ", "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    original = E._blocks
    monkeypatch.setattr(E, "_blocks", lambda df, keep, arrays: kept.append(list(keep)) or original(df, keep, arrays))
    shown = [sorted(map(tuple, encoding.token_labels(spark, str(tmp_path)).collect()), key=repr)]
    vocab_lookup = E.vocab_lookup
    monkeypatch.setattr(E, "vocab_lookup", lambda vocab: vocab_lookup(vocab, **JOINED))
    shown.append(sorted(map(tuple, encoding.token_labels(spark, str(tmp_path)).collect()), key=repr))
    assert shown[0] == shown[1] and kept == [["id"], ["id", "ids"]]
    words = [(1, 0, "the"), (1, 1, "cat,"), (1, 2, "the"), (1, 3, "cat"), (1, 4, "<eos>")]
    assert sorted((i, p, t) for i, p, _, t in shown[0]) == sorted([*words, *words, (3, 0, "<eos>"), (4, 0, "<eos>")])


@pytest.mark.parametrize("bounds", [{}, JOINED])
def test_encode_pairs_query_makes_its_pairs_once(spark, monkeypatch, bounds):
    from catalog import encoding

    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(text):
        made.add(1)
        return text

    rows = [(1, "train", "The cat", "le chat"), (1, "train", "The cat", "le chat"), (2, "test", None, "zebra the"), (3, "train", "", None), (None, "validation", "The", "")]
    given = spark.createDataFrame(rows, "id long, split string, fr string, en string")
    pairs = given.select("id", "split", F.struct(noted.asNondeterministic()("fr").alias("fr"), "en").alias("translation"))
    monkeypatch.setattr(encoding, "pairs", lambda *a: pairs)
    encode_pairs = E.encode_pairs
    monkeypatch.setattr(E, "encode_pairs", lambda df, vocab, opts: encode_pairs(df, vocab, opts, **bounds))
    shown = encoding.encode_pairs_variable_length(spark, "").collect()
    assert made.value == len(rows)
    assert sorted([(r["id"], r["split"], r["input_ids"], r["labels"]) for r in shown], key=repr) == sorted(
        [(1, "train", "7 4 3", "6 5 3"), (1, "train", "7 4 3", "6 5 3"), (2, "test", None, "1 7 3"), (3, "train", "3", None), (None, "validation", "7 3", "3")], key=repr
    )


def test_a_sent_lookup_is_ready_to_use_in_every_task(spark, vocab):
    """A task looks its own elements up; it makes no dictionary of the whole table."""
    sent = E.vocab_lookup(vocab).sent.value
    assert sent[0] == by_id(vocab.withColumnRenamed("token", "id"), "token_id") and str(sent[1]) == "int32"
    table = spark.createDataFrame([("a", 1), ("b", None), (None, 3), ("c", 2**40)], "token string, token_id long")
    df = spark.createDataFrame([(1, ["a", "b", None, "z", "c"]), (1, ["a", "b", None, "z", "c"]), (2, []), (3, None)], "id long, x array<string>")
    for default, want in ((None, [1, None, None, None, 2**40]), (7, [1, 7, 7, 7, 2**40])):
        found = E.lookup_arrays(df.repartition(3), {"y": "x"}, table, "token", "token_id", default)
        assert sorted(((r["id"], r["y"]) for r in found.collect()), key=repr) == [(1, want), (1, want), (2, []), (3, None)]


def test_rare_elements_are_not_sorted_to_be_found(spark, monkeypatch, capsys):
    """The larger side of the join streams past a hash table of the vocabulary; nulls and repeated rows keep their place."""
    plans = []
    original = E.write_shared

    def write(df, label, *a):
        if label == "found":
            df.explain()
            plans.append(capsys.readouterr().out)
        return original(df, label, *a)

    monkeypatch.setattr(E, "write_shared", write)
    rows = [(1, "the cat sat"), (1, "the cat sat"), (None, "zebra dog the"), (2, None), (3, ""), (4, "mat mat hat")]
    df = spark.createDataFrame(rows, "id long, text string")
    vocab = V.build_vocab(df, ["text"]).filter("token not in ('zebra', 'the')")
    coded = E.encode(df, "text", vocab, **JOINED)
    labels = E.token_labels(coded, "ids", vocab, **JOINED)
    assert len(plans) == 2 and all(p.count("ShuffledHashJoin") == 1 and "SortMergeJoin" not in p for p in plans)
    wide = E.encode(df, "text", vocab)
    assert sorted(map(repr, coded.collect())) == sorted(map(repr, wide.collect()))
    assert sorted(map(repr, labels.collect())) == sorted(map(repr, E.token_labels(wide, "ids", vocab).collect()))
