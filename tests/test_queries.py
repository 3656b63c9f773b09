"""Every registered query: its SQL twin, and the shape of its plan."""

import re

import duckdb
import pytest

from __spark_entry__ import entry
from catalog import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tools.check import TABLES, rows_of



@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name, capsys):
    df = QUERIES[name](spark, SF_SMALL)
    got = rows_of(df.columns, df.collect())
    df.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Window .*\n.*Sort .*\n.*Exchange SinglePartition", plan)
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert sorted(df.columns) == sorted(columns)
        assert got == rows_of(columns, result.fetchall())
    else:
        assert got


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["id", "split", "input_ids", "attention_mask", "labels"]
    assert df.count() > 0


def test_labelled_projection_labels_every_position_with_its_word(spark):
    from catalog.encoding import clean

    words = {r.id: (r.text or "").split() for r in clean(spark, SF_SMALL).select("id", "text").collect()}
    vectors = [r.vec_id for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id").collect()]
    want = {(v // 10, v % 10): words[v // 10][v % 10] for v in vectors if v % 10 < len(words.get(v // 10, ()))}
    got = {(r.id, r.pos): r.token for r in QUERIES["labelled_projection"](spark, SF_SMALL).collect()}
    assert got == want and any(pos == 9 for _, pos in got)


def test_sample_report_encodes_only_the_rows_reported(spark, monkeypatch):
    from catalog import tables

    seen, original = [], tables.encode
    monkeypatch.setattr(tables, "encode", lambda df, *a, **k: seen.append(df.count()) or original(df, *a, **k))
    assert QUERIES["encoded_sample_report"](spark, SF_SMALL).count() == 5
    assert seen == [5]


@pytest.mark.parametrize("name", ["encode", "decode", "decode_by_join"])
def test_encoded_texts_are_normalised_once(spark, monkeypatch, name):
    """The documents to encode are read as written, and ids are decoded without the texts beside them."""
    from catalog import encoding

    plans, columns, encode, decode = [], [], encoding.E.encode, encoding.E.decode

    def encoded(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().toString())
        return encode(df, *args, **kwargs)

    monkeypatch.setattr(encoding.E, "encode", encoded)
    monkeypatch.setattr(encoding.E, "decode", lambda df, *a, **k: columns.append(df.columns) or decode(df, *a, **k))
    QUERIES[name](spark, SF_SMALL)
    assert len(plans) == 1 and "regexp_replace" not in plans[0]
    assert columns == [["id", "ids"]] * (name != "encode")


def test_decode_by_join_leaves_no_copy_that_its_result_does_not_read(spark):
    """The documents and the blocks they were encoded in are removed once their ids are written."""
    import os
    from collections import Counter
    from urllib.parse import urlparse

    from seqprep.session import _own_folder

    folder = urlparse(_own_folder(spark)).path
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df = QUERIES["decode_by_join"](spark, SF_SMALL)
    left = set(os.listdir(folder)) - before
    assert Counter(x.partition("-")[0] for x in left) == {"sorted": 1, "blocks": 1, "found": 1}
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
