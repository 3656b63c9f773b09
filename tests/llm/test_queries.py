"""The registered queries with SQL, and the pipeline against its stages' plain versions."""

import duckdb
import pytest

from seqprep.llm import ORACLES, QUERIES, secret_scan
from tests.conftest import SF_SMALL
from tests.llm.cases import clashing, documents, rows
from tests.llm.test_corpus import check_packing, plain_components, plain_leaks
from tools.check import TABLES, rows_of


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    return con


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_pipeline_takes_awkward_tables(spark, tmp_path):
    import corpus_pipeline as P

    benchmark = [(1, rows()[4][1]), (2, None), (None, "")]
    for name, made in (("awkward", rows()), ("empty", [])):
        folder = str(tmp_path / name)
        clashing(documents(spark, made)).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        pieces = P.run(spark, folder).collect()
        if not made:
            assert pieces == []
            continue
        # 1 to 3 are copies of 0, as is the row without id; 4 and 14 hold the item; 6 to 10 and 13 are no prose.
        kept = {r.doc_id for r in pieces}
        assert 0 in kept and {11, 16} <= kept and not kept & {1, 2, 3, 4, 6, 7, 8, 9, 10, 13, 14}
        by = {}
        for r in pieces:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert all(sum(n for _, n in own) <= 2048 for own in by.values())


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, benchmark = docs.columns, [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    texts = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    clean = P.quality(spark, docs, SF_SMALL)
    first = P.near_duplicates(spark, clean, SF_SMALL)
    own = texts(clean)
    assert texts(first) == [t for t, c in zip(own, sorted(plain_components(own, 5), key=lambda c: c[0])) if c[3]]
    free = P.decontamination(spark, first, SF_SMALL)
    leaking = {d for d, _ in plain_leaks(texts(first), benchmark)}
    assert texts(free) == [t for t in texts(first) if t[0] not in leaking] and leaking
    masked = P.secrets(spark, free, SF_SMALL)
    scanner = secret_scan.Scanner(secret_scan.RULES)
    before = texts(free)
    want = [(d, secret_scan.redact(t, s, "[secret]")) for (d, t), s in zip(before, scanner.scan([t for _, t in before]))]
    assert texts(masked) == want
    for stage in (clean, first, free, masked):
        assert stage.columns == columns
    made = P.run(spark, SF_SMALL).collect()
    check_packing(made, texts(masked), 2048)
