import pyarrow as pa
import pyarrow.compute as pc
import pytest

from seqprep.operators import scoring as U


def test_score_isolates_failures(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "boom"), (3, None), (4, "cd")], "id long, text string")

    def factory():
        def predict(text):
            if text == "boom":
                raise RuntimeError("no")
            return text.upper()

        return predict

    got = {r["id"]: (r["translation"], r["error"]) for r in U.score(df, "text", factory).collect()}
    assert got[1] == ("AB", None) and got[4] == ("CD", None)
    assert got[2] == ("[Translation failed]", "RuntimeError: no")
    assert got[3][0] == "[Translation failed]" and got[3][1].startswith("AttributeError")


def test_score_builds_the_predictor_once_per_task(spark, tmp_path):
    log = str(tmp_path / "built")

    def factory():
        with open(log, "a") as file:
            file.write("x")
        return lambda text: text

    df = spark.range(1000, numPartitions=2).selectExpr("id", "cast(id AS string) AS text")
    assert U.score(df, "text", factory, out="t").filter("t = text").count() == 1000
    with open(log) as file:
        assert len(file.read()) == 2


def test_map_batches(spark):
    def sizes(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = pa.array([batch.num_rows] * batch.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays([pc.add(batch.column("id"), 1), n], names=["id", "n"])

    df = spark.range(100, numPartitions=1)
    got = U.map_batches(df, sizes, "id long, n long", batch_rows=30).collect()
    assert sorted(r["id"] for r in got) == list(range(1, 101))
    assert {r["n"] for r in got} == {30, 10}
    with pytest.raises(ValueError):
        U.map_batches(df, sizes, "id long, n long", batch_rows=0)
