import datetime as dt
import shutil
import time

import pytest

from seqprep import PrepOptions
from seqprep.operators.encode import encode_pairs, select_pair
from seqprep.operators.vocab import build_vocab
from seqprep.streaming.monitor import monitor
from seqprep.streaming.prepare import prepare_stream

SCHEMA = "id long, split string, translation struct<fr:string,en:string>"
OPTS = PrepOptions(max_source_length=5, max_target_length=5)


def rows(first, last):
    return [(i, "train", (f"mot {i}", f"word {i}")) for i in range(first, last)]


def test_prepare_stream_takes_each_file_once(spark, tmp_path):
    folder = {n: str(tmp_path / n) for n in ("in", "out", "state")}
    first = spark.createDataFrame(rows(0, 20), SCHEMA).coalesce(1)
    first.write.parquet(folder["in"])
    vocab = build_vocab(select_pair(first), ["source", "target"])

    def run():
        prepare_stream(spark, folder["in"], vocab, folder["out"], folder["state"], SCHEMA, OPTS, max_files=1).awaitTermination()
        return sorted(str(r) for r in spark.read.parquet(folder["out"]).drop("batch").collect())

    want = sorted(str(r) for r in encode_pairs(select_pair(first), vocab, OPTS).collect())
    assert run() == want
    assert run() == want
    second = spark.createDataFrame(rows(20, 30), SCHEMA).coalesce(1)
    second.write.mode("append").parquet(folder["in"])
    both = encode_pairs(select_pair(first.union(second)), vocab, OPTS)
    assert run() == sorted(str(r) for r in both.collect())


def test_replay_replaces_its_own_output(spark, tmp_path):
    """A batch written but not committed is written again, not twice."""
    folder = {n: str(tmp_path / n) for n in ("in", "out", "state")}
    spark.createDataFrame(rows(0, 10), SCHEMA).coalesce(1).write.parquet(folder["in"])
    vocab = build_vocab(select_pair(spark.read.parquet(folder["in"])), ["source"])
    for _ in range(2):
        prepare_stream(spark, folder["in"], vocab, folder["out"], folder["state"], SCHEMA, OPTS).awaitTermination()
        shutil.rmtree(f"{folder['state']}/commits")
    assert spark.read.parquet(folder["out"]).count() == 10


@pytest.fixture(scope="module")
def series(spark):
    start = dt.datetime(2024, 1, 1)
    data = [(start + dt.timedelta(minutes=i), "ab"[i % 2], float(i)) for i in range(120)]
    return spark.createDataFrame(data, "ts timestamp_ntz, run string, value double")


def test_monitor_stream_equals_batch_on_closed_windows(spark, series, tmp_path):
    path = str(tmp_path / "log")
    series.coalesce(1).write.parquet(path)
    live = monitor(spark.readStream.schema(series.schema).parquet(path))
    query = live.writeStream.format("memory").queryName("closed").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    closed = {tuple(r) for r in spark.table("closed").collect()}
    every = {tuple(r) for r in monitor(series).collect()}
    assert closed < every
    # The last event is at minute 119, the watermark ten minutes before it.
    assert {w for w, *_ in every - closed} == {dt.datetime(2024, 1, 1, 1, 40), dt.datetime(2024, 1, 1, 1, 50)}


def test_monitor_drops_late_rows(spark, series, tmp_path):
    path = str(tmp_path / "log")
    series.coalesce(1).write.parquet(path)

    def run():
        live = monitor(spark.readStream.schema(series.schema).parquet(path))
        query = (
            live.writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append")
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    before = run()
    late = [(dt.datetime(2024, 1, 1, 0, 1), "a", 1000.0), (dt.datetime(2024, 1, 1, 4, 0), "a", 1.0)]
    spark.createDataFrame(late, series.schema).coalesce(1).write.mode("append").parquet(path)
    after = run()
    assert before <= after and 1000.0 not in {v for _, _, v, _ in after}
    assert {r for r in after if r[0] < dt.datetime(2024, 1, 1, 1, 0)} == {r for r in before if r[0] < dt.datetime(2024, 1, 1, 1, 0)}


def test_the_vocabulary_is_sent_once_for_all_micro_batches(spark, tmp_path, monkeypatch):
    from seqprep.operators import encode as E

    folder = {n: str(tmp_path / n) for n in ("in", "out", "state")}
    for k in range(4):
        spark.createDataFrame(rows(10 * k, 10 * k + 10), SCHEMA).coalesce(1).write.mode("append").parquet(folder["in"])
    vocab = build_vocab(select_pair(spark.read.parquet(folder["in"])), ["source", "target"])
    sent, measured = [], []
    send, fits = E._send, E._fits
    monkeypatch.setattr(E, "_send", lambda *a: sent.append(send(*a)) or sent[-1])
    monkeypatch.setattr(E, "_fits", lambda *a: measured.append(1) or fits(*a))
    query = prepare_stream(spark, folder["in"], vocab, folder["out"], folder["state"], SCHEMA, OPTS, max_files=1)
    query.awaitTermination()
    assert len(list((tmp_path / "out").glob("batch=*"))) == 4
    assert len(sent) == len(measured) == 1
    for _ in range(100):  # freed by a thread that waits for the query's end
        if sent[0]._jbroadcast is not None and not sent[0]._jbroadcast.isValid():
            break
        time.sleep(0.1)
    assert not sent[0]._jbroadcast.isValid()


def test_windows_do_not_depend_on_the_session_zone(spark, series):
    def windows():
        return sorted(tuple(r) for r in monitor(series).selectExpr("unix_timestamp(window_start)", "run", "mean_value", "n_values").collect())

    before = windows()
    assert before[0][0] == 1704067200  # 2024-01-01 00:00 in UTC
    for zone in ("America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert windows() == before
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
