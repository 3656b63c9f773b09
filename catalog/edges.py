"""Input and output, Python functions on rows, streaming."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from catalog.corpus import pairs
from catalog.encoding import ALL_PADDED, QUARTER_PADDED, _as_text
from catalog.quality import scores
from catalog.registry import documents, query, table
from seqprep.functions.text import normalize
from seqprep.operators import guards as G
from seqprep.operators import scoring as U
from seqprep.operators.encode import encode_pairs, select_pair
from seqprep.operators.metrics import masked_xent
from seqprep.operators.vocab import build_vocab
from seqprep.options import PrepOptions
from seqprep.plans.prepare import corpus_vocab, prepare_cached, prepare_incremental, selected_pairs
from seqprep.session import shared_dir
from seqprep.sources import processed as S
from seqprep.sources.tables import write_metrics
from seqprep.streaming.monitor import monitor, monitor_to
from seqprep.streaming.prepare import prepare_stream as stream


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _vocab(both):
    texts = [normalize(F.col("source")), normalize(F.col("target"))]
    return build_vocab(both.filter("split = 'train'"), texts)


@query(ALL_PADDED)
def processed_round_trip(spark, sf_dir):
    """Built on the first call, read back on the second."""
    both, root = select_pair(pairs(spark, sf_dir)), _folder(spark, "processed")
    opts, vocab = PrepOptions(normalize=True), _vocab(both)
    renamed = F.when(F.col("split") == "validation", "val").otherwise(F.col("split"))

    def build():
        return encode_pairs(both, vocab, opts).withColumn("split", renamed)

    def refuse():
        raise AssertionError("the processed set was not reused")

    S.load_or_prepare(spark, opts, root, build)
    again = S.load_or_prepare(spark, opts, root, refuse)
    back = F.when(F.col("split") == "val", "validation").otherwise(F.col("split"))
    return _as_text(again.withColumn("split", back))


@query(QUARTER_PADDED)
def prepare_through_cache(spark, sf_dir):
    """Prepared behind the cache, with vocabulary and fingerprint; the second call reads back."""
    raw, root = pairs(spark, sf_dir), _folder(spark, "cache")
    opts = PrepOptions(normalize=True, dataset_fraction=0.25)
    prepare_cached(spark, raw, root, opts)
    return _as_text(prepare_cached(spark, raw, root, opts)[0])


@query(QUARTER_PADDED)
def prepare_changed_files(spark, sf_dir):
    """A corpus in files of which some are then changed, dropped and added: only those are encoded again."""
    raw, root, source = pairs(spark, sf_dir), _folder(spark, "incremental"), _folder(spark, "corpus")
    opts = PrepOptions(normalize=True, dataset_fraction=0.25)
    vocab = corpus_vocab(selected_pairs(raw, opts), opts)
    parts = [raw.filter(F.pmod(F.xxhash64("id"), F.lit(4)) == k) for k in range(4)]
    other = parts[1].withColumn("translation", F.struct(F.upper("translation.en").alias("fr"), F.col("translation.fr").alias("en")))

    def put(rows, name):
        rows.write.partitionBy("split").mode("overwrite").parquet(f"{source}/part={name}")

    for name, rows in (("0", parts[0]), ("1", other), ("2", parts[2]), ("gone", other.withColumn("id", -F.col("id")))):
        put(rows, name)
    prepare_incremental(spark, source, root, opts, vocab)
    for name, rows in (("1", parts[1]), ("3", parts[3]), ("gone", other.limit(0))):
        put(rows, name)
    return _as_text(prepare_incremental(spark, source, root, opts, vocab)[0])


@query(
    """SELECT 'eval' AS kind, round(avg(ln(list_sum(list_transform(embedding::DOUBLE[], lambda x: exp(x))))
              - embedding[label + 1]::DOUBLE), 6) AS loss FROM embeddings WHERE label <> 0"""
)
def metrics_record(spark, sf_dir):
    """A metrics row, written and read back."""
    path = _folder(spark, "metrics")
    write_metrics(masked_xent(scores(spark, sf_dir)), path, "eval")
    return spark.read.schema("kind string, loss double").json(path).withColumn("loss", F.round("loss", 6))


@query("SELECT doc_id AS id, text AS source FROM documents")
def require_columns(spark, sf_dir):
    docs = documents(spark, sf_dir).select("id", F.col("text").alias("source"))
    return G.require_columns(docs, ("id", "source"))


@query("SELECT lang, count(*) AS n_rows, (SELECT count(*) = 0 FROM documents) AS is_empty FROM documents GROUP BY lang")
def is_empty(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.groupBy("lang").agg(F.count("*").alias("n_rows")).withColumn("is_empty", F.lit(G.is_empty(docs)))


@query(
    """SELECT doc_id AS id, CASE WHEN length(text) % 97 = 0 THEN '[Translation failed]' ELSE left(text, 20) END AS translation,
              CASE WHEN length(text) % 97 = 0 THEN 'ValueError: cannot translate' END AS error FROM documents"""
)
def score(spark, sf_dir):
    """A stand-in translator that fails on some texts."""

    def factory():
        def translate(text: str) -> str:
            if len(text) % 97 == 0:
                raise ValueError("cannot translate")
            return text[:20]

        return translate

    return U.score(documents(spark, sf_dir), "text", factory).select("id", "translation", "error")


@query("SELECT doc_id AS id, length(text)::BIGINT AS n FROM documents")
def map_batches(spark, sf_dir):
    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = pc.cast(pc.utf8_length(batch.column("text")), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("id"), n], names=["id", "n"])

    return U.map_batches(documents(spark, sf_dir).select("id", "text"), measure, "id long, n long")


@query(ALL_PADDED)
def prepare_stream(spark, sf_dir):
    """New files through the stream: the same rows as the batch encoding."""
    raw, folder = pairs(spark, sf_dir), _folder(spark, "stream")
    vocab = _vocab(select_pair(raw))
    raw.write.parquet(f"{folder}/in")
    stream(
        spark, f"{folder}/in", vocab, f"{folder}/out", f"{folder}/state", raw.schema, PrepOptions(normalize=True)
    ).awaitTermination()
    return _as_text(spark.read.parquet(f"{folder}/out"))


@query(
    """WITH w AS (SELECT (floor(epoch(ts) / 600) * 600)::BIGINT AS window_start, event_type AS run,
                         round(avg(value), 8) AS mean_value, count(value) AS n_values FROM events GROUP BY 1, 2)
       SELECT * FROM w WHERE window_start + 600 <= (SELECT epoch(max(ts)) FROM events) - 600"""
)
def monitor_stream(spark, sf_dir):
    """The metric monitor as a stream: the windows that are closed when all events are read."""
    events, folder = table(spark, sf_dir, "events"), _folder(spark, "monitor")
    events.select("ts", "event_type", "value").write.parquet(f"{folder}/in")
    live = spark.readStream.schema("ts timestamp_ntz, event_type string, value double").parquet(f"{folder}/in")
    monitor_to(monitor(live, run="event_type"), f"{folder}/out", f"{folder}/state").awaitTermination()
    closed = spark.read.schema("window_start timestamp, run string, mean_value double, n_values long").parquet(f"{folder}/out")
    shown = [F.unix_timestamp("window_start").alias("window_start"), "run", F.round("mean_value", 8).alias("mean_value"), "n_values"]
    return closed.select(*shown)
