"""Sources, splits, pairs, subsets, order and run history."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.registry import long, query, table
from seqprep.operators import sampling as S
from seqprep.operators.encode import select_pair
from seqprep.options import PrepOptions
from seqprep.session import shared_dir
from seqprep.plans.prepare import selected_pairs
from seqprep.sources import parallel as R
from seqprep.sources.tables import read_vectors


def pairs(spark, sf_dir):
    return R.pairs_from_turns(table(spark, sf_dir, "conversations"))


@query("SELECT doc_id AS id, text AS fr, lang AS en FROM documents")
def read_parallel(spark, sf_dir):
    df = R.read_parallel(
        spark, f"{sf_dir}/documents.parquet", id_col="doc_id", languages={"fr": "text", "en": "lang"}
    )
    return df.select("id", "translation.fr", "translation.en")


_CONTENT = "md5('2:en' || length(lang) || ':' || lang || '2:fr' || length(text) || ':' || text)"


@query(
    f"""WITH d AS (SELECT *, {_CONTENT} AS h FROM documents)
        SELECT h || ':' || (row_number() OVER (PARTITION BY h) - 1) AS id, text AS fr, lang AS en FROM d"""
)
def read_parallel_without_ids(spark, sf_dir):
    """JSON lines without ids: the contents' hash and the number among equal contents."""
    folder = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    texts = table(spark, sf_dir, "documents").select(F.struct(F.col("text").alias("fr"), F.col("lang").alias("en")).alias("translation"))
    texts.write.json(folder)
    df = R.read_parallel(spark, folder, "json", "translation struct<fr: string, en: string>")
    return df.select("id", "translation.fr", "translation.en")


@query(f"WITH {Q.PAIRS} SELECT id, split, source, target FROM pairs")
def pairs_from_turns(spark, sf_dir):
    return select_pair(pairs(spark, sf_dir))


@query(
    f"""WITH {Q.PAIRS} SELECT id, split, source FROM pairs WHERE split = (
        SELECT CASE WHEN count(*) FILTER (WHERE split = 'validation') > 0 THEN 'validation' ELSE 'test' END FROM pairs)"""
)
def resolve_eval_split(spark, sf_dir):
    return select_pair(R.resolve_eval_split(pairs(spark, sf_dir))).drop("target")


@query(f"WITH {Q.PAIRS} SELECT split, count(*) AS n_rows FROM pairs GROUP BY split")
def split_counts(spark, sf_dir):
    return R.split_counts(pairs(spark, sf_dir))


@query(f"WITH {Q.PAIRS} SELECT id, split, source, target FROM pairs")
def select_pair_by_language(spark, sf_dir):
    df = pairs(spark, sf_dir)
    as_map = F.map_from_arrays(F.array(F.lit("fr"), F.lit("en")), F.array("translation.fr", "translation.en"))
    return select_pair(df.withColumn("translation", as_map), "fr", "en")


@query(f"WITH {Q.PAIRS} SELECT id, split, target AS source, source AS target FROM pairs")
def select_pair_swapped(spark, sf_dir):
    return select_pair(pairs(spark, sf_dir), "en", "fr")


@query("SELECT vec_id AS token_id, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings")
def read_vector_table(spark, sf_dir):
    vectors = read_vectors(spark, f"{sf_dir}/embeddings.parquet", "vec_id")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return vectors.select("token_id", F.round(total, 4).alias("total"))


_SUBSET = """
  WITH ranked AS (
    SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn, count(*) OVER () AS total FROM documents)
  SELECT doc_id AS id, lang FROM ranked
  WHERE rn <= least(greatest(trunc(total * {f}::DOUBLE), 1), total)"""


@query(_SUBSET.format(f="0.25"))
def get_subset(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return S.get_subset(docs, 0.25)


@query(_SUBSET.format(f="0.0001"))
def get_subset_tiny_fraction(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return S.get_subset(docs, 0.0001)


@query(
    f"""WITH {Q.PAIRS}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || id), id) AS rn,
             count(*) OVER (PARTITION BY split) AS total FROM pairs WHERE split <> 'test')
    SELECT id, CASE split WHEN 'train' THEN 'train' ELSE 'val' END AS split, source, target FROM ranked
    WHERE rn <= least(greatest(trunc(total * 0.25::DOUBLE), 1), total)"""
)
def subset_of_both_splits(spark, sf_dir):
    return selected_pairs(pairs(spark, sf_dir), PrepOptions(dataset_fraction=0.25))


@query(
    """SELECT event_id AS id, (row_number() OVER (ORDER BY md5('42:' || event_id), event_id) - 1)::BIGINT AS shuffle_idx
       FROM events"""
)
def shuffle(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return S.shuffle(events).select("id", long("shuffle_idx").alias("shuffle_idx"))


@query("SELECT event_id, (row_number() OVER (ORDER BY value DESC, event_id) - 1)::BIGINT AS idx FROM events")
def sorted_index(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return S.sorted_index(events, [F.desc("value"), F.asc("event_id")]).select("event_id", "idx")


@query("SELECT doc_id AS id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 100")
def max_samples(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars")
    return S.max_samples(docs, 100)


@query(
    """SELECT lang, count(*) AS n_rows FROM (SELECT lang FROM documents ORDER BY lang LIMIT 150) GROUP BY lang"""
)
def max_samples_of_tied_rows(spark, sf_dir):
    """The cap falls among rows with one key, which hold a map."""
    docs = table(spark, sf_dir, "documents").select("lang", F.create_map(F.lit("fr"), "text").alias("translation"))
    return S.max_samples(docs, 150, "lang").groupBy("lang").agg(F.count("translation").alias("n_rows"))


@query("SELECT doc_id AS id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def head_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars")
    return S.head_rows(docs, 5)


def history(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss")
    )


_BEST = """
  SELECT event_type AS run, event_id AS best_step, round(value, 4) AS best_loss FROM (
    SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value {way}, event_id) AS rn FROM events) WHERE rn = 1"""


@query(_BEST.format(way="ASC"))
def best_run_lowest(spark, sf_dir):
    best = S.best_run(history(spark, sf_dir), "run", "loss")
    return best.withColumn("best_loss", F.round("best_loss", 4))


@query(_BEST.format(way="DESC"))
def best_run_highest(spark, sf_dir):
    best = S.best_run(history(spark, sf_dir), "run", "loss", greater_is_better=True)
    return best.withColumn("best_loss", F.round("best_loss", 4))


@query(
    """SELECT event_type AS run, event_id AS step FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 3"""
)
def keep_last(spark, sf_dir):
    return S.keep_last(history(spark, sf_dir), "run", "step", 3).select("run", "step")


@query("SELECT event_type AS run, event_id AS step, round(value, 4) AS loss FROM events WHERE event_id % 10 = 0")
def every_nth(spark, sf_dir):
    return S.every_nth(history(spark, sf_dir), "step", 10).withColumn("loss", F.round("loss", 4))
