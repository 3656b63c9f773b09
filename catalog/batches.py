"""Batch collation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.registry import documents, ids_text, long, query, table
from seqprep.functions import arrays as A
from seqprep.functions.text import words
from seqprep.operators import collate as C
from seqprep.options import PrepOptions
from seqprep.plans.evaluate import training_feed
from seqprep.session import shared_dir

_LEN = f"list_transform({Q.words('text')}, lambda w: length(w))"
# Word lengths stand in for ids; a document's own length varies.
_ROWS = f"""rows AS (
    SELECT doc_id AS id, {_LEN} AS input_ids, list_append({_LEN}, 3) AS labels FROM documents),
  placed AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS idx FROM rows),
  batched AS (SELECT *, (idx // 32)::BIGINT AS batch_id, (idx % 32)::BIGINT AS pos_in_batch,
                     list_transform(input_ids, lambda x: 1) AS attention_mask FROM placed),
  longest AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) AS ml,
                     max(len(labels)) OVER (PARTITION BY batch_id) AS tl FROM batched),
  padded AS (SELECT id, batch_id, pos_in_batch, {Q.pad('input_ids', 'ml')} AS src_tokens,
                    {Q.pad('labels', 'tl')} AS labels, {Q.pad('attention_mask', 'ml')} AS attention_mask FROM longest)"""
_INPUT = "list_concat([2], labels[1:len(labels) - 1])"
_MASKED = "list_transform({}, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END)"


def rows(spark, sf_dir):
    ids = F.transform(words(F.col("text")), lambda w: F.length(w))
    own = documents(spark, sf_dir).select("id", ids.alias("input_ids"))
    labels = A.append_eos(F.col("input_ids"))
    return own.withColumns({"labels": labels, "attention_mask": A.attention_mask(F.col("input_ids"))})


def batched(spark, sf_dir, measure=()):
    return C.assign_batches(rows(spark, sf_dir), 32, measure=measure)


def _place():
    return ["id", long("batch_id").alias("batch_id"), long("pos_in_batch").alias("pos_in_batch")]


@query(
    """SELECT event_id AS id, ((row_number() OVER (ORDER BY event_id) - 1) // 64)::BIGINT AS batch_id,
              ((row_number() OVER (ORDER BY event_id) - 1) % 64)::BIGINT AS pos_in_batch FROM events"""
)
def assign_batches(spark, sf_dir):
    """Batch 16 on 2 devices, accumulated twice, in key order."""
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return C.assign_batches(events, 16, devices=2, accum=2).select(*_place())


@query(
    """WITH r AS (SELECT event_id AS id, row_number() OVER (ORDER BY md5('7:' || event_id), event_id) - 1 AS idx FROM events)
       SELECT id, (idx // 32)::BIGINT AS batch_id, (idx % 32)::BIGINT AS pos_in_batch FROM r"""
)
def assign_batches_shuffled(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return C.assign_batches(events, 32, seed=7).select(*_place())


def _padded(name: str, col: str, shown: str) -> None:
    def run(spark, sf_dir):
        pad = C.pad_batch(batched(spark, sf_dir), col)
        return pad.select(*_place(), ids_text(col).alias(col))

    run.__name__ = name
    query(f"WITH {_ROWS} SELECT id, batch_id, pos_in_batch, {Q.ids_text(shown)} AS {col} FROM padded")(run)


_padded("pad_batch_input_ids", "input_ids", "src_tokens")
_padded("pad_batch_attention_mask", "attention_mask", "attention_mask")
_padded("pad_batch_labels", "labels", "labels")


def _collated(name: str, target: str, alignment: str) -> None:
    def run(spark, sf_dir):
        fed = C.collate(batched(spark, sf_dir, measure=("input_ids", "labels")), alignment=alignment)
        return fed.select(*_place(), *[ids_text(c).alias(c) for c in C.COLLATED_COLUMNS])

    run.__name__ = name
    query(
        f"""WITH {_ROWS} SELECT id, batch_id, pos_in_batch, {Q.ids_text('src_tokens')} AS src_tokens,
            {Q.ids_text(_INPUT)} AS tgt_tokens_input, {Q.ids_text(_MASKED.format(target))} AS tgt_tokens_target,
            {Q.ids_text('attention_mask')} AS attention_mask FROM padded"""
    )(run)


_collated("collate", "labels[2:]", "reference")
_collated("collate_aligned", "labels", "aligned")


_SHUFFLED = _ROWS.replace("ORDER BY id", "ORDER BY md5('42:' || id), id")


@query(
    f"""WITH {_SHUFFLED} SELECT id, batch_id, pos_in_batch, {Q.ids_text('src_tokens')} AS src_tokens,
        {Q.ids_text(_INPUT)} AS tgt_tokens_input, {Q.ids_text(_MASKED.format('labels[2:]'))} AS tgt_tokens_target,
        {Q.ids_text('attention_mask')} AS attention_mask FROM padded"""
)
def shuffled_training_feed(spark, sf_dir):
    fed = training_feed(rows(spark, sf_dir), PrepOptions(batch_size=32))
    return fed.select(*_place(), *[ids_text(c).alias(c) for c in C.COLLATED_COLUMNS])


@query(
    f"""WITH {_SHUFFLED} SELECT id, batch_id, pos_in_batch, {Q.ids_text('src_tokens')} AS src_tokens,
        batch_id // 4 AS feed_part FROM padded"""
)
def stored_training_feed(spark, sf_dir):
    """The feed written a folder per four batches, and read back batch by batch."""
    path = f"{shared_dir(spark)}/feed-{uuid.uuid4().hex}"
    C.write_feed(training_feed(rows(spark, sf_dir), PrepOptions(batch_size=32), batches_per_part=4), path)
    back = C.read_batches(spark, path)
    return back.select(*_place(), ids_text("src_tokens").alias("src_tokens"), long("feed_part").alias("feed_part"))


@query(
    f"""WITH {_ROWS} SELECT batch_id, string_agg({Q.ids_text('src_tokens')}, '|' ORDER BY pos_in_batch) AS src_tokens,
        string_agg({Q.ids_text(_INPUT)}, '|' ORDER BY pos_in_batch) AS tgt_tokens_input FROM padded GROUP BY batch_id"""
)
def stack_batches(spark, sf_dir):
    fed = C.collate(batched(spark, sf_dir))
    stacked = C.stack_batches(fed, ["src_tokens", "tgt_tokens_input"])
    shown = [F.array_join(F.transform(c, ids_text), "|").alias(c) for c in ("src_tokens", "tgt_tokens_input")]
    return stacked.select("batch_id", *shown)


@query(
    f"""WITH {_ROWS}, e AS (SELECT id, unnest(labels) AS token_id, generate_subscripts(labels, 1) - 1 AS pos FROM padded)
        SELECT id, pos::BIGINT AS pos, token_id::BIGINT AS token_id FROM e WHERE token_id <> 0"""
)
def non_pad(spark, sf_dir):
    kept = C.non_pad(C.pad_batch(batched(spark, sf_dir), "labels"), "labels")
    return kept.select("id", long("pos").alias("pos"), long("token_id").alias("token_id"))
