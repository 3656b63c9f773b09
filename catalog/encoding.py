"""Encoding, padding, masks and decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.corpus import pairs
from catalog.registry import documents, ids_text, long, query
from seqprep.functions import arrays as A
from seqprep.functions.text import normalize, words
from seqprep.operators import encode as E
from seqprep.operators import vocab as V
from seqprep.options import PrepOptions
from seqprep.plans.prepare import prepare
from seqprep.session import remove_copies, write_shared

DOC_VOCAB = Q.vocab(f"SELECT {Q.words('text')} AS w FROM docs")
DOCS = f"docs AS (SELECT doc_id AS id, {Q.normalize('text')} AS text FROM documents)"


def clean(spark, sf_dir):
    """Documents with normalised text."""
    return documents(spark, sf_dir).select("id", normalize(F.col("text")).alias("text"))


def clean_and_vocab(spark, sf_dir, written=False):
    """Documents and the vocabulary of all; ``written`` spares normalising them a second time to encode them."""
    docs = clean(spark, sf_dir)
    if written:
        docs = write_shared(docs, "clean", "zstd")
    return docs, V.build_vocab(docs, ["text"])


# --- whole-column encoding ------------------------------------------------

_IDS = Q.encoded("enc", "docs", "text", None)
_CUT = Q.encoded("enc", "docs", "text", 31)


@query(f"WITH {DOCS}, {DOC_VOCAB}, {_IDS} SELECT id, {Q.ids_text('ids')} AS ids FROM enc")
def encode(spark, sf_dir):
    docs, vocab = clean_and_vocab(spark, sf_dir, written=True)
    return E.encode(docs, "text", vocab, add_special=False).select("id", ids_text("ids").alias("ids"))


@query(f"WITH {DOCS}, {DOC_VOCAB}, {_CUT} SELECT id, {Q.ids_text(Q.pad('list_append(ids, 3)', 32))} AS ids FROM enc")
def encode_truncated_and_padded(spark, sf_dir):
    docs, vocab = clean_and_vocab(spark, sf_dir, written=True)
    coded = E.encode(docs, "text", vocab, max_len=32, padding="max_length")
    return coded.select("id", ids_text("ids").alias("ids"))


@query(f"WITH {DOCS}, {DOC_VOCAB}, {_IDS} SELECT id, {Q.ids_text('list_append(ids, 3)')} AS ids FROM enc")
def encode_by_join(spark, sf_dir):
    """The same as for a vocabulary that is too large to broadcast."""
    docs, vocab = clean_and_vocab(spark, sf_dir, written=True)
    return E.encode(docs, "text", vocab, max_rows=0, hot_elements=100).select("id", ids_text("ids").alias("ids"))


# --- array functions on an id column (here: word lengths) -----------------

_LEN = f"list_transform({Q.words('text')}, lambda w: length(w))"
LENGTHS = f"x AS (SELECT doc_id AS id, {_LEN} AS ids FROM documents)"


def lengths(spark, sf_dir):
    """Documents with the lengths of their words as ids."""
    return documents(spark, sf_dir).select("id", F.transform(words(F.col("text")), lambda w: F.length(w)).alias("ids"))


def _on_ids(name: str, sql: str, fn) -> None:
    def run(spark, sf_dir):
        return lengths(spark, sf_dir).select("id", ids_text(fn(F.col("ids"))).alias("ids"))

    run.__name__ = name
    query(f"WITH {LENGTHS} SELECT id, {Q.ids_text(sql)} AS ids FROM x")(run)


_on_ids("append_eos", "list_append(ids, 3)", A.append_eos)
_on_ids("truncate", "list_append(ids[1:63], 3)", lambda c: A.truncate(c, 64))
_on_ids("truncate_without_eos", "ids[1:64]", lambda c: A.truncate(c, 64, add_special=False))
_on_ids("pad_to", Q.pad("ids", 300), lambda c: A.pad_to(c, 300))
_on_ids(
    "attention_mask",
    Q.pad("list_transform(ids, lambda x: 1)", 300),
    lambda c: A.attention_mask(c, 300),
)
_on_ids("shift_right", "list_concat([2], ids[1:len(ids) - 1])", A.shift_right)
_on_ids("target_tail", "ids[2:]", A.target_tail)
_on_ids("ignore_mask", "list_transform(ids, lambda x: CASE WHEN x = 2 THEN -100 ELSE x END)", lambda c: A.ignore_mask(c, 2))
_on_ids(
    "unmask",
    "list_transform(ids, lambda x: CASE WHEN x = 2 THEN 0 ELSE x END)",
    lambda c: A.unmask(A.ignore_mask(c, 2), 0),
)
_on_ids("padding_mask", "list_transform(ids, lambda x: x = 2)", lambda c: A.padding_mask(c, 2))


@query(
    f"""WITH {LENGTHS}, y AS (SELECT id, ids AS a, ids[1:50] AS b FROM x),
        z AS (SELECT id, a, b, least(len(a), len(b)) AS n FROM y)
        SELECT id, {Q.ids_text('a[1:n]')} AS a, {Q.ids_text('b[1:n]')} AS b FROM z"""
)
def align_lengths(spark, sf_dir):
    a, b = A.align_lengths(F.col("ids"), F.slice("ids", 1, 50))
    return lengths(spark, sf_dir).select("id", ids_text(a).alias("a"), ids_text(b).alias("b"))


# --- pairs ----------------------------------------------------------------

_TEXTS = f"SELECT {Q.words('source')} AS w FROM train UNION ALL SELECT {Q.words('target')} FROM train"


def _pair_sql(chosen: str, max_src: int, max_tgt: int, padded: bool) -> str:
    src, tgt = "list_append(s.ids, 3)", "list_append(t.ids, 3)"
    mask = f"list_transform({src}, lambda x: 1)"
    if padded:
        src, tgt, mask = Q.pad(src, max_src), Q.pad(tgt, max_tgt), Q.pad(mask, max_src)
    return f"""WITH {Q.PAIRS}, {chosen},
      train AS (SELECT * FROM chosen WHERE split = 'train'), {Q.vocab(_TEXTS)},
      {Q.encoded('src', 'chosen', 'source', max_src - 1)}, {Q.encoded('tgt', 'chosen', 'target', max_tgt - 1)}
      SELECT c.id, c.split, {Q.ids_text(src)} AS input_ids, {Q.ids_text(mask)} AS attention_mask,
             {Q.ids_text(tgt)} AS labels
      FROM chosen c JOIN src s USING (id) JOIN tgt t USING (id)"""


_CLEAN = f"{Q.normalize('source')} AS source, {Q.normalize('target')} AS target"
_ALL = f"chosen AS (SELECT id, split, {_CLEAN} FROM pairs)"
_QUARTER = f"""ranked AS (
      SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || id), id) AS rn,
             count(*) OVER (PARTITION BY split) AS total FROM pairs WHERE split <> 'test'),
      chosen AS (SELECT id, CASE split WHEN 'train' THEN 'train' ELSE 'val' END AS split, {_CLEAN} FROM ranked
                 WHERE rn <= least(greatest(trunc(total * 0.25::DOUBLE), 1), total))"""


def _as_text(encoded):
    columns = ("input_ids", "attention_mask", "labels")
    return encoded.select("id", "split", *[ids_text(c).alias(c) for c in columns])


def encoded_pairs(spark, sf_dir, opts: PrepOptions):
    """All pairs, encoded with the vocabulary of the training rows."""
    both = write_shared(E.select_pair(pairs(spark, sf_dir)), "pairs", "zstd")  # read for the vocabulary and again to be encoded
    texts = [normalize(F.col("source")), normalize(F.col("target"))]
    vocab = V.build_vocab(both.filter("split = 'train'"), texts)
    encoded = E.encode_pairs(both, vocab, opts)
    remove_copies(both, but=encoded)
    return encoded


ALL_PADDED = _pair_sql(_ALL, 128, 128, True)


@query(ALL_PADDED)
def encode_pairs(spark, sf_dir):
    return _as_text(encoded_pairs(spark, sf_dir, PrepOptions(normalize=True)))


@query(_pair_sql(_ALL, 24, 16, False))
def encode_pairs_variable_length(spark, sf_dir):
    opts = PrepOptions(normalize=True, padding=None, max_source_length=24, max_target_length=16)
    return _as_text(encoded_pairs(spark, sf_dir, opts))


QUARTER_PADDED = _pair_sql(_QUARTER, 128, 128, True)


@query(QUARTER_PADDED)
def prepare_corpus(spark, sf_dir):
    """Flagship: subset of both splits, normalised, vocabulary, encoded, padded, masked."""
    return _as_text(prepare(pairs(spark, sf_dir), PrepOptions(normalize=True, dataset_fraction=0.25))[0])


# --- decode ---------------------------------------------------------------

_DECODED = f"""WITH {DOCS}, {DOC_VOCAB}, w AS (SELECT id, {Q.words('text')} AS w FROM docs),
      p AS (SELECT id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM w),
      k AS (SELECT id, string_agg(token, ' ' ORDER BY pos) AS text FROM p JOIN vocab USING (token)
            WHERE token_id > 3 GROUP BY id)
      SELECT id, coalesce(k.text, '') AS text FROM docs LEFT JOIN k USING (id)"""


@query(_DECODED)
def decode(spark, sf_dir):
    docs, vocab = clean_and_vocab(spark, sf_dir, written=True)
    return E.decode(E.encode(docs, "text", vocab).select("id", "ids"), "ids", vocab).select("id", "text")


@query(_DECODED)
def decode_by_join(spark, sf_dir):
    """The same as for a vocabulary that is too large to broadcast."""
    docs, vocab = clean_and_vocab(spark, sf_dir, written=True)
    coded = E.encode(docs, "text", vocab, keep=["id"]).select("id", "ids")
    remove_copies(docs, but=coded)
    text = E.decode(coded, "ids", vocab, keep=["id"], max_rows=0, hot_elements=100).select("id", "text")
    remove_copies(docs, coded, but=text)  # the ids are written anew by now
    return text


@query(
    f"""WITH {DOCS}, {DOC_VOCAB}, w AS (SELECT id, {Q.words('text')} AS w FROM docs),
      p AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM w),
      l AS (SELECT id, pos, coalesce(token_id, 1) AS token_id, coalesce(token, '<unk>') AS token
            FROM p LEFT JOIN vocab ON token = word
            UNION ALL SELECT id, len(w), 3, '<eos>' FROM w)
      SELECT id, pos::BIGINT AS pos, token_id::BIGINT AS token_id, token FROM l"""
)
def token_labels(spark, sf_dir):
    docs, vocab = clean_and_vocab(spark, sf_dir, written=True)
    ids = E.vocab_lookup(vocab)
    encoded = E.encode(docs, "text", ids, keep=["id"]).select("id", "ids")
    coded = write_shared(encoded, "coded", "zstd")  # so that no task runs the workers of both lookups
    remove_copies(docs, encoded)
    labels = E.token_labels(coded, "ids", ids.reversed())
    remove_copies(coded, but=labels)
    return labels.select("id", long("pos").alias("pos"), long("token_id").alias("token_id"), "token")
