"""String functions and word counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.registry import documents, long, query
from catalog.corpus import pairs
from seqprep.functions import text as X
from seqprep.operators import vocab as V
from seqprep.operators.encode import select_pair

# Spaces on both sides and doubled marks, so that every step has work to do.
_RAW = "chr(10) || ' ' || replace(replace(text, '.', '..  '), ',', ',,?!!') || chr(10)"
_SPARK_RAW = "concat('\\n ', replace(replace(text, '.', '..  '), ',', ',,?!!'), '\\n')"


def _raw(spark, sf_dir):
    return documents(spark, sf_dir).select("id", F.expr(_SPARK_RAW).alias("text"))


def _step(name: str, sql: str, fn) -> None:
    def run(spark, sf_dir):
        return _raw(spark, sf_dir).select("id", fn(F.col("text")).alias("text"))

    run.__name__ = name
    query(f"SELECT doc_id AS id, {sql} AS text FROM documents")(run)


_step("strip", Q.strip(_RAW), X.strip)
_step("strip_special", Q.strip_special(_RAW), X.strip_special)
_step("collapse_spaces", Q.collapse(_RAW, " "), X.collapse_spaces)
_step("collapse_exclamation", Q.collapse(_RAW, "!"), lambda t: X.collapse_punct(t, "!"))
_step("collapse_comma", Q.collapse(_RAW, ","), lambda t: X.collapse_punct(t, ","))
_step("collapse_question", Q.collapse(_RAW, "?"), lambda t: X.collapse_punct(t, "?"))
_step("lower_case", f"lower({_RAW})", F.lower)
_step("normalize", Q.normalize(_RAW), X.normalize)
_step("normalize_final_trim", Q.strip(Q.normalize(_RAW)), lambda t: X.normalize(t, final_trim=True))
_step("words", Q.ids_text(Q.words(_RAW)), lambda t: F.array_join(X.words(t), " "))
_step("tok13a", Q.ids_text(Q.tok13a(_RAW)), lambda t: F.array_join(X.tok13a(t), " "))


@query(f"SELECT doc_id AS id, len({Q.words('text')})::BIGINT AS n_words FROM documents")
def word_count(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select("id", long(X.word_count(F.col("text"))).alias("n_words"))


@query(
    f"""WITH {Q.PAIRS}, texts AS (SELECT {Q.words(Q.normalize('source'))} AS w FROM pairs
          UNION ALL SELECT {Q.words(Q.normalize('target'))} FROM pairs)
    SELECT token, count(*) AS freq FROM (SELECT unnest(w) AS token FROM texts) GROUP BY token"""
)
def words_of_pairs(spark, sf_dir):
    """How often does each normalised word occur in the paired corpus?"""
    both = select_pair(pairs(spark, sf_dir))
    return V.word_counts(both, [X.normalize(F.col("source")), X.normalize(F.col("target"))])


_DOC_WORDS = f"SELECT {Q.words(Q.normalize('text'))} AS w FROM documents"


@query(f"WITH {Q.vocab(_DOC_WORDS)} SELECT token, token_id::BIGINT AS token_id, freq::BIGINT AS freq FROM vocab")
def build_vocab(spark, sf_dir):
    vocab = V.build_vocab(documents(spark, sf_dir), [X.normalize(F.col("text"))])
    return vocab.withColumn("token_id", long("token_id"))


@query(f"WITH {Q.vocab(_DOC_WORDS, 5000)} SELECT token, token_id::BIGINT AS token_id, freq::BIGINT AS freq FROM vocab")
def build_vocab_capped(spark, sf_dir):
    vocab = V.build_vocab(documents(spark, sf_dir), [X.normalize(F.col("text"))], max_size=5000)
    return vocab.withColumn("token_id", long("token_id"))


@query(
    f"""WITH {Q.vocab(_DOC_WORDS)} SELECT token, token_id::BIGINT AS token_id, freq::BIGINT AS freq
        FROM vocab WHERE freq >= 2 OR token_id < 4"""
)
def build_vocab_min_count(spark, sf_dir):
    vocab = V.build_vocab(documents(spark, sf_dir), [X.normalize(F.col("text"))], min_count=2)
    return vocab.withColumn("token_id", long("token_id"))


@query(f"WITH {Q.vocab(_DOC_WORDS)} SELECT count(*) AS vocab_size FROM vocab")
def vocab_size(spark, sf_dir):
    vocab = V.build_vocab(documents(spark, sf_dir), [X.normalize(F.col("text"))])
    return vocab.agg(F.count("*").alias("vocab_size"))


@query(
    f"""WITH {Q.vocab(_DOC_WORDS)}
        SELECT lang, count(*) AS n_docs, (SELECT token_id FROM vocab WHERE token = '<bos>')::BIGINT AS bos_id
        FROM documents GROUP BY lang"""
)
def resolve_bos(spark, sf_dir):
    docs = documents(spark, sf_dir)
    bos = V.resolve_bos(V.build_vocab(docs, [X.normalize(F.col("text"))]))
    return docs.groupBy("lang").agg(F.count("*").alias("n_docs")).withColumn("bos_id", F.lit(bos).cast("long"))


@query(
    f"""WITH {Q.vocab(_DOC_WORDS)}, firsts AS (
          SELECT doc_id AS id, ({Q.words(Q.normalize('text'))})[1] AS token FROM documents)
        SELECT id, token_id::BIGINT AS token_id FROM firsts JOIN vocab USING (token)"""
)
def first_token_id(spark, sf_dir):
    docs = documents(spark, sf_dir).select("id", X.normalize(F.col("text")).alias("text"))
    found = V.first_token_id(docs, "text", V.build_vocab(docs, ["text"]))
    return found.select("id", long("token_id").alias("token_id"))
