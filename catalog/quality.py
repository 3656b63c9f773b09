"""Translation quality: BLEU, lengths, accuracy, loss."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.encoding import DOC_VOCAB, DOCS, clean_and_vocab
from catalog.registry import documents, long, query, table
from seqprep.functions import arrays as A
from seqprep.functions.text import normalize, words
from seqprep.operators import metrics as M
from seqprep.operators.guards import has_nan as nan_check
from seqprep.plans.evaluate import evaluate_scores as score_report, evaluation_report as full_report

# The reference is the normalised text; the prediction lacks every seventh word
# and is blank for every fiftieth document.
_W = Q.words(Q.normalize("text"))
_DROP = "list_filter({w}, lambda x, i: (i - 1) % 7 <> 3)"
_TEXTS = f"""texts AS (
    SELECT doc_id AS id, lang, {_W} AS w FROM documents),
  predicted AS (SELECT id, lang, array_to_string(w, ' ') AS reference,
    CASE WHEN id % 50 = 0 THEN '  ' ELSE array_to_string({_DROP.format(w='w')}, ' ') END AS prediction FROM texts),
  valid AS (SELECT * FROM predicted WHERE length({Q.strip('prediction')}) > 0 AND length({Q.strip('reference')}) > 0)"""
_PAIR = f"pair AS (SELECT id, lang, {Q.tok13a(Q.strip('prediction'))} AS h, {Q.tok13a(Q.strip('reference'))} AS r FROM valid)"
_PLAIN = f"pair AS (SELECT id, lang, {Q.words('prediction')} AS h, {Q.words('reference')} AS r FROM valid)"


def predictions(spark, sf_dir):
    w = words(normalize(F.col("text")))
    kept = F.array_join(F.filter(w, lambda x, i: i % 7 != 3), " ")
    return documents(spark, sf_dir).select(
        "id",
        "lang",
        F.when(F.col("id") % 50 == 0, "  ").otherwise(kept).alias("prediction"),
        F.array(F.array_join(w, " ")).alias("references"),
    )


@query(
    f"""WITH t AS MATERIALIZED (SELECT doc_id AS id, {Q.words('text')} AS w FROM documents),
        g AS (SELECT id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM t))
        SELECT id, coalesce(string_agg(g, '|' ORDER BY i), '') AS grams FROM t LEFT JOIN g USING (id) GROUP BY id"""
)
def ngrams(spark, sf_dir):
    grams = A.ngrams(F.col("w"), 3)
    split = documents(spark, sf_dir).select("id", words(F.col("text")).alias("w"))
    return split.select("id", F.array_join(grams, "|").alias("grams"))


@query(f"WITH {_TEXTS}, {_PLAIN}, {Q.ngram_sums('h', 'r')} SELECT * FROM sums")
def ngram_matches(spark, sf_dir):
    return M.ngram_matches(M.drop_empty_pairs(predictions(spark, sf_dir)), tokenize=words)


@query(f"WITH {_TEXTS}, {_PAIR}, {Q.ngram_sums('h', 'r')} SELECT * FROM sums")
def ngram_matches_13a(spark, sf_dir):
    return M.ngram_matches(M.drop_empty_pairs(predictions(spark, sf_dir)))


_PER_REF = " UNION ALL ".join(
    f"SELECT id, {side} AS side, {n} AS n, unnest({Q.ngrams(col, n)}) AS g FROM pair"
    for n in (1, 2, 3, 4)
    for side, col in ((0, "h"), (1, "r"), (2, "q"))
)


@query(
    f"""WITH t AS (SELECT doc_id AS id, {_W} AS w FROM documents),
      pair AS (SELECT id, {_DROP.format(w='w')} AS h, list_filter(w, lambda x, i: (i - 1) % 5 <> 2) AS r,
                      list_filter(w, lambda x, i: (i - 1) % 3 <> 1) AS q FROM t),
      grams AS ({_PER_REF}),
      c AS (SELECT id, n, g, count(*) FILTER (WHERE side = 0) AS h,
                   greatest(count(*) FILTER (WHERE side = 1), count(*) FILTER (WHERE side = 2)) AS r
            FROM grams GROUP BY id, n, g)
      SELECT {', '.join(f'(sum(least(h, r)) FILTER (WHERE n = {n}))::BIGINT AS m{n}' for n in (1, 2, 3, 4))},
             (SELECT sum(least(len(r), len(q)))::BIGINT FROM pair) AS ref_len FROM c"""
)
def ngram_matches_several_references(spark, sf_dir):
    w = F.col("w")
    split = documents(spark, sf_dir).select("id", words(normalize(F.col("text"))).alias("w"))
    texts = split.select(
        "id",
        F.array_join(F.filter(w, lambda x, i: i % 7 != 3), " ").alias("prediction"),
        F.array(
            F.array_join(F.filter(w, lambda x, i: i % 5 != 2), " "),
            F.array_join(F.filter(w, lambda x, i: i % 3 != 1), " "),
        ).alias("references"),
    )
    return M.ngram_matches(texts, tokenize=words).select("m1", "m2", "m3", "m4", "ref_len")


@query(
    f"""WITH {_TEXTS}, {_PLAIN}, {Q.ngram_sums('h', 'r')}
        SELECT round(m1 / t1, 4) AS p1, round(m2 / t2, 4) AS p2, round(m3 / t3, 4) AS p3, round(m4 / t4, 4) AS p4 FROM sums"""
)
def precisions(spark, sf_dir):
    sums = M.ngram_matches(M.drop_empty_pairs(predictions(spark, sf_dir)), tokenize=words)
    return M.precisions(sums).select(*[F.round(f"p{n}", 4).alias(f"p{n}") for n in (1, 2, 3, 4)])


@query(f"WITH {_TEXTS}, {_PLAIN}, {Q.ngram_sums('h', 'r')} SELECT hyp_len, ref_len, round({Q.BREVITY}, 4) AS bp FROM sums")
def brevity_penalty(spark, sf_dir):
    sums = M.ngram_matches(M.drop_empty_pairs(predictions(spark, sf_dir)), tokenize=words)
    return M.brevity_penalty(sums).select("hyp_len", "ref_len", F.round("bp", 4).alias("bp"))


@query(
    f"""WITH {_TEXTS}, {_PAIR}, {Q.ngram_sums('h', 'r')}
        SELECT round({Q.BLEU}, 4) AS bleu, round({Q.BREVITY}, 4) AS bp FROM sums"""
)
def corpus_bleu(spark, sf_dir):
    return M.corpus_bleu(predictions(spark, sf_dir))


@query(
    f"""WITH {_TEXTS}, {_PAIR}, {Q.ngram_sums('h', 'r', 'lang')}
        SELECT lang, round({Q.BLEU}, 4) AS bleu, round({Q.BREVITY}, 4) AS bp FROM sums"""
)
def corpus_bleu_by_language(spark, sf_dir):
    return M.corpus_bleu(predictions(spark, sf_dir), by=["lang"])


_GEN_LEN = f"(SELECT round(avg(len({Q.words('prediction')})), 4) FROM predicted)"


@query(f"WITH {_TEXTS} SELECT {_GEN_LEN} AS gen_len")
def mean_gen_len(spark, sf_dir):
    return M.mean_gen_len(predictions(spark, sf_dir))


@query(
    f"""WITH {_TEXTS}, {_PAIR}, {Q.ngram_sums('h', 'r')}
        SELECT round({Q.BLEU}, 4) AS bleu, {_GEN_LEN} AS gen_len, round({Q.BREVITY}, 4) AS bp,
               (SELECT count(*) FROM predicted) AS n_rows FROM sums"""
)
def compute_metrics(spark, sf_dir):
    return M.compute_metrics(predictions(spark, sf_dir), extra=[F.count("*").alias("n_rows")])


@query(f"WITH {_TEXTS} SELECT id, {Q.strip('prediction')} AS prediction, {Q.strip('reference')} AS reference FROM valid")
def drop_empty_pairs(spark, sf_dir):
    kept = M.drop_empty_pairs(predictions(spark, sf_dir))
    return kept.select("id", "prediction", F.col("references")[0].alias("reference"))


@query("SELECT d.doc_id AS id, d.text AS prediction, l.quality::BIGINT AS quality FROM documents d JOIN labels l USING (doc_id)")
def align_predictions(spark, sf_dir):
    pred = documents(spark, sf_dir).select("id", F.col("text").alias("prediction"))
    ref = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), long("quality").alias("quality"))
    return M.align_predictions(pred, ref)


# --- score tables ---------------------------------------------------------

_SCORES = """scores AS (
    SELECT vec_id // 10 AS id, vec_id % 10 AS pos, embedding AS logits, label AS target,
           list_position(embedding, list_max(embedding)) - 1 AS pred FROM embeddings)"""


def scores(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 10).alias("id"),
        (F.col("vec_id") % 10).cast("int").alias("pos"),
        F.col("embedding").alias("logits"),
        F.col("label").alias("target"),
    )


@query(f"WITH {_SCORES} SELECT id, pos::BIGINT AS pos, pred::BIGINT AS pred FROM scores")
def argmax(spark, sf_dir):
    return scores(spark, sf_dir).select("id", long("pos").alias("pos"), long(A.argmax(F.col("logits"))).alias("pred"))


@query(f"WITH {_SCORES} SELECT round(avg((pred % 10 = target)::INT), 4) AS accuracy FROM scores WHERE target <> 0")
def token_accuracy(spark, sf_dir):
    """The best id modulo 10 against the target, so that some are right."""
    best = scores(spark, sf_dir).withColumn("pred", A.argmax(F.col("logits")) % 10)
    return M.token_accuracy(best).withColumn("accuracy", F.round("accuracy", 4))


_LOSS = "ln(list_sum(list_transform(logits::DOUBLE[], lambda x: exp(x)))) - logits[target + 1]::DOUBLE"


@query(f"WITH {_SCORES} SELECT round(avg({_LOSS}), 6) AS loss FROM scores WHERE target NOT IN (0, -100)")
def masked_xent(spark, sf_dir):
    return M.masked_xent(scores(spark, sf_dir)).withColumn("loss", F.round("loss", 6))


@query(f"WITH {_SCORES} SELECT round(avg({_LOSS}), 6) AS loss FROM scores")
def unmasked_xent(spark, sf_dir):
    return M.masked_xent(scores(spark, sf_dir), ignore=()).withColumn("loss", F.round("loss", 6))


@query(
    f"""WITH {_SCORES}, m AS (SELECT id, avg(CASE WHEN id % 3 = 0 THEN 'NaN'::DOUBLE ELSE {_LOSS} END) AS v FROM scores GROUP BY id)
        SELECT id, CASE WHEN isnan(v) THEN 0 ELSE round(v, 4) END AS v FROM m"""
)
def round_metric(spark, sf_dir):
    loss = A.log_sum_exp(F.col("logits")) - F.get("logits", F.col("target")).cast("double")
    some_nan = F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(loss)
    return scores(spark, sf_dir).groupBy("id").agg(M.round_metric(F.avg(some_nan)).alias("v"))


@query(
    """SELECT (SELECT bool_or(len(list_filter(embedding, lambda x: isnan(x))) > 0) FROM embeddings) AS clean,
              (SELECT bool_or(vec_id % 97 = 0) FROM embeddings) AS poisoned"""
)
def has_nan(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    broken = F.transform(
        "embedding", lambda x, i: F.when((F.col("vec_id") % 97 == 0) & (i == 5), F.lit(float("nan"))).otherwise(x)
    )
    poisoned = nan_check(vectors.withColumn("embedding", broken), "embedding", "poisoned")
    return nan_check(vectors, "embedding", "clean").withColumn("poisoned", poisoned.scalar())


_TOKENS = f"""{DOCS}, {DOC_VOCAB}, {_SCORES},
  texts AS (SELECT s.id, coalesce(string_agg(p.token, ' ' ORDER BY s.pos) FILTER (WHERE p.token_id > 3), '') AS prediction,
                   coalesce(string_agg(t.token, ' ' ORDER BY s.pos) FILTER (WHERE t.token_id > 3), '') AS reference
            FROM scores s LEFT JOIN vocab p ON p.token_id = s.pred LEFT JOIN vocab t ON t.token_id = s.target GROUP BY s.id)"""


@query(f"WITH {_TOKENS} SELECT id, prediction, reference FROM texts")
def decode_scores(spark, sf_dir):
    _, vocab = clean_and_vocab(spark, sf_dir)
    texts = M.decode_scores(scores(spark, sf_dir), vocab)
    return texts.select("id", "prediction", F.col("references")[0].alias("reference"))


@query(
    f"""WITH {_TOKENS},
        pair AS (SELECT id, {Q.tok13a('prediction')} AS h, {Q.tok13a('reference')} AS r FROM texts
                 WHERE prediction <> '' AND reference <> ''), {Q.ngram_sums('h', 'r')}
        SELECT round({Q.BLEU}, 4) AS bleu, (SELECT round(avg(len({Q.words('prediction')})), 4) FROM texts) AS gen_len,
               round({Q.BREVITY}, 4) AS bp FROM sums"""
)
def evaluate_scores(spark, sf_dir):
    _, vocab = clean_and_vocab(spark, sf_dir)
    return score_report(scores(spark, sf_dir), vocab)


@query("SELECT CASE WHEN count(*) > 0 THEN 0.0::DOUBLE END AS bleu, 0.0::DOUBLE AS gen_len, 0.0::DOUBLE AS bp FROM embeddings")
def evaluate_scores_with_nan(spark, sf_dir):
    _, vocab = clean_and_vocab(spark, sf_dir)
    broken = F.transform(
        "logits", lambda x, i: F.when((F.col("id") % 7 == 0) & (i == 5), F.lit(float("nan"))).otherwise(x)
    )
    return score_report(scores(spark, sf_dir).withColumn("logits", broken), vocab)


_ZEROS = "CASE WHEN count(*) > 0 THEN 0.0::DOUBLE END AS bleu, 0.0::DOUBLE AS gen_len, 0.0::DOUBLE AS bp"


@query(f"SELECT {_ZEROS} FROM embeddings")
def evaluate_scores_with_null(spark, sf_dir):
    """A missing score array or score makes the scores as unusable as a NaN."""
    _, vocab = clean_and_vocab(spark, sf_dir)
    holed = F.transform("logits", lambda x, i: F.when((F.col("id") % 7 == 0) & (i == 5), F.lit(None)).otherwise(x))
    missing = F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(holed)
    return score_report(scores(spark, sf_dir).withColumn("logits", missing), vocab)


@query(
    f"""WITH {_TOKENS},
        pair AS (SELECT id, {Q.tok13a('prediction')} AS h, {Q.tok13a('reference')} AS r FROM texts
                 WHERE prediction <> '' AND reference <> ''), {Q.ngram_sums('h', 'r')}
        SELECT round({Q.BLEU}, 4) AS bleu, (SELECT round(avg(len({Q.words('prediction')})), 4) FROM texts) AS gen_len,
               round({Q.BREVITY}, 4) AS bp,
               (SELECT round(avg(ln(list_sum(list_transform(embedding::DOUBLE[], lambda x: exp(x)))) - embedding[label + 1]::DOUBLE), 6)
                FROM embeddings WHERE label <> 0) AS eval_loss
        FROM sums"""
)
def evaluation_report(spark, sf_dir):
    """Text metrics and loss together."""
    _, vocab = clean_and_vocab(spark, sf_dir)
    return full_report(scores(spark, sf_dir), vocab).withColumn("eval_loss", F.round("eval_loss", 6))
