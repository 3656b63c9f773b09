"""Embedding and parameter tables, sample report, metric monitor."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.encoding import DOC_VOCAB, DOCS, clean_and_vocab
from catalog.registry import documents, long, query, table
from seqprep.operators import analysis as N
from seqprep.operators.encode import encode, token_labels
from seqprep.operators.sampling import head_rows
from seqprep.operators.vocab import first_token_id
from seqprep.plans.evaluate import encoded_report
from seqprep.session import shared_dir
from seqprep.sources.tables import read_parameters, read_vectors, sample_report as report
from seqprep.streaming.monitor import monitor


def vectors(spark, sf_dir):
    return read_vectors(spark, f"{sf_dir}/embeddings.parquet", "vec_id")


def shifted(spark, sf_dir):
    """Target table: token n has the vector of n + 1, so the last one is missing."""
    return vectors(spark, sf_dir).withColumn("token_id", F.col("token_id") - 1)


_COSINE = "round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6)"


@query(f"SELECT a.vec_id AS token_id, {_COSINE} AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def embedding_similarity(spark, sf_dir):
    pairs = N.embedding_similarity(vectors(spark, sf_dir), shifted(spark, sf_dir))
    return pairs.withColumn("similarity", F.round("similarity", 6))


@query(
    f"""WITH {DOCS}, {DOC_VOCAB},
        probes AS (SELECT DISTINCT token_id FROM (SELECT ({Q.words('text')})[1] AS token FROM docs) JOIN vocab USING (token))
        SELECT token_id::BIGINT AS token_id, {_COSINE} AS similarity
        FROM probes JOIN embeddings a ON a.vec_id = token_id JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def embedding_similarity_of_probe_words(spark, sf_dir):
    """Probe words: the first word of every document; ids beyond the tables drop out."""
    docs, vocab = clean_and_vocab(spark, sf_dir)
    probes = first_token_id(docs, "text", vocab).select(long("token_id").alias("token_id")).distinct()
    pairs = N.embedding_similarity(vectors(spark, sf_dir), shifted(spark, sf_dir), probes)
    return pairs.withColumn("similarity", F.round("similarity", 6))


_CLOSE = """
  WITH x AS (SELECT embedding AS a, list_transform(embedding, lambda x: (x * {f}::FLOAT)::FLOAT) AS b FROM embeddings),
  y AS (SELECT unnest(a)::DOUBLE AS a, unnest(b)::DOUBLE AS b FROM x)
  SELECT bool_and(abs(a - b) <= 1e-8 + 1e-5 * abs(b)) AS is_shared FROM y"""


def _close(name: str, factor: str) -> None:
    def run(spark, sf_dir):
        scaled = F.transform("embedding", lambda x: x * F.lit(factor).cast("float"))
        return N.tables_close(vectors(spark, sf_dir), vectors(spark, sf_dir).withColumn("embedding", scaled))

    run.__name__ = name
    query(_CLOSE.format(f=factor))(run)


_close("tables_close", "1.000001")
_close("tables_not_close", "1.0001")


def parameters(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("layer_"), F.col("label").cast("string")).alias("tensor"),
        (F.col("label") != 0).alias("trainable"),
        F.col("embedding").alias("values"),
    )


@query(
    """SELECT 'layer_' || label AS tensor, label <> 0 AS trainable, count(*) AS n_rows, sum(len(embedding))::BIGINT AS n_values,
              round(sum(list_sum(embedding::DOUBLE[])), 4) AS total FROM embeddings GROUP BY label"""
)
def read_parameter_table(spark, sf_dir):
    """Tensors in chunk rows, written as matrices of one row and read back."""
    path = f"{shared_dir(spark)}/parameters-{uuid.uuid4().hex}"
    parameters(spark, sf_dir).withColumn("values", F.array("values")).write.parquet(path)
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return (
        read_parameters(spark, path)
        .groupBy("tensor", "trainable")
        .agg(F.count("*").alias("n_rows"), F.sum(F.size("values")).alias("n_values"), F.round(F.sum(total), 4).alias("total"))
    )


@query(
    """SELECT sum(len(embedding))::BIGINT AS total_params,
              (sum(len(embedding)) FILTER (WHERE label <> 0))::BIGINT AS trainable_params FROM embeddings"""
)
def param_counts(spark, sf_dir):
    return N.param_counts(parameters(spark, sf_dir))


@query(
    """SELECT tensor, round(avg(abs(v)), 6) AS mean_abs, round(max(abs(v)), 6) AS max_abs FROM (
         SELECT 'layer_' || label AS tensor, unnest(embedding)::DOUBLE AS v FROM embeddings WHERE label <> 0)
       GROUP BY tensor"""
)
def param_magnitudes(spark, sf_dir):
    sizes = N.param_magnitudes(parameters(spark, sf_dir))
    return sizes.select("tensor", F.round("mean_abs", 6).alias("mean_abs"), F.round("max_abs", 6).alias("max_abs"))


# Two principal axes: a matrix squared again and again turns into its largest
# axis; without that one's share it turns into the next.
_SQUARED = "list_transform(m, lambda a: list_transform(m, lambda b: list_dot_product(a, b)))"
_LARGEST = "list_max(list_transform({0}, lambda r: list_max(list_transform(r, lambda x: abs(x)))))"


def _axis(name: str, start: str) -> str:
    """CTEs for the largest axis of the matrix m of CTE ``start``: ``name`` has its vector v and its value e."""
    scaled = "list_transform({0}, lambda r: list_transform(r, lambda x: x / {1}))"
    return f"""
  {name}_powers AS (
    SELECT 0 AS k, {scaled.format('m', 'big')} AS m FROM (SELECT m, {_LARGEST.format('m')} AS big FROM {start})
    UNION ALL
    SELECT k, {scaled.format('m', 'big')} FROM (
      SELECT k, m, {_LARGEST.format('m')} AS big FROM (SELECT k + 1 AS k, {_SQUARED} AS m FROM {name}_powers WHERE k < 24))),
  {name}_column AS (SELECT unnest(m) AS r FROM {name}_powers WHERE k = 24),
  {name}_longest AS (SELECT r FROM {name}_column ORDER BY list_dot_product(r, r) DESC LIMIT 1),
  {name}_unit AS (
    SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))
             * sign(r[list_position(list_transform(r, lambda y: abs(y)), list_max(list_transform(r, lambda y: abs(y))))])) AS v
    FROM {name}_longest),
  {name} AS (SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS e FROM {name}_unit, {start})"""


PRINCIPAL = f"""
  entries AS (SELECT vec_id, unnest(embedding::DOUBLE[]) AS e, generate_subscripts(embedding, 1) AS j FROM embeddings),
  centred AS (SELECT vec_id, j, e - avg(e) OVER (PARTITION BY j) AS e FROM entries),
  cells AS (SELECT a.j AS i, b.j AS j, sum(a.e * b.e) AS s FROM centred a JOIN centred b USING (vec_id) GROUP BY a.j, b.j),
  spread AS (SELECT sum(s) AS total FROM cells WHERE i = j),
  covariance AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(s ORDER BY j) AS r FROM cells GROUP BY i)),
  {_axis('first_axis', 'covariance')},
  rest AS (
    SELECT list_transform(range(1, len(v) + 1), lambda i: list_transform(range(1, len(v) + 1), lambda j: m[i][j] - e * v[i] * v[j])) AS m
    FROM covariance, first_axis),
  {_axis('second_axis', 'rest')},
  points AS (
    SELECT vec_id, round(list_dot_product(c, a.v), 4) + 0 AS pc1, round(list_dot_product(c, b.v), 4) + 0 AS pc2
    FROM (SELECT vec_id, list(e ORDER BY j) AS c FROM centred GROUP BY vec_id), first_axis a, second_axis b)"""


def _rounded(points):
    return points.withColumns({c: F.round(c, 4) + F.lit(0.0) for c in ("pc1", "pc2")})


@query(f"WITH RECURSIVE {PRINCIPAL} SELECT vec_id AS token_id, pc1, pc2 FROM points")
def pca_project(spark, sf_dir):
    return _rounded(N.pca_project(vectors(spark, sf_dir), 2))


@query(
    f"""WITH RECURSIVE {DOCS}, {PRINCIPAL},
        w AS (SELECT id, {Q.words('text')} AS w FROM docs),
        l AS (SELECT id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM w)
        SELECT id, pos::INT AS pos, pc1, pc2, token FROM points JOIN l ON id = vec_id // 10 AND pos = vec_id % 10"""
)
def labelled_projection(spark, sf_dir):
    """Vectors laid out as (text, position), labelled with the token there; only texts with a vector are encoded."""
    docs, vocab = clean_and_vocab(spark, sf_dir)
    points = table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 10).alias("id"), (F.col("vec_id") % 10).cast("int").alias("pos"), "embedding"
    )
    wanted = docs.join(points.select("id").distinct(), "id", "left_semi")
    labels = token_labels(encode(wanted, "text", vocab, add_special=False), "ids", vocab).select("id", "pos", "token")
    return _rounded(N.labelled_projection(points, labels))


@query(
    f"""WITH RECURSIVE {PRINCIPAL}
        SELECT 1::INT AS component, round(e / total, 6) AS ratio FROM first_axis, spread
        UNION ALL SELECT 2, round(e / total, 6) FROM second_axis, spread"""
)
def explained_variance(spark, sf_dir):
    return N.explained_variance(vectors(spark, sf_dir), 2).withColumn("ratio", F.round("ratio", 6))


@query(
    """SELECT d.doc_id AS id, d.text AS source, d.lang AS reference, l.quality::BIGINT AS prediction
       FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 5) d LEFT JOIN labels l USING (doc_id)"""
)
def sample_report(spark, sf_dir):
    docs = documents(spark, sf_dir)
    pred = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), long("quality").alias("prediction"))
    source, reference = docs.select("id", F.col("text").alias("source")), docs.select("id", F.col("lang").alias("reference"))
    return report(source, reference, pred)


@query(
    f"""WITH {DOCS}, {DOC_VOCAB}, five AS (SELECT * FROM docs ORDER BY id LIMIT 5),
        w AS (SELECT id, {Q.words('text')} AS w FROM five),
        p AS (SELECT id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM w),
        k AS (SELECT id, string_agg(token, ' ' ORDER BY pos) AS text FROM p JOIN vocab USING (token)
              WHERE token_id > 3 GROUP BY id)
        SELECT id, coalesce(text, '') AS source, coalesce(text, '') AS reference, lang AS prediction
        FROM five f LEFT JOIN (SELECT id AS kid, text AS ktext FROM k) ON kid = id
        JOIN (SELECT doc_id, lang FROM documents) ON doc_id = id"""
    .replace("coalesce(text, '')", "coalesce(ktext, '')")
)
def encoded_sample_report(spark, sf_dir):
    """The vocabulary is that of all documents; only those reported are encoded."""
    docs, vocab = clean_and_vocab(spark, sf_dir)
    coded = encode(head_rows(docs, 5), "text", vocab, out="input_ids").withColumn("labels", F.col("input_ids"))
    pred = documents(spark, sf_dir).select("id", F.col("lang").alias("prediction"))
    return encoded_report(coded, pred, vocab)


@query(
    """SELECT (floor(epoch(ts) / 600) * 600)::BIGINT AS window_start, event_type AS run,
              round(avg(value), 8) AS mean_value, count(value) AS n_values FROM events GROUP BY 1, 2"""
)
def monitor_windows(spark, sf_dir):
    """The batch twin of the streaming monitor."""
    windows = monitor(table(spark, sf_dir, "events"), run="event_type")
    return windows.select(
        F.unix_timestamp("window_start").alias("window_start"),
        "run",
        F.round("mean_value", 8).alias("mean_value"),
        "n_values",
    )
