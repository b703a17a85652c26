"""Queries on retrieval lanes, fusion and ordered selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import words
from quarrymill.operators import retrieval
from quarrymill.plans.catalog import query
from quarrymill.session import table


def passages(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, text): the training documents as what is searched."""
    return table(spark, root, "documents").where("text is not null").select("doc_id", "text")


def asked(spark: SparkSession, root: str) -> DataFrame:
    """(query_id, text): the evaluation items' questions."""
    return table(spark, root, "mbzuai_preprod_answer_completeness_v1").select(F.col("id").alias("query_id"), F.col("query").alias("text"))


def gold(spark: SparkSession, root: str) -> DataFrame:
    """(query_id, doc_id): records that an item names as its source."""
    return table(spark, root, "mbzuai_preprod_answer_completeness_v1").select(F.col("id").alias("query_id"), F.explode("gold_chunk_ids").alias("doc_id"))


_W = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
_BM25_SQL = rf"""qt AS (SELECT id AS query_id, t AS term, count(*) AS qtf FROM (SELECT id, unnest({_W.format('query')}) AS t FROM mbzuai_preprod_answer_completeness_v1) GROUP BY 1, 2),
dw AS (SELECT doc_id, {_W.format('text')} AS w FROM documents WHERE text IS NOT NULL), n AS (SELECT count(*) AS n_docs, avg(len(w)) AS mean_len FROM dw),
tf AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS len, unnest(w) AS term FROM dw) WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2, 3), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
bm AS (SELECT query_id, doc_id, round(sum(qtf * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / mean_len))), 6) AS score FROM qt JOIN tf USING (term) JOIN df USING (term), n GROUP BY 1, 2),
bk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM bm WHERE score > 0 QUALIFY rank <= 10)"""
_OVERLAP_SQL = rf"""oq AS (SELECT DISTINCT id AS query_id, t AS term FROM (SELECT id, unnest({_W.format('query')}) AS t FROM mbzuai_preprod_answer_completeness_v1) WHERE length(t) >= 3), os AS (SELECT query_id, count(*) AS terms FROM oq GROUP BY 1),
od AS (SELECT DISTINCT doc_id, unnest({_W.format('text')}) AS term FROM documents), oh AS (SELECT query_id, doc_id, count(*) AS hits FROM oq JOIN od USING (term) GROUP BY 1, 2),
ok AS (SELECT query_id, doc_id, hits, round(hits / terms + least(0.15, 0.03 * (hits - 1)), 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(hits / terms + least(0.15, 0.03 * (hits - 1)), 6) DESC, doc_id) AS rank FROM oh JOIN os USING (query_id) QUALIFY rank <= 10)"""


@query("WITH " + _BM25_SQL + " SELECT query_id, doc_id, score, rank FROM bk")
def bm25_topk(spark: SparkSession, root: str) -> DataFrame:
    return retrieval.bm25(passages(spark, root), asked(spark, root), 10)


@query("WITH " + _OVERLAP_SQL + " SELECT query_id, doc_id, hits, score, rank FROM ok")
def lexical_overlap_topk(spark: SparkSession, root: str) -> DataFrame:
    return retrieval.overlap(passages(spark, root), asked(spark, root), 10)


@query("WITH " + _BM25_SQL + ", " + _OVERLAP_SQL + """ SELECT * FROM (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM
 (SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM (SELECT query_id, doc_id, rank FROM bk UNION ALL SELECT query_id, doc_id, rank FROM ok) GROUP BY 1, 2)) WHERE rank <= 10""")
def rrf_fusion(spark: SparkSession, root: str) -> DataFrame:
    lanes = [bm25_topk(spark, root), lexical_overlap_topk(spark, root)]
    return retrieval.top_k(retrieval.fuse(lanes), "query_id", "doc_id", "score", 10)


@query(rf"SELECT term, count(*) AS documents, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM (SELECT DISTINCT doc_id, unnest({_W.format('text')}) AS term FROM documents) GROUP BY term")
def inverted_index(spark: SparkSession, root: str) -> DataFrame:
    held = passages(spark, root).select("doc_id", F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    return held.groupBy("term").agg(F.count(F.lit(1)).alias("documents"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))


@query(
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), q AS (SELECT * FROM v WHERE vec_id % 50 = 0)
 SELECT * FROM (SELECT q.vec_id AS query_id, v.vec_id AS item_id, round(list_cosine_similarity(q.e, v.e), 6) AS cosine, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.e, v.e), 9) DESC, v.vec_id) AS rank FROM q, v WHERE q.vec_id <> v.vec_id) WHERE rank <= 10"""
)
def dense_cosine_topk(spark: SparkSession, root: str) -> DataFrame:
    items = table(spark, root, "embeddings").select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("vector"))
    found = retrieval.dense_top_k(items, items.where("id % 50 = 0"), 10)
    return found.select("query_id", "item_id", F.round("cosine", 6).alias("cosine"), "rank")


@query(
    """WITH u AS (SELECT row_id, lane, CAST(embedding AS DOUBLE[]) AS e FROM embedding_records e JOIN releases r USING (release_id) WHERE r.status = 'active' AND len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
 q AS (SELECT * FROM u WHERE row_id % 50 = 0)
 SELECT * FROM (SELECT q.row_id AS query_id, u.row_id AS item_id, round(list_cosine_similarity(q.e, u.e), 6) AS cosine, row_number() OVER (PARTITION BY q.row_id ORDER BY round(list_cosine_similarity(q.e, u.e), 9) DESC, u.row_id) AS rank FROM q, u WHERE q.row_id <> u.row_id) WHERE rank <= 5"""
)
def release_vector_query(spark: SparkSession, root: str) -> DataFrame:
    active = table(spark, root, "releases").where("status = 'active'").select("release_id")
    records = table(spark, root, "embedding_records").join(active, "release_id", "left_semi").where("size(embedding) = 64 and forall(embedding, x -> abs(x) < double('infinity')) and exists(embedding, x -> x != 0)")
    items = records.select(F.col("row_id").alias("id"), F.col("embedding").alias("vector"))
    found = retrieval.dense_top_k(items, items.where("id % 50 = 0"), 5)
    return found.select("query_id", "item_id", F.round("cosine", 6).alias("cosine"), "rank")


@query("WITH " + _BM25_SQL + """, s AS (SELECT k.*, coalesce(source, 'none') AS source, row_number() OVER (PARTITION BY query_id, coalesce(source, 'none') ORDER BY rank) AS turn FROM bk k JOIN documents d USING (doc_id))
 SELECT query_id, doc_id, rank, row_number() OVER (PARTITION BY query_id ORDER BY turn > 1, rank) AS place FROM s""")
def source_diverse_ranking(spark: SparkSession, root: str) -> DataFrame:
    kept = bm25_topk(spark, root).join(table(spark, root, "documents").select("doc_id", F.coalesce("source", F.lit("none")).alias("source")), "doc_id")
    turn = kept.withColumn("turn", F.row_number().over(Window.partitionBy("query_id", "source").orderBy("rank")))
    return turn.select("query_id", "doc_id", "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("turn") > 1, "rank")).alias("place"))


@query(
    """SELECT doc_id, source, turn, place FROM (SELECT doc_id, source, turn, row_number() OVER (ORDER BY turn, source) AS place FROM (SELECT doc_id, coalesce(source, 'none') AS source, row_number() OVER (PARTITION BY coalesce(source, 'none') ORDER BY n_chars DESC, doc_id) AS turn FROM documents) WHERE turn <= 20)"""
)
def round_robin_sources(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", F.coalesce("source", F.lit("none")).alias("source"), "n_chars")
    first = docs.withColumn("turn", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id"))).where("turn <= 20")
    return first.select("doc_id", "source", "turn", F.row_number().over(Window.orderBy("turn", "source")).alias("place"))  # 20 rows a source


@query(
    """SELECT id, CASE WHEN (r - 1) / n < 0.7 THEN 'train' WHEN (r - 1) / n < 0.85 THEN 'dev' ELSE 'test' END AS split FROM (SELECT id, row_number() OVER (PARTITION BY query_type, no_answer ORDER BY sha256(id)) AS r, count(*) OVER (PARTITION BY query_type, no_answer) AS n FROM mbzuai_preprod_answer_completeness_v1)"""
)
def stratified_split(spark: SparkSession, root: str) -> DataFrame:
    stratum = Window.partitionBy("query_type", "no_answer")
    ranked = table(spark, root, "mbzuai_preprod_answer_completeness_v1").select("id", F.row_number().over(stratum.orderBy(F.sha2("id", 256))).alias("r"), F.count(F.lit(1)).over(stratum).alias("n"))
    at = (F.col("r") - 1) / F.col("n")
    return ranked.select("id", F.when(at < 0.7, "train").when(at < 0.85, "dev").otherwise("test").alias("split"))
