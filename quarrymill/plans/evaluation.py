"""Queries on evaluation items, metrics and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import words
from quarrymill.operators import retrieval
from quarrymill.plans.catalog import query
from quarrymill.session import table

ITEMS = "mbzuai_preprod_answer_completeness_v1"


@query(
    """SELECT ocr_provider, ocr_model, count(*) AS pages, round(coalesce(quantile_cont(ocr_latency_ms, 0.5) FILTER (WHERE ocr_latency_ms > 0), 0), 6) AS p50, round(coalesce(quantile_cont(ocr_latency_ms, 0.95) FILTER (WHERE ocr_latency_ms > 0), 0), 6) AS p95,
 round(coalesce(max(ocr_latency_ms), 0), 6) AS longest FROM corpus_merge_formatter GROUP BY 1, 2"""
)
def latency_percentiles(spark: SparkSession, root: str) -> DataFrame:
    positive = F.when(F.col("ocr_latency_ms") > 0, F.col("ocr_latency_ms"))
    at = lambda p: F.round(F.coalesce(F.percentile(positive, F.lit(p)), F.lit(0.0)), 6)
    return table(spark, root, "corpus_merge_formatter").groupBy("ocr_provider", "ocr_model").agg(F.count(F.lit(1)).alias("pages"), at(0.5).alias("p50"), at(0.95).alias("p95"), F.round(F.coalesce(F.max("ocr_latency_ms"), F.lit(0.0)), 6).alias("longest"))


_SLICES = "(), (query_type), (source_type), (no_answer)"


@query(
    f"""SELECT CASE WHEN grouping(query_type) = 0 THEN 'query_type' WHEN grouping(source_type) = 0 THEN 'source_type' WHEN grouping(no_answer) = 0 THEN 'no_answer' ELSE 'overall' END AS slice, coalesce(query_type, source_type, CAST(no_answer AS VARCHAR), 'all') AS value,
 count(*) AS items, round(avg(len(gold_chunk_ids)) FILTER (WHERE NOT no_answer), 6) AS mean_gold, round(avg(length(query)), 6) AS mean_length FROM {ITEMS} GROUP BY GROUPING SETS ({_SLICES})"""
)
def sliced_item_metrics(spark: SparkSession, root: str) -> DataFrame:
    items = table(spark, root, ITEMS).select(
        F.explode(F.array(*(F.struct(F.lit(s).alias("slice"), v.alias("value")) for s, v in (("overall", F.lit("all")), ("query_type", F.col("query_type")), ("source_type", F.col("source_type")), ("no_answer", F.col("no_answer").cast("string")))))).alias("s"),
        "no_answer", F.size("gold_chunk_ids").alias("gold"), F.length("query").alias("length"),
    )
    return items.groupBy("s.slice", "s.value").agg(F.count(F.lit(1)).alias("items"), F.round(F.avg(F.when(~F.col("no_answer"), F.col("gold"))), 6).alias("mean_gold"), F.round(F.avg("length"), 6).alias("mean_length"))


@query(
    f"""SELECT coalesce(nullif(lower(trim(language)), ''), 'none') AS label, count(*) AS items, count(*) FILTER (WHERE no_answer) AS unanswerable, count(*) FILTER (WHERE NOT no_answer AND coalesce(trim(reference_answer), '') = '') AS without_answer,
 count(*) FILTER (WHERE NOT no_answer AND len(gold_chunk_ids) = 0) AS without_gold FROM {ITEMS} GROUP BY 1"""
)
def item_coverage(spark: SparkSession, root: str) -> DataFrame:
    answerable = ~F.col("no_answer")
    return table(spark, root, ITEMS).groupBy(F.coalesce(F.nullif(F.lower(F.trim("language")), F.lit("")), F.lit("none")).alias("label")).agg(
        F.count(F.lit(1)).alias("items"), F.count_if("no_answer").alias("unanswerable"), F.count_if(answerable & (F.coalesce(F.trim("reference_answer"), F.lit("")) == "")).alias("without_answer"), F.count_if(answerable & (F.size("gold_chunk_ids") == 0)).alias("without_gold"),
    )


_RANKED_SQL = rf"""qt AS (SELECT DISTINCT id AS query_id, t AS term FROM (SELECT id, unnest(regexp_extract_all(lower(query), '[\p{{L}}\p{{N}}]+')) AS t FROM {ITEMS} WHERE len(gold_chunk_ids) > 0) WHERE length(t) >= 3), qs AS (SELECT query_id, count(*) AS terms FROM qt GROUP BY 1),
dt AS (SELECT DISTINCT record_id AS doc_id, unnest(regexp_extract_all(lower(retrieval_text), '[\p{{L}}\p{{N}}]+')) AS term FROM embedding_records WHERE lane = 'chunks'), h AS (SELECT query_id, doc_id, count(*) AS hits FROM qt JOIN dt USING (term) GROUP BY 1, 2),
rk AS (SELECT query_id, doc_id, hits, terms, row_number() OVER (PARTITION BY query_id ORDER BY round(hits / terms + least(0.15, 0.03 * (hits - 1)), 6) DESC, doc_id) AS rank, round(hits / terms + least(0.15, 0.03 * (hits - 1)), 6) AS score FROM h JOIN qs USING (query_id) QUALIFY rank <= 10),
g AS (SELECT DISTINCT id AS query_id, unnest(gold_chunk_ids) AS doc_id FROM {ITEMS})"""


def ranked_chunks(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(ranked, gold): overlap ranking of the chunk records for all items with gold, and that gold."""
    items = table(spark, root, ITEMS).where("size(gold_chunk_ids) > 0")
    chunks = table(spark, root, "embedding_records").where("lane = 'chunks'").select(F.col("record_id").alias("doc_id"), "retrieval_text")
    # a record carried into other releases counts once, with all its words
    texts = chunks.distinct().groupBy("doc_id").agg(F.concat_ws("\n", F.collect_set("retrieval_text")).alias("text"))
    ranked = retrieval.overlap(texts, items.select(F.col("id").alias("query_id"), F.col("query").alias("text")), 10).drop("hits")
    return ranked, items.select(F.col("id").alias("query_id"), F.explode("gold_chunk_ids").alias("doc_id"))


@query(
    "WITH " + _RANKED_SQL + """, n AS (SELECT query_id, count(*) AS n FROM g GROUP BY 1), f AS (SELECT query_id, count(DISTINCT doc_id) AS hits, min(rank) AS first, sum(1 / log2(rank + 1)) AS dcg FROM rk JOIN g USING (query_id, doc_id) GROUP BY 1)
 SELECT query_id, CASE WHEN hits > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS hit, round(coalesce(hits / n, 0), 6) AS recall, round(coalesce(1 / first, 0), 6) AS mrr, round(coalesce(dcg / list_sum(list_transform(range(1, least(n, 10) + 1), lambda i: 1 / log2(i + 1))), 0), 6) AS ndcg FROM n LEFT JOIN f USING (query_id)"""
)
def ranking_metrics(spark: SparkSession, root: str) -> DataFrame:
    return retrieval.ranking_metrics(*ranked_chunks(spark, root))


@query(
    "WITH " + _RANKED_SQL + """, t AS (SELECT query_id, max(score) AS top, max(CASE WHEN rk.doc_id IN (SELECT doc_id FROM g WHERE g.query_id = rk.query_id) THEN 1 ELSE 0 END) AS good FROM rk GROUP BY 1), s AS (SELECT DISTINCT top FROM t),
 m AS (SELECT (top + lead(top) OVER (ORDER BY top)) / 2 AS cut FROM s) SELECT floor(cut * 1000000 + 0.5) / 1000000 AS threshold, count(*) FILTER (WHERE good = 1 AND top >= cut) AS kept_good, count(*) FILTER (WHERE good = 0 AND top < cut) AS dropped_bad,
 floor((count(*) FILTER (WHERE good = 1 AND top >= cut) / greatest(1, count(*) FILTER (WHERE good = 1)) + count(*) FILTER (WHERE good = 0 AND top < cut) / greatest(1, count(*) FILTER (WHERE good = 0))) / 2 * 1000000 + 0.5) / 1000000 AS balanced FROM m, t WHERE cut IS NOT NULL GROUP BY cut"""
)
def threshold_sweep(spark: SparkSession, root: str) -> DataFrame:
    ranked, gold = ranked_chunks(spark, root)
    marked = ranked.join(gold.distinct().withColumn("good", F.lit(1)), ["query_id", "doc_id"], "left")
    best = marked.groupBy("query_id").agg(F.max("score").alias("top"), F.max(F.coalesce("good", F.lit(0))).alias("good"))
    # all thresholds at once from running counts over the distinct scores, so that queries never meet each other in a join
    by_score = best.groupBy("top").agg(F.count_if(F.col("good") == 1).alias("g"), F.count_if(F.col("good") == 0).alias("b"))
    below = Window.orderBy("top").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = by_score.select(((F.col("top") + F.lead("top").over(Window.orderBy("top"))) / 2).alias("cut"), F.sum("g").over(below).alias("low_good"), F.sum("b").over(below).alias("dropped_bad"), F.sum("g").over(every).alias("good"), F.sum("b").over(every).alias("bad"))
    kept = F.col("good") - F.col("low_good")
    return counted.where("cut is not null").select((F.floor(F.col("cut") * 1_000_000 + 0.5) / 1_000_000).alias("threshold"), kept.alias("kept_good"), "dropped_bad", (F.floor((kept / F.greatest(F.lit(1), "good") + F.col("dropped_bad") / F.greatest(F.lit(1), "bad")) / 2 * 1_000_000 + 0.5) / 1_000_000).alias("balanced"))


_GATES = [("overall", "all", "mean_gold", 1.0, 5.0), ("query_type", "fact", "items", 10.0, None), ("query_type", "opinion", "items", 1.0, None), ("no_answer", "true", "items", 5.0, 60.0), ("source_type", "pdf", "mean_length", 200.0, None)]


@query(
    "WITH r(slice, value, metric, lo, hi) AS (VALUES " + ", ".join(f"('{s}', '{v}', '{m}', {lo if lo is not None else 'NULL'}, {hi if hi is not None else 'NULL'})" for s, v, m, lo, hi in _GATES) + f"""),
 m AS (SELECT CASE WHEN grouping(query_type) = 0 THEN 'query_type' WHEN grouping(source_type) = 0 THEN 'source_type' WHEN grouping(no_answer) = 0 THEN 'no_answer' ELSE 'overall' END AS slice, coalesce(query_type, source_type, CAST(no_answer AS VARCHAR), 'all') AS value,
 CAST(count(*) AS DOUBLE) AS items, round(avg(len(gold_chunk_ids)) FILTER (WHERE NOT no_answer), 6) AS mean_gold, round(avg(length(query)), 6) AS mean_length FROM {ITEMS} GROUP BY GROUPING SETS ({_SLICES})),
 u AS (SELECT slice, value, 'items' AS metric, items AS x FROM m UNION ALL SELECT slice, value, 'mean_gold', mean_gold FROM m UNION ALL SELECT slice, value, 'mean_length', mean_length FROM m)
 SELECT r.slice, r.value, r.metric, CASE WHEN x IS NULL THEN 'missing' WHEN x < lo - 1e-9 THEN 'below' WHEN x > hi + 1e-9 THEN 'above' ELSE 'passed' END AS verdict FROM r LEFT JOIN u ON u.slice = r.slice AND u.value = r.value AND u.metric = r.metric"""
)
def gate_check(spark: SparkSession, root: str) -> DataFrame:
    rules = spark.createDataFrame(_GATES, "slice string, value string, metric string, lo double, hi double")
    report = sliced_item_metrics(spark, root).withColumn("items", F.col("items").cast("double")).unpivot(["slice", "value"], ["items", "mean_gold", "mean_length"], "metric", "x")
    joined = rules.join(report, ["slice", "value", "metric"], "left")
    verdict = F.when(F.col("x").isNull(), "missing").when(F.col("x") < F.col("lo") - 1e-9, "below").when(F.col("x") > F.col("hi") + 1e-9, "above").otherwise("passed")
    return joined.select("slice", "value", "metric", verdict.alias("verdict"))


@query(
    """WITH p AS (SELECT ocr_provider, round(avg(ocr_quality_score) FILTER (WHERE ocr_quality_score BETWEEN 0 AND 1), 6) AS quality, round(avg(ocr_attempts), 6) AS attempts FROM corpus_merge_formatter WHERE ocr_mode = 'layout' GROUP BY 1),
 q AS (SELECT ocr_provider, round(avg(ocr_quality_score) FILTER (WHERE ocr_quality_score BETWEEN 0 AND 1), 6) AS quality, round(avg(ocr_attempts), 6) AS attempts FROM corpus_merge_formatter WHERE ocr_mode <> 'layout' GROUP BY 1)
 SELECT coalesce(p.ocr_provider, q.ocr_provider) AS ocr_provider, round(q.quality - p.quality, 6) AS delta, CASE WHEN q.quality IS NULL OR p.quality IS NULL THEN 'incomparable' WHEN q.quality - p.quality > 0.01 THEN 'improvement' WHEN q.quality - p.quality < -0.01 THEN 'regression' ELSE 'unchanged' END AS verdict FROM p FULL JOIN q ON p.ocr_provider = q.ocr_provider"""
)
def report_deltas(spark: SparkSession, root: str) -> DataFrame:
    scans = table(spark, root, "corpus_merge_formatter")
    mean = lambda name: F.round(F.avg(F.when(F.col("ocr_quality_score").between(0, 1), F.col("ocr_quality_score"))), 6).alias(name)
    base = scans.where("ocr_mode = 'layout'").groupBy("ocr_provider").agg(mean("p"))
    other = scans.where("ocr_mode != 'layout'").groupBy("ocr_provider").agg(mean("q"))
    d = F.col("q") - F.col("p")
    verdict = F.when(d.isNull(), "incomparable").when(d > 0.01, "improvement").when(d < -0.01, "regression").otherwise("unchanged")
    return base.join(other, "ocr_provider", "full").select("ocr_provider", F.round(d, 6).alias("delta"), verdict.alias("verdict"))


@query(
    "WITH " + _RANKED_SQL + """, src AS (SELECT record_id AS doc_id, min(source_url) AS source FROM embedding_records GROUP BY 1), same AS (SELECT DISTINCT query_id, source FROM g JOIN src USING (doc_id)),
 hg AS (SELECT rk.query_id, rank, CASE WHEN g.doc_id IS NOT NULL THEN 1.0::DOUBLE WHEN same.source IS NOT NULL THEN 0.65::DOUBLE END AS gain FROM rk LEFT JOIN src USING (doc_id) LEFT JOIN g ON g.query_id = rk.query_id AND g.doc_id = rk.doc_id LEFT JOIN same ON same.query_id = rk.query_id AND same.source = src.source),
 f AS (SELECT query_id, arg_min(gain / log2(rank + 1), rank) AS v FROM hg WHERE gain IS NOT NULL GROUP BY 1) SELECT query_id, round(coalesce(v, 0), 6) AS ndcg FROM (SELECT DISTINCT query_id FROM g) LEFT JOIN f USING (query_id)"""
)
def source_aware_ndcg(spark: SparkSession, root: str) -> DataFrame:
    ranked, gold = ranked_chunks(spark, root)
    sources = table(spark, root, "embedding_records").groupBy(F.col("record_id").alias("doc_id")).agg(F.min("source_url").alias("source"))
    return retrieval.source_aware_ndcg(ranked, gold, sources)


@query(
    "WITH " + _RANKED_SQL + """, n AS (SELECT query_id, count(*) AS n FROM g GROUP BY 1), f AS (SELECT query_id, count(DISTINCT doc_id) AS hits, min(rank) AS first FROM rk JOIN g USING (query_id, doc_id) GROUP BY 1),
 m AS (SELECT i.language, CASE WHEN hits > 0 THEN 1e0 ELSE 0e0 END AS hit, round(coalesce(hits / n, 0), 6) AS recall, round(coalesce(1 / first, 0), 6) AS mrr FROM n LEFT JOIN f USING (query_id) JOIN mbzuai_preprod_answer_completeness_v1 i ON i.id = query_id)
 SELECT coalesce(language, 'none') AS language, count(*) AS queries, round(0.5e0 * avg(recall) + 0.3e0 * avg(mrr) + 0.2e0 * avg(hit), 5) AS selection_score FROM m GROUP BY 1"""
)
def selection_scores(spark: SparkSession, root: str) -> DataFrame:
    """A weighted composite of recall, reciprocal rank and hits by language label."""
    m = retrieval.ranking_metrics(*ranked_chunks(spark, root)).join(table(spark, root, ITEMS).select(F.col("id").alias("query_id"), "language"), "query_id")
    score = 0.5 * F.avg("recall") + 0.3 * F.avg("mrr") + 0.2 * F.avg("hit")
    return m.groupBy(F.coalesce("language", F.lit("none")).alias("language")).agg(F.count(F.lit(1)).alias("queries"), F.round(score, 5).alias("selection_score"))


@query()
def lane_bootstrap(spark: SparkSession, root: str) -> DataFrame:
    """Confidence interval of the difference in top score between the two lexical lanes; resampling has no SQL, a test compares it with numpy."""
    from quarrymill.plans import ranking

    best = lambda lane, name: lane.where("rank = 1").select("query_id", (F.col("score") / (1 + F.col("score"))).alias(name))
    both = best(ranking.bm25_topk(spark, root), "a").join(best(ranking.lexical_overlap_topk(spark, root), "b"), "query_id")
    return retrieval.paired_bootstrap(both.select((F.col("a") - F.col("b")).alias("delta")), "delta")
