"""Queries on graphs, merges and record state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.operators import dedup, graph
from quarrymill.plans.catalog import query
from quarrymill.session import table


def trade_graph(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Regions, nations, customers and suppliers as nodes, their references as edges."""
    node = lambda t, c, p: table(spark, root, t).select(F.concat(F.lit(p), F.col(c)).alias("id"), F.lit(t).alias("node_type"))
    edge = lambda t, a, pa, b, pb, kind: table(spark, root, t).select(F.concat(F.lit(pa), F.col(a)).alias("source_id"), F.concat(F.lit(pb), F.col(b)).alias("target_id"), F.lit(kind).alias("edge_type"))
    nodes = node("region", "r_regionkey", "r").union(node("nation", "n_nationkey", "n")).union(node("customer", "c_custkey", "c")).union(node("supplier", "s_suppkey", "s"))
    edges = edge("nation", "n_regionkey", "r", "n_nationkey", "n", "HAS_NATION").union(edge("customer", "c_nationkey", "n", "c_custkey", "c", "HAS_CUSTOMER")).union(edge("supplier", "s_nationkey", "n", "s_suppkey", "s", "HAS_SUPPLIER"))
    return nodes, edges


def gold_links(spark: SparkSession, root: str, item: str, chunk: str) -> DataFrame:
    """Evaluation items (i...) and their gold chunks (c...)."""
    held = table(spark, root, "mbzuai_preprod_answer_completeness_v1").select("id", F.explode("gold_chunk_ids").alias("chunk"))
    return held.select(F.concat(F.lit("i"), F.col("id")).alias(item), F.concat(F.lit("c"), F.col("chunk")).alias(chunk))


_GRAPH_SQL = """WITH nodes AS (SELECT 'r' || r_regionkey AS id, 'region' AS node_type FROM region UNION ALL SELECT 'n' || n_nationkey, 'nation' FROM nation UNION ALL SELECT 'c' || c_custkey, 'customer' FROM customer UNION ALL SELECT 's' || s_suppkey, 'supplier' FROM supplier),
edges AS (SELECT 'r' || n_regionkey AS source_id, 'n' || n_nationkey AS target_id, 'HAS_NATION' AS edge_type FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey, 'HAS_CUSTOMER' FROM customer UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, 'HAS_SUPPLIER' FROM supplier)"""


@query(_GRAPH_SQL + " SELECT edge_type AS kind, count(*) AS n FROM edges GROUP BY 1 UNION ALL SELECT node_type, count(*) FROM nodes GROUP BY 1")
def graph_type_counts(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = trade_graph(spark, root)
    n = F.count(F.lit(1)).alias("n")
    return edges.groupBy(F.col("edge_type").alias("kind")).agg(n).union(nodes.groupBy("node_type").agg(n))


@query(_GRAPH_SQL + " SELECT id, (SELECT count(DISTINCT target_id) FROM edges WHERE source_id = id) AS outgoing, (SELECT count(DISTINCT source_id) FROM edges WHERE target_id = id) AS incoming FROM nodes")
def graph_adjacency(spark: SparkSession, root: str) -> DataFrame:
    return graph.adjacency(*trade_graph(spark, root))


@query(
    _GRAPH_SQL + """ SELECT seed, id, min(depth) AS depth FROM (SELECT id AS seed, id, 0 AS depth FROM nodes WHERE node_type = 'region' UNION ALL SELECT source_id, target_id, 1 FROM edges WHERE source_id LIKE 'r%'
 UNION ALL SELECT a.source_id, b.target_id, 2 FROM edges a JOIN edges b ON a.target_id = b.source_id WHERE a.source_id LIKE 'r%') GROUP BY 1, 2"""
)
def graph_two_hops(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = trade_graph(spark, root)
    return graph.reachable(edges, nodes.where("node_type = 'region'"), 2)


@query(
    """WITH edges AS (SELECT record_id AS s, chunk AS t FROM (SELECT id AS record_id, unnest(gold_chunk_ids) AS chunk FROM mbzuai_preprod_answer_completeness_v1)), nodes AS (SELECT DISTINCT record_id AS id FROM embedding_records)
 SELECT 'dangling_edge' AS issue, t AS id, count(*) AS n FROM edges WHERE t NOT IN (SELECT id FROM nodes) GROUP BY t"""
)
def dangling_gold_chunks(spark: SparkSession, root: str) -> DataFrame:
    items = table(spark, root, "mbzuai_preprod_answer_completeness_v1").select(F.col("id").alias("source_id"), F.explode("gold_chunk_ids").alias("target_id"))
    nodes = table(spark, root, "embedding_records").select(F.col("record_id").alias("id")).distinct().union(items.select("source_id").distinct())
    return graph.issues(nodes, items)


@query(
    """WITH RECURSIVE e AS (SELECT DISTINCT 'i' || id AS a, 'c' || chunk AS b FROM (SELECT id, unnest(gold_chunk_ids) AS chunk FROM mbzuai_preprod_answer_completeness_v1)), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
 r AS (SELECT DISTINCT a AS id, a AS c FROM u UNION SELECT r.id, u.b FROM r JOIN u ON r.c = u.a) SELECT id, least(id, min(c)) AS component FROM r GROUP BY id"""
)
def gold_components(spark: SparkSession, root: str) -> DataFrame:
    links = gold_links(spark, root, "a", "b")
    return dedup.components(links.select(F.col("a").alias("id")), links)


@query()
def gold_communities(spark: SparkSession, root: str) -> DataFrame:
    links = gold_links(spark, root, "source_id", "target_id")
    nodes = links.select(F.col("source_id").alias("id")).union(links.select("target_id")).distinct()
    return graph.label_communities(nodes, links)


@query(
    """WITH m AS (SELECT DISTINCT id, chunk FROM (SELECT id, unnest(gold_chunk_ids) AS chunk FROM mbzuai_preprod_answer_completeness_v1)) SELECT x.chunk AS a, y.chunk AS b, count(*) AS n FROM m x JOIN m y ON x.id = y.id AND x.chunk < y.chunk GROUP BY 1, 2"""
)
def gold_chunk_pairs(spark: SparkSession, root: str) -> DataFrame:
    items = table(spark, root, "mbzuai_preprod_answer_completeness_v1").select("id", F.explode("gold_chunk_ids").alias("chunk"))
    return graph.pair_links(items, "id", "chunk")


@query(
    """WITH c AS (SELECT release_id, lane, count(*) AS n FROM embedding_records GROUP BY 1, 2), x AS (SELECT release_id, unnest(map_entries(expected_counts)) AS e FROM releases)
 SELECT coalesce(c.release_id, x.release_id) AS release_id, coalesce(c.lane, x.e.key) AS lane, coalesce(n, 0) AS records, coalesce(x.e.value, 0) AS expected, CASE WHEN x.e.key IS NULL THEN 'unexpected' WHEN n IS NULL THEN 'missing' WHEN n = x.e.value THEN 'equal' ELSE 'different' END AS verdict
 FROM c FULL JOIN x ON c.release_id = x.release_id AND c.lane = x.e.key"""
)
def namespace_count_diff(spark: SparkSession, root: str) -> DataFrame:
    counted = table(spark, root, "embedding_records").groupBy("release_id", "lane").agg(F.count(F.lit(1)).alias("n"))
    wanted = table(spark, root, "releases").select("release_id", F.explode("expected_counts").alias("lane", "m"))
    zero = F.lit(0).cast("bigint")
    return counted.join(wanted, ["release_id", "lane"], "full").select(
        "release_id", "lane", F.coalesce("n", zero).alias("records"), F.coalesce("m", zero).alias("expected"),
        F.when(F.col("m").isNull(), "unexpected").when(F.col("n").isNull(), "missing").when(F.col("n") == F.col("m"), "equal").otherwise("different").alias("verdict"),
    )


@query(
    """WITH a AS (SELECT record_id, min(md5(retrieval_text)) AS h FROM embedding_records WHERE release_id = 'rel-2025-06-a' GROUP BY 1), b AS (SELECT record_id, min(md5(retrieval_text)) AS h FROM embedding_records WHERE release_id = 'rel-2025-09-a' GROUP BY 1)
 SELECT CASE WHEN a.h IS NULL THEN 'new' WHEN b.h IS NULL THEN 'removed' WHEN a.h = b.h THEN 'unchanged' ELSE 'changed' END AS state, count(*) AS records FROM a FULL JOIN b ON a.record_id = b.record_id GROUP BY 1"""
)
def snapshot_compare(spark: SparkSession, root: str) -> DataFrame:
    def of(release: str, name: str) -> DataFrame:
        return table(spark, root, "embedding_records").where(F.col("release_id") == release).groupBy("record_id").agg(F.min(F.md5("retrieval_text")).alias(name))

    both = of("rel-2025-06-a", "a").join(of("rel-2025-09-a", "b"), "record_id", "full")
    state = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "removed").when(F.col("a") == F.col("b"), "unchanged").otherwise("changed")
    return both.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("records"))


@query(
    """SELECT record_id, arg_max(retrieval_text_md5, p) AS text_md5, max(p) AS priority, arg_max(source_url, p) FILTER (WHERE source_url IS NOT NULL) AS source_url FROM
 (SELECT record_id, md5(retrieval_text) AS retrieval_text_md5, source_url, strftime(coalesce(created_at, TIMESTAMP '1970-01-01'), '%Y%m%d%H%M%S') || lpad(CAST(row_id AS VARCHAR), 12, '0') AS p FROM embedding_records) GROUP BY record_id"""
)
def overlay_merge(spark: SparkSession, root: str) -> DataFrame:
    p = F.concat(F.date_format(F.coalesce("created_at", F.lit("1970-01-01").cast("timestamp")), "yyyyMMddHHmmss"), F.lpad(F.col("row_id").cast("string"), 12, "0"))
    records = table(spark, root, "embedding_records").select("record_id", F.md5("retrieval_text").alias("t"), "source_url", p.alias("p"))
    return records.groupBy("record_id").agg(F.max_by("t", "p").alias("text_md5"), F.max("p").alias("priority"), F.max_by("source_url", F.when(F.col("source_url").isNotNull(), F.col("p"))).alias("source_url"))


@query(
    """SELECT e.path, CASE WHEN a.n = 1 THEN 'record' WHEN u.n = 1 THEN 'url' ELSE 'none' END AS matched_by FROM (SELECT DISTINCT path, record_id, source_url FROM dedup_entry) e
 LEFT JOIN (SELECT record_id, count(DISTINCT release_id) AS n FROM embedding_records GROUP BY 1) a ON a.record_id = e.record_id LEFT JOIN (SELECT source_url, count(DISTINCT record_id) AS n FROM embedding_records WHERE source_url IS NOT NULL GROUP BY 1) u ON u.source_url = e.source_url"""
)
def fallback_join(spark: SparkSession, root: str) -> DataFrame:
    records = table(spark, root, "embedding_records")
    by_id = records.groupBy("record_id").agg(F.count_distinct("release_id").alias("a"))
    by_url = records.where("source_url is not null").groupBy("source_url").agg(F.count_distinct("record_id").alias("u"))
    entries = table(spark, root, "dedup_entry").select("path", "record_id", "source_url").distinct()
    return entries.join(by_id, "record_id", "left").join(by_url, "source_url", "left").select("path", F.when(F.col("a") == 1, "record").when(F.col("u") == 1, "url").otherwise("none").alias("matched_by"))


@query(
    """SELECT release_id, project_name, CASE WHEN retired_at IS NOT NULL THEN 'retired' WHEN activated_at IS NOT NULL THEN 'active' WHEN ready_at IS NOT NULL THEN 'ready' ELSE 'building' END AS reached, status,
 count(*) FILTER (WHERE activated_at IS NOT NULL AND retired_at IS NULL) OVER (PARTITION BY project_name) AS active_in_project FROM releases"""
)
def release_states(spark: SparkSession, root: str) -> DataFrame:
    reached = F.when(F.col("retired_at").isNotNull(), "retired").when(F.col("activated_at").isNotNull(), "active").when(F.col("ready_at").isNotNull(), "ready").otherwise("building")
    live = F.count_if(F.col("activated_at").isNotNull() & F.col("retired_at").isNull()).over(Window.partitionBy("project_name"))
    return table(spark, root, "releases").select("release_id", "project_name", reached.alias("reached"), "status", live.alias("active_in_project"))


@query(
    """SELECT e.release_id, count(*) AS records, count(*) FILTER (WHERE e.created_at > r.ready_at) AS after_ready, count(*) FILTER (WHERE e.updated_at < e.created_at) AS back_in_time FROM embedding_records e JOIN releases r ON e.release_id = r.release_id GROUP BY 1"""
)
def late_records(spark: SparkSession, root: str) -> DataFrame:
    joined = table(spark, root, "embedding_records").select("release_id", "created_at", "updated_at").join(table(spark, root, "releases").select("release_id", "ready_at"), "release_id")
    return joined.groupBy("release_id").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("created_at") > F.col("ready_at")).alias("after_ready"), F.count_if(F.col("updated_at") < F.col("created_at")).alias("back_in_time"))


@query(
    r"""SELECT DISTINCT release_id, namespace, left(regexp_replace(lower(trim(namespace)), '[^a-z0-9]+', '-', 'g') || '--' || regexp_replace(lower(release_id), '[^a-z0-9]+', '-', 'g'), 48) AS full_name FROM embedding_records WHERE namespace IS NOT NULL"""
)
def namespace_names(spark: SparkSession, root: str) -> DataFrame:
    token = lambda c: F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-")
    return table(spark, root, "embedding_records").where("namespace is not null").select("release_id", "namespace", F.left(F.concat(token("namespace"), F.lit("--"), F.regexp_replace(F.lower("release_id"), "[^a-z0-9]+", "-")), F.lit(48)).alias("full_name")).distinct()


@query(
    """SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS hour, count(*) AS events, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"""
)
def event_windows(spark: SparkSession, root: str) -> DataFrame:
    events = table(spark, root, "events")
    return events.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT event_id, ts, event_type FROM events WHERE event_id < 5000 ORDER BY event_id DESC LIMIT 100")
def log_page(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").where("event_id < 5000").orderBy(F.desc("event_id")).limit(100).select("event_id", "ts", "event_type")


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM g) SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY 1, 2"""
)
def event_sessions(spark: SparkSession, root: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    near = F.col("ts") <= F.lag("ts").over(w) + F.expr("INTERVAL '30' MINUTE")
    marked = table(spark, root, "events").withColumn("fresh", F.when(near, 0).otherwise(1))
    numbered = marked.withColumn("session", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
