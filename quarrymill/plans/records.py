"""Queries that build, filter and cut records for retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.functions import urls as U
from quarrymill.operators import retrieval
from quarrymill.plans import ranking
from quarrymill.plans.catalog import query
from quarrymill.session import table

ITEMS = "mbzuai_preprod_answer_completeness_v1"


@query(
    r"""SELECT row_id, CASE WHEN len(regexp_extract_all(lower(retrieval_text), '[\p{L}\p{N}]+')) >= 8 THEN sha1(array_to_string(regexp_extract_all(lower(retrieval_text), '[\p{L}\p{N}]+'), ' ')) END AS evidence_key FROM embedding_records"""
)
def evidence_keys(spark: SparkSession, root: str) -> DataFrame:
    w = T.words(F.col("retrieval_text"))
    return table(spark, root, "embedding_records").select("row_id", F.when(F.size(w) >= 8, F.sha1(F.array_join(w, " "))).alias("evidence_key"))


@query(
    r"""WITH s AS (SELECT row_id, lower(regexp_extract(trim(source_url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS h, coalesce(regexp_extract(trim(source_url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '') AS p, source_url FROM embedding_records)
 SELECT CASE WHEN source_url IS NULL THEN 'no_url' WHEN h = 'staging.norvale.example' OR starts_with(p, '/news/') THEN 'denied' WHEN h = 'norvale.example' OR ends_with(h, '.norvale.example') THEN 'allowed' ELSE 'outside' END AS verdict, count(*) AS records FROM s GROUP BY 1"""
)
def source_filter_counts(spark: SparkSession, root: str) -> DataFrame:
    """Hosts and path prefixes let in or kept out; keeping out wins."""
    u = F.col("source_url")
    verdict = F.when(u.isNull(), "no_url").when((U.host(u) == "staging.norvale.example") | F.startswith(U.path(u), F.lit("/news/")), "denied").when(U.on_host(u, "norvale.example"), "allowed").otherwise("outside")
    return table(spark, root, "embedding_records").groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("records"))


@query(
    r"""WITH s AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([.!?؟])[ \t]+', '\1' || chr(10), 'g'), '[\r\n]+'), lambda x: trim(x)), lambda x: x <> '')) AS s FROM documents WHERE text IS NOT NULL)
 SELECT CASE WHEN regexp_matches(s, '@|\+\d') THEN 'contact' WHEN regexp_matches(s, '\b(19|20)\d\d\b') THEN 'dated' WHEN regexp_matches(s, '\d') THEN 'figure' WHEN s LIKE '%?' THEN 'question' ELSE 'prose' END AS span_type, count(*) AS spans, CAST(sum(length(s)) AS BIGINT) AS characters FROM s GROUP BY 1"""
)
def span_types(spark: SparkSession, root: str) -> DataFrame:
    spans = table(spark, root, "documents").where("text is not null").select(F.explode(T.sentences(F.col("text"))).alias("s"))
    kind = F.when(F.col("s").rlike(r"@|\+\d"), "contact").when(F.col("s").rlike(r"\b(19|20)\d\d\b"), "dated").when(F.col("s").rlike(r"\d"), "figure").when(F.col("s").endswith("?"), "question").otherwise("prose")
    return spans.groupBy(kind.alias("span_type")).agg(F.count(F.lit(1)).alias("spans"), F.sum(F.length("s")).alias("characters"))


@query(
    """SELECT doc_id, CAST(i AS INTEGER) AS window_no, md5(substr(text, i * 1000 + 1, 1200)) AS window_md5, length(substr(text, i * 1000 + 1, 1200)) AS characters
 FROM (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil((length(text) - 200) / 1000) AS BIGINT), 1))) AS i FROM documents WHERE text IS NOT NULL AND text <> '')"""
)
def char_windows(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").where("text is not null and text != ''")
    cut = docs.select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil((F.length("text") - 200) / 1000) - 1, F.lit(0)).cast("int"))).alias("window_no"))
    part = F.substr(F.col("text"), F.col("window_no") * 1000 + 1, F.lit(1200))
    return cut.select("doc_id", "window_no", F.md5(part).alias("window_md5"), F.length(part).cast("bigint").alias("characters"))


@query(
    """SELECT doc_id, CASE WHEN length(text) <= 400 THEN text ELSE substr(text, 1, 220) || ' ... ' || substr(text, (length(text) - 80) // 2 + 1, 80) || ' ... ' || right(text, 100) END AS excerpt FROM documents WHERE text IS NOT NULL"""
)
def head_middle_tail(spark: SparkSession, root: str) -> DataFrame:
    t, n = F.col("text"), F.length("text")
    cut = F.concat(F.substr(t, F.lit(1), F.lit(220)), F.lit(" ... "), F.substr(t, F.floor((n - 80) / 2).cast("int") + 1, F.lit(80)), F.lit(" ... "), F.right(t, F.lit(100)))
    return table(spark, root, "documents").where("text is not null").select("doc_id", F.when(n <= 400, t).otherwise(cut).alias("excerpt"))


@query(
    r"""SELECT id, CASE WHEN length(v) <= 60 THEN v ELSE coalesce(nullif(regexp_extract(v, '^(.{0,60})[ ]', 1), ''), substr(v, 1, 60)) || '...' END AS short FROM (SELECT id, trim(regexp_replace(query, '[ \t\r\n]+', ' ', 'g')) AS v FROM mbzuai_preprod_answer_completeness_v1)"""
)
def truncated_queries(spark: SparkSession, root: str) -> DataFrame:
    v = T.clean(F.col("query"))
    at_word = F.coalesce(F.nullif(F.regexp_extract(v, "^(.{0,60})[ ]", 1), F.lit("")), F.substring(v, 1, 60))
    return table(spark, root, ITEMS).select("id", F.when(F.length(v) <= 60, v).otherwise(F.concat(at_word, F.lit("..."))).alias("short"))


@query(
    """SELECT release_id, source_url, count(*) AS records, count(DISTINCT record_id) AS ids, count(*) FILTER (WHERE lane = 'chunks') AS chunks, count(*) FILTER (WHERE lane = 'parents') AS parents, min(row_id) AS first_row, max(TRY_CAST(metadata['page_number'] AS INTEGER)) AS last_page
 FROM embedding_records WHERE source_url IS NOT NULL GROUP BY 1, 2"""
)
def page_rollup(spark: SparkSession, root: str) -> DataFrame:
    records = table(spark, root, "embedding_records").where("source_url is not null")
    return records.groupBy("release_id", "source_url").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("record_id").alias("ids"), F.count_if(F.col("lane") == "chunks").alias("chunks"), F.count_if(F.col("lane") == "parents").alias("parents"),
        F.min("row_id").alias("first_row"), F.max(F.try_element_at("metadata", F.lit("page_number")).try_cast("int")).alias("last_page"),
    )


@query(
    "WITH " + ranking._BM25_SQL + ", " + ranking._OVERLAP_SQL + """ SELECT query_id, doc_id, round(sum(w / (60 + rank)), 9) AS support, count(*) AS lanes FROM (SELECT query_id, doc_id, rank, 1.0::DOUBLE AS w FROM bk UNION ALL SELECT query_id, doc_id, rank, 0.5 FROM ok) GROUP BY 1, 2"""
)
def lane_support(spark: SparkSession, root: str) -> DataFrame:
    lanes = [ranking.bm25_topk(spark, root).select("query_id", "doc_id", "rank", F.lit(1.0).alias("w")), ranking.lexical_overlap_topk(spark, root).select("query_id", "doc_id", "rank", F.lit(0.5).alias("w"))]
    return lanes[0].union(lanes[1]).groupBy("query_id", "doc_id").agg(F.round(F.sum(F.col("w") / (60 + F.col("rank"))), 9).alias("support"), F.count(F.lit(1)).alias("lanes"))


@query(
    "WITH " + ranking._BM25_SQL + ", " + ranking._OVERLAP_SQL + """, f AS (SELECT query_id, doc_id, rank FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM (SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS s FROM (SELECT query_id, doc_id, rank FROM bk UNION ALL SELECT query_id, doc_id, rank FROM ok) GROUP BY 1, 2))),
 t AS (SELECT query_id, doc_id, min(tier) AS tier, min(rank) AS rank FROM (SELECT query_id, doc_id, 0 AS tier, rank FROM bk WHERE rank <= 2 UNION ALL SELECT query_id, doc_id, 1, rank FROM f) GROUP BY 1, 2)
 SELECT query_id, doc_id, place FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY tier, rank, doc_id) AS place FROM t) WHERE place <= 5"""
)
def recall_floor(spark: SparkSession, root: str) -> DataFrame:
    """The fused ranking with the first two of the BM25 lane in front."""
    bm = ranking.bm25_topk(spark, root)
    fused = retrieval.top_k(retrieval.fuse([bm, ranking.lexical_overlap_topk(spark, root)]), "query_id", "doc_id", "score", 1000)
    every = bm.where("rank <= 2").select("query_id", "doc_id", F.lit(0).alias("tier"), "rank").union(fused.select("query_id", "doc_id", F.lit(1).alias("tier"), "rank"))
    best = every.groupBy("query_id", "doc_id").agg(F.min("tier").alias("tier"), F.min("rank").alias("rank"))
    return best.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("tier", "rank", "doc_id"))).where("place <= 5").select("query_id", "doc_id", "place")


_W = r"unnest(regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+'))"


@query(
    f"""WITH q AS (SELECT id, t, count(*) AS n FROM (SELECT id, {_W.format('query')} AS t FROM {ITEMS}) GROUP BY 1, 2), a AS (SELECT id, t, count(*) AS n FROM (SELECT id, {_W.format('reference_answer')} AS t FROM {ITEMS}) GROUP BY 1, 2),
 b AS (SELECT coalesce(q.id, a.id) AS id, coalesce(q.n, 0) AS qn, coalesce(a.n, 0) AS an FROM q FULL JOIN a ON q.id = a.id AND q.t = a.t) SELECT id, CAST(sum(least(qn, an)) AS BIGINT) AS shared, round(coalesce(sum(least(qn, an)) / nullif(sum(qn), 0), 0), 6) AS recall, round(coalesce(sum(least(qn, an)) / nullif(sum(an), 0), 0), 6) AS precision FROM b GROUP BY 1"""
)
def token_agreement(spark: SparkSession, root: str) -> DataFrame:
    """Multiset overlap of the words of question and answer."""
    counts = lambda c, n: table(spark, root, ITEMS).select("id", F.explode(T.words(F.col(c))).alias("t")).groupBy("id", "t").agg(F.count(F.lit(1)).alias(n))
    both = counts("query", "qn").join(counts("reference_answer", "an"), ["id", "t"], "full").select("id", F.coalesce("qn", F.lit(0)).alias("qn"), F.coalesce("an", F.lit(0)).alias("an"))
    shared = F.sum(F.least("qn", "an"))
    share = lambda n: F.round(F.coalesce(shared / F.nullif(F.sum(n), F.lit(0)), F.lit(0.0)), 6)
    return both.groupBy("id").agg(shared.alias("shared"), share("qn").alias("recall"), share("an").alias("precision"))


@query(
    "WITH " + ranking._BM25_SQL + r""", q AS (SELECT id AS query_id, lower(trim(regexp_replace(query, '[ \t\r\n]+', ' ', 'g'))) AS quote FROM mbzuai_preprod_answer_completeness_v1 WHERE length(query) >= 20)
 SELECT query_id, min(rank) AS first_rank, round(1 / log2(min(rank) + 1), 6) AS gain FROM bk JOIN q USING (query_id) JOIN documents d USING (doc_id) WHERE contains(lower(trim(regexp_replace(d.text, '[ \t\r\n]+', ' ', 'g'))), quote) GROUP BY 1"""
)
def quote_ranks(spark: SparkSession, root: str) -> DataFrame:
    """The first rank at which a found document quotes the question."""
    quotes = table(spark, root, ITEMS).where(F.length("query") >= 20).select(F.col("id").alias("query_id"), F.lower(T.clean(F.col("query"))).alias("quote"))
    found = ranking.bm25_topk(spark, root).select("query_id", "doc_id", "rank").join(quotes, "query_id").join(table(spark, root, "documents").select("doc_id", "text"), "doc_id")
    hits = found.where(F.contains(F.lower(T.clean(F.col("text"))), F.col("quote")))
    return hits.groupBy("query_id").agg(F.min("rank").alias("first_rank"), F.round(1 / F.log2(F.min("rank") + 1), 6).alias("gain"))


@query(
    """SELECT CASE WHEN freshness IS NULL THEN 'none' WHEN try_strptime(CAST(freshness AS VARCHAR), '%Y%m%d') IS NULL OR freshness < 10000101 THEN 'no_date' WHEN freshness < 20200101 THEN 'old' WHEN freshness > 20261231 THEN 'future' ELSE 'plausible' END AS verdict, count(*) AS entries, min(freshness) AS least, max(freshness) AS most FROM dedup_entry GROUP BY 1"""
)
def freshness_check(spark: SparkSession, root: str) -> DataFrame:
    f = F.col("freshness")
    no_date = F.try_to_date(F.when((f >= 10000101) & (f <= 99991231), f.cast("string")), "yyyyMMdd").isNull()
    verdict = F.when(f.isNull(), "none").when(no_date, "no_date").when(f < 20200101, "old").when(f > 20261231, "future").otherwise("plausible")
    return table(spark, root, "dedup_entry").groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("entries"), F.min("freshness").alias("least"), F.max("freshness").alias("most"))


@query(
    """WITH r AS (SELECT release_id, lane, row_id // 1000 AS block, row_id, octet_length(encode(retrieval_text)) AS bytes FROM embedding_records), c AS (SELECT *, sum(bytes) OVER (PARTITION BY release_id, lane, block ORDER BY row_id) AS upto FROM r)
 SELECT release_id, lane, block, CAST((upto - bytes) // 20000 AS BIGINT) AS batch, count(*) AS records, CAST(sum(bytes) AS BIGINT) AS bytes FROM c GROUP BY 1, 2, 3, 4"""
)
def upsert_batches(spark: SparkSession, root: str) -> DataFrame:
    """Batches that begin anew after every 20,000 bytes, inside blocks of 1,000 row ids, so that no release is summed in one task."""
    records = table(spark, root, "embedding_records").select("release_id", "lane", F.floor(F.col("row_id") / 1000).alias("block"), "row_id", F.octet_length("retrieval_text").alias("bytes"))
    upto = F.sum("bytes").over(Window.partitionBy("release_id", "lane", "block").orderBy("row_id"))
    batch = records.withColumn("batch", F.floor((upto - F.col("bytes")) / 20000))
    return batch.groupBy("release_id", "lane", "block", "batch").agg(F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"))


@query(
    f"""WITH g AS (SELECT id, unnest(gold_chunk_ids) AS record_id FROM {ITEMS}), u AS (SELECT record_id, min(source_url) AS url, count(DISTINCT source_url) AS urls FROM embedding_records GROUP BY 1)
 SELECT g.id, count(*) AS gold, count(u.record_id) AS found, count(u.url) AS with_url, count(DISTINCT u.url) AS distinct_urls FROM g LEFT JOIN u USING (record_id) GROUP BY 1"""
)
def gold_urls(spark: SparkSession, root: str) -> DataFrame:
    gold = table(spark, root, ITEMS).select("id", F.explode("gold_chunk_ids").alias("record_id"))
    urls = table(spark, root, "embedding_records").groupBy("record_id").agg(F.min("source_url").alias("url"), F.lit(1).alias("there"))
    return gold.join(urls, "record_id", "left").groupBy("id").agg(F.count(F.lit(1)).alias("gold"), F.count("there").alias("found"), F.count("url").alias("with_url"), F.count_distinct("url").alias("distinct_urls"))


@query(
    """SELECT lower(trim(title)) AS name, media_type, count(*) AS mentions, min(title) AS first_spelling, count(DISTINCT title) AS spellings, count(DISTINCT document_id) AS documents, max(context_confidence) AS confidence FROM media WHERE trim(coalesce(title, '')) <> '' GROUP BY 1, 2"""
)
def merged_names(spark: SparkSession, root: str) -> DataFrame:
    named = table(spark, root, "media").where("trim(coalesce(title, '')) != ''")
    return named.groupBy(F.lower(F.trim("title")).alias("name"), "media_type").agg(
        F.count(F.lit(1)).alias("mentions"), F.min("title").alias("first_spelling"), F.count_distinct("title").alias("spellings"), F.count_distinct("document_id").alias("documents"), F.max("context_confidence").alias("confidence")
    )


@query(
    r"""SELECT row_id, concat_ws(chr(10), 'TITLE: ' || nullif(trim(metadata['title']), ''), 'LANE: ' || lane, trim(regexp_replace(retrieval_text, '[ \t\r\n]+', ' ', 'g'))) AS embedding_text FROM embedding_records"""
)
def embedding_texts(spark: SparkSession, root: str) -> DataFrame:
    title = F.nullif(F.trim(F.try_element_at("metadata", F.lit("title"))), F.lit(""))
    return table(spark, root, "embedding_records").select("row_id", F.concat_ws("\n", F.concat(F.lit("TITLE: "), title), F.concat(F.lit("LANE: "), "lane"), T.clean(F.col("retrieval_text"))).alias("embedding_text"))
