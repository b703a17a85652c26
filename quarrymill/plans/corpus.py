"""Queries on texts, URLs, records and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.functions import urls as U
from quarrymill.operators import chunking, dedup
from quarrymill.plans.catalog import query
from quarrymill.session import table

_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
_URL_SQL = r"""
parts AS (SELECT *, lower(regexp_extract(trim(u), '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
  lower(regexp_extract(trim(u), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
  regexp_extract(trim(u), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(trim(u), '^[^?#]*\?([^#]*)', 1) AS q FROM src),
normal AS (SELECT *, CASE WHEN scheme IN ('http', 'https') THEN scheme || '://' || regexp_replace(host, ':(80|443)$', '') || regexp_replace(regexp_replace(path, '/{2,}', '/', 'g'), '/+$', '')
  || CASE WHEN len(list_filter(string_split(q, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?i:utm_[^=]*|gclid|fbclid|msclkid|mc_cid|mc_eid)(=|$)'))) > 0
     THEN '?' || array_to_string(list_sort(list_filter(string_split(q, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?i:utm_[^=]*|gclid|fbclid|msclkid|mc_cid|mc_eid)(=|$)'))), '&') ELSE '' END
  ELSE u END AS url FROM parts)"""


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g'))) AS clean_md5, md5(replace(lower(trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g'))), 'ß', 'ss')) AS fold_md5 FROM documents")
def clean_text_normalize(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", F.md5(T.clean(F.col("text"))).alias("clean_md5"), F.md5(T.fold(F.col("text"))).alias("fold_md5"))


@query(r"""SELECT doc_id, CAST(coalesce(list_sum(list_transform(regexp_extract_all(text, '[A-Za-z0-9]+'), lambda x: ceil(length(x) / 4))), 0) + length(regexp_replace(text, '[A-Za-z0-9 \t\r\n]|[^\x00-\x7F]', '', 'g'))
 + strlen(regexp_replace(text, '[\x00-\x7F]', '', 'g')) AS BIGINT) AS tokens FROM documents""")
def token_estimates(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query(f"WITH src AS (SELECT row_id, source_url AS u FROM embedding_records), {_URL_SQL} SELECT row_id, url FROM normal")
def url_normalize(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "embedding_records").select("row_id", U.normalize(F.col("source_url")).alias("url"))


@query(
    f"WITH src AS (SELECT source_url AS u FROM embedding_records WHERE source_url IS NOT NULL), {_URL_SQL}, "
    r"f AS (SELECT regexp_replace(regexp_replace(regexp_replace(url, '\?.*$', ''), '^(https?://[^/]+)/(ar|de|en|es|fr)(/|$)', '\1\3'), '^https?://(www\.)?', '') AS family, u AS url FROM normal) "
    "SELECT family, count(*) AS records, count(DISTINCT url) AS urls, min(url) AS first_url FROM f GROUP BY family HAVING count(DISTINCT url) > 1"
)
def url_family_groups(spark: SparkSession, root: str) -> DataFrame:
    """Families of addresses (without scheme, www, language and query) that are spelt in several ways."""
    family = F.regexp_replace(U.family(F.col("source_url")), r"^https?://(www\.)?", "")
    urls = table(spark, root, "embedding_records").where("source_url is not null").select(family.alias("family"), F.col("source_url").alias("url"))
    # one row a URL first, so that a hot URL is folded on the map side
    folded = urls.groupBy("family", "url").agg(F.count(F.lit(1)).alias("n"))
    return folded.groupBy("family").agg(F.sum("n").alias("records"), F.count(F.lit(1)).alias("urls"), F.min("url").alias("first_url")).where("urls > 1")


@query(
    r"""SELECT coalesce(regexp_replace(lower(regexp_extract(trim(source_url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), ':\d+$', ''), '') AS host,
 CASE WHEN p SIMILAR TO '.*\.pdf' THEN 'pdf' WHEN regexp_matches(p, '/(news|events)(/|$)') THEN 'news_or_event' WHEN regexp_matches(p, '/(apply|admissions?)(/|$)') THEN 'admission'
 WHEN regexp_matches(p, '/(people-and-units|labs)(/|$)') THEN 'unit' WHEN regexp_matches(p, '/(study|research)(/|$)') THEN 'study_or_research' WHEN p IN ('', '/') THEN 'home' ELSE 'page' END AS page_type,
 coalesce(nullif(regexp_extract(p0, '^/(ar|de|en|es|fr)(?:/|$)', 1), ''), 'none') AS path_language, count(*) AS records
 FROM (SELECT source_url, coalesce(regexp_extract(trim(source_url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '') AS p0, lower(p0) AS p FROM embedding_records) GROUP BY 1, 2, 3"""
)
def page_type_counts(spark: SparkSession, root: str) -> DataFrame:
    u = F.col("source_url")
    return table(spark, root, "embedding_records").groupBy(U.host(u).alias("host"), U.page_type(u).alias("page_type"), F.coalesce(U.path_language(u), F.lit("none")).alias("path_language")).agg(F.count(F.lit(1)).alias("records"))


@query(
    """WITH u AS (SELECT DISTINCT release_id, source_url AS url FROM embedding_records WHERE source_url IS NOT NULL), b AS (SELECT release_id, substr(sha256(url), 1, 3) AS bucket, sha256(string_agg(url, chr(10) ORDER BY url)) AS digest, count(*) AS n FROM u GROUP BY 1, 2)
 SELECT release_id, sha256(string_agg(digest, chr(10) ORDER BY bucket)) AS digest, CAST(sum(n) AS BIGINT) AS urls FROM b GROUP BY 1"""
)
def url_set_digest(spark: SparkSession, root: str) -> DataFrame:
    """A digest of each release's set of URLs in two levels: 4,096 buckets by hash, so that no task holds a whole release."""
    urls = table(spark, root, "embedding_records").where("source_url is not null").select("release_id", F.col("source_url").alias("url")).distinct()
    buckets = urls.groupBy("release_id", F.substring(F.sha2("url", 256), 1, 3).alias("bucket")).agg(F.array_sort(F.collect_list("url")).alias("u"))
    digests = buckets.select("release_id", F.struct("bucket", F.sha2(F.array_join("u", "\n"), 256).alias("digest")).alias("d"), F.size("u").alias("n"))
    whole = digests.groupBy("release_id").agg(F.array_sort(F.collect_list("d")).alias("d"), F.sum("n").alias("urls"))  # at most 4,096 digests
    return whole.select("release_id", F.sha2(F.array_join("d.digest", "\n"), 256).alias("digest"), "urls")


@query(
    rf"""SELECT coalesce(source, 'none') AS source, CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty' WHEN length(trim(text)) < 100 THEN 'too_short' WHEN len({_WORDS.format('text')}) < 5 THEN 'few_words' ELSE 'accepted' END AS reason,
 count(*) AS documents FROM documents GROUP BY 1, 2"""
)
def quality_reason_codes(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    reason = F.when(F.col("text").isNull() | (F.trim("text") == ""), "empty").when(F.length(F.trim("text")) < 100, "too_short").when(F.size(T.words(F.col("text"))) < 5, "few_words").otherwise("accepted")
    return docs.groupBy(F.coalesce("source", F.lit("none")).alias("source"), reason.alias("reason")).agg(F.count(F.lit(1)).alias("documents"))


@query(
    """SELECT count(*) AS records, count(*) FILTER (WHERE length(trim(retrieval_text)) >= 100) AS accepted, round(count(*) FILTER (WHERE length(trim(retrieval_text)) >= 100) / count(*), 6) AS retention,
 round(count(*) FILTER (WHERE source_url IS NULL) / count(*), 6) AS without_url, CASE WHEN count(*) FILTER (WHERE length(trim(retrieval_text)) >= 100) / count(*) < 0.5 THEN 'retention' ELSE 'passed' END AS verdict FROM embedding_records"""
)
def quality_gate_summary(spark: SparkSession, root: str) -> DataFrame:
    kept = F.count_if(F.length(F.trim("retrieval_text")) >= 100)
    every = F.count(F.lit(1))
    return table(spark, root, "embedding_records").agg(
        every.alias("records"), kept.alias("accepted"), F.round(kept / every, 6).alias("retention"), F.round(F.count_if(F.col("source_url").isNull()) / every, 6).alias("without_url"),
        F.when(kept / every < 0.5, "retention").otherwise("passed").alias("verdict"),
    )


@query(
    r"""SELECT host, records, usable, round(usable / records, 6) AS retention FROM (SELECT regexp_replace(lower(regexp_extract(trim(source_url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), ':\d+$', '') AS host, count(*) AS records,
 count(*) FILTER (WHERE embedding IS NOT NULL AND len(embedding) = 64) AS usable FROM embedding_records WHERE source_url IS NOT NULL GROUP BY 1) WHERE records >= 5"""
)
def host_retention(spark: SparkSession, root: str) -> DataFrame:
    records = table(spark, root, "embedding_records").where("source_url is not null")
    counted = records.groupBy(U.host(F.col("source_url")).alias("host")).agg(F.count(F.lit(1)).alias("records"), F.count_if(F.size("embedding") == 64).alias("usable"))
    return counted.where("records >= 5").select("host", "records", "usable", F.round(F.col("usable") / F.col("records"), 6).alias("retention"))


@query(
    r"""SELECT doc_id, count(*) FILTER (WHERE regexp_matches(l, '^#{1,6}\s')) AS headings, count(*) FILTER (WHERE regexp_matches(l, '^\s*([-*+]|\d+[.)])\s')) AS items, count(*) FILTER (WHERE trim(l) <> '') AS lines
 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) GROUP BY doc_id"""
)
def markdown_line_kinds(spark: SparkSession, root: str) -> DataFrame:
    lines = F.split("text", "\n")
    n = lambda test: F.size(F.filter(lines, test)).cast("bigint")
    return table(spark, root, "documents").where("text is not null").select("doc_id", n(lambda x: x.rlike(r"^#{1,6}\s")).alias("headings"), n(lambda x: x.rlike(r"^\s*([-*+]|\d+[.)])\s")).alias("items"), n(lambda x: F.trim(x) != "").alias("lines"))


@query(
    """SELECT media_type, count(*) AS items, count(*) FILTER (WHERE coalesce(trim(caption), '') = '' AND coalesce(trim(description), '') = '') AS silent, count(*) FILTER (WHERE width <= 0 OR height <= 0) AS flat,
 count(*) FILTER (WHERE width > 0 AND height > 0 AND (width / height > 5 OR height / width > 5)) AS extreme FROM media GROUP BY media_type"""
)
def media_signal_counts(spark: SparkSession, root: str) -> DataFrame:
    empty = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    w, h = F.col("width"), F.col("height")
    return table(spark, root, "media").groupBy("media_type").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(empty("caption") & empty("description")).alias("silent"), F.count_if((w <= 0) | (h <= 0)).alias("flat"),
        F.count_if((w > 0) & (h > 0) & ((w / F.nullif(h, F.lit(0)) > 5) | (h / F.nullif(w, F.lit(0)) > 5))).alias("extreme"),
    )


@query(
    r"""SELECT sha256(replace(lower(trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g'))), 'ß', 'ss')) AS content_hash, min(doc_id) AS winner, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1"""
)
def exact_dedup_winners(spark: SparkSession, root: str) -> DataFrame:
    return dedup.exact_groups(table(spark, root, "documents"), "doc_id", "text")


_SETS_SQL = r"""
WITH t AS (SELECT min(row_id) AS id, retrieval_text AS text FROM embedding_records WHERE retrieval_text IS NOT NULL GROUP BY 2),
w AS (SELECT id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM t),
s AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w WHERE len(w) > 0),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
p AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.id < y.id GROUP BY 1, 2)"""


@query(_SETS_SQL + " SELECT a, b, round(c / (na.n + nb.n - c), 6) AS similarity FROM p JOIN n na ON na.id = a JOIN n nb ON nb.id = b WHERE c / (na.n + nb.n - c) >= 0.8")
def near_duplicate_pairs(spark: SparkSession, root: str) -> DataFrame:
    pairs, _ = dedup.near_duplicates(table(spark, root, "embedding_records"), "row_id", "retrieval_text")
    return pairs.select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("SELECT row_id AS id, min(row_id) OVER (PARTITION BY retrieval_text) AS representative FROM embedding_records WHERE retrieval_text IS NOT NULL")
def near_duplicate_members(spark: SparkSession, root: str) -> DataFrame:
    return dedup.near_duplicates(table(spark, root, "embedding_records"), "row_id", "retrieval_text")[1]


@query(
    _SETS_SQL.replace("WITH t", "WITH RECURSIVE t") + """, l AS (SELECT a, b FROM p JOIN n na ON na.id = a JOIN n nb ON nb.id = b WHERE c / (na.n + nb.n - c) >= 0.8), u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
 r AS (SELECT id, id AS c FROM t UNION SELECT r.id, u.b FROM r JOIN u ON r.c = u.a), k AS (SELECT id, min(c) AS component FROM r GROUP BY id)
 SELECT e.row_id AS id, t.id AS representative, component FROM embedding_records e JOIN t ON e.retrieval_text = t.text JOIN k ON k.id = t.id"""
)
def near_duplicate_components(spark: SparkSession, root: str) -> DataFrame:
    pairs, members = dedup.near_duplicates(table(spark, root, "embedding_records"), "row_id", "retrieval_text")
    reps = members.select(F.col("representative").alias("id")).distinct()
    found = dedup.components(reps, pairs.select("a", "b"))
    return members.join(found.withColumnRenamed("id", "representative"), "representative").select("id", "representative", "component")


@query(
    "SELECT release_id, lane, record_id, count(*) AS deliveries, count(DISTINCT content_sha256) AS hashes, count(DISTINCT md5(retrieval_text)) AS texts FROM embedding_records GROUP BY 1, 2, 3 HAVING count(*) > 1"
)
def redelivered_records(spark: SparkSession, root: str) -> DataFrame:
    records = table(spark, root, "embedding_records").groupBy("release_id", "lane", "record_id")
    return records.agg(F.count(F.lit(1)).alias("deliveries"), F.count_distinct("content_sha256").alias("hashes"), F.count_distinct(F.md5("retrieval_text")).alias("texts")).where("deliveries > 1")


@query(
    """SELECT row_id, release_id, lane, record_id, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY release_id, lane, record_id ORDER BY updated_at DESC NULLS LAST, row_id DESC) AS r FROM embedding_records) WHERE r = 1"""
)
def latest_upsert(spark: SparkSession, root: str) -> DataFrame:
    records = table(spark, root, "embedding_records").select("row_id", "release_id", "lane", "record_id", "updated_at")
    return dedup.survivors(records, ["release_id", "lane", "record_id"], F.desc_nulls_last("updated_at"), F.desc("row_id"))


@query("SELECT row_id, content_sha256 IS NOT NULL AND content_sha256 = sha256(retrieval_text) AS fresh FROM embedding_records")
def content_hash_check(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "embedding_records").select("row_id", (F.col("content_sha256").isNotNull() & F.coalesce(F.col("content_sha256") == F.sha2("retrieval_text", 256), F.lit(False))).alias("fresh"))


@query(
    """SELECT media_type, url, count(*) AS occurrences, count(DISTINCT document_id) AS documents, min(page_number) AS first_page, min(id) AS first_id FROM media GROUP BY media_type, url"""
)
def media_assets(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "media").groupBy("media_type", "url").agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct("document_id").alias("documents"), F.min("page_number").alias("first_page"), F.min("id").alias("first_id"))


@query(
    """SELECT content_hash, id FROM (SELECT content_hash, id, row_number() OVER (PARTITION BY content_hash ORDER BY length(coalesce(caption, '')) + length(coalesce(description, '')) + length(coalesce(alt, '')) DESC, id) AS r
 FROM (SELECT DISTINCT content_hash, id, caption, description, alt FROM media WHERE content_hash IS NOT NULL)) WHERE r = 1"""
)
def richest_media_reference(spark: SparkSession, root: str) -> DataFrame:
    size = lambda c: F.length(F.coalesce(c, F.lit("")))
    media = table(spark, root, "media").where("content_hash is not null")
    return dedup.survivors(media, ["content_hash"], F.desc(size("caption") + size("description") + size("alt")), F.col("id")).select("content_hash", "id")


@query(
    """WITH h AS (SELECT perceptual_hash AS h, count(DISTINCT url) AS assets FROM media WHERE regexp_matches(perceptual_hash, '^[0-9a-f]{16}$') GROUP BY 1), v AS (SELECT h, assets, ('0x' || h)::UBIGINT AS v FROM h),
 p AS (SELECT x.h AS h, count(*) AS near FROM v x JOIN v y ON x.h <> y.h AND bit_count(xor(x.v, y.v)::BIT::VARCHAR::BIT) <= 2 GROUP BY 1) SELECT v.h AS perceptual_hash, assets, coalesce(near, 0) AS near_hashes FROM v LEFT JOIN p ON v.h = p.h"""
)
def perceptual_groups(spark: SparkSession, root: str) -> DataFrame:
    """Assets that look alike: those of the same hash, and how many other hashes are within two bits."""
    media = table(spark, root, "media").where(F.col("perceptual_hash").rlike("^[0-9a-f]{16}$"))
    pairs = dedup.hamming_pairs(media, "id", "perceptual_hash", 2)
    near = pairs.select("a").union(pairs.select("b")).groupBy(F.col("a").alias("perceptual_hash")).agg(F.count(F.lit(1)).alias("near"))
    return media.groupBy("perceptual_hash").agg(F.count_distinct("url").alias("assets")).join(near, "perceptual_hash", "left").select("perceptual_hash", "assets", F.coalesce("near", F.lit(0)).alias("near_hashes"))


@query(
    rf"""WITH w AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents), c AS (SELECT doc_id, w, unnest(range(0, greatest(CAST(ceil((len(w) - 80) / 370) AS BIGINT) - 1, 0) + 1)) AS i FROM w WHERE len(w) > 0)
 SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CAST(i * 370 AS INTEGER) AS first_word, CAST(len(w[i * 370 + 1 : i * 370 + 450]) AS INTEGER) AS chunk_words, md5(array_to_string(w[i * 370 + 1 : i * 370 + 450], ' ')) AS chunk_md5 FROM c"""
)
def fixed_word_windows(spark: SparkSession, root: str) -> DataFrame:
    cut = chunking.word_windows(table(spark, root, "documents"), "doc_id", "text")
    return cut.select("doc_id", "chunk_index", "first_word", "chunk_words", F.md5("chunk").alias("chunk_md5"))


@query()
def markdown_chunks(spark: SparkSession, root: str) -> DataFrame:
    return chunking.markdown_chunks(table(spark, root, "documents"), "doc_id", "text")


@query(
    r"""SELECT doc_id, len(s) AS sentences, CAST(coalesce(list_max(list_transform(s, lambda x: length(x))), 0) AS BIGINT) AS longest, coalesce(md5(s[1]), '') AS first_md5 FROM (SELECT doc_id,
 list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([.!?؟])[ \t]+', '\1' || chr(10), 'g'), '[\r\n]+'), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents WHERE text IS NOT NULL)"""
)
def sentence_split(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "documents").where("text is not null").select("doc_id", T.sentences(F.col("text")).alias("s"))
    longest = F.coalesce(F.array_max(F.transform("s", F.length)), F.lit(0)).cast("bigint")
    return s.select("doc_id", F.size("s").cast("bigint").alias("sentences"), longest.alias("longest"), F.coalesce(F.md5(F.get("s", F.lit(0))), F.lit("")).alias("first_md5"))


@query(
    r"""WITH l AS (SELECT doc_id, CAST(i AS INTEGER) AS line_no, lines[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL) WHERE trim(lines[i]) <> ''),
 m AS (SELECT *, CAST(length(regexp_extract(line, '^(#{1,6})\s', 1)) AS INTEGER) AS level, trim(regexp_replace(line, '^#{1,6}\s+', '')) AS title FROM l),
 p AS (SELECT *, last_value(CASE WHEN level = 1 THEN title END IGNORE NULLS) OVER w AS h1, last_value(CASE WHEN level = 2 THEN title WHEN level = 1 THEN '' END IGNORE NULLS) OVER w AS h2 FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
 SELECT doc_id, line_no, level, CASE WHEN level > 0 THEN title END AS heading, concat_ws(' > ', h1, nullif(h2, '')) AS section FROM p"""
)
def section_paths(spark: SparkSession, root: str) -> DataFrame:
    return chunking.heading_lines(table(spark, root, "documents"), "doc_id", "text")


@query(
    """SELECT media_id, lag(media_id) OVER w AS previous, lead(media_id) OVER w AS next FROM (SELECT DISTINCT document_id, media_id, page_number FROM corpus_merge_formatter WHERE page_number IS NOT NULL) WINDOW w AS (PARTITION BY document_id ORDER BY page_number, media_id)"""
)
def neighbour_pages(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "corpus_merge_formatter").where("page_number is not null").select("document_id", "media_id", "page_number").distinct()
    pages = pages.withColumn("place", F.struct("page_number", "media_id"))
    return chunking.neighbours(pages, "document_id", "place", "media_id").select("media_id", "previous", "next")


@query(
    """SELECT document_id, count(DISTINCT media_id) AS pages, count(*) - count(DISTINCT media_id) AS repeats, min(page_number) AS first_page, max(page_number) AS last_page, count(*) FILTER (WHERE page_number IS NULL) AS unnumbered,
 CAST(sum(length(coalesce(ocr_text, ''))) AS BIGINT) AS characters FROM corpus_merge_formatter GROUP BY document_id"""
)
def scan_rollup(spark: SparkSession, root: str) -> DataFrame:
    pages = F.count_distinct("media_id")
    return table(spark, root, "corpus_merge_formatter").groupBy("document_id").agg(
        pages.alias("pages"), (F.count(F.lit(1)) - pages).alias("repeats"), F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"),
        F.count_if(F.col("page_number").isNull()).alias("unnumbered"), F.sum(F.length(F.coalesce("ocr_text", F.lit("")))).alias("characters"),
    )


@query(
    r"""SELECT DISTINCT doc_id, 'bullet' AS kind, left(trim(regexp_replace(l, '^\s*[-*]\s+', '')), 360) AS snippet FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE regexp_matches(l, '^\s*[-*]\s+\S') AND length(trim(regexp_replace(l, '^\s*[-*]\s+', ''))) BETWEEN 40 AND 360"""
)
def fact_snippets(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("l")).where(F.col("l").rlike(r"^\s*[-*]\s+\S"))
    body = F.trim(F.regexp_replace("l", r"^\s*[-*]\s+", ""))
    return lines.where(F.length(body).between(40, 360)).select("doc_id", F.lit("bullet").alias("kind"), body.alias("snippet")).distinct()


@query(
    r"""WITH l AS (SELECT DISTINCT doc_id, regexp_replace(trim(l), '\d+', '0', 'g') AS signature FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents WHERE text IS NOT NULL) WHERE trim(l) <> '')
 SELECT signature, count(*) AS documents FROM l GROUP BY signature HAVING count(*) >= greatest(20, ceil(0.01 * (SELECT count(*) FROM documents)))"""
)
def template_signatures(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    least = max(20, -(-docs.count() // 100))
    signed = docs.where("text is not null").select("doc_id", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.regexp_replace(F.trim(x), r"\d+", "0")))).alias("signature")).where("signature != ''")
    return signed.groupBy("signature").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") >= least)


@query(
    r"""SELECT doc_id, lower(m) AS email FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')) AS m FROM documents)"""
)
def contact_matches(spark: SparkSession, root: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), F.lit(0))
    return table(spark, root, "documents").select("doc_id", F.explode(F.array_distinct(found)).alias("m")).select("doc_id", F.lower("m").alias("email"))


@query(
    """SELECT record_id, count(DISTINCT word_count) AS counts, count(*) AS entries, max(freshness) AS freshest, CASE WHEN count(DISTINCT word_count) > 1 THEN 'conflict' WHEN max(word_count) IS NULL THEN 'missing' WHEN max(word_count) <= 0 THEN 'impossible' ELSE 'single' END AS verdict
 FROM dedup_entry GROUP BY record_id"""
)
def entry_conflicts(spark: SparkSession, root: str) -> DataFrame:
    counts = F.count_distinct("word_count")
    return table(spark, root, "dedup_entry").groupBy("record_id").agg(
        counts.alias("counts"), F.count(F.lit(1)).alias("entries"), F.max("freshness").alias("freshest"),
        F.when(counts > 1, "conflict").when(F.max("word_count").isNull(), "missing").when(F.max("word_count") <= 0, "impossible").otherwise("single").alias("verdict"),
    )


@query(
    """SELECT path, record_id, freshness FROM (SELECT *, row_number() OVER (PARTITION BY normalized_content_hash ORDER BY freshness DESC NULLS LAST, normalized_character_count DESC NULLS LAST, path, record_id) AS r FROM
 (SELECT DISTINCT path, record_id, freshness, normalized_content_hash, normalized_character_count FROM dedup_entry WHERE normalized_content_hash IS NOT NULL)) WHERE r = 1"""
)
def representative_entries(spark: SparkSession, root: str) -> DataFrame:
    entries = table(spark, root, "dedup_entry").where("normalized_content_hash is not null").select("path", "record_id", "freshness", "normalized_content_hash", "normalized_character_count").distinct()
    return dedup.survivors(entries, ["normalized_content_hash"], F.desc_nulls_last("freshness"), F.desc_nulls_last("normalized_character_count"), F.col("path"), F.col("record_id")).select("path", "record_id", "freshness")


@query(
    """SELECT d.path, d.record_id, count(e.row_id) AS records FROM (SELECT DISTINCT path, record_id FROM dedup_entry) d LEFT JOIN embedding_records e ON d.record_id = e.record_id GROUP BY 1, 2"""
)
def entry_records(spark: SparkSession, root: str) -> DataFrame:
    entries = table(spark, root, "dedup_entry").select("path", "record_id").distinct()
    counted = table(spark, root, "embedding_records").groupBy("record_id").agg(F.count(F.lit(1)).alias("records"))  # before the join: a hot record is one row
    return entries.join(counted, "record_id", "left").select("path", "record_id", F.coalesce("records", F.lit(0)).alias("records"))


@query("SELECT doc_id, substr(sha1(concat_ws('|', nullif(coalesce(path, ''), ''), nullif(coalesce(source_url, ''), ''))), 1, 16) AS document_id FROM documents")
def stable_document_ids(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", T.stable_id(16, F.col("path"), F.col("source_url")).alias("document_id"))


@query("SELECT doc_id, round(('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 12))::BIGINT / 281474976710656, 9) AS fraction FROM documents WHERE ('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 12))::BIGINT / 281474976710656 < 0.1")
def stable_sample(spark: SparkSession, root: str) -> DataFrame:
    fraction = T.stable_fraction(F.col("doc_id"))
    return table(spark, root, "documents").where(fraction < 0.1).select("doc_id", F.round(fraction, 9).alias("fraction"))


@query(
    """WITH p AS (SELECT document_id, media_id, length(coalesce(ocr_text, '')) AS n, row_number() OVER (PARTITION BY document_id ORDER BY page_number NULLS LAST, media_id, md5(coalesce(ocr_text, ''))) AS r FROM corpus_merge_formatter)
 SELECT document_id, media_id, r AS place, CAST(sum(n) OVER (PARTITION BY document_id ORDER BY r) AS BIGINT) AS characters FROM p QUALIFY sum(n) OVER (PARTITION BY document_id ORDER BY r) <= 4000"""
)
def budget_pack(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "corpus_merge_formatter")
    order = Window.partitionBy("document_id").orderBy(F.asc_nulls_last("page_number"), "media_id", F.md5(F.coalesce("ocr_text", F.lit(""))))
    ranked = pages.select("document_id", "media_id", F.length(F.coalesce("ocr_text", F.lit(""))).alias("n"), F.row_number().over(order).alias("place"))
    running = F.sum("n").over(Window.partitionBy("document_id").orderBy("place"))
    return ranked.select("document_id", "media_id", F.col("place").cast("bigint").alias("place"), running.alias("characters")).where("characters <= 4000")


@query()
def sentence_spans(spark: SparkSession, root: str) -> DataFrame:
    """Spans of up to four sentences; a fold over sentences has no SQL twin, a test compares it with a plain loop."""
    return chunking.sentence_windows(table(spark, root, "documents"), "doc_id", "text")
