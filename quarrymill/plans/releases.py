"""Queries on merging runs, assembling and checking releases, identities of duplicates, and the graphs behind them, each stated once for both engines."""

from __future__ import annotations

from quarrymill.plans.dialect import ITEMS, Duck, stated

_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
_STALE = "^(.*[^a-z])?(old|archive|archived|legacy|deprecated|draft)([^a-z].*)?$"


@stated("documents")
def shingle_fingerprints(d: Duck) -> str:
    """Number of a text's different five-word runs, and the least of their fingerprints."""
    runs = d.unique(d.map(d.upto("1", f"{d.size('w')} - 4"), "i", d.join(d.slice("w", 1, 5).replace("w[1:5]", "w[i:i + 4]").replace("slice(w, 1, 5)", "slice(w, i, 5)"))))
    return f"SELECT doc_id, {d.size('f')} AS shingles, {'array_min' if d.spark else 'list_min'}({d.map('f', 'x', 'md5(x)')}) AS least FROM (SELECT doc_id, {runs} AS f FROM (SELECT doc_id, {d.words('text')} AS w FROM documents WHERE text IS NOT NULL) AS a) AS b"


_ENTRIES = "e AS (SELECT path, record_id, source_url, raw_content_hash AS raw, coalesce(lower(source_url), normalized_content_hash) AS h, max(normalized_character_count) AS chars, max(word_count) AS words, max(freshness) AS freshness FROM dedup_entry GROUP BY 1, 2, 3, 4, 5)"


def _ranked(d: Duck) -> str:
    url = f"lower(coalesce({d.cut('source_url', _PATH)}, ''))"
    opaque, stale = d.has(url, "/(node|content|page)/[0-9]+/?$|/[0-9]+/?$"), d.has("lower(coalesce(source_url, ''))", _STALE)
    order = f"CASE WHEN {opaque} THEN 1 ELSE 0 END, CASE WHEN {stale} THEN 1 ELSE 0 END, coalesce(freshness, 0) DESC, coalesce(chars, 0) DESC, coalesce(source_url, path), path, record_id, coalesce(raw, '')"
    return f"r AS (SELECT e.*, row_number() OVER (PARTITION BY h ORDER BY {order}) AS place FROM e)"


@stated("dedup_entry")
def representative_ranking(d: Duck) -> str:
    """Entries of one address, or else of equal content, in the order in which they may represent it: readable address, not outdated, fresh, long, then by address."""
    return f"WITH {_ENTRIES}, {_ranked(d)} SELECT path, record_id, h AS content, place FROM r"


@stated("dedup_entry")
def duplicate_identity(d: Duck) -> str:
    """Whether an entry may be folded into the representative of its address or content: the same source bytes, the same page in the same language, or a long text under another route."""
    family = lambda c: d.sub(d.sub(f"lower(coalesce({c}, ''))", r"[?#].*$"), "^([a-z]+://[^/]+)/(ar|de|en|es|fr)(/|$)", "$1$3")
    lang = lambda c: d.cut(f"lower(coalesce({c}, ''))", "^[a-z]+://[^/]+/(ar|de|en|es|fr)(/|$)")
    return f"""WITH {_ENTRIES}, {_ranked(d)}, w AS (SELECT h, path AS wp, raw AS wr, source_url AS wu, chars AS wc, words AS ww FROM r WHERE place = 1)
 SELECT path, record_id, wp AS winner, CASE WHEN raw = wr THEN 'same_bytes' WHEN source_url IS NOT NULL AND {family('source_url')} = {family('wu')} AND {lang('source_url')} = {lang('wu')} THEN 'same_page' WHEN least(chars, wc) >= 160 AND least(words, ww) >= 20 AND {lang('source_url')} = {lang('wu')} THEN 'other_route' ELSE 'refused' END AS reason FROM r JOIN w USING (h) WHERE place > 1"""


@stated("dedup_entry", "embedding_records")
def rebound_records(d: Duck) -> str:
    """Records whose entry lost to another one, with the record that stands for them now."""
    return f"""WITH {_ENTRIES}, {_ranked(d)}, m AS (SELECT l.record_id AS loser, min(w.record_id) AS winner FROM r AS l JOIN r AS w ON l.h = w.h AND w.place = 1 WHERE l.place > 1 AND l.record_id <> w.record_id GROUP BY 1)
 SELECT row_id, record_id, coalesce(winner, record_id) AS bound_to FROM embedding_records LEFT JOIN m ON record_id = loser WHERE lane = 'parents'"""


@stated("embedding_records")
def run_union(d: Duck) -> str:
    """Records of all releases as one corpus: equal ones fold, an id with different texts is a conflict."""
    return f"""SELECT lane, record_id, count(DISTINCT release_id) AS runs, count(DISTINCT md5(retrieval_text)) AS variants, min(md5(retrieval_text)) AS first_md5, CASE WHEN count(DISTINCT md5(retrieval_text)) > 1 THEN 'conflict' WHEN count(DISTINCT release_id) > 1 THEN 'carried' ELSE 'single' END AS state FROM embedding_records GROUP BY 1, 2"""


@stated("embedding_records", "releases", ITEMS)
def assembled_references(d: Duck) -> str:
    """References of the evaluation items remapped to the active release: by the same id, else by the same text under another id, else lost."""
    return f"""WITH a AS (SELECT DISTINCT record_id, md5(retrieval_text) AS h FROM embedding_records JOIN releases USING (release_id) WHERE status = 'active'), o AS (SELECT record_id, min(md5(retrieval_text)) AS h FROM embedding_records GROUP BY 1),
 t AS (SELECT h, min(record_id) AS record_id FROM a GROUP BY 1), g AS (SELECT DISTINCT id, gold FROM (SELECT id, {d.each('gold_chunk_ids')} AS gold FROM {ITEMS}) AS x)
 SELECT g.id, gold, coalesce(s.record_id, t.record_id) AS mapped, CASE WHEN s.record_id IS NOT NULL THEN 'same_id' WHEN t.record_id IS NOT NULL THEN 'same_text' ELSE 'lost' END AS how FROM g LEFT JOIN (SELECT DISTINCT record_id FROM a) AS s ON gold = s.record_id LEFT JOIN o ON gold = o.record_id LEFT JOIN t ON o.h = t.h"""


@stated("embedding_records", "releases")
def migration_counts(d: Duck) -> str:
    """Each release against the one before it in its project: lanes may not lose records."""
    return """WITH r AS (SELECT release_id, project_name, lag(release_id) OVER (PARTITION BY project_name ORDER BY created_at, release_id) AS before FROM releases), c AS (SELECT release_id, lane, count(DISTINCT record_id) AS n FROM embedding_records GROUP BY 1, 2)
 SELECT r.release_id, o.lane, o.n AS before_n, coalesce(c.n, 0) AS after_n, coalesce(c.n, 0) >= o.n AS kept FROM r JOIN c AS o ON o.release_id = r.before LEFT JOIN c ON c.release_id = r.release_id AND c.lane = o.lane"""


@stated("releases")
def contract_issues(d: Duck) -> str:
    """How many release manifests break a rule: malformed digests, times out of order, states without their time, wrong dimensions."""
    rule = lambda name, test: f"SELECT '{name}' AS rule, count(*) AS releases, count(*) FILTER (WHERE {test}) AS broken FROM releases"
    return " UNION ALL ".join(
        [
            rule("contract_digest", f"contract_sha256 IS NULL OR NOT {d.has('contract_sha256', '^[0-9a-f]{64}$')}"),
            rule("artifact_digest", f"{d.size(d.keep('map_values(artifact_hashes)', 'x', 'NOT ' + d.has('x', '^[0-9a-f]{64}$')))} > 0"),
            rule("ready_before_created", "ready_at < created_at"),
            rule("active_before_ready", "activated_at IS NOT NULL AND (ready_at IS NULL OR activated_at < ready_at)"),
            rule("active_without_time", "status = 'active' AND activated_at IS NULL"),
            rule("dimensions", "embedding_dimensions IS NULL OR embedding_dimensions <> 64"),
            rule("metric", "distance_metric IS NULL OR distance_metric NOT IN ('cosine', 'dot', 'l2')"),
        ]
    )


@stated("releases", "embedding_records")
def contract_fingerprints(d: Duck) -> str:
    """One digest of a release's settings: its sorted artifact digests and counts with the model and its size."""
    kind = "STRING" if d.spark else "VARCHAR"
    pairs = lambda c: d.stack(d.ordered(d.map(d.entries(c), "e", f"concat(e.key, '=', CAST(e.value AS {kind}))")))
    whole = f"concat_ws('|', embedding_model, CAST(embedding_dimensions AS {kind}), {pairs('artifact_hashes')}, {pairs('expected_counts')})"
    return f"SELECT release_id, {d.sha256(whole)} AS fingerprint FROM releases"


@stated("documents")
def cohort_evidence(d: Duck) -> str:
    """Members, digest of their addresses and counts by state of each source, whose states must add up."""
    return f"""WITH m AS (SELECT coalesce(source, 'none') AS source, source_url, CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty' WHEN length(text) < 400 THEN 'short' ELSE 'full' END AS state FROM documents)
 SELECT source, count(*) AS members, count(DISTINCT source_url) AS addresses, md5({d.stack(d.gathered(d.sub('md5(source_url)', '^(....).*$', '$1')))}) AS digest, count(*) FILTER (WHERE state = 'empty') AS empty, count(*) FILTER (WHERE state = 'short') AS short, count(*) FILTER (WHERE state = 'full') AS whole,
 count(*) FILTER (WHERE state = 'empty') + count(*) FILTER (WHERE state = 'short') + count(*) FILTER (WHERE state = 'full') = count(*) AS reconciled FROM m GROUP BY source"""


@stated("embedding_records", "media", "documents")
def content_graph(d: Duck) -> str:
    """The deterministic graph of the corpus, as counts of nodes and edges by type: websites, pages, records and media with HAS and NEXT edges."""
    host = d.cut("lower(trim(source_url))", "^[a-z][a-z0-9+.-]*://([^/?#]*)")
    return f"""WITH p AS (SELECT DISTINCT source_url, {host} AS host FROM embedding_records WHERE source_url IS NOT NULL), r AS (SELECT record_id, lane, min(source_url) AS source_url FROM embedding_records GROUP BY 1, 2), m AS (SELECT id, min(source_url) AS source_url FROM media GROUP BY id),
 n AS (SELECT source_url, count(*) AS k FROM r WHERE lane = 'chunks' AND source_url IS NOT NULL GROUP BY 1)
 SELECT 'node' AS what, 'website' AS kind, count(DISTINCT host) AS n FROM p UNION ALL SELECT 'node', 'page', count(*) FROM p UNION ALL SELECT 'node', lane, count(*) FROM r GROUP BY lane UNION ALL SELECT 'node', 'media_item', count(*) FROM m
 UNION ALL SELECT 'edge', 'WEBSITE_HAS_PAGE', count(*) FROM p UNION ALL SELECT 'edge', concat('PAGE_HAS_', upper(lane)), count(*) FROM r WHERE source_url IS NOT NULL GROUP BY lane UNION ALL SELECT 'edge', 'PAGE_HAS_MEDIA', count(*) FROM m JOIN p USING (source_url) UNION ALL SELECT 'edge', 'NEXT_CHUNK', CAST(sum(k - 1) AS BIGINT) FROM n"""


_MENTIONS = "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"


@stated("documents")
def entity_projection(d: Duck) -> str:
    """Entities (mail addresses) joined over the documents that mention both as subject and object, for documents with at most twenty of them."""
    return f"""WITH m AS (SELECT DISTINCT doc_id, lower(e) AS entity FROM (SELECT doc_id, {d.each(d.every('text', _MENTIONS))} AS e FROM documents WHERE text IS NOT NULL) AS x), n AS (SELECT doc_id, count(*) AS k FROM m GROUP BY 1), b AS (SELECT m.doc_id, entity FROM m JOIN n ON m.doc_id = n.doc_id WHERE k <= 20)
 SELECT s.entity AS subject, o.entity AS object, count(*) AS assertions, min(s.doc_id) AS first_doc FROM b AS s JOIN b AS o ON s.doc_id = o.doc_id AND s.entity < o.entity GROUP BY 1, 2"""


@stated("documents")
def semantic_graph(d: Duck) -> str:
    """The promoted layer over documents: entities of at least two mentions, their domains, mention and membership edges, as counts, with colliding ids."""
    return f"""WITH m AS (SELECT DISTINCT doc_id, lower(e) AS entity FROM (SELECT doc_id, {d.each(d.every('text', _MENTIONS))} AS e FROM documents WHERE text IS NOT NULL) AS x), a AS (SELECT entity, {d.cut('entity', '@(.*)$')} AS domain, count(*) AS n FROM m GROUP BY 1, 2 HAVING count(*) >= 2),
 k AS (SELECT substr(sha1(entity), 1, 16) AS id, count(*) AS n FROM a GROUP BY 1)
 SELECT 'entity' AS kind, count(*) AS n FROM a UNION ALL SELECT 'domain', count(DISTINCT domain) FROM a UNION ALL SELECT 'CHUNK_MENTIONS_ENTITY', CAST(coalesce(sum(n), 0) AS BIGINT) FROM a UNION ALL SELECT 'IN_DOMAIN', count(*) FROM a UNION ALL SELECT 'colliding_id', count(*) FILTER (WHERE n > 1) FROM k"""


@stated("media")
def merged_links(d: Duck) -> str:
    """Links from pages to media folded by both ends: types and captions as sorted sets, the least of single values."""
    return f"SELECT source_url, url, {d.join(d.gathered('media_type'), ',')} AS media_types, count(DISTINCT caption) AS captions, min(document_id) AS first_document, count(*) AS occurrences FROM media WHERE source_url IS NOT NULL AND url IS NOT NULL GROUP BY 1, 2"


@stated("media", "embedding_records")
def media_chunk_matches(d: Duck) -> str:
    """Media matched to the records of their page: the same page number (100), else the same section (95); another page number does not match. Records are folded to one a key before the join."""
    page, section = d.meta("metadata", "page_number"), f"nullif(lower(trim({d.meta('metadata', 'section')})), '')"
    kind = "STRING" if d.spark else "VARCHAR"
    return f"""WITH m AS (SELECT DISTINCT id, source_url, CAST(page_number AS {kind}) AS page, nullif(lower(trim({d.item('section_path', d.size('section_path'))})), '') AS section FROM media WHERE source_url IS NOT NULL), r AS (SELECT source_url, record_id, {page} AS page, {section} AS section FROM embedding_records WHERE source_url IS NOT NULL),
 p AS (SELECT source_url, page, min(record_id) AS record_id FROM r WHERE page IS NOT NULL GROUP BY 1, 2), s AS (SELECT source_url, section, min(record_id) AS record_id FROM r WHERE section IS NOT NULL GROUP BY 1, 2)
 SELECT id, coalesce(p.record_id, s.record_id) AS record_id, CASE WHEN p.record_id IS NOT NULL THEN 100 WHEN s.record_id IS NOT NULL THEN 95 ELSE 0 END AS score, CASE WHEN p.record_id IS NOT NULL THEN 'exact_page' WHEN s.record_id IS NOT NULL THEN 'exact_section' ELSE 'none' END AS reason
 FROM m LEFT JOIN p ON m.source_url = p.source_url AND m.page = p.page LEFT JOIN s ON m.source_url = s.source_url AND m.section = s.section"""


@stated("media", "embedding_records")
def parent_aliases(d: Duck) -> str:
    """Records with the canonical parent of their page: the parents record of the same address, whose other ids are aliases."""
    return """WITH p AS (SELECT source_url, min(record_id) AS parent, count(DISTINCT record_id) AS names FROM embedding_records WHERE lane = 'parents' AND source_url IS NOT NULL GROUP BY 1)
 SELECT DISTINCT record_id, coalesce(parent, record_id) AS parent, coalesce(names, 0) AS aliases FROM embedding_records AS r LEFT JOIN p ON r.source_url = p.source_url WHERE lane = 'chunks'"""


@stated("embedding_records", "releases")
def upload_resume(d: Duck) -> str:
    """What an interrupted upload still has to send: records of the newest release whose id and text the one before does not hold."""
    return f"""WITH n AS (SELECT release_id, row_number() OVER (ORDER BY created_at DESC, release_id DESC) AS r FROM releases WHERE release_id IN (SELECT release_id FROM embedding_records)), a AS (SELECT DISTINCT lane, record_id, md5(retrieval_text) AS h FROM embedding_records JOIN n USING (release_id) WHERE r = 1),
 b AS (SELECT DISTINCT lane, record_id, md5(retrieval_text) AS h FROM embedding_records JOIN n USING (release_id) WHERE r > 1) SELECT a.lane, count(*) AS records, count(b.h) AS sent, count(*) - count(b.h) AS to_send FROM a LEFT JOIN b ON a.lane = b.lane AND a.record_id = b.record_id AND a.h = b.h GROUP BY 1"""


@stated("documents", "embedding_records", "media", "dedup_entry", "corpus_merge_formatter", "releases", ITEMS)
def integrity_audit(d: Duck) -> str:
    """References between the tables that lead nowhere, and keys that stand twice, as counts by rule."""
    return f"""SELECT 'record_release' AS rule, count(*) AS broken FROM embedding_records WHERE release_id NOT IN (SELECT release_id FROM releases WHERE release_id IS NOT NULL)
 UNION ALL SELECT 'entry_record', count(*) FROM (SELECT DISTINCT record_id FROM dedup_entry) AS e LEFT JOIN (SELECT DISTINCT record_id AS k FROM embedding_records) AS r ON e.record_id = r.k WHERE k IS NULL
 UNION ALL SELECT 'gold_record', count(*) FROM (SELECT {d.each('gold_chunk_ids')} AS g FROM {ITEMS}) AS g LEFT JOIN (SELECT DISTINCT record_id AS k FROM embedding_records) AS r ON g.g = r.k WHERE k IS NULL
 UNION ALL SELECT 'repeated_row', count(*) FROM (SELECT row_id FROM embedding_records GROUP BY 1 HAVING count(*) > 1) AS x UNION ALL SELECT 'repeated_media', count(*) FROM (SELECT id FROM media GROUP BY 1 HAVING count(*) > 1) AS x
 UNION ALL SELECT 'repeated_page', count(*) FROM (SELECT media_id FROM corpus_merge_formatter GROUP BY 1 HAVING count(*) > 1) AS x UNION ALL SELECT 'document_without_text', count(*) FROM documents WHERE text IS NULL OR trim(text) = ''"""


@stated("events")
def frontier_merge(d: Duck) -> str:
    """Two crawl states as one: visited wins over pending, the least depth stays, pending ones are cut to the budget by depth and key."""
    return """WITH s AS (SELECT user_id AS page, min(event_id % 5) AS depth, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS visited FROM events GROUP BY 1)
 SELECT page, depth, state FROM (SELECT page, depth, CASE WHEN visited = 1 THEN 'visited' ELSE 'pending' END AS state, row_number() OVER (PARTITION BY visited ORDER BY depth, page) AS r FROM s) AS x WHERE state = 'visited' OR r <= 500"""


@stated(ITEMS)
def cache_keys(d: Duck) -> str:
    """Questions that share a cached answer: the same words in lower case with single blanks."""
    return f"SELECT {d.sha256(d.join(d.words('query')))} AS cache_key, count(*) AS questions, min(id) AS first_id FROM {ITEMS} GROUP BY 1"


@stated("media")
def collection_signatures(d: Duck) -> str:
    """Items of each page's media collection without repeats, and a digest that changes with any of them."""
    return f"SELECT source_url, {d.size(d.gathered('url'))} AS items, {d.sha256(d.stack(d.gathered('url')))} AS signature FROM media WHERE source_url IS NOT NULL GROUP BY 1"


@stated("embedding_records")
def page_section_keys(d: Duck) -> str:
    """Keys of a record's page and section: address and page number, page key and section path."""
    page = f"substr(sha1(concat_ws('|', coalesce(source_url, record_id), coalesce({d.meta('metadata', 'page_number')}, 'root'))), 1, 16)"
    return f"SELECT row_id, {page} AS page_key, substr(sha1(concat_ws('|', {page}, coalesce(nullif(trim({d.meta('metadata', 'section')}), ''), '__root__'))), 1, 16) AS section_key FROM embedding_records"


@stated("media")
def media_manifest(d: Duck) -> str:
    """Media as compact lines: type, label, what is said of it up to 200 characters, whole sections; one line an item."""
    said = f"trim({d.sub('concat_ws(chr_sep, nullif(trim(title), empty_), nullif(trim(caption), empty_), nullif(trim(alt), empty_))', r'[ \t\r\n]+', ' ')})".replace("chr_sep", "' - '").replace("empty_", "''")
    return f"SELECT DISTINCT id, media_type, substr(concat('[', coalesce(media_type, 'media'), '] ', {said}), 1, 200) AS line, {d.join('section_path', ' > ')} AS section FROM media"


@stated("embedding_records")
def citation_anchors(d: Duck) -> str:
    """Bounded citations: title, address and the first 160 characters of the cleaned text, in one digest-keyed line."""
    return f"SELECT row_id, concat_ws(' | ', nullif(trim({d.meta('metadata', 'title')}), ''), source_url, substr(trim({d.sub('retrieval_text', r'[ \t\r\n]+', ' ')}), 1, 160)) AS anchor FROM embedding_records"


@stated("documents", ITEMS, lanes=True)
def answer_terms(d: Duck) -> str:
    """Words of a reference answer that the best document holds, required ones (with a digit or five letters) apart."""
    need = d.unique(d.keep(d.words("reference_answer"), "x", f"length(x) >= 5 OR {d.has('x', '[0-9]')}"))
    held = d.keep("need", "x", d.member("said", "x"))
    return f"""SELECT query_id, {d.size('need')} AS needed, {d.size(held)} AS held, round({d.size(held)} / greatest(1, {d.size('need')}), 6) AS share FROM (SELECT id AS query_id, {need} AS need FROM {ITEMS} WHERE coalesce(reference_answer, '') <> '') AS q JOIN bk USING (query_id) JOIN (SELECT doc_id, {d.words('text')} AS said FROM documents) AS x USING (doc_id) WHERE rank = 1"""


@stated("corpus_merge_formatter")
def readiness_slices(d: Duck) -> str:
    """Pass rate, latency percentiles and worst case of page recognition over all, by provider, by mode, in one pass of grouping sets."""
    return f"""SELECT coalesce(ocr_provider, 'all') AS provider, coalesce(ocr_mode, 'all') AS mode, count(*) AS pages, round(avg(CASE WHEN ocr_error IS NULL AND trim(coalesce(ocr_text, '')) <> '' THEN 1e0 ELSE 0e0 END), 6) AS pass_rate, round({d.percentile('ocr_latency_ms', 0.5)}, 4) AS p50, round({d.percentile('ocr_latency_ms', 0.95)}, 4) AS p95, max(ocr_latency_ms) AS worst
 FROM (SELECT coalesce(ocr_provider, 'none') AS ocr_provider, coalesce(ocr_mode, 'none') AS ocr_mode, ocr_error, ocr_text, ocr_latency_ms FROM corpus_merge_formatter) AS x GROUP BY GROUPING SETS ((), (ocr_provider), (ocr_mode))"""


@stated("corpus_merge_formatter")
def stratified_take(d: Duck) -> str:
    """Pages taken in turns over the strata of provider, one at a time in order of key, thirty in all."""
    return """WITH p AS (SELECT DISTINCT coalesce(ocr_provider, 'none') AS stratum, media_id FROM corpus_merge_formatter), t AS (SELECT stratum, media_id, row_number() OVER (PARTITION BY stratum ORDER BY md5(media_id)) AS turn FROM p), o AS (SELECT stratum, media_id, turn FROM t WHERE turn <= 30)
 SELECT stratum, media_id, place FROM (SELECT stratum, media_id, row_number() OVER (ORDER BY turn, stratum) AS place FROM o) AS x WHERE place <= 30"""


@stated("embedding_records", ITEMS)
def disjoint_split(d: Duck) -> str:
    """Items split by the source of their gold record, whole sources together, by a hash of the source: no source is in two parts."""
    return f"""WITH s AS (SELECT id, min(coalesce(source_url, record_id)) AS source FROM (SELECT id, {d.each('gold_chunk_ids')} AS record_id FROM {ITEMS}) AS g JOIN embedding_records USING (record_id) GROUP BY 1), h AS (SELECT id, coalesce(source, id) AS source, substr({d.sha256('coalesce(source, id)')}, 1, 1) AS x FROM {ITEMS} LEFT JOIN s USING (id))
 SELECT id, source, CASE WHEN x < 'a' THEN 'train' WHEN x < 'd' THEN 'dev' ELSE 'test' END AS split FROM h"""


@stated("releases", "embedding_records")
def variant_finalists(d: Duck) -> str:
    """Embedding models in order of the share of usable vectors, then of fewer bytes, then by name; the first three."""
    return f"""WITH v AS (SELECT embedding_model AS variant, count(*) AS records, avg(CASE WHEN {d.size('embedding')} = 64 THEN 1e0 ELSE 0e0 END) AS score, sum({d.bytes('retrieval_text')}) AS bytes FROM embedding_records JOIN releases USING (release_id) GROUP BY 1)
 SELECT variant, records, round(score, 6) AS score, CAST(bytes AS BIGINT) AS bytes, place FROM (SELECT variant, records, score, bytes, row_number() OVER (ORDER BY round(score, 6) DESC, bytes, variant) AS place FROM v) AS x WHERE place <= 3"""


@stated("corpus_merge_formatter")
def page_key_join(d: Duck) -> str:
    """Pages joined with the next page of their document by document and page number."""
    return "WITH p AS (SELECT document_id, page_number, min(media_id) AS media_id, count(*) AS n FROM corpus_merge_formatter WHERE page_number IS NOT NULL AND document_id IS NOT NULL GROUP BY 1, 2) SELECT a.media_id, a.page_number, b.media_id AS next_id, a.n AS deliveries FROM p AS a LEFT JOIN p AS b ON a.document_id = b.document_id AND b.page_number = a.page_number + 1"


@stated("embedding_records", ITEMS)
def evidence_units(d: Duck) -> str:
    """Each item's gold records as evidence units with source and text digest, and how many of them have one."""
    return f"""WITH g AS (SELECT id, {d.each('gold_chunk_ids')} AS record_id FROM {ITEMS}), r AS (SELECT record_id, min(source_url) AS source_url, min(md5(retrieval_text)) AS text_md5 FROM embedding_records GROUP BY 1)
 SELECT g.id, g.record_id, source_url, text_md5, count(source_url) OVER (PARTITION BY g.id) AS sourced FROM g JOIN r ON g.record_id = r.record_id"""


@stated("documents", "embedding_records")
def span_links(d: Duck) -> str:
    """Spans attached across sources: mail addresses in documents with the records that hold them too, as sorted lists of up to five."""
    return f"""WITH s AS (SELECT DISTINCT lower(e) AS span, doc_id FROM (SELECT doc_id, {d.each(d.every('text', _MENTIONS))} AS e FROM documents WHERE text IS NOT NULL) AS x), r AS (SELECT DISTINCT lower(e) AS span, row_id FROM (SELECT row_id, {d.each(d.every('retrieval_text', _MENTIONS))} AS e FROM embedding_records WHERE retrieval_text IS NOT NULL) AS y),
 a AS (SELECT span, count(*) AS documents, min(doc_id) AS first_doc FROM s GROUP BY 1), b AS (SELECT span, count(*) AS records, min(row_id) AS first_row FROM r GROUP BY 1) SELECT span, documents, first_doc, coalesce(records, 0) AS records, first_row FROM a LEFT JOIN b USING (span)"""
