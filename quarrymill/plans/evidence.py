"""Queries between ranked lanes and an answer: query understanding, rescoring, evidence and confidence, each stated once for both engines."""

from __future__ import annotations

from quarrymill.plans.dialect import ITEMS, Duck, stated

#: Words that say nothing about a question's subject.
STOP = "('the', 'and', 'for', 'with', 'that', 'this', 'from', 'are', 'was', 'were', 'does', 'did', 'can', 'has', 'have', 'what', 'which', 'when', 'where', 'who', 'how', 'why', 'its', 'their', 'about', 'into', 'than', 'there', 'any', 'all')"
_ASKING = "('who', 'what', 'when', 'where', 'which', 'why', 'how', 'is', 'are', 'does', 'do', 'can', 'has', 'have')"


def _tokens(d: Duck, c: str) -> str:
    """White-space tokens in lower case with only letters, digits, - and _, possessive s taken off."""
    plain = d.sub(d.sub(d.sub("lower(x)", r"[^\p{L}\p{N}_'-]"), "^'+|'+$"), "'s$")
    return d.keep(d.map(d.every(f"coalesce({c}, '')", r"[^ \t\r\n]+"), "x", plain), "x", "x <> ''")


def _variants(d: Duck, c: str) -> str:
    """Tokens with their singular forms beside them."""
    forms = "(x, CASE WHEN length(x) > 4 AND x LIKE '%ies' THEN concat(substr(x, 1, length(x) - 3), 'y') END, CASE WHEN length(x) > 4 AND x LIKE '%s' AND NOT x LIKE '%ss' THEN substr(x, 1, length(x) - 1) END)"
    return d.flat(d.map(_tokens(d, c), "x", d.keep(("array" if d.spark else "list_value") + forms, "y", "y IS NOT NULL")))


def _informative(d: Duck, c: str) -> str:
    return d.unique(d.keep(_tokens(d, c), "x", f"length(x) >= 3 AND x NOT IN {STOP}"))


def _named(d: Duck, c: str) -> str:
    """Tokens that look like names: a capital after the first letter, or a capital first letter past the first word."""
    words = d.keep(d.map(d.every(f"coalesce({c}, '')", r"[^ \t\r\n]+"), "x", d.sub("x", r"[^\p{L}\p{N}_'-]")), "x", "x <> ''")
    rest = d.keep(d.map(d.every(d.cut(f"coalesce({c}, '')", r"^[^ ]+ (.*)$"), r"[^ \t\r\n]+"), "x", d.sub("x", r"[^\p{L}\p{N}_'-]")), "x", d.has("x", r"^\p{Lu}.*\p{Ll}"))
    inner = d.keep(words, "x", d.has("x", r"^.+\p{Lu}"))
    both = f"concat({inner}, {rest})" if d.spark else f"list_concat({inner}, {rest})"
    return d.unique(d.map(d.keep(both, "x", f"lower(x) NOT IN {_ASKING}"), "x", "lower(x)"))


@stated(ITEMS)
def query_tokens(d: Duck) -> str:
    """A question's tokens with singular variants, its informative and its named tokens."""
    return f"SELECT id, {d.join(_variants(d, 'query'))} AS variants, {d.join(d.ordered(_informative(d, 'query')))} AS informative, {d.join(d.ordered(_named(d, 'query')))} AS named FROM {ITEMS}"


@stated(ITEMS)
def query_modes(d: Duck) -> str:
    """What kind of answer a question wants, the type of value it looks up and the years it names, by ordered rules."""
    q = "lower(coalesce(query, ''))"
    mode = f"CASE WHEN {d.has(q, r'(^|[^a-z])(compare|summari[sz]e|overview|difference|relationship|across)([^a-z]|$)')} THEN 'synthesis' WHEN {d.has(q, r'(^|[^a-z])(list|all|which|every|what are)([^a-z]|$)')} THEN 'scoped' ELSE 'fact' END"
    media = d.has(q, r"(^|[^a-z])(photo|image|picture|video|figure|chart|diagram)s?([^a-z]|$)")
    slot = f"CASE WHEN {d.has(q, r'e-?mail')} THEN 'email' WHEN {d.has(q, r'(phone|telephone|call)')} THEN 'phone' WHEN {d.has(q, r'(hours|open|close)')} THEN 'hours' WHEN {d.has(q, r'(deadline|when|date)')} THEN 'date' WHEN {d.has(q, r'(where|address|located)')} THEN 'location' WHEN {d.has(q, r'(^|[^a-z])who([^a-z]|$)')} THEN 'person' WHEN {d.has(q, r'how (many|much)')} THEN 'number' ELSE 'none' END"
    return f"SELECT id, {mode} AS mode, {media} AS wants_media, {slot} AS slot, {d.join(d.unique(d.every(q, r'20[0-9][0-9]')))} AS years FROM {ITEMS}"


@stated("documents", ITEMS, lanes=True)
def phrase_bonus(d: Duck) -> str:
    """0.15 where a text holds any query token, 0.35 more where it holds two neighbours side by side."""
    pairs = d.map(d.upto("1", f"{d.size('t')} - 1"), "i", f"concat({d.item('t', 'i')}, ' ', {d.item('t', 'i + 1')})")
    return f"""WITH q AS (SELECT query_id, t, {pairs} AS p FROM (SELECT id AS query_id, {_tokens(d, 'query')} AS t FROM {ITEMS}) AS a), x AS (SELECT query_id, doc_id, lower(trim({d.sub('text', r'[ \t\r\n]+', ' ')})) AS said FROM bk JOIN documents USING (doc_id))
 SELECT query_id, doc_id, round(CASE WHEN {d.size(d.keep('t', 'w', 'contains(said, w)'))} > 0 THEN 0.15e0 ELSE 0e0 END + CASE WHEN {d.size(d.keep('p', 'w', 'contains(said, w)'))} > 0 THEN 0.35e0 ELSE 0e0 END, 2) AS bonus FROM x JOIN q USING (query_id)"""


_LANES = "l AS (SELECT query_id, doc_id, sum(1e0 / (60 + rank)) AS fused, count(*) AS lanes, min(rank) AS best FROM (SELECT query_id, doc_id, rank FROM bk UNION ALL SELECT query_id, doc_id, rank FROM ok) AS u GROUP BY 1, 2)"


@stated("documents", ITEMS, lanes=True)
def fallback_rerank(d: Duck) -> str:
    """Fused support, share of the informative tokens that a text holds, and a bonus for documents that several lanes name; the five best."""
    hit = f"{d.size(d.keep('t', 'w', 'contains(said, w)'))} / greatest(1, {d.size('t')})"
    return f"""WITH {_LANES}, q AS (SELECT id AS query_id, {_informative(d, 'query')} AS t FROM {ITEMS}), s AS (SELECT query_id, doc_id, round(fused + {hit} + CASE WHEN lanes > 1 THEN 0.75e0 ELSE 0e0 END + least(0.4e0, 0.1e0 * (lanes - 1)), 6) AS score FROM l JOIN q USING (query_id) JOIN (SELECT doc_id, lower(text) AS said FROM documents) AS x USING (doc_id))
 SELECT query_id, doc_id, score, place FROM (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS place FROM s) AS r WHERE place <= 5"""


@stated("documents", ITEMS, lanes=True)
def source_promotion(d: Duck) -> str:
    """The fused ranking with documents whose address or title holds an informative token of the question moved up, order kept otherwise."""
    names = "lower(concat_ws(' ', coalesce(source_url, ''), coalesce(document_title, '')))"
    return f"""WITH {_LANES}, r AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 9) DESC, doc_id) AS rank FROM l), q AS (SELECT id AS query_id, {_informative(d, 'query')} AS t FROM {ITEMS}),
 m AS (SELECT query_id, doc_id, rank, {d.size(d.keep('t', 'w', "length(w) >= 5 AND contains(names, w)"))} > 0 AS named FROM r JOIN q USING (query_id) JOIN (SELECT doc_id, {names} AS names FROM documents) AS x USING (doc_id))
 SELECT query_id, doc_id, named, place FROM (SELECT query_id, doc_id, named, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN named THEN 0 ELSE 1 END, rank) AS place FROM m) AS p WHERE place <= 8"""


@stated(lanes=True)
def balanced_pool(d: Duck) -> str:
    """Candidates from the anchors of one lane, the fused ranking, and the rest of the other lane, each once under its first tier."""
    return f"""WITH {_LANES}, f AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 9) DESC, doc_id) AS rank FROM l),
 t AS (SELECT query_id, doc_id, min(tier * 1000 + rank) AS k FROM (SELECT query_id, doc_id, 0 AS tier, rank FROM ok WHERE rank <= 2 UNION ALL SELECT query_id, doc_id, 1, rank FROM f WHERE rank <= 4 UNION ALL SELECT query_id, doc_id, 2, rank FROM bk) AS u GROUP BY 1, 2)
 SELECT query_id, doc_id, place FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY k, doc_id) AS place FROM t) AS p WHERE place <= 8"""


@stated("documents", lanes=True)
def evidence_pack(d: Duck) -> str:
    """At most two documents of a source, eight in all, up to 6,000 characters together, in order of rank."""
    return """WITH c AS (SELECT query_id, doc_id, rank, n_chars, row_number() OVER (PARTITION BY query_id, coalesce(source, 'none') ORDER BY rank) AS turn FROM bk JOIN documents USING (doc_id)),
 s AS (SELECT query_id, doc_id, rank, sum(n_chars) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place FROM c WHERE turn <= 2)
 SELECT query_id, doc_id, rank, CAST(upto AS BIGINT) AS characters FROM s WHERE place <= 8 AND upto <= 6000"""


@stated("documents", ITEMS, lanes=True)
def evidence_scores(d: Duck) -> str:
    """A score of each ranked document as evidence: base, decay by rank, language, overlap of informative tokens."""
    hit = f"{d.size(d.keep('t', 'w', 'contains(said, w)'))} / greatest(1, {d.size('t')})"
    return f"""WITH q AS (SELECT id AS query_id, {_informative(d, 'query')} AS t, lower(substr(language, 1, 2)) AS lang FROM {ITEMS}), x AS (SELECT doc_id, lower(text) AS said, lower(lang) AS doc_lang, source_url IS NOT NULL AS sourced FROM documents)
 SELECT query_id, doc_id, round(20e0 + 12e0 / (1 + rank) + CASE WHEN sourced THEN 4e0 ELSE -4e0 END + CASE WHEN coalesce(lang = doc_lang, false) THEN 6e0 ELSE 0e0 END + {hit} * 28e0, 6) AS evidence FROM bk JOIN q USING (query_id) JOIN x USING (doc_id)"""


@stated("documents", ITEMS, lanes=True)
def evidence_sufficiency(d: Duck) -> str:
    """Whether the five best documents of a question suffice: alignment of the best, different sources, named tokens that none of them has; and whether to abstain."""
    hit = f"{d.size(d.keep('t', 'w', 'contains(said, w)'))} / greatest(1, {d.size('t')})"
    lost = f"{d.size(d.keep('n', 'w', 'NOT contains(said, w)'))} / greatest(1, {d.size('n')})"
    return f"""WITH q AS (SELECT id AS query_id, {_informative(d, 'query')} AS t, {_named(d, 'query')} AS n FROM {ITEMS}), x AS (SELECT doc_id, lower(text) AS said, coalesce(source, 'none') AS source FROM documents),
 a AS (SELECT query_id, max({hit}) AS aligned, min({lost}) AS missing, count(DISTINCT source) AS sources FROM bk JOIN q USING (query_id) JOIN x USING (doc_id) WHERE rank <= 5 GROUP BY 1)
 SELECT id AS query_id, round(coalesce(aligned, 0e0), 6) AS alignment, coalesce(sources, 0) AS sources, round(coalesce(missing, 1e0), 6) AS missing_named, CASE WHEN aligned IS NULL THEN 'no_hits' WHEN aligned >= 0.32e0 AND sources >= 2 THEN 'sufficient' WHEN aligned >= 0.24e0 THEN 'partial' ELSE 'weak' END AS verdict,
 aligned IS NULL OR aligned < 0.24e0 OR missing > 0.5e0 AS abstain FROM {ITEMS} LEFT JOIN a ON id = query_id"""


@stated("documents", lanes=True)
def retrieval_confidence(d: Duck) -> str:
    """0.46 direct signal, 0.18 agreement of lanes, 0.18 authority of the best source, 0.05 where spans are there, as one number a question."""
    return f"""WITH {_LANES}, g AS (SELECT query_id, count(*) AS chunks, count(*) FILTER (WHERE lanes > 1) AS agreed, max(CASE WHEN contains(coalesce(source_url, ''), 'norvale.example') THEN 1e0 ELSE 0.3e0 END) AS authority FROM l JOIN documents USING (doc_id) WHERE best <= 8 GROUP BY 1)
 SELECT query_id, chunks, round(agreed / chunks, 4) AS agreement, round(least(1e0, greatest(0e0, 0.56e0 * least(1e0, chunks / 8e0) * 0.46e0 + agreed / chunks * 0.18e0 + authority * 0.18e0)), 4) AS confidence FROM g"""


@stated("documents", ITEMS, lanes=True)
def dense_excerpts(d: Duck) -> str:
    """The sentence of the best document that holds most informative tokens of the question, the first of equals."""
    marked = d.sub("text", r"([.!?])[ \t]+", "$1|")
    cut = d.keep(d.map(d.every(marked, r"[^|\r\n]+"), "s", "trim(s)"), "s", "s <> ''")
    pos = "posexplode(s) AS (n, sentence)" if d.spark else "unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS n"
    return f"""WITH q AS (SELECT id AS query_id, {_informative(d, 'query')} AS t FROM {ITEMS}), s AS (SELECT query_id, doc_id, {cut} AS s FROM bk JOIN documents USING (doc_id) WHERE rank = 1), e AS (SELECT query_id, doc_id, {pos} FROM s),
 h AS (SELECT query_id, doc_id, n, sentence, {d.size(d.keep('t', 'w', 'contains(lower(sentence), w)'))} AS hits FROM e JOIN q USING (query_id))
 SELECT query_id, doc_id, hits, sentence FROM (SELECT query_id, doc_id, hits, sentence, row_number() OVER (PARTITION BY query_id ORDER BY hits DESC, n) AS r FROM h) AS x WHERE r = 1 AND hits > 0"""


@stated("documents", ITEMS, lanes=True)
def facet_coverage(d: Duck) -> str:
    """For each question, which of its informative tokens the five best documents hold at all and in at least two sources."""
    return f"""WITH q AS (SELECT query_id, {d.each('t')} AS facet FROM (SELECT id AS query_id, {_informative(d, 'query')} AS t FROM {ITEMS}) AS a), x AS (SELECT query_id, lower(text) AS said, coalesce(source, 'none') AS source FROM bk JOIN documents USING (doc_id) WHERE rank <= 5),
 h AS (SELECT q.query_id, facet, count(DISTINCT source) AS sources FROM q LEFT JOIN x ON q.query_id = x.query_id AND contains(said, facet) GROUP BY 1, 2)
 SELECT query_id, count(*) AS facets, count(*) FILTER (WHERE sources > 0) AS held, count(*) FILTER (WHERE sources > 1) AS corroborated, CASE WHEN count(*) FILTER (WHERE sources > 0) = count(*) THEN 'complete' WHEN count(*) FILTER (WHERE sources > 0) = 0 THEN 'missing' ELSE 'partial' END AS status FROM h GROUP BY 1"""


@stated("documents")
def capped_postings(d: Duck) -> str:
    """The first 512 documents of each word, as the look-up keeps them, beside the number of all."""
    return f"""WITH p AS (SELECT DISTINCT doc_id, {d.each(d.words('text'))} AS term FROM documents), r AS (SELECT term, doc_id, row_number() OVER (PARTITION BY term ORDER BY doc_id) AS place FROM p), n AS (SELECT term, count(*) AS documents FROM p GROUP BY 1)
 SELECT term, documents, kept, last_kept FROM n JOIN (SELECT term, count(*) AS kept, max(doc_id) AS last_kept FROM r WHERE place <= 512 GROUP BY 1) AS k USING (term)"""


@stated("media", "embedding_records", ITEMS)
def attached_media(d: Duck) -> str:
    """Media of the pages that hold a question's gold records, scored by shared words, the three best of each question."""
    return f"""WITH g AS (SELECT id, {d.words('query')} AS t, {d.each('gold_chunk_ids')} AS record_id FROM {ITEMS}), u AS (SELECT DISTINCT id, t, source_url FROM g JOIN embedding_records USING (record_id) WHERE source_url IS NOT NULL),
 m AS (SELECT DISTINCT id AS media_id, source_url, {d.words("concat_ws(' ', title, caption, alt)")} AS w FROM media WHERE source_url IS NOT NULL), s AS (SELECT u.id, media_id, max({d.size(d.keep(d.unique('t'), 'x', d.member('w', 'x')))}) AS shared FROM u JOIN m USING (source_url) GROUP BY 1, 2)
 SELECT id, media_id, shared, place FROM (SELECT id, media_id, shared, row_number() OVER (PARTITION BY id ORDER BY shared DESC, media_id) AS place FROM s) AS x WHERE place <= 3"""


@stated("embedding_records", ITEMS)
def scope_expansion(d: Duck) -> str:
    """Pages that hold two or more of a question's gold records, with their further records in order."""
    return f"""WITH g AS (SELECT DISTINCT id, record_id FROM (SELECT id, {d.each('gold_chunk_ids')} AS record_id FROM {ITEMS}) AS a), r AS (SELECT DISTINCT record_id, source_url FROM embedding_records WHERE source_url IS NOT NULL AND lane = 'chunks'), p AS (SELECT id, source_url, count(*) AS seeds FROM g JOIN r USING (record_id) GROUP BY 1, 2)
 SELECT id, source_url, seeds, record_id, place FROM (SELECT p.id, p.source_url, seeds, r.record_id, row_number() OVER (PARTITION BY p.id, p.source_url ORDER BY r.record_id) AS place FROM p JOIN r ON p.source_url = r.source_url LEFT JOIN g AS k ON k.id = p.id AND k.record_id = r.record_id WHERE k.id IS NULL) AS x WHERE place <= 6"""


@stated("corpus_merge_formatter")
def neighbour_expansion(d: Duck) -> str:
    """Seeds (pages of good quality) with the pages before and after them, each once under its best rank, six a document."""
    return """WITH p AS (SELECT DISTINCT document_id, media_id, page_number, ocr_quality_score FROM corpus_merge_formatter WHERE page_number IS NOT NULL AND document_id IS NOT NULL), n AS (SELECT document_id, media_id, ocr_quality_score, lag(media_id) OVER w AS before, lead(media_id) OVER w AS after FROM p WINDOW w AS (PARTITION BY document_id ORDER BY page_number, media_id, ocr_quality_score)),
 s AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY coalesce(ocr_quality_score, -1e0) DESC, media_id) * 2 AS rank FROM n), e AS (SELECT document_id, media_id, rank FROM s UNION ALL SELECT document_id, before, rank + 1 FROM s WHERE before IS NOT NULL UNION ALL SELECT document_id, after, rank + 1 FROM s WHERE after IS NOT NULL),
 b AS (SELECT document_id, media_id, min(rank) AS rank FROM e GROUP BY 1, 2) SELECT document_id, media_id, place FROM (SELECT document_id, media_id, row_number() OVER (PARTITION BY document_id ORDER BY rank, media_id) AS place FROM b) AS x WHERE place <= 6"""


@stated("documents")
def span_selection(d: Duck) -> str:
    """The four sentences of each text with most signs of a fact: digits, addresses, dates, amounts, a fitting length."""
    marked = d.sub("text", r"([.!?])[ \t]+", "$1|")
    cut = d.unique(d.keep(d.map(d.every(marked, r"[^|\r\n]+"), "s", "trim(s)"), "s", "length(s) >= 20"))
    score = f"CASE WHEN {d.has('s', '[0-9]')} THEN 2 ELSE 0 END + CASE WHEN {d.has('s', '@|https?://')} THEN 3 ELSE 0 END + CASE WHEN {d.has('s', '(19|20)[0-9][0-9]')} THEN 2 ELSE 0 END + CASE WHEN {d.has('s', '[0-9] ?(%|percent|AED|EUR|USD)')} THEN 2 ELSE 0 END + CASE WHEN length(s) BETWEEN 40 AND 240 THEN 1 ELSE 0 END"
    return f"""WITH s AS (SELECT doc_id, {d.each(cut)} AS s FROM documents), r AS (SELECT doc_id, s, {score} AS signal FROM s) SELECT doc_id, signal, place, md5(s) AS span_md5 FROM (SELECT doc_id, s, signal, row_number() OVER (PARTITION BY doc_id ORDER BY signal DESC, s) AS place FROM r) AS x WHERE place <= 4"""


@stated("documents")
def extractive_summaries(d: Duck) -> str:
    """The first five headings and the first six sentences of at least six words of each text."""
    heads = d.slice(d.map(d.keep(d.lines("text"), "l", d.has("l", "^#{1,6} ")), "l", f"trim({d.sub('l', '^#+ +')})"), 1, 5)
    marked = d.sub(d.join(d.keep(d.lines("text"), "l", f"NOT {d.has('l', '^#{1,6} ')}"), " "), r"([.!?])[ \t]+", "$1|")
    body = d.slice(d.keep(d.map(d.every(marked, "[^|]+"), "s", "trim(s)"), "s", f"{d.size(d.words('s'))} >= 6"), 1, 6)
    return f"SELECT doc_id, {d.join(heads, ' / ')} AS headings, {d.size(body)} AS sentences, md5({d.join(body)}) AS summary_md5 FROM documents WHERE text IS NOT NULL"
