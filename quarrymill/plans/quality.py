"""Quality, URL and page-identity queries, each stated once for both engines."""

from __future__ import annotations

from quarrymill.plans.dialect import ITEMS, Duck, stated

#: Classes of sources by words in their address, title, type or path, first match first, and their scores.
AUTHORITY = (
    ("canonical_page", 1.0, ("leadership", "office-of-the-president", "office-of-the-provost")),
    ("policy_page", 0.96, ("policy", "regulation", "law", "governance")),
    ("official_catalog", 0.94, ("catalogue", "catalog", "handbook", "university_catalogue")),
    ("official_brochure", 0.86, ("brochure", "prospectus")),
    ("faq_page", 0.84, ("faq",)),
    ("news_page", 0.48, ("news", "press-release", "press release")),
    ("event_page", 0.42, ("event", "conference", "summit", "workshop", "booklet", "program")),
)
OWN_SITE, OWN_SCORE, OTHER_SCORE = "norvale.example", 1.0, 0.3
#: Words that make a text dated or current, and the freshness of either and of all others.
DATED, CURRENT, FRESHNESS = ("former", "previous", "past", "historic", "historical", "2022", "2023"), ("2024", "2025", "2026", "current", "present"), (0.35, 1.0, 0.75)
_BARE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
_LANG = "^/(ar|de|en|es|fr)(/|$)"


def _any(d: Duck, c: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def _host(d: Duck, c: str) -> str:
    return d.sub(f"lower(coalesce({d.cut(f'trim({c})', _BARE)}, ''))", r":\d+$")


@stated("documents")
def markdown_quality(d: Duck) -> str:
    """Score and reasons of a text as an index candidate: too short, words run together, undecodable signs, lost formulas."""
    bare = d.sub(d.sub(d.sub("text", r"!\[[^\]]*\]\([^)]*\)", " "), r"\[([^\]]*)\]\([^)]*\)", "$1"), r"<!--[^>]*-->", " ")
    case_runs = f"length({d.sub(d.sub('t', '[a-z]+', 'a'), '[A-Z]+', 'A')})"
    long_token = f"({d.has('t', '^[A-Za-z]{40,}$')} OR {d.has('t', '^[A-Za-z]{28,}$')} AND length({d.sub('t', '[^A-Z]')}) >= 2 AND length({d.sub('t', '[^a-z]')}) >= 6 AND {case_runs} >= 3)"
    strip = r"^[.,;:!?()\[\]{}<>`*_]+|[.,;:!?()\[\]{}<>`*_]+$"
    longest = f"coalesce({'array_max' if d.spark else 'list_max'}({d.map('odd', 't', 'length(t)')}), 0)"
    return f"""WITH b AS (SELECT doc_id, text, {bare} AS bare FROM documents WHERE text IS NOT NULL),
 m AS (SELECT doc_id, length(bare) AS chars, {d.size(d.words('bare'))} AS words, {d.keep(d.map(d.every('bare', r'[^ \t\r\n]+'), 't', d.sub('t', strip)), 't', long_token)} AS odd,
   length(text) - length(replace(text, '�', '')) AS lost, CAST((length(text) - length(replace(text, '<!-- formula', ''))) / 12 AS INTEGER) AS formulas FROM b),
 r AS (SELECT *, {d.size('odd')} / greatest(1, words) AS odd_share, lost / greatest(1, chars) AS lost_share, words < 6 OR chars < 20 AS short, {longest} >= 40 OR {d.size('odd')} >= 6 AND {d.size('odd')} / greatest(1, words) > 0.04e0 AS run_on FROM m)
 SELECT doc_id, concat_ws(',', CASE WHEN short THEN 'too_short' END, CASE WHEN run_on THEN 'collapsed_spacing' END, CASE WHEN lost_share > 0.002e0 THEN 'decoding_noise' END, CASE WHEN formulas >= 12 AND words < 200 THEN 'formula_loss' END) AS reasons, words,
 round(greatest(0e0, 1e0 - CASE WHEN short THEN 0.35e0 ELSE 0e0 END - CASE WHEN run_on THEN least(0.45e0, odd_share * 10e0) ELSE least(0.15e0, odd_share * 5e0) END - CASE WHEN lost_share > 0.002e0 THEN least(0.25e0, lost_share * 40e0) ELSE 0e0 END
  - CASE WHEN formulas >= 12 AND words < 200 THEN 0.2e0 WHEN formulas >= 3 THEN least(0.1e0, formulas * 0.01e0) ELSE 0e0 END), 4) AS score FROM r"""


@stated("media")
def fallback_choice(d: Duck) -> str:
    """The second candidate text only if it is accepted and the first is not, or better by more than a margin."""
    score = lambda c: f"least(1e0, {d.size(d.words(c))} / 20e0)"
    ok = lambda c: f"{d.size(d.words(c))} >= 6"
    return f"""SELECT id, max(CASE WHEN {ok('description')} AND NOT {ok('caption')} THEN 'description' WHEN NOT {ok('description')} THEN 'caption' WHEN {score('description')} > {score('caption')} + 0.05e0 THEN 'description' ELSE 'caption' END) AS chosen FROM media GROUP BY id"""


@stated("documents")
def resolved_titles(d: Duck) -> str:
    """The first readable title: the given one unless it is a hexadecimal id, the last path segment, the file name."""

    def human(c: str) -> str:
        plain = f"trim({d.sub(d.sub(c, r'[.](?:md|html?|pdf|docx?|pptx?|xlsx?)$'), '[-_ ]+', ' ')})"
        return f"nullif({d.join(d.map(d.split(plain, ' '), 'w', 'concat(upper(substr(w, 1, 1)), substr(w, 2))'), ' ')}, '')"

    segment, name = d.cut(d.sub(f"coalesce({d.cut('trim(source_url)', _PATH)}, '')", "/+$"), "([^/]+)$"), d.cut("source_file", "([^/]+)$")
    return f"""WITH t AS (SELECT doc_id, nullif(trim(document_title), '') AS own, {human(f"coalesce({segment}, '')")} AS url, {human(f"coalesce({name}, '')")} AS file FROM documents)
 SELECT doc_id, CASE WHEN own IS NOT NULL AND NOT {d.has('own', '^[0-9a-f]{12,64}$')} THEN own ELSE coalesce(url, file, 'Document') END AS title, CASE WHEN own IS NOT NULL AND NOT {d.has('own', '^[0-9a-f]{12,64}$')} THEN 'own' WHEN url IS NOT NULL THEN 'url' WHEN file IS NOT NULL THEN 'file' ELSE 'none' END AS origin FROM t"""


@stated("documents", "embedding_records", "media")
def wall_and_error_shells(d: Duck) -> str:
    """Short texts whose first five lines hold a whole line that is the heading of a login wall or an error page."""
    head = d.map(d.slice(d.lines("lower(t)"), 1, 5), "l", f"trim({d.sub('l', '^[#>* ]+')})")
    wall = d.keep("h", "l", d.has("l", r"^(please )?(sign in|log ?in|authenticate|enable javascript)\b.{0,40}$|^(access|permission) denied\W*$|checking your browser"))
    error = d.keep("h", "l", d.has("l", r"^(error )?(404|403|500|502|503)\b.{0,40}$|^(page )?not found\W*$|^something went wrong\W*$|^internal server error\W*$"))
    return f"""WITH s AS (SELECT 'documents' AS tbl, text AS t FROM documents UNION ALL SELECT 'records', retrieval_text FROM embedding_records UNION ALL SELECT 'descriptions', description FROM media), h AS (SELECT tbl, length(t) <= 1200 AS short, {head} AS h FROM s WHERE t IS NOT NULL)
 SELECT tbl, CASE WHEN NOT short THEN 'page' WHEN {d.size(wall)} > 0 THEN 'wall' WHEN {d.size(error)} > 0 THEN 'error' ELSE 'page' END AS verdict, count(*) AS texts FROM h GROUP BY 1, 2"""


@stated("documents")
def cleaning_gate(d: Duck) -> str:
    """Retention by host and survival of critical addresses after the content policy (100 characters and five words)."""
    return f"""WITH a AS (SELECT {_host(d, 'source_url')} AS host, source_url, length(trim(text)) >= 100 AND {d.size(d.words('text'))} >= 5 AS kept FROM documents WHERE source_url IS NOT NULL),
 h AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE kept) AS k FROM a GROUP BY host), p AS (SELECT {d.each("array('/study/', '/research/', '/no-such-part/')" if d.spark else "['/study/', '/research/', '/no-such-part/']")} AS part)
 SELECT 'host' AS rule, host AS subject, n AS before, k AS after, n < 5 OR k / n >= 0.5e0 AS passed FROM h UNION ALL
 SELECT 'critical', part, count(source_url), count(*) FILTER (WHERE kept), count(*) FILTER (WHERE kept) > 0 FROM p LEFT JOIN a ON contains(source_url, part) GROUP BY part"""


@stated(ITEMS, "media")
def sparse_worthy(d: Duck) -> str:
    """Texts with something a sparse index can hold: a word of two letters that is no stop word, or letters mixed with digits."""
    stop = "('the', 'and', 'for', 'with', 'that', 'this', 'from', 'are', 'was', 'of', 'in', 'on', 'at', 'to', 'is', 'it', 'an', 'by', 'or', 'as')"
    good = d.keep("w", "x", f"{d.has('x', '[a-z]{2}')} AND x NOT IN {stop} OR {d.has('x', '[a-z]')} AND {d.has('x', '[0-9]')} AND length(x) >= 3")
    return f"""SELECT tbl, {d.size(good)} > 0 AS worthy, count(*) AS texts FROM (SELECT 'items' AS tbl, {d.words('query')} AS w FROM {ITEMS} UNION ALL SELECT 'titles', {d.words('title')} FROM media) AS x GROUP BY 1, 2"""


@stated("media")
def low_signal_media(d: Duck) -> str:
    """Media without words of their own: generic labels, no text, tiny or very long images."""
    said = f"trim(lower(concat_ws(' ', nullif(trim(alt), ''), nullif(trim(title), ''), nullif(trim(caption), ''), nullif(trim(description), ''))))"
    generic = r"^(figure|fig|image|img|photo|picture|logo|icon|banner|chart|table|untitled)[ .:_-]*\d*$"
    return f"""SELECT media_type, CASE WHEN {said} = '' THEN 'silent' WHEN {d.has(said, generic)} THEN 'generic' WHEN width < 32 OR height < 32 THEN 'tiny' WHEN width > 6 * height OR height > 6 * width THEN 'strip' ELSE 'kept' END AS verdict, count(*) AS items FROM media GROUP BY 1, 2"""


@stated("documents")
def usable_statements(d: Duck) -> str:
    """List items that can stand as a fact: long enough, no fragment with an open end, no marker."""
    body = f"trim({d.sub('l', r'^[ \t]*[-*][ \t]+')})"
    return f"""WITH b AS (SELECT doc_id, {body} AS s FROM (SELECT doc_id, {d.each(d.lines('text'))} AS l FROM documents WHERE text IS NOT NULL) AS x WHERE {d.has('l', r'^[ \t]*[-*][ \t]+[^ ]')})
 SELECT CASE WHEN length(s) < 20 THEN 'short' WHEN {d.has('s', r'[:,;]$')} THEN 'open_end' WHEN {d.has('lower(s)', r'^(todo|tbd|n/a|see |click )')} THEN 'marker' WHEN NOT {d.has('s', '[a-zA-Z]{2}')} AND {d.bytes('s')} = length(s) THEN 'wordless' ELSE 'usable' END AS verdict, count(*) AS statements, count(DISTINCT s) AS different FROM b GROUP BY 1"""


@stated("documents")
def stripped_markdown(d: Duck) -> str:
    """Texts without table separators, blank lines and short sharing lines, as they go into shingles."""
    keep = d.keep(d.map(d.lines("text"), "l", "trim(l)"), "l", f"l <> '' AND NOT {d.has('l', r'^[|: -]*-[|: -]*$')} AND NOT (length(l) < 100 AND {d.has('lower(l)', r'^(share|tweet|follow us|like us)([ :]|$)')})")
    return f"SELECT doc_id, {d.size(d.lines('text'))} - {d.size(keep)} AS dropped, md5({d.stack(keep)}) AS stripped_md5 FROM documents WHERE text IS NOT NULL"


def _spelt(d: Duck, c: str) -> str:
    """Scheme and host in lower case, single slashes, none at the end."""
    scheme, host, path = (d.cut(f"trim({c})", p) for p in (r"^([A-Za-z][A-Za-z0-9+.-]*)://", _BARE, _PATH))
    return f"concat(lower({scheme}), '://', lower({host}), {d.sub(d.sub(path, '/+', '/'), '/$')})"


@stated("embedding_records")
def url_policies(d: Duck) -> str:
    """Four identities of an address: for crawling (only web addresses, a nested one instead of its wrapper), for duplicates (query kept), canonical (no query), and across languages."""
    query = d.cut("trim(u)", r"^[^?#]*([?][^#]*)")
    nested = d.cut("trim(u)", r"^https?://.*(https?://.*)$")
    canonical = _spelt(d, "u")
    return f"""SELECT row_id, CASE WHEN NOT {d.has("lower(trim(u))", "^https?://")} THEN NULL WHEN {nested} <> '' THEN {d.sub(nested, '#.*$')} ELSE {d.sub('trim(u)', '#.*$')} END AS crawled, concat({canonical}, {query}) AS for_duplicates, {canonical} AS canonical,
 {d.sub(canonical, '^([a-z]+://[^/]+)/(ar|de|en|es|fr)(/|$)', '$1$3')} AS across_languages FROM (SELECT row_id, source_url AS u FROM embedding_records WHERE source_url IS NOT NULL) AS x"""


@stated("embedding_records")
def frontier_filter(d: Duck) -> str:
    """Which addresses a crawl may take: own domain, no skipped extension, no query beyond the allowed parameters, no denied path."""
    path = f"lower(coalesce({d.cut('trim(source_url)', _PATH)}, ''))"
    query = f"coalesce({d.cut('trim(source_url)', r'^[^?#]*[?]([^#]*)')}, '')"
    host = _host(d, "source_url")
    return f"""SELECT CASE WHEN {host} = '' THEN 'no_host' WHEN {host} <> '{OWN_SITE}' AND NOT ends_with_own THEN 'other_domain' WHEN {d.has(path, r'[.](jpe?g|png|gif|svg|css|js|zip|mp4)$')} THEN 'extension' WHEN {query} <> '' AND NOT {d.has(query, '^((page|lang)=[^&]*&?)+$')} THEN 'query' WHEN {d.starts(path, "'/news/'")} THEN 'path' ELSE 'taken' END AS verdict,
 count(*) AS addresses FROM (SELECT source_url, {d.has(host, '[.]norvale[.]example$')} AS ends_with_own FROM embedding_records) AS x GROUP BY 1"""


@stated("embedding_records")
def page_classes(d: Duck) -> str:
    """Page classes by ordered rules over the path, and the language: the label's first part, else the leading path segment."""
    p = f"lower(coalesce({d.cut('trim(source_url)', _PATH)}, ''))"
    has = lambda *parts: "(" + " OR ".join(f"contains({p}, '{x}')" for x in parts) + ")"
    label = f"nullif({d.cut('lower(trim(language))', '^([^-_ ]*)')}, '')"
    return f"""SELECT CASE WHEN {d.has(p, '[.]pdf$')} THEN 'pdf' WHEN {has('/news/', '/event/', '/the-node/')} THEN 'news_or_event' WHEN {has('/leadership', 'office-of-the-president')} THEN 'leadership' WHEN {has('/study/', 'admission', 'program')} THEN 'admissions_or_program'
 WHEN {has('/student-resources', 'campus')} THEN 'student_life' WHEN {has('/about/contact')} OR {d.has(p, '/contact$')} THEN 'contact' ELSE 'content' END AS page_class, coalesce({label}, nullif({d.cut(p, _LANG)}, ''), '') AS language, count(*) AS records, count(DISTINCT source_url) AS addresses FROM embedding_records GROUP BY 1, 2"""


@stated("embedding_records")
def page_hashes(d: Duck) -> str:
    """SHA-1 of the text, or of address, title and lane where there is none."""
    return f"SELECT row_id, sha1(coalesce(nullif(retrieval_text, ''), concat_ws('|', coalesce(source_url, ''), coalesce({d.meta('metadata', 'title')}, ''), lane))) AS page_hash FROM embedding_records"


@stated("embedding_records")
def page_identities(d: Duck) -> str:
    """Pages by canonical address with the language versions of their family, whether they may be indexed, and how many spellings an address has."""
    canonical = _spelt(d, "source_url")
    family = d.sub("page", "^([a-z]+://[^/]+)/(ar|de|en|es|fr)(/|$)", "$1$3")
    return f"""WITH p AS (SELECT {canonical} AS page, source_url FROM embedding_records WHERE {d.has('lower(trim(source_url))', '^https?://')}), g AS (SELECT page, {family} AS family, count(DISTINCT source_url) AS spellings, count(*) AS records FROM p GROUP BY 1, 2),
 f AS (SELECT family, count(*) AS versions, {d.join(d.gathered('page'), ' ')} AS pages FROM g GROUP BY family) SELECT page, family, spellings, records, versions, pages, NOT {d.has('page', r'/(login|search|admin)(/|$)')} AS indexable FROM g JOIN f USING (family)"""


@stated("documents", "dedup_entry")
def source_file_lookup(d: Duck) -> str:
    """Addresses of entries by their path: the document with the same path, else the only one with the same file name, else the only one with the same stem."""
    name, stem = (lambda c: d.cut(c, "([^/]+)$")), (lambda c: d.sub(d.cut(c, "([^/]+)$"), "[.][^.]*$"))
    by = lambda key: f"SELECT {key} AS k, min(source_url) AS url, count(DISTINCT source_url) AS n FROM documents WHERE source_url IS NOT NULL AND path IS NOT NULL GROUP BY 1"
    return f"""WITH e AS (SELECT DISTINCT path FROM dedup_entry WHERE path IS NOT NULL), a AS ({by('path')}), b AS ({by(name('path'))}), c AS ({by(stem('path'))})
 SELECT path, coalesce(a.url, CASE WHEN b.n = 1 THEN b.url END, CASE WHEN c.n = 1 THEN c.url END) AS url, CASE WHEN a.url IS NOT NULL THEN 'path' WHEN b.n = 1 THEN 'name' WHEN c.n = 1 THEN 'stem' ELSE 'none' END AS matched_by
 FROM e LEFT JOIN a ON e.path = a.k LEFT JOIN b ON {name('e.path')} = b.k LEFT JOIN c ON {stem('e.path')} = c.k"""


@stated("documents")
def authority_and_freshness(d: Duck) -> str:
    classes = " ".join(f"WHEN {_any(d, 'said', words)} THEN '{name}'" for name, _, words in AUTHORITY)
    scores = " ".join(f"WHEN {_any(d, 'said', words)} THEN {score}e0" for _, score, words in AUTHORITY)
    own = f"WHEN contains(said, '{OWN_SITE}')"
    text = "lower(concat_ws(' ', nullif(trim(source_url), ''), nullif(trim(document_title), ''), nullif(trim(document_type), ''), nullif(trim(path), '')))"
    dated = "lower(concat_ws(' ', nullif(trim(source_url), ''), nullif(trim(document_title), '')))"
    return f"""SELECT doc_id, CASE {classes} {own} THEN 'canonical_page' ELSE 'external_or_embedded' END AS authority, CASE {scores} {own} THEN {OWN_SCORE}e0 ELSE {OTHER_SCORE}e0 END AS authority_score,
 CASE WHEN {_any(d, 'dated', DATED)} THEN {FRESHNESS[0]}e0 WHEN {_any(d, 'dated', CURRENT)} THEN {FRESHNESS[1]}e0 ELSE {FRESHNESS[2]}e0 END AS freshness_score FROM (SELECT doc_id, {text} AS said, {dated} AS dated FROM documents) AS x"""


@stated("events")
def transcript_text(d: Duck) -> str:
    """Captions without headers, cue times and tags: here of cues made of each user's events."""
    cue = "concat('WEBVTT', chr(10), chr(10), '00:00:', lpad(CAST(user_id % 60 AS STRING), 2, '0'), '.000 --> 00:01:00.000', chr(10), '<v Guide>', event_type, '</v>', chr(10), 'second ', CAST(user_id AS STRING))".replace("chr(10)", "char(10)" if d.spark else "chr(10)").replace("STRING", "STRING" if d.spark else "VARCHAR")
    lines = d.keep(d.map(d.lines("v"), "l", f"trim({d.sub('l', '<[^>]*>')})"), "l", f"l <> '' AND l <> 'WEBVTT' AND NOT contains(l, '-->') AND NOT {d.has('l', '^(NOTE|STYLE|Kind:|Language:|[0-9]+$)')}")
    return f"SELECT user_id, event_type, {d.join(lines, ' ')} AS transcript FROM (SELECT DISTINCT user_id, event_type, {cue} AS v FROM events) AS x"


@stated("embedding_records", "media")
def egress_policy(d: Duck) -> str:
    """Which addresses may be fetched: https, a host, no literal private address, an allowed suffix."""
    host = _host(d, "u")
    private = r"^(localhost|127[.].*|10[.].*|192[.]168[.].*|169[.]254[.].*|172[.](1[6-9]|2[0-9]|3[01])[.].*|\[?::1\]?)$"
    return f"""SELECT CASE WHEN u IS NULL THEN 'none' WHEN NOT {d.has('lower(trim(u))', '^https://')} THEN 'not_https' WHEN {host} = '' THEN 'no_host' WHEN {d.has(host, private)} THEN 'private' WHEN {d.has(host, '(^|[.])norvale[.]example$')} THEN 'allowed' ELSE 'other_host' END AS verdict, count(*) AS addresses
 FROM (SELECT source_url AS u FROM embedding_records UNION ALL SELECT url FROM media) AS x GROUP BY 1"""
