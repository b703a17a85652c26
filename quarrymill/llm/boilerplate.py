"""Main body of web pages, by differencing each page with its nearest pages in URL order.

Pages are put in the order of host and path by a range sort, so that a page's neighbours are the nearest URLs of its host and no
host is gathered in one task. A page is aligned with the `NEIGHBOURS` pages before it by the longest common
subsequence of lines. Lines that a pair shares are taken away from both pages. What stays, the long lines that no neighbour has,
marks where the main body lies, and tells for each shared line whether it stands inside the body (a heading, a list
item, a sentence that many pages have) or around it. Over all pairs of a host this gives each of its shared lines a profile; a line is
deleted where its profile and its place say that it is no part of the body.

A host judges by its own pages: a line needs `LEAST_PAGES` different texts, however large the collection is, and is well known by its share of the host's
pages. Where other hosts have the line too and the host saw it fewer than `EVIDENCE` times, the profile over all hosts stands in. Profiles are not
broadcast: pages go in blocks of `BLOCK` neighbours, and each block is sent the profiles of its own lines.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import texts_of
from quarrymill.session import durable, parallelism

NEIGHBOURS = 3
LEAST_PAGES = 4
EVIDENCE = 100
BLOCK = 256
#: A shared line is part of bodies if it stands between a page's own long lines in this share of its places, a heading if it is marked as one in this share.
INSIDE_SHARE = 0.28
HEADING_SHARE = 0.1
#: A line that so many of the host's texts have, or of those of all its hosts, is no title that a few sidebars repeat.
STRONG_SHARE = 0.0035

_BULLET = re.compile(r"^(?:[-*•–]|\d{1,3}[.)])\s+")
_MARK = re.compile(r"^#{1,6}\s+")
_PROSE = re.compile(r"^(?=(?:\S+\s+){7}).*[.?!؟…;:][\"'”’»)\]]*$", re.S)
_MENU = re.compile(r"\s[|·›>/]\s|\S {2,}\S.* {2,}")
_LABEL = re.compile(r"^(?:TITLE|SECTION): ")
_HEADING, _PROSE_KIND, _ITEM, _PLAIN, _META = 1, 2, 3, 4, 5


def line_kind(line: str) -> int:
    if _LABEL.match(line):
        return _META
    if _MARK.match(line):
        return _HEADING
    long = len(line.split(None, 11)) > 11 and not _MENU.search(line)
    if long or _PROSE.match(line):
        return _PROSE_KIND
    return _ITEM if _BULLET.match(line) else _PLAIN


def line_key(line: str) -> str:
    """What two lines must share to count as the same: the text without heading mark, digits as one sign."""
    return re.sub(r"\d+", "0", _MARK.sub("", line.strip()))


def page_lines(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """Number, key and kind of each line with a letter or digit; rulers and the like are neither body nor boilerplate."""
    import xxhash

    numbers, keys, kinds = [], [], []
    for n, line in enumerate((text or "").split("\n"), 1):
        line = line.strip()
        if any(map(str.isalnum, line)):
            numbers.append(n)
            keys.append(xxhash.xxh3_64_intdigest(line_key(line).encode()) - (1 << 63))
            kinds.append(line_kind(line))
    return numbers, keys, kinds


def aligned(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Positions of a longest common subsequence of two lists of line keys (Hunt and Szymanski's way)."""
    where: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i, key in enumerate(a):
        for j in where.get(key, ()):
            at = bisect_left(ends, j)
            node = (i, j, links[at - 1] if at else None)
            if at == len(ends):
                ends.append(j)
                links.append(node)
            else:
                ends[at] = j
                links[at] = node
    node, out = links[-1] if links else None, []
    while node:
        out.append((node[0], node[1]))
        node = node[2]
    out.reverse()
    return [i for i, _ in out], [j for _, j in out]


def _marks(keys: list[int], kinds: list[int], shared: set[int], common: set[int], tally: dict[int, list[int]]) -> None:
    """Adds to each shared line's profile: times shared, inside the body, before a long line of the page's own, as a marked heading.

    A page's own long lines are those that neither the neighbour nor several other pages have.
    """
    own = [i for i, k in enumerate(kinds) if k == _PROSE_KIND and i not in shared and keys[i] not in common]
    if not own:
        return
    first, last = own[0], own[-1]
    own_set = set(own)
    for i, key in enumerate(keys):
        if i not in shared and key not in common:
            continue
        row = tally.get(keys[i])
        if row is None:
            row = tally[keys[i]] = [0, 0, 0, 0]
        row[0] += 1
        row[1] += first < i < last
        row[2] += i + 1 in own_set
        row[3] += kinds[i] == _HEADING


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Differencing along the order of URLs: partial profiles of each host's shared lines."""
    past: list[tuple[list[int], list[int]]] = []
    tally: dict[str, dict[int, list[int]]] = {}
    common: set[int] = set()

    def flush() -> pa.RecordBatch:
        hosts = [h for h, own in tally.items() for _ in own]
        keys = np.array([k for own in tally.values() for k in own], dtype=np.int64)
        rows = np.array([r for own in tally.values() for r in own.values()], dtype=np.int64).reshape(-1, 4)
        tally.clear()
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys), *(pa.array(rows[:, c]) for c in range(4))], ["host", "line", "shared", "inside", "leads", "marked"])

    for batch in batches:
        for place, host, keys, kinds, lines in zip(*(texts_of(batch, c) for c in ("place", "host", "keys", "kinds", "lines"))):
            if place == _KNOWN:
                common = set(lines)
                past.clear()
                continue
            if place < 0:
                past.append((keys, kinds))  # the neighbours before the block
                continue
            own_tally = tally.setdefault(host, {})
            for other, other_kinds in past:
                i, j = aligned(keys, other)
                if not i:
                    continue
                left, right = set(i), set(j)
                own = sum(1 for x, k in enumerate(kinds) if k == _PROSE_KIND and x not in left)
                both = sum(1 for x in i if kinds[x] == _PROSE_KIND)
                if own > both:  # else it is an edited copy of the same page
                    _marks(keys, kinds, left, common, own_tally)
                    _marks(other, other_kinds, right, common, own_tally)
            past.append((keys, kinds))
            if len(past) > NEIGHBOURS:
                past.pop(0)
        if sum(map(len, tally.values())) > 100_000:
            yield flush()
    if tally:
        yield flush()


_HEADS, _WITHIN, _AROUND, _STRONG = 1, 2, 4, 8


def foreign_lines(numbers: list[int], keys: list[int], kinds: list[int], menu: bool, known: dict[int, int]) -> list[int]:
    """Numbers of the lines that are no part of the main body; none if the text is no web page. `known` has the profiles of the host's lines.

    A text is a web page if it has a line that stands around bodies elsewhere. A first line before a heading may be a
    title, which sidebars of other pages may repeat; alone it makes a page only if very many texts have it or it is a `menu`.
    """
    n = len(keys)
    flags = [known.get(k, 0) for k in keys]
    around = [bool(f & _AROUND) and kind != _META for f, kind in zip(flags, kinds)]
    strong = [bool(f & _STRONG) for f in flags]
    item = [bool(f & _WITHIN and f & _STRONG) for f in flags]
    if not any(around[1:]) and not (n and around[0] and (strong[0] or menu)):
        return []
    body = [False] * n
    for i, kind in enumerate(kinds):
        if kind in (_HEADING, _META):
            body[i] = True
        elif kind == _PROSE_KIND:
            body[i] = not around[i] or not strong[i]
        elif kind == _ITEM:
            # an item goes on with what it follows, unless it is itself well known
            body[i] = item[i] or not around[i] and i > 0 and body[i - 1]
        elif flags[i] & _HEADS:
            j = i + 1
            while j < n and around[j] and kinds[j] != _ITEM:
                j += 1
            body[i] = j < n and (kinds[j] == _PROSE_KIND or kinds[j] == _ITEM and item[j])
    return [numbers[i] for i in range(n) if not body[i]]


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, int] = {}
    for batch in batches:
        rows = []
        for place, host, digest, numbers, keys, kinds, menu, lines, flags in zip(*(texts_of(batch, c) for c in ("place", "host", "digest", "numbers", "keys", "kinds", "menu", "lines", "flags"))):
            if place == _KNOWN:
                known = dict(zip(lines, flags))
            elif place >= 0 and (found := foreign_lines(numbers, keys, kinds, menu, known)):
                rows.append((host, digest, found))
        types = (pa.string(), pa.string(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], ["host", "digest", "found"])


def _url_parts(url: str) -> tuple[F.Column, F.Column]:
    """Host and path of a URL column, however spelt; empty where there is none."""
    low = F.lower(F.trim(F.coalesce(F.col(url), F.lit(""))))
    rest = F.regexp_replace(low, r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*", 0), r":\d+$|\.$", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), r"/{2,}", "/"), r"/+$", "")
    return host, path


_PAGE = "host string, path string, digest string, numbers array<int>, keys array<bigint>, kinds array<tinyint>, menu boolean"


def _hashed_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in texts_of(batch, "text"):
            numbers, keys, kinds = page_lines(text)
            rows.append((numbers, keys, kinds, bool(numbers and _MENU.search(text.split("\n")[numbers[0] - 1]))))
        types = (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int8()), pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types))], ["host", "path", "digest", "numbers", "keys", "kinds", "menu"])


#: The place of the row with what is known of a block's lines, before all pages.
_KNOWN = -1000


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page with the block of neighbours of its host that it is in, and its place there.

    The last pages of a block stand at negative places before the next block of the host too, where they are only compared with. `part` and `row` say where a page came.
    """
    import xxhash
    from pyspark import TaskContext

    part, row = TaskContext.get().partitionId(), 0
    last, block, place = None, 0, BLOCK
    past: list[dict] = []
    for batch in batches:
        out = []
        for page in batch.to_pylist():
            place, row = place + 1, row + 1
            if page["host"] != last or place >= BLOCK:
                if page["host"] != last:
                    past = []
                last, place = page["host"], 0
                block = xxhash.xxh3_64_intdigest(f"{page['host']}\n{page['digest']}".encode()) - (1 << 63)
                out += [{**p, "part": part, "row": -1, "block": block, "place": n - len(past)} for n, p in enumerate(past)]
            out.append({**page, "part": part, "row": row, "block": block, "place": place})
            past = [*past, page][-NEIGHBOURS:]
        if out:
            yield pa.RecordBatch.from_pylist(out, _BLOCK_TYPE)


_BLOCK_TYPE = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("block", pa.int64()), ("place", pa.int32()), ("host", pa.string()), ("digest", pa.string()), ("numbers", pa.list_(pa.int32())), ("keys", pa.list_(pa.int64())), ("kinds", pa.list_(pa.int8())), ("menu", pa.bool_())])


def _carried(blocks: DataFrame) -> DataFrame:
    """`blocks` with the last pages of each partition before the first block of the next one too, if that has the same host: a few rows a partition."""
    ends = blocks.where("place >= 0").groupBy("part").agg(F.max("row").alias("last"), F.min_by(F.struct("host", "block"), "row").alias("first"))
    heads = F.broadcast(ends.select((F.col("part") - 1).alias("part"), F.col("first.host").alias("host"), F.col("first.block").alias("next")))  # a row a partition
    tails = blocks.where("place >= 0").join(F.broadcast(ends.select("part", "last")), "part").where(F.col("row") > F.col("last") - NEIGHBOURS)
    before = tails.join(heads, ["part", "host"]).withColumns({"place": (F.col("row") - F.col("last") - 1).cast("int"), "block": F.col("next"), "row": F.lit(-1).cast("bigint")})
    return blocks.union(before.select(*blocks.columns))


def _beside(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """The pages block by block in order, before each block a row with what is known of its lines: rows of block, line, flag."""
    known = lines.groupBy("block").agg(F.collect_list(F.struct("line", "flag")).alias("x")).select("block", F.lit(_KNOWN).alias("place"), F.col("x.line").alias("lines"), F.col("x.flag").alias("flags"))
    none = pages.select("block").distinct().join(known.select("block"), "block", "left_anti").select("block", F.lit(_KNOWN).alias("place"), F.array().cast("array<bigint>").alias("lines"), F.array().cast("array<int>").alias("flags"))
    rows = pages.unionByName(known, allowMissingColumns=True).unionByName(none, allowMissingColumns=True)
    return rows.repartition(parallelism(pages.sparkSession, 12), "block").sortWithinPartitions("block", "place")


def line_profiles(pages: DataFrame) -> DataFrame:
    """(host, line, flag): what differencing says of the lines that several pages have. `pages` are in blocks, each text of a host once."""
    every, pages = pages, pages.where("place >= 0")
    here = durable(every.groupBy("block", "host").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("lines")).select("block", "host", F.explode("lines").alias("line")))
    spread = pages.select("host", F.explode(F.array_distinct("keys")).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    spread = spread.join(pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "host")
    pooled = spread.groupBy("line").agg(F.sum("n").alias("all_n"), F.sum("pages").alias("all_pages")).where(F.col("all_n") >= LEAST_PAGES)
    spread = durable(spread.join(pooled, "line"))
    common = here.join(spread.select("host", "line", F.lit(0).alias("flag")), ["host", "line"])
    partial = _beside(every, common).select("place", "host", "keys", "kinds", "lines").mapInArrow(_differenced, "host string, line bigint, shared bigint, inside bigint, leads bigint, marked bigint")
    counts = ("shared", "inside", "marked")
    own = durable(partial.groupBy("host", "line").agg(*(F.sum(c).alias(c) for c in counts)))
    every = own.groupBy("line").agg(*(F.sum(c).alias(f"all_{c}") for c in counts))
    facts = spread.join(own, ["host", "line"], "left").join(every, "line")
    enough = (F.col("n") >= LEAST_PAGES) & (F.col("shared") >= F.when(F.col("all_n") > F.col("n"), EVIDENCE).otherwise(LEAST_PAGES))
    facts = facts.where((F.col("shared").isNotNull() & enough) | (F.col("all_shared") >= LEAST_PAGES))
    shared, inside, marked = (F.when(F.coalesce(enough, F.lit(False)), F.col(c)).otherwise(F.col(f"all_{c}")) for c in counts)
    kind = F.when(marked >= HEADING_SHARE * shared, _HEADS).when(inside >= INSIDE_SHARE * shared, _WITHIN).otherwise(_AROUND)
    strong = (F.col("n") >= LEAST_PAGES) & (F.col("n") >= STRONG_SHARE * F.col("pages")) | (F.col("all_n") >= STRONG_SHARE * F.col("all_pages"))
    flags = facts.select("host", "line", (kind + F.when(strong, _STRONG).otherwise(0)).alias("flag"))
    return here.join(flags, ["host", "line"])


def _found(records: DataFrame, text: str, url: str) -> DataFrame:
    """(host, digest, found): the line numbers outside the body of each different text of a host that has any."""
    host, path = _url_parts(url)
    pages = records.where(F.instr(text, "\n") > 0).select(host.alias("host"), path.alias("path"), F.md5(text).alias("digest"), F.col(text).alias("text"))
    hashed = pages.mapInArrow(_hashed_pages, _PAGE)
    once = hashed.groupBy("host", "digest").agg(F.min("path").alias("path"), *(F.first(c).alias(c) for c in ("numbers", "keys", "kinds", "menu")))
    once = durable(once)
    ordered = once.repartitionByRange(parallelism(records.sparkSession, 12), "host", "path", "digest").sortWithinPartitions("host", "path", "digest")
    placed = ordered.select("host", "digest", "numbers", "keys", "kinds", "menu")
    blocks = durable(placed.mapInArrow(_blocks, f"part int, row bigint, block bigint, place int, {_PAGE.replace('path string, ', '')}"))
    blocks = _carried(blocks).drop("part", "row")
    return _beside(blocks, line_profiles(blocks)).mapInArrow(_judged, "host string, digest string, found array<int>")


def page_boilerplate(records: DataFrame, key: str = "row_id", text: str = "retrieval_text", url: str = "source_url") -> DataFrame:
    """(key, line_no): the lines with letters or digits of web pages outside their main body. Null, empty and one-line texts have none."""
    rows = records.select(F.col(key), _url_parts(url)[0].alias("page_host"), F.md5(text).alias("page_digest"))
    found = _found(records, text, url)
    return rows.join(found, (F.col("page_host") == F.col("host")) & (F.col("page_digest") == F.col("digest"))).select(F.col(key), F.explode("found").alias("line_no"))


def page_bodies(records: DataFrame, key: str = "row_id", text: str = "retrieval_text", url: str = "source_url") -> DataFrame:
    """(key, removed_lines, body): every text without the lines that page_boilerplate finds; null stays null."""
    rows = records.select(F.col(key), F.col(text).alias("page_text"), _url_parts(url)[0].alias("page_host"), F.md5(text).alias("page_digest"))
    joined = rows.join(_found(records, text, url), (F.col("page_host") == F.col("host")) & (F.col("page_digest") == F.col("digest")), "left")
    gone = F.coalesce("found", F.array().cast("array<int>"))
    kept = F.array_join(F.filter(F.split("page_text", "\n"), lambda x, i: ~F.array_contains(gone, i + 1)), "\n")
    return joined.select(F.col(key), F.size(gone).alias("removed_lines"), F.when(F.size(gone) > 0, kept).otherwise(F.col("page_text")).alias("body"))
