"""Markdown blocks, sections and chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import sentences, words


def heading_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, level, heading, section): each non-blank line with the last heading at or above it, as a path of levels 1 and 2.

    The last heading of a level holds until a heading of that or a higher level.
    """
    lines = df.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line")).where(F.trim("line") != "")
    level = F.length(F.regexp_extract("line", r"^(#{1,6})\s", 1))
    title = F.trim(F.regexp_replace("line", r"^#{1,6}\s+", ""))
    up_to = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = lines.withColumn("level", level).withColumn("h1", F.last(F.when(level == 1, title), ignorenulls=True).over(up_to))
    marked = marked.withColumn("h2", F.last(F.when(level == 2, title).when(level == 1, F.lit("")), ignorenulls=True).over(up_to))
    return marked.select(key, (F.col("pos") + 1).alias("line_no"), "level", F.when(F.col("level") > 0, title).alias("heading"), F.concat_ws(" > ", "h1", F.nullif("h2", F.lit(""))).alias("section"))


def word_windows(df: DataFrame, key: str, text: str, size: int = 450, overlap: int = 80) -> DataFrame:
    """(key, chunk_index, first_word, chunk_words, chunk): windows of `size` words that share `overlap`; a short text is one, a wordless none."""
    step = size - overlap
    spread = df.select(key, words(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil((F.size("w") - overlap) / step) - 1, F.lit(0)).cast("int"))
    cut = spread.select(key, "w", F.explode(starts).alias("chunk_index"))
    part = F.slice("w", F.col("chunk_index") * step + 1, size)
    return cut.select(key, "chunk_index", (F.col("chunk_index") * step).alias("first_word"), F.size(part).alias("chunk_words"), F.array_join(part, " ").alias("chunk"))


def neighbours(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """`df` with the value before and after each row of its group, null at the ends."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("previous", F.lag(value).over(w)).withColumn("next", F.lead(value).over(w))


_BLOCK = re.compile(r"\n\s*\n")
_SENTENCE = re.compile(r"(?<=[.!?؟…])\s+")


def _estimate(text: str) -> int:
    run = re.findall(r"[A-Za-z0-9]+", text)
    rest = re.sub(r"[A-Za-z0-9\s]+", "", text)
    return sum(-(-len(r) // 4) for r in run) + sum(1 if ord(c) < 128 else len(c.encode()) for c in rest)


def blocks(text: str) -> list[tuple[tuple[str, ...], str, str]]:
    """(section path, kind, text) of a markdown text's blocks; a heading opens a section and is a block of its own."""
    path: list[str] = []
    out = []
    fence = False
    for part in _BLOCK.split(text):
        rest: list[str] = []
        for line in part.split("\n"):
            if line.lstrip().startswith("```"):
                fence = not fence
            m = None if fence else re.match(r"^(#{1,6})\s+(.*)", line)
            if m:
                if rest:
                    out.append((tuple(path), _kind(rest), "\n".join(rest)))
                    rest = []
                path = [*path[: len(m[1]) - 1], m[2].strip()]
                out.append((tuple(path), "heading", line.strip()))
            elif line.strip() or fence:
                rest.append(line)
        if rest:
            out.append((tuple(path), _kind(rest), "\n".join(rest)))
    return out


def _kind(lines: list[str]) -> str:
    if lines[0].lstrip().startswith("```"):
        return "code"
    if all(line.lstrip().startswith("|") for line in lines):
        return "table"
    if all(re.match(r"^\s*(?:[-*+]|\d+[.)])\s", line) for line in lines):
        return "list"
    return "paragraph"


def split_units(text: str, most: int) -> list[str]:
    """Pieces of at most `most` estimated tokens: sentences, else words, else characters."""
    out: list[str] = []
    for sentence in _SENTENCE.split(text):
        if _estimate(sentence) <= most:
            out.append(sentence)
            continue
        held = ""
        for word in sentence.split():
            while _estimate(word) > most:
                n = max(1, most // 4)
                word, head = word[n:], word[:n]
                out += [x for x in (held, head) if x]
                held = ""
            joined = f"{held} {word}".strip()
            if _estimate(joined) > most:
                out.append(held)
                joined = word
            held = joined
        if held:
            out.append(held)
    return [u for u in out if u.strip()]


def section_chunks(text: str | None, target: int = 450, most: int = 650, overlap: int = 80) -> list[tuple[str, str, int]]:
    """(section, text, tokens): chunks that stay inside a section, are filled to `target`, never over `most`, and repeat about `overlap` tokens within a section that is cut."""
    out: list[tuple[str, str, int]] = []
    sections: list[tuple[tuple[str, ...], list[str]]] = []
    for path, _, body in blocks(text or ""):
        if not sections or sections[-1][0] != path:
            sections.append((path, []))
        sections[-1][1].append(body)
    for path, bodies in sections:
        units = [u for b in bodies for u in ([b] if _estimate(b) <= target else split_units(b, target))]
        held: list[str] = []
        for unit in units:
            if held and _estimate(" ".join([*held, unit])) > target:
                out.append((" > ".join(path), "\n".join(held), _estimate(" ".join(held))))
                tail: list[str] = []
                for back in reversed(held):
                    if _estimate(" ".join([back, *tail])) > overlap:
                        break
                    tail.insert(0, back)
                held = tail if _estimate(" ".join([*tail, unit])) <= most else []
            held.append(unit)
        if held:
            out.append((" > ".join(path), "\n".join(held), _estimate(" ".join(held))))
    return out


def markdown_chunks(df: DataFrame, key: str, text: str, target: int = 450, most: int = 650, overlap: int = 80) -> DataFrame:
    """(key, chunk_index, chunk_count, section, tokens, chunk): section-bound chunks; null and blank texts have none."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                cut = section_chunks(t, target, most, overlap)
                at += [i] * len(cut)
                rows += [(n, len(cut), s, tokens, body) for n, (s, body, tokens) in enumerate(cut)]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds))], [key, "chunk_index", "chunk_count", "section", "tokens", "chunk"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, chunk_index int, chunk_count int, section string, tokens int, chunk string")


def sentence_windows(docs: DataFrame, key: str, text: str, most_sentences: int = 4, most_chars: int = 700) -> DataFrame:
    """(key, span_no, span): sentences packed into spans of at most `most_sentences`, ended early from 65 % of `most_chars` on; a longer sentence stands alone, cut at `most_chars`.

    Null and empty texts have no span.
    """

    def fold(acc, s):
        joined = F.when(acc["open"] == "", s).otherwise(F.concat(acc["open"], F.lit(" "), s))
        over = (acc["open"] != "") & ((F.length(joined) > most_chars) | (acc["n"] >= most_sentences) | (F.length(acc["open"]) >= 0.65 * most_chars))
        return F.struct(F.when(over, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]).alias("done"), F.when(over, s).otherwise(joined).alias("open"), F.when(over, 1).otherwise(acc["n"] + 1).alias("n"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))
    spans = F.aggregate("s", start, fold, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))
    cut = docs.where(F.col(text).isNotNull()).select(key, sentences(F.col(text)).alias("s")).select(key, F.posexplode(spans).alias("span_no", "span"))
    return cut.select(key, "span_no", F.left("span", F.lit(most_chars)).alias("span"))


def enforce_chunk_limit(chunks: DataFrame, text: str, most_chars: int) -> DataFrame:
    """`chunks`, whose reading fails if any text is longer than `most_chars`: nothing is ever cut to fit."""
    long = F.concat(F.lit("chunk of "), F.length(text).cast("string"), F.lit(f" characters, at most {most_chars} are allowed"))
    return chunks.withColumn(text, F.when(F.length(text) > most_chars, F.raise_error(long)).otherwise(F.col(text)))
