"""Splitting oversized texts at natural boundaries, by prefix sums of word offsets and binary search."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import texts_of

_WORD = re.compile(r"[^\W_]+")
#: Ends of lines, and of sentences before white space.
_BOUNDARY = re.compile(r"\n+|[.!?…؟。]+[\"'”’»)\]]*(?=\s)")


def word_spans(text: str) -> list[tuple[int, int]]:
    """Start and end of each word of `text`: the maximal runs of letters and digits of the lower-cased text.

    Lower-casing may lengthen a text (İ); then a word's place is found through the lengths of the characters' lower forms.
    """
    low = text.lower()
    spans = [m.span() for m in _WORD.finditer(low)]
    if len(low) == len(text):
        return spans
    origin = [i for i, ch in enumerate(text) for _ in ch.lower()]
    if len(origin) != len(low):  # only a final sigma's form depends on its place, never a length
        raise ValueError("lower-casing changed the text in an unknown way")
    return [(origin[a], origin[b - 1] + 1) for a, b in spans]


def pieces(text: str | None, limit: int = 650, overlap: int = 80) -> list[tuple[int, int, str]]:
    """(first word, word after the last, text) of the pieces of `text`, in order.

    Each piece has at most `limit` words and begins `overlap` words before the end of the one before. It ends at the last
    line or sentence end that leaves it at most `limit` and more than `overlap` words; where there is none, after `limit`
    words. A text of at most `limit` words is one piece, null and wordless texts included (as an empty or the same text).
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    text = text or ""
    spans = word_spans(text)
    n = len(spans)
    if n <= limit:
        return [(0, n, text)]
    starts = [a for a, _ in spans]
    # after how many words each boundary lies: sorted, as the boundaries are
    cuts = [bisect_right(starts, m.start()) for m in _BOUNDARY.finditer(text)]
    out, first = [], 0
    while True:
        if n - first <= limit:
            out.append((first, n, text[0 if not first else starts[first] :]))
            return out
        at = bisect_right(cuts, first + limit) - 1
        last = cuts[at] if at >= 0 and cuts[at] > first + overlap else first + limit
        out.append((first, last, text[0 if not first else starts[first] : starts[last]].rstrip()))
        first = last - overlap


def split_oversized(records: DataFrame, key: str = "row_id", text: str = "retrieval_text", limit: int = 650, overlap: int = 80) -> DataFrame:
    """(key, piece_no, piece_count, first_word, last_word, piece_text): all rows' texts as pieces of at most `limit` words.

    piece_no counts from 1; last_word is the place after the last word. Null texts come out as one empty piece. See pieces().
    Only texts of more than `limit` characters, which alone can have more words, leave the JVM.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    schema = f"`{key}` {records.schema[key].dataType.simpleString()}, piece_no int, piece_count int, first_word int, last_word int, piece_text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            rows: list[tuple] = []
            for i, t in enumerate(texts_of(batch, text)):
                cut = pieces(t, limit, overlap)
                at += [i] * len(cut)
                rows += [(k + 1, len(cut), a, b, s) for k, (a, b, s) in enumerate(cut)]
            cols = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *cols], [key, "piece_no", "piece_count", "first_word", "last_word", "piece_text"])

    return records.select(key, whole.alias(text)).mapInArrow(run, schema)


def oversized(records: DataFrame, key: str = "row_id", text: str = "retrieval_text", limit: int = 650, overlap: int = 80) -> DataFrame:
    """The pieces of the texts that need more than one; texts too short for that in characters stay in the JVM."""
    return split_oversized(records.where(F.length(text) > limit), key, text, limit, overlap).where(F.col("piece_count") > 1)
