"""Evaluation passages inside training documents, by the CGK embedding and bit-sampling hashing.

A passage is a window of `span` words (`SPAN` where nothing else is said, the least that counts as a leak). The CGK embedding walks over a window's words: at step j it writes the
current word and moves on if bit j of the word's hash is set. Windows at small edit distance then differ in few of the
written places, so edit distance becomes Hamming distance. Each key hashes `SAMPLED` random places, apart from each other, of one of `WALKS` independent embeddings, which
fail apart; equal windows agree in every key, so one key finds them all, and windows with up to two edits agree in one of the `TABLES` keys with a
probability of at least 0.9, the recall asked for (`tests/llm/test_leakage.py` measures it).

Documents and items meet in one join by key, however many items there are. Documents are read once: a bit filter of the items' keys (`FILTER_BITS` bits, its size does not
depend on the items; a full one only lets more through) drops windows no item can have. Equal windows of all documents are folded before the join, verified once by exact
edit distance, and then given back to the documents that hold them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import attach, mix64, texts_of, word_codes
from quarrymill.session import durable

SPAN = 10
STEPS = 24
SAMPLED = 3
TABLES = 12
WALKS = 12
#: A walk is seldom past the window before this step; places after it say little, and places less than `_APART` apart often hold the same word.
_WITHIN = 16
_APART = 4
#: 2 MB to every executor.
FILTER_BITS = 24

_rng = np.random.default_rng(20)
# sampled places less (_APART - 1) each are any places of a shorter walk
_PLACES = np.sort(np.stack([_rng.choice(_WITHIN - (SAMPLED - 1) * (_APART - 1), SAMPLED, replace=False) for _ in range(TABLES)]), axis=1) + np.arange(SAMPLED) * (_APART - 1)
_FACTORS = mix64(np.arange(1, SAMPLED * TABLES + 1, dtype=np.uint64)).reshape(TABLES, SAMPLED) | np.uint64(1)


def window_starts(counts: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Place of each window's first word among all words, and the text it belongs to."""
    n = np.maximum(counts - span + 1, 0)
    text = np.repeat(np.arange(len(counts)), n)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else np.zeros(0, np.int64)
    return first[text] + np.arange(len(text)) - begin[text], text


def window_keys(codes: np.ndarray, starts: np.ndarray, span: int = SPAN, tables: int = TABLES) -> np.ndarray:
    """The first `tables` keys of each window (a row each); table t is of walk t modulo WALKS."""
    keys = np.zeros((len(starts), tables), dtype=np.uint64)
    if not len(starts):
        return keys
    padded_codes = np.append(codes, np.uint64(0))
    end = starts + span
    blank = len(codes)
    for walk in range(min(WALKS, tables)):
        padded_steps = np.append(mix64(codes ^ np.uint64(0x5DEECE66D + walk)), np.uint64(0))
        at = starts.copy()
        own = np.arange(walk, tables, WALKS)
        for j in range(_PLACES[own].max() + 1):
            here = np.where(at < end, at, blank)
            used = np.argwhere(_PLACES[own] == j)
            if len(used):
                written = padded_codes[here]
                for t, s in used:
                    keys[:, own[t]] += (written ^ (written >> np.uint64(31))) * _FACTORS[own[t], s]
            at += ((padded_steps[here] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
    for t in range(tables):
        keys[:, t] = mix64(keys[:, t] + np.uint64(t))
    return keys


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Least number of inserted, deleted and replaced words that turn a into b; most + 1 if it is over `most`."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def _item_windows(tables: int, span: int):
    """A row for each window of an item and each of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, counts = word_codes(texts_of(batch, "t"))
            starts, owner = window_starts(counts, span)
            keys = window_keys(codes, starts, span, tables)
            window = _bytes(codes, starts, span)
            row = pa.array(np.repeat(owner, tables))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), pa.array(keys.ravel().view(np.int64)), pa.array([w for w in window for _ in range(tables)], pa.binary())], ["item", "key", "own"])

    return run


def _bytes(codes: np.ndarray, starts: np.ndarray, span: int) -> list[bytes]:
    raw = np.ascontiguousarray(codes[starts[:, None] + np.arange(span)]).tobytes() if len(starts) else b""
    return [raw[i : i + 8 * span] for i in range(0, len(raw), 8 * span)]


def _document_windows(bits: np.ndarray, tables: int, span: int):
    """A row for each window of a document and each of its keys that the filter knows."""
    import xxhash

    shift = np.uint64(65 - (64 * len(bits)).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 2000):
                batch = whole.slice(s, 2000)
                codes, counts = word_codes(texts_of(batch, "t"))
                starts, owner = window_starts(counts, span)
                if not len(starts):
                    continue
                keys = window_keys(codes, starts, span, tables)
                place = keys >> shift
                w, t = np.nonzero((bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))
                window = _bytes(codes, starts[w], span)
                first = np.cumsum(counts) - counts
                cols = [pa.array(starts[w] - first[owner[w]]), pa.array(keys[w, t].view(np.int64)), pa.array([xxhash.xxh3_128_digest(x) for x in window], pa.binary()), pa.array(window, pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[w])), *cols], ["doc", "first_word", "key", "digest", "held"])

    return run


def _verified(most_edits: int, span: int):
    """The pairs of windows within `most_edits` word edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 50_000):
                batch = whole.slice(s, 50_000)
                a, b = (np.frombuffer(b"".join(texts_of(batch, c)), dtype=np.uint64).reshape(-1, span) for c in ("held", "own"))
                edits = np.where((a == b).all(axis=1), 0, most_edits + 1)
                if most_edits:
                    # windows within the edits share all words but those; what a common word brought together goes here
                    common = sum((b == a[:, k, None]).any(axis=1).astype(np.int64) for k in range(span))
                    for n in np.flatnonzero((edits > 0) & (common >= span - most_edits)):
                        edits[n] = edit_distance(a[n].tolist(), b[n].tolist(), most_edits)
                keep = np.flatnonzero(edits <= most_edits)
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep)) for c in (0, 1)] + [pa.array(edits[keep], pa.int32())], ["digest", "item", "edits"])

    return run


def key_filter(keys: DataFrame) -> np.ndarray:
    """2^FILTER_BITS bits, set where a key's leading bits point; 64 of them a word."""
    place = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    placed = keys.select(place.alias("place")).select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"))
    words = placed.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    return out


def leaked_items(documents: DataFrame, items: DataFrame, texts: list[str], key: str = "doc_id", text: str = "text", item: str = "id", most_edits: int = 0, span: int = SPAN) -> DataFrame:
    """(key, item_id, edits, windows): documents that hold `span` consecutive words of an item's text, up to `most_edits` word edits.

    edits: the fewest of any of the document's windows; windows: how many of them hold a passage of the item. `texts` are the item's columns, each taken by itself. Null
    texts and texts of fewer than `span` words hold and leak nothing; copies are reported each; an item with the same passage as another is reported with it.
    """
    spark = documents.sparkSession
    tables = TABLES if most_edits else 1
    queries = reduce(DataFrame.union, [items.select(F.col(item).cast("string").alias("item"), F.col(c).alias("t")) for c in texts]).where(F.col("t").isNotNull())
    asked = durable(queries.mapInArrow(_item_windows(tables, span), "item string, key bigint, own binary").distinct())
    bits = spark.sparkContext.broadcast(key_filter(asked))
    kind = documents.schema[key].dataType.simpleString()
    chosen = documents.select(F.col(key).alias("doc"), F.col(text).alias("t"))
    hits = durable(chosen.mapInArrow(lambda batches: _document_windows(bits.value, tables, span)(batches), f"doc {kind}, first_word bigint, key bigint, digest binary, held binary"))
    # each different window once: a passage that very many documents hold is verified once
    windows = hits.groupBy("digest", "key").agg(F.first("held").alias("held"))
    same = windows.join(asked, "key").select("digest", "item", "held", "own").mapInArrow(_verified(most_edits, span), "digest binary, item string, edits int")
    same = same.groupBy("digest", "item").agg(F.min("edits").alias("edits"))
    holders = hits.select("doc", "first_word", "digest").distinct()
    copies = holders.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    found = attach(holders, durable(same.join(copies, "digest")), "digest")
    return found.groupBy("doc", "item").agg(F.min("edits").alias("edits"), F.count_distinct("first_word").cast("int").alias("windows")).select(F.col("doc").alias(key), F.col("item").alias("item_id"), "edits", "windows")
