"""Near-duplicate records with small edits, found by anchor points of a covering code.

A text's set of five-word shingles is summarised by a fingerprint of `SYMBOLS` min-hash symbols, each a number of the field of P = 2^31 - 1 elements. The
anchors are the words of a Reed-Solomon code: the values, at the points 1..SYMBOLS, of all polynomials of a degree below its dimension k. This code covers the
space with radius R = SYMBOLS - k, since a polynomial can be laid through any k symbols. A fingerprint goes to every anchor within R + D, D being the threshold of
symbols in which two fingerprints may differ. With D = k - DIMENSION these are the codewords that agree with it on at least DIMENSION symbols, whatever k is. They are
too many to be written one by one (the field has 2^31 elements), but they come in families: all codewords through the same DIMENSION symbols, named by the one polynomial of
degree below DIMENSION through them. One row is written for each family, 56 in all. Fingerprints that agree on DIMENSION symbols, so more than the D that the
triangle inequality promises, have a family in common; others do not meet. At an anchor only sketches are compared (64 one-bit min-hashes); survivors are verified on the shingle
sets of their whole texts.

Identical texts are first folded into one representative, so copies cost one row and lose no link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import attach, compare_buckets, hot_buckets, meet, mix64, shingles, texts_of, word_codes
from quarrymill.operators.dedup import components
from quarrymill.session import durable, parallelism

P = (1 << 31) - 1
SYMBOLS = 8
DIMENSION = 3
SKETCH_BITS = 64
#: Standard deviations above the mean number of differing sketch bits at which a pair is given up: 3 in a million pairs at the threshold itself.
SKETCH_SPREAD = 4.5
SHINGLE = 5
HOT_ROWS = 20_000
SAMPLE = 0.02

_SEEDS = mix64(np.arange(1, SYMBOLS + SKETCH_BITS + 1, dtype=np.uint64)) | np.uint64(1)


def _minima(hashes: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Min-hashes, one row a seed and one column a text; texts must have at least one shingle."""
    starts = np.concatenate([[0], np.cumsum(runs)[:-1]])
    out = np.empty((len(_SEEDS), len(runs)), dtype=np.uint64)
    for k, seed in enumerate(_SEEDS):
        h = (hashes ^ (seed >> np.uint64(7))) * seed
        h ^= h >> np.uint64(29)
        out[k] = np.minimum.reduceat(h, starts)
    return out


def fingerprints(texts: list[str | None], least_words: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the texts of at least `least_words` words, their symbols and their sketches."""
    codes, counts = word_codes(texts)
    use = counts >= max(least_words, size)
    codes = codes[np.repeat(use, counts)]
    hashes, runs = shingles(codes, counts[use], size)
    if not use.any():
        return np.flatnonzero(use), np.zeros((0, SYMBOLS), np.int64), np.zeros(0, np.int64)
    minima = mix64(_minima(hashes, runs))
    symbols = (minima[:SYMBOLS].T % np.uint64(P)).astype(np.int64)
    sketch = np.zeros(minima.shape[1], dtype=np.uint64)
    for b in range(SKETCH_BITS):
        sketch |= (minima[SYMBOLS + b] & np.uint64(1)) << np.uint64(b)
    return np.flatnonzero(use), symbols, sketch.view(np.int64)


def anchors(symbols: np.ndarray) -> np.ndarray:
    """Names of the families of anchors within reach of each fingerprint, a row each: the values of their polynomial at two further points, 62 bits in all."""
    out = np.empty((len(symbols), len(list(combinations(range(SYMBOLS), DIMENSION)))), dtype=np.int64)
    for n, chosen in enumerate(combinations(range(SYMBOLS), DIMENSION)):
        at = []
        for point in (P - 12345, P - 987654):
            value = np.zeros(len(symbols), dtype=np.int64)
            for i in chosen:
                top = bottom = 1
                for j in chosen:
                    if j != i:
                        top, bottom = top * (point - j - 1) % P, bottom * (i - j) % P
                value = (value + symbols[:, i] * (top * pow(bottom, P - 2, P) % P)) % P
            at.append(value)
        out[:, n] = (at[0] << 31) | at[1]
    return out


def _fingerprint_rows(key: str, text: str, least_words: int):
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, text)
            at, symbols, sketch = fingerprints(texts, least_words)
            if not len(at):
                continue
            digests = [xxhash.xxh3_128_digest(texts[i].encode()) for i in at]
            flat = pa.array(symbols.astype(np.int32).ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(key)).take(pa.array(at)), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(np.arange(0, flat.__len__() + 1, SYMBOLS, dtype=np.int32), flat), pa.array(sketch)],
                [key, "digest", "symbols", "sketch"],
            )

    return run


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            symbols = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(-1, SYMBOLS)
            ids = anchors(symbols)
            offsets = np.arange(0, ids.size + 1, ids.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.ListArray.from_arrays(offsets, pa.array(ids.ravel()))], ["id", "sketch", "buckets"])


def sketch_radius(threshold: float) -> int:
    """Differing sketch bits up to which a pair is verified: a bit differs with probability (1 - similarity) / 2."""
    p = (1 - threshold) / 2
    return math.ceil(SKETCH_BITS * p + SKETCH_SPREAD * math.sqrt(SKETCH_BITS * p * (1 - p)))


def shingle_lists(texts: list[str | None], size: int = SHINGLE) -> list[frozenset[int]]:
    hashes, runs = shingles(*word_codes(texts), size)
    return [frozenset(x.tolist()) for x in np.split(hashes, np.cumsum(runs)[:-1])] if len(runs) else []


def _verified(threshold: float):
    def work(a: np.ndarray, b: np.ndarray, sets: dict[int, frozenset[int]]) -> list[pa.Array]:
        sim = np.zeros(len(a))
        for n, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
            x, y = sets[i], sets[j]
            if min(len(x), len(y)) >= threshold * max(len(x), len(y)):
                common = len(x & y)
                sim[n] = common / (len(x) + len(y) - common)
        keep = sim >= threshold
        return [pa.array(a[keep]), pa.array(b[keep]), pa.array(sim[keep])]

    return work


def near_edit_links(records: DataFrame, key: str = "row_id", text: str = "retrieval_text", threshold: float = 0.8, least_words: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(links, members): similar pairs of different texts, and the rows that hold each text.

    links(a, b, similarity): a < b are the smallest keys that hold two different texts of at least `least_words` words
    whose sets of five-word shingles have a Jaccard similarity of at least `threshold`. members(row_key, a, copies): for each row of at
    least `least_words` words the smallest key with exactly its text and the number of rows that have it. Null and short texts take no part; an empty table gives
    empty results; other columns are ignored.
    """
    spark = records.sparkSession
    base = records.select(F.col(key).alias("row_key"), F.col(text).alias("row_text"))
    marked = base.mapInArrow(_fingerprint_rows("row_key", "row_text", least_words), "row_key bigint, digest binary, symbols array<int>, sketch bigint")
    # one pass over the texts; all that follows works on a few dozen bytes a row
    rows = durable(marked)
    texts = rows.groupBy("digest").agg(F.min("row_key").alias("id"), F.min_by(F.struct("symbols", "sketch"), "row_key").alias("f"), F.count(F.lit(1)).alias("copies")).select("digest", "id", "copies", "f.*")
    texts = durable(texts)
    exploded = lambda t: t.select("id", "symbols", "sketch").mapInArrow(_anchor_rows, "id bigint, sketch bigint, buckets array<bigint>").select(F.explode("buckets").alias("bucket"), "id", "sketch")
    hot = durable(hot_buckets(exploded(texts.sample(SAMPLE, seed=7)), SAMPLE, HOT_ROWS))
    hot = hot if hot.head(1) else None
    radius = sketch_radius(threshold)

    def close(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        return np.bitwise_count((left[0] ^ right[0]).view(np.uint64)) <= radius

    parts = parallelism(spark, 12)
    candidates = durable(compare_buckets(exploded(texts), close, parts, hot))
    links = meet(candidates, base.select(F.col("row_key").alias("id"), F.col("row_text").alias("value")), _verified(threshold), "a bigint, b bigint, similarity double", shingle_lists, parts)
    members = attach(rows.select("row_key", "digest"), texts.select("digest", F.col("id").alias("a"), "copies"), "digest").select("row_key", "a", "copies")
    return links, members


#: Rows of one text that are expanded in one task.
_SALTED = 20_000


def near_edit_pairs(records: DataFrame, key: str = "row_id", text: str = "retrieval_text", threshold: float = 0.7, least_words: int = 30) -> DataFrame:
    """Pairs (key_a, key_b) of rows with different texts that near_edit_links joins, every copy included.

    The rows of a text with very many copies are spread over several tasks, to each of which its links are sent.
    """
    links, members = near_edit_links(records, key, text, threshold, least_words)
    pieces = F.ceil(F.col("copies") / _SALTED).cast("int")
    members = members.withColumn("salt", F.pmod(F.xxhash64("row_key"), pieces).cast("int"))
    sizes = members.groupBy("a").agg(F.max(pieces).alias("pieces"))
    pairs = links.select("a", "b")
    for side in ("a", "b"):
        salted = pairs.join(sizes.withColumnRenamed("a", side), side).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
        pairs = salted.join(members.select(F.col("a").alias(side), F.col("row_key").alias(f"row_{side}"), "salt"), [side, "salt"]).drop("salt")
    return pairs.select(F.least("row_a", "row_b").alias(f"{key}_a"), F.greatest("row_a", "row_b").alias(f"{key}_b"))


def near_edit_groups(records: DataFrame, key: str = "row_id", text: str = "retrieval_text", threshold: float = 0.8, least_words: int = SHINGLE) -> DataFrame:
    """(key, class_id, copies, links): a row for each record of at least `least_words` words.

    class_id: the smallest key that chains of links reach; copies: rows with exactly the record's text; links: different texts that are near to it.
    """
    links, members = near_edit_links(records, key, text, threshold, least_words)
    links, members = durable(links.select("a", "b")), durable(members)
    ends = links.select("a").union(links.select("b")).groupBy("a").agg(F.count(F.lit(1)).alias("links"))
    classes = components(links.select(F.col("a").alias("id")), links).join(ends, F.col("id") == F.col("a"), "left").select("id", "component", "links")
    sized = members.groupBy("a").agg(F.max("copies").alias("copies")).join(classes, F.col("a") == F.col("id"), "left")
    sized = durable(sized.select("a", "copies", F.coalesce("component", "a").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links")))
    return attach(members.select("row_key", "a"), sized, "a").select(F.col("row_key").alias(key), "class_id", "copies", "links")
