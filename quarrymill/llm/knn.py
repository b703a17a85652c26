"""Most similar vectors of every vector: multi-index hashing over learned rotated binary codes.

Codes: orthogonal rotations are learned by iterative quantisation on a bounded sample of unit vectors (`FIT_ROWS`, the only use of a sample: it sets the
rotations, every vector is indexed). The signs of a rotated vector are its code bits. The code is split into a few substrings, and each substring is an index of its own.

Probing: two codes that differ in few bits differ in at most `flips` bits in some substring (pigeonhole). Each vector goes to every bucket that its substring reaches by setting
up to `flips` of its unset bits. Substrings x and y then meet at x | y whenever neither has more than `flips` bits that the other lacks, so in every case within the Hamming
radius `flips` and in some up to twice that, and no bit is probed from both sides. `plan` chooses length, radius and number of substrings so that a pair at `min_cosine` meets with
probability `recall`: the length follows the number of vectors (`BUCKET_ROWS` vectors to a bucket), the radius follows the length, and so the number of substrings
stays at `MOST_TABLES` or fewer. Pairs of a bucket are compared by the Hamming distance of `COMPARED_BITS` code bits, up to 3.2 standard deviations beyond what `min_cosine` gives on average (7 in
10,000 pairs at that cosine differ in more); survivors are reranked by the cosine of their floats.

Equal vectors are folded into one before indexing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import attach, compare_buckets, hot_buckets, meet
from quarrymill.session import durable, parallelism

FIT_ROWS = 5_000
LEAST_BITS = 14
BUCKET_ROWS = 512
MOST_TABLES = 12
#: Code bits that travel with a row to its buckets.
COMPARED_BITS = 192
SPREAD = 3.2
HOT_ROWS = 20_000
SAMPLE = 0.05


def usable(batch: pa.RecordBatch, name: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and float64 values of the vectors of `size` finite numbers that are not all zero."""
    column = batch.column(batch.schema.get_field_index(name))
    lengths = np.nan_to_num(np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.float64), nan=-1)
    at = np.flatnonzero(lengths == size)
    if not len(at):
        return at, np.zeros((0, size))
    values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    with np.errstate(all="ignore"):
        ok = np.isfinite(values).all(axis=1) & (np.abs(values).sum(axis=1) > 0)
    return at[ok], values[ok] + 0.0


def unit(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def learn_rotations(sample: np.ndarray, count: int, seed: int = 11, rounds: int = 15, size: int | None = None) -> np.ndarray:
    """`count` rotations by iterative quantisation, each from another random start."""
    rng = np.random.default_rng(seed)
    size = size or sample.shape[1]
    out = []
    for _ in range(count):
        r, _ = np.linalg.qr(rng.standard_normal((size, size)))
        for _ in range(rounds if len(sample) >= 2 * size else 0):
            v = sample @ r
            u, _, w = np.linalg.svd(np.where(v >= 0, 1.0, -1.0).T @ sample)
            r = (u @ w).T
        out.append(r)
    return np.concatenate(out, axis=1)


def code_bits(values: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    return unit(values) @ rotations >= 0


def meeting(bits: int, flips: int, p: float) -> float:
    """Probability that two substrings, each bit of which differs with probability p, meet: neither has over `flips` set bits that the other lacks."""
    out = 0.0
    for d in range(2 * flips + 1):
        split = sum(math.comb(d, up) for up in range(d + 1) if up <= flips and d - up <= flips) / 2**d
        out += math.comb(bits, d) * p**d * (1 - p) ** (bits - d) * split
    return out


def plan(rows: int, min_cosine: float, recall: float, bits: int | None = None) -> tuple[int, int, int]:
    """Length and number of substrings, and how many bits are set in probing, for `rows` vectors; a given length `bits` is kept."""
    bits = bits or max(LEAST_BITS, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS)))
    p = math.acos(min_cosine) / math.pi
    for flips in range(1, bits):
        tables = math.ceil(math.log(1 - recall) / math.log(1 - meeting(bits, flips, p)))
        if tables <= MOST_TABLES:
            break
    return bits, tables, flips


def _coded(rotations: np.ndarray, bits: int, tables: int, size: int):
    """The compared code words of each usable vector, and its substrings."""
    import xxhash

    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    own = np.int64(1) << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = usable(batch, "vector", size)
            if not len(at):
                continue
            b = code_bits(values, rotations)
            words = [pa.array((b[:, n : n + 64] * weights).sum(axis=1, dtype=np.uint64).view(np.int64)) for n in range(0, COMPARED_BITS, 64)]
            subs = (b[:, : tables * bits].reshape(-1, tables, bits) * own).sum(axis=2)
            digests = [xxhash.xxh3_128_digest(x.tobytes()) for x in values.astype(np.float32)]
            lists = pa.ListArray.from_arrays(np.arange(0, subs.size + 1, tables, dtype=np.int32), pa.array(subs.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(digests, pa.binary()), lists, *words], ["row_key", "digest", "subs", *_WORDS])

    return run


_WORDS = [f"w{n}" for n in range(COMPARED_BITS // 64)]
_WORD_SCHEMA = ", ".join(f"{w} bigint" for w in _WORDS)


def _probed(bits: int, tables: int, flips: int):
    """A row for each bucket that a vector's substrings reach by setting up to `flips` unset bits."""
    masks = np.array([sum(1 << i for i in chosen) for n in range(flips + 1) for chosen in combinations(range(bits), n)], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 2000):
                batch = whole.slice(s, 2000)
                subs = batch.column(1).flatten().to_numpy().reshape(-1, tables)
                row, table, mask = np.nonzero((subs[:, :, None] & masks) == 0)
                buckets = (table << bits) | subs[row, table] | masks[mask]
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(buckets), *(batch.column(c).take(row) for c in (0, *range(2, 2 + len(_WORDS))))], ["bucket", "id", *_WORDS])

    return run


def _radius(min_cosine: float) -> int:
    p = math.acos(min_cosine) / math.pi
    return math.ceil(COMPARED_BITS * p + SPREAD * math.sqrt(COMPARED_BITS * p * (1 - p)))


def _reranked(k: int, min_cosine: float):
    """For each end of a task's pairs its k most similar other ends, ties to the smaller id."""

    def work(a: np.ndarray, b: np.ndarray, values: dict[int, np.ndarray]) -> list[pa.Array]:
        ids = np.array(sorted(values), dtype=np.int64)
        vectors = unit(np.array([values[i] for i in ids.tolist()], dtype=np.float64))
        x, y = np.searchsorted(ids, a), np.searchsorted(ids, b)
        cosine = np.concatenate([np.round(np.einsum("ij,ij->i", vectors[x[s : s + 100_000]], vectors[y[s : s + 100_000]]), 9) for s in range(0, len(x), 100_000)])
        near = cosine >= min_cosine
        left, right, cosine = np.concatenate([a[near], b[near]]), np.concatenate([b[near], a[near]]), np.concatenate([cosine[near]] * 2)
        order = np.lexsort((right, -cosine, left))
        left, right, cosine = left[order], right[order], cosine[order]
        first = np.flatnonzero(np.append(True, left[1:] != left[:-1])) if len(left) else np.zeros(0, np.int64)
        place = np.arange(len(left)) - np.repeat(first, np.diff(np.append(first, len(left))))
        keep = place < k
        return [pa.array(left[keep]), pa.array(right[keep]), pa.array(cosine[keep])]

    return work


def nearest_pairs(records: DataFrame, key: str = "row_id", vector: str = "embedding", k: int = 5, min_cosine: float = 0.85, size: int = 64, recall: float = 0.95, bits: int | None = None) -> DataFrame:
    """Pairs (key_a, key_b) of rows with a cosine of at least `min_cosine` where one is among the other's k nearest rows.

    Nearest: highest cosine, ties to the smaller key; a row is not its own neighbour. Rows whose vector is null, has not `size`
    numbers, holds null, NaN or infinity, or is all zeros take no part. Equal vectors are neighbours at cosine 1. Empty input gives an empty result; other columns are ignored.
    `bits` sets the length of substrings that else follows the number of rows.
    """
    spark = records.sparkSession
    base = records.select(F.col(key).alias("row_key"), F.col(vector).cast("array<float>").alias("vector"))
    rows = base.count()
    bits, tables, flips = plan(rows, min_cosine, recall, bits)
    fit = base.where(F.size("vector") == size).sample(min(1.0, 3 * FIT_ROWS / max(1, rows)), seed=3).limit(FIT_ROWS).select("row_key", "vector").toArrow()
    sample = [usable(b, "vector", size)[1] for b in fit.to_batches()]
    sample = np.concatenate(sample) if sample else np.zeros((0, size))
    rotations = learn_rotations(unit(sample) if len(sample) else sample, math.ceil(max(COMPARED_BITS, tables * bits) / size), size=size)
    coded = durable(base.mapInArrow(_coded(rotations, bits, tables, size), f"row_key bigint, digest binary, subs array<bigint>, {_WORD_SCHEMA}"))
    folded = durable(_fold(coded, k))

    def probed(t: DataFrame) -> DataFrame:
        return t.select("id", "subs", *_WORDS).mapInArrow(_probed(bits, tables, flips), f"bucket bigint, id bigint, {_WORD_SCHEMA}")

    hot = durable(hot_buckets(probed(folded.sample(SAMPLE, seed=7)), SAMPLE, HOT_ROWS))
    hot = hot if hot.head(1) else None
    radius = _radius(min_cosine)

    def near(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        return sum(np.bitwise_count((x ^ y).view(np.uint64)) for x, y in zip(left, right)) <= radius

    parts = parallelism(spark, 12)
    pairs = durable(compare_buckets(probed(folded), near, parts, hot))
    scored = meet(pairs, base.select(F.col("row_key").alias("id"), F.col("vector").alias("value")), _reranked(k, min_cosine), "a bigint, b bigint, cosine double", list, parts)
    best = scored.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))).where(F.col("r") <= k).select("a", "b", "cosine")
    head = folded.select("id", "head")
    others = best.join(head.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), F.transform("head", lambda m: F.struct((-F.col("cosine")).alias("d"), m.alias("m"))).alias("list"))
    own = head.select("id", F.transform("head", lambda m: F.struct(F.lit(-1.0).alias("d"), m.alias("m"))).alias("list"))
    # at most k lists of at most k + 1 members for each vector
    near_rows = others.union(own).groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("list"))), 1, k + 1).alias("near"))
    lists = durable(folded.select("digest", "id", "copies").join(near_rows.where(F.size("near") > 1), "id").select("digest", "copies", "near"))
    mine = attach(coded.select("row_key", "digest"), lists, "digest").select("row_key", F.explode(F.slice(F.filter("near", lambda x: x["m"] != F.col("row_key")), 1, k)).alias("n"))
    return mine.select(F.least("row_key", "n.m").alias(f"{key}_a"), F.greatest("row_key", "n.m").alias(f"{key}_b")).distinct()


def _fold(coded: DataFrame, k: int) -> DataFrame:
    """One row for each distinct vector: its smallest key, its number of copies, its code and its k + 1 smallest keys.

    The keys are first cut to k + 1 within each digest by rank, so that a large group of copies is never gathered.
    """
    ranked = coded.select("digest", "row_key", F.row_number().over(Window.partitionBy("digest").orderBy("row_key")).alias("r")).where(F.col("r") <= k + 1)
    heads = ranked.groupBy("digest").agg(F.array_sort(F.collect_list("row_key")).alias("head"))
    codes = coded.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.first(F.struct("subs", *_WORDS)).alias("c"))
    return heads.join(codes, "digest").select(F.col("head")[0].alias("id"), "digest", "head", "copies", "c.*")
