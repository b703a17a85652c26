"""Pieces that several operators of this subpackage share: words, shingle hashes, bucket comparison."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_VOCABULARY_LIMIT = 200_000
_word_hashes: dict[str, int] = {}


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits of the lower-cased text."""
    return WORD.findall(text.lower()) if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all words of all texts one after the other, and the number of words of each text.

    The per-process memo of word codes only saves time: it is emptied when it grows past a fixed size.
    """
    import xxhash

    memo = _word_hashes
    if len(memo) > _VOCABULARY_LIMIT:
        memo.clear()
    counts = np.zeros(len(texts), dtype=np.int64)
    flat: list[int] = []
    for i, text in enumerate(texts):
        ws = words(text)
        counts[i] = len(ws)
        try:
            flat.extend([memo[w] for w in ws])
        except KeyError:
            for w in ws:
                if w not in memo:
                    memo[w] = xxhash.xxh3_64_intdigest(w.encode())
                flat.append(memo[w])
    return np.array(flat, dtype=np.uint64), counts


def shingles(codes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside each text, and the number of runs of each text."""
    runs = np.maximum(counts - size + 1, 0)
    if len(codes) < size or not runs.any():
        return np.zeros(0, np.uint64), runs
    rolled = np.zeros(len(codes) - size + 1, dtype=np.uint64)
    for k in range(size):
        rolled = mix64(rolled * _MIX + codes[k : len(codes) - size + 1 + k] + np.uint64(k + 1))
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    keep = np.repeat(starts, runs) + _ramp(runs)
    return rolled[keep], runs


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of `lengths`, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths)


def compare_buckets(
    df: DataFrame,
    near: Callable[[list[np.ndarray], list[np.ndarray]], np.ndarray],
    partitions: int,
    hot: DataFrame | None = None,
    block: int = 2048,
) -> DataFrame:
    """Distinct pairs (a, b), a < b, of ids that share a bucket and that `near` lets through.

    `df` has bucket, id and any number of further bigint columns; `near(left, right)` gets the further columns of
    two broadcastable sets of rows and says which pairs pass. `hot` (bucket, blocks) names large buckets: each is cut
    into that many blocks by a hash of id, a row goes to the tasks of all its block pairs, and each block pair is
    compared in its own task, so no bucket, however large, ends in one task, and no pair is lost. Pairs are filtered
    before they are emitted.
    """
    payload = [c for c in df.columns if c not in ("bucket", "id")]
    zero = F.lit(0).cast("int")
    if hot is not None:
        df = df.join(hot, "bucket", "left").withColumn("g", F.coalesce("blocks", F.lit(1)).cast("int"))
        mine = F.pmod(F.xxhash64("id"), F.col("g").cast("bigint")).cast("int")
        tasks = F.when(F.col("g") == 1, F.array(F.struct(zero.alias("i"), zero.alias("j"), zero.alias("side")))).otherwise(
            F.transform(
                F.sequence(zero, F.col("g") - 1),
                lambda o: F.struct(F.least(mine, o).alias("i"), F.greatest(mine, o).alias("j"), F.when(mine <= o, 1).otherwise(2).alias("side")),
            )
        )
        df = df.withColumn("t", F.explode(tasks)).select("bucket", "t.i", "t.j", "t.side", "id", *payload)
    else:
        df = df.select("bucket", zero.alias("i"), zero.alias("j"), zero.alias("side"), "id", *payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for cols, starts in _whole_groups(batches, ["bucket", "i", "j"], ["i", "j", "side", "id", *payload]):
            held += _near_in_groups(cols, starts, near, block)
            if sum(map(len, held)) > 200_000:
                yield _pairs_batch(held)
                held = []
        if held:
            yield _pairs_batch(held)

    shuffled = df.repartition(partitions, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return shuffled.mapInArrow(run, "a bigint, b bigint").distinct()


_SMALL = 48


def _near_in_groups(cols: list[np.ndarray], starts: np.ndarray, near: Callable, block: int) -> list[np.ndarray]:
    """Arrays of passing pairs of the groups that begin at `starts`; small groups are compared all at once."""
    i, j, side, ids, payload = cols[0], cols[1], cols[2], cols[3], cols[4:]
    sizes = np.diff(np.append(starts, len(ids)))
    out = []
    small = (sizes > 1) & (sizes <= _SMALL) & (i[starts] == j[starts])
    if small.any():
        rows = np.repeat(starts[small], sizes[small]) + _ramp(sizes[small])
        group = np.repeat(np.flatnonzero(small), sizes[small])
        for d in range(1, int(sizes[small].max())):
            at = np.flatnonzero(group[d:] == group[:-d])
            p, q = rows[at], rows[at + d]
            ok = near([c[p] for c in payload], [c[q] for c in payload])
            out.append(np.stack([ids[p[ok]], ids[q[ok]]], axis=1))
    for g in np.flatnonzero((sizes > 1) & ~small):
        rows = np.arange(starts[g], starts[g] + sizes[g])
        same = i[starts[g]] == j[starts[g]]
        left, right = (rows, rows) if same else (rows[side[rows] == 1], rows[side[rows] == 2])
        for s in range(0, len(left), block):
            for u in range(s if same else 0, len(right), block):
                x, y = left[s : s + block], right[u : u + block]
                ok = near([c[x][:, None] for c in payload], [c[y][None, :] for c in payload])
                if same and s == u:
                    ok = np.triu(ok, 1)
                p, q = np.nonzero(ok)
                out.append(np.stack([ids[x[p]], ids[y[q]]], axis=1))
    return [x for x in out if len(x)]


def _pairs_batch(held: list[np.ndarray]) -> pa.RecordBatch:
    ab = np.sort(np.concatenate(held), axis=1)
    ab = np.unique(ab[ab[:, 0] != ab[:, 1]], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["a", "b"])


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Sorted input in pieces of whole groups: int64 arrays of `names` and where groups start; a group may span batches."""
    carry: list[np.ndarray] | None = None
    pending: list[list[np.ndarray]] = []

    def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in [*keys, *names]]

    def changes(cols: list[np.ndarray]) -> np.ndarray:
        change = np.ones(len(cols[0]), bool)
        change[1:] = False
        for k in range(len(keys)):
            change[1:] |= cols[k][1:] != cols[k][:-1]
        return np.flatnonzero(change)

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = arrays(batch)
        if carry is not None and all(carry[k][-1] == cols[k][0] == cols[k][-1] for k in range(len(keys))):
            pending.append(cols)  # still inside one large group
            continue
        if pending:
            carry = [np.concatenate([carry[c], *(p[c] for p in pending)]) for c in range(len(cols))]
            pending = []
        if carry is not None:
            cols = [np.concatenate([x, y]) for x, y in zip(carry, cols)]
        starts = changes(cols)
        last = starts[-1]
        if last:
            yield [c[:last] for c in cols[len(keys) :]], starts[:-1]
        carry = [c[last:] for c in cols]
    if carry is not None:
        if pending:
            carry = [np.concatenate([carry[c], *(p[c] for p in pending)]) for c in range(len(carry))]
        yield carry[len(keys) :], np.zeros(1, np.int64)


def hot_buckets(sample: DataFrame, fraction: float, limit: int) -> DataFrame:
    """(bucket, blocks) of buckets that, by a sample, hold over `limit` rows.

    The sample only chooses how a bucket's work is cut up; every row is compared either way.
    """
    n = F.count(F.lit(1))
    return (
        sample.groupBy("bucket").agg(n.alias("n")).where(F.col("n") >= max(3, int(limit * fraction)))
        .select("bucket", F.greatest(F.lit(2), F.ceil(F.col("n") / F.lit(limit * fraction))).cast("int").alias("blocks"))
    )


def attach(rows: DataFrame, folded: DataFrame, key: str, most: int = 100_000) -> DataFrame:
    """`rows` with the columns of `folded`, which has one row a key and its number of rows in `copies`.

    Keys of more than `most` rows are broadcast, of which there are at most (number of rows) / `most`, so that no hot key is shuffled into one task; the rest meets by a
    shuffle. Rows whose key is not in `folded` are left out.
    """
    hot = folded.where(F.col("copies") > most)
    cold = folded.where(F.col("copies") <= most)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def meet(pairs: DataFrame, items: DataFrame, work: Callable[[np.ndarray, np.ndarray, dict[int, object]], list[pa.Array]], schema: str, prepare: Callable[[list], list], partitions: int, per: int = 2_000) -> DataFrame:
    """What `work(a, b, values)` returns for the pairs (a, b), with the values of both sides at hand.

    `items` is (id, value). Ids are hashed into blocks, so many that a task (a pair of blocks) has about `per` pairs, and a value is sent once to each task that needs it: a cluster of m rows
    costs m times the number of blocks in values, not its number of pairs. `prepare` is applied once to the values of a task. Nothing is dropped; blocks only cut the work.
    """
    blocks = max(1, math.ceil(math.sqrt(pairs.count() / per)))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    cut = pairs.select((block("a") * blocks + block("b")).alias("task"), "a", "b")
    need = cut.select("task", F.col("a").alias("id")).union(cut.select("task", F.col("b").alias("id"))).distinct()
    sent = need.join(items.select("id", "value"), "id").select("task", F.lit(0).alias("kind"), F.col("id").alias("a"), F.lit(None).cast("bigint").alias("b"), "value")
    both = sent.unionByName(cut.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values: dict[int, object] = {}
        held: list[list[np.ndarray]] = []
        now = None

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                a, b = (np.concatenate([h[c] for h in held]) for c in (0, 1))
                out = work(a, b, values)
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays(out, names)
            values.clear()
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            task, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero((task[1:] != task[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), len(task)]
            for s, e in zip(edges, edges[1:]):
                if task[s] != now:
                    yield from done()
                    now = task[s]
                part = batch.slice(s, e - s)
                if kind[s] == 0:
                    values.update(zip(part.column(2).to_pylist(), prepare(part.column(4).to_pylist())))
                else:
                    held.append([part.column(2).to_numpy(), part.column(3).to_numpy()])
        yield from done()

    shuffled = both.select("task", "kind", "a", "b", "value").repartition(partitions, "task").sortWithinPartitions("task", "kind")
    return shuffled.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
