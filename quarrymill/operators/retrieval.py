"""Lexical and dense retrieval, rank fusion, ranking metrics."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.session import durable

K1, B = 1.5, 0.75


def top_k(scored: DataFrame, query: str, item: str, score: str, k: int) -> DataFrame:
    """The k best items of each query with their rank: highest score first, ties to the smaller item."""
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(F.desc(score), item)))
    return ranked.where(F.col("rank") <= k)


#: Most bytes of query words that are sent to every executor at once; more queries go in several passes.
QUERY_BYTES = 64 << 20
_WORD = re.compile(r"[^\W_]+")


def _terms(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _best(scores: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best positive scores of each row, ties to the smaller document."""
    rows, cols = [], []
    for q in np.flatnonzero(scores.max(axis=1, initial=0) > 0):
        at = np.flatnonzero(scores[q] > 0)
        if len(at) > k:
            at = at[scores[q, at] >= np.partition(scores[q, at], len(at) - k)[len(at) - k]]
            at = at[np.lexsort((docs[at], -scores[q, at]))[:k]]
        rows.append(np.full(len(at), q))
        cols.append(at)
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _query_blocks(queries: DataFrame) -> list[list]:
    """The stated queries on the driver, in blocks of at most QUERY_BYTES; usually one."""
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // QUERY_BYTES))
    return [queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == n).select("query_id", "text").collect() for n in range(blocks)]


def _scored(docs: DataFrame, queries: DataFrame, k: int, weigh, value_schema: str) -> DataFrame:
    """Documents are read once and scored batch by batch against a block of queries; only each batch's k best of a query are shuffled."""
    kind, key = (dict(f.dtypes)[c] for f, c in ((queries, "query_id"), (docs, "doc_id")))
    names = ["query_id", "doc_id", *(f.split()[0] for f in value_schema.split(", "))]

    parts = []
    for block in _query_blocks(queries):
        score = weigh(block)

        def run(batches: Iterator[pa.RecordBatch], score=score) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for s in range(0, whole.num_rows, 1000):
                    batch = whole.slice(s, 1000)
                    ids, rows, cols, values = score(batch.column(1).to_pylist(), np.array(batch.column(0).to_pylist()))
                    if len(rows):
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), batch.column(0).take(pa.array(cols)), *values], names)

        found = docs.select("doc_id", "text").mapInArrow(run, f"query_id {kind}, doc_id {key}, {value_schema}")
        parts.append(top_k(found, "query_id", "doc_id", "score", k))
    return reduce(DataFrame.union, parts)


def _postings(texts: list[str | None], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, document, count) of the vocabulary's words in order of terms, and all lengths."""
    lengths = np.zeros(len(texts), dtype=np.int64)
    codes = []
    for n, text in enumerate(texts):
        ws = _terms(text)
        lengths[n] = len(ws)
        codes += [vocabulary[w] * len(texts) + n for w in ws if w in vocabulary]
    pairs, counts = np.unique(np.array(codes, dtype=np.int64), return_counts=True)
    return pairs // max(1, len(texts)), pairs % max(1, len(texts)), counts, lengths


def _asked(block: list, least: int = 1) -> tuple[dict[str, int], list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """The words of the queries, for each of them the queries that have it and how often, and the number of different words of each query."""
    vocabulary: dict[str, int] = {}
    held: list[dict[int, int]] = []
    sizes = np.zeros(len(block), dtype=np.int64)
    for n, row in enumerate(block):
        counts = Counter(w for w in _terms(row.text) if len(w) >= least)
        sizes[n] = len(counts)
        for w, c in counts.items():
            if w not in vocabulary:
                vocabulary[w] = len(held)
                held.append({})
            held[vocabulary[w]][n] = c
    return vocabulary, [(np.array(list(h)), np.array(list(h.values()), dtype=float)) for h in held], sizes


def bm25(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, doc_id, score, rank): the k best documents of docs(doc_id bigint, text) for each of queries(query_id, text) by BM25; positive scores only.

    A first pass counts the documents of each query word (a row a word and task is shuffled), a second one scores; no posting is ever shuffled, so a word that a third of
    all documents have costs no more than others. Null texts count as documents without words.
    """
    blocks = _query_blocks(queries)
    every = sorted({w for block in blocks for row in block for w in _terms(row.text)})
    vocabulary = {w: n for n, w in enumerate(every)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, documents, words = np.zeros(len(vocabulary) + 1, dtype=np.int64), 0, 0
        for batch in batches:
            term, _, _, lengths = _postings(batch.column(0).to_pylist(), vocabulary)
            df += np.bincount(term, minlength=len(df))
            documents, words = documents + len(lengths), words + int(lengths.sum())
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(df[at], [documents, words]))], ["term", "n"])

    counted = {r.term: r.n for r in docs.select("text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()}  # a row a query word
    n_docs = counted.get(-1, 0)
    mean = counted.get(-2, 0) / n_docs if n_docs else 0.0

    def weigh(block: list):
        words, held, _ = _asked(block)
        df = np.array([counted.get(vocabulary[w], 0) for w in words], dtype=float)
        idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
        ids = pa.array([r.query_id for r in block])

        def score(texts: list[str | None], docs: np.ndarray):
            term, doc, tf, lengths = _postings(texts, words)
            scores = np.zeros((len(block), len(texts)))
            edges = np.searchsorted(term, np.arange(len(held) + 1))
            for t in np.flatnonzero(np.diff(edges)):
                d, f = doc[edges[t] : edges[t + 1]], tf[edges[t] : edges[t + 1]]
                w = idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * lengths[d] / mean))
                scores[np.ix_(held[t][0], d)] += held[t][1][:, None] * w
            scores = np.round(scores, 6)
            rows, cols = _best(scores, docs, k)
            return ids, rows, cols, [pa.array(scores[rows, cols])]

        return score

    return _scored(docs, queries, k, weigh, "score double")


def overlap(docs: DataFrame, queries: DataFrame, k: int = 10, least: int = 3) -> DataFrame:
    """(query_id, doc_id, hits, score, rank): share of a query's distinct words of at least `least` letters that a text has, plus up to 0.15 for more hits; the k best."""

    def weigh(block: list):
        words, held, sizes = _asked(block, least)
        ids = pa.array([r.query_id for r in block])

        def score(texts: list[str | None], docs: np.ndarray):
            term, doc, _, _ = _postings(texts, words)
            hits = np.zeros((len(block), len(texts)), dtype=np.int64)
            edges = np.searchsorted(term, np.arange(len(held) + 1))
            for t in np.flatnonzero(np.diff(edges)):
                hits[np.ix_(held[t][0], doc[edges[t] : edges[t + 1]])] += 1
            scores = np.where(hits > 0, np.round(hits / np.maximum(sizes, 1)[:, None] + np.minimum(0.15, 0.03 * (hits - 1)), 6), 0)
            rows, cols = _best(scores, docs, k)
            return ids, rows, cols, [pa.array(hits[rows, cols]), pa.array(scores[rows, cols])]

        return score

    return _scored(docs, queries, k, weigh, "hits bigint, score double")


def dense_top_k(items: DataFrame, queries: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """(query_id, item_id, cosine): the k items nearest to each query, itself left out; ties to the smaller item.

    items and queries have (id, vector). The stated queries meet all items in blocks of about `block` queries by a hash of their id: one block is broadcast at a time, and every
    batch of items keeps its own k best, so what is shuffled is k rows a query and batch. With several blocks each block's result is kept before the next begins.
    """
    spark = items.sparkSession
    blocks = max(1, -(-queries.count() // block))
    parts = []
    for n in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n).select("id", "vector").toArrow()
        ids = part.column("id").to_numpy()
        vectors = np.array(part.column("vector").to_pylist(), dtype=np.float64)
        if len(ids):
            usable = np.isfinite(vectors).all(axis=1) & (np.abs(vectors).sum(axis=1) > 0)  # others have no direction and find nothing
            ids, vectors = ids[usable], vectors[usable]
        shared = spark.sparkContext.broadcast((ids, vectors))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, q = shared.value
            if not len(ids):
                return
            q = q / np.linalg.norm(q, axis=1, keepdims=True)
            for batch in batches:
                if not batch.num_rows:
                    continue
                other = batch.column(0).to_numpy()
                v = np.array(batch.column(1).to_pylist(), dtype=np.float64)
                norm = np.linalg.norm(v, axis=1, keepdims=True)
                cosine = np.round(q @ (v / np.where(norm > 0, norm, 1)).T, 9)
                cosine[ids[:, None] == other[None, :]] = -2
                order = np.lexsort((np.broadcast_to(other, cosine.shape), -cosine), axis=1)[:, :k]
                kept = np.take_along_axis(cosine, order, axis=1)
                ok = kept > -1.5
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, ok.sum(axis=1))), pa.array(other[order][ok]), pa.array(kept[ok])], ["query_id", "item_id", "cosine"])

        best = top_k(items.select("id", "vector").mapInArrow(run, "query_id bigint, item_id bigint, cosine double"), "query_id", "item_id", "cosine", k)
        if blocks > 1:
            best = durable(best)
            shared.unpersist()
        parts.append(best)
    return reduce(DataFrame.union, parts)


def fuse(lanes: list[DataFrame], k: int = 60) -> DataFrame:
    """(query_id, doc_id, score): sum of 1 / (k + rank) over ranked lanes (query_id, doc_id, rank)."""
    every = lanes[0].select("query_id", "doc_id", "rank")
    for lane in lanes[1:]:
        every = every.union(lane.select("query_id", "doc_id", "rank"))
    return every.groupBy("query_id", "doc_id").agg(F.round(F.sum(1.0 / (k + F.col("rank"))), 9).alias("score"))


def ranking_metrics(ranked: DataFrame, gold: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, hit, recall, mrr, ndcg) at k of ranked(query_id, doc_id, rank) against gold(query_id, doc_id); queries without gold are left out."""
    wanted = gold.select("query_id", "doc_id").distinct()
    size = wanted.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    hits = ranked.where(F.col("rank") <= k).join(wanted, ["query_id", "doc_id"], "left_semi")
    found = hits.groupBy("query_id").agg(F.count_distinct("doc_id").alias("hits"), F.min("rank").alias("first"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    joined = size.join(found, "query_id", "left")
    return joined.select(
        "query_id", F.when(F.col("hits") > 0, 1.0).otherwise(0.0).alias("hit"), F.round(F.coalesce(F.col("hits") / F.col("n"), F.lit(0.0)), 6).alias("recall"),
        F.round(F.coalesce(1 / F.col("first"), F.lit(0.0)), 6).alias("mrr"), F.round(F.coalesce(F.col("dcg") / ideal, F.lit(0.0)), 6).alias("ndcg"),
    )


def paired_bootstrap(deltas: DataFrame, value: str, samples: int = 1000, seed: int = 7, parts: int = 8) -> DataFrame:
    """(mean_delta, ci95_low, ci95_high) of the mean of `value` over resamples of its rows; all zero for no rows.

    The rows are one number for each evaluated question, a stated set that is sent to every task; the resamples are spread over the tasks, each seeded by its number.
    """
    spark = deltas.sparkSession
    values = deltas.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v")).orderBy("v").toArrow().column(0).to_numpy()
    shared = spark.sparkContext.broadcast(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            means = [float(v[np.random.default_rng([seed, n]).integers(0, len(v), len(v))].mean()) if len(v) else 0.0 for n in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(means, pa.float64())], ["mean"])

    drawn = spark.range(0, samples, 1, parts).mapInArrow(run, "mean double")
    return drawn.agg(F.avg("mean").alias("mean_delta"), F.percentile("mean", F.lit(0.025)).alias("ci95_low"), F.percentile("mean", F.lit(0.975)).alias("ci95_high"))


def source_aware_ndcg(ranked: DataFrame, gold: DataFrame, sources: DataFrame, k: int = 10, gain: float = 0.65) -> DataFrame:
    """(query_id, ndcg): the first hit of each ranking only, 1 for a gold document and `gain` for another one of a gold document's source, discounted by rank.

    ranked(query_id, doc_id, rank), gold(query_id, doc_id), sources(doc_id, source), one row a document. Queries without gold are left out.
    """
    wanted = gold.select("query_id", "doc_id").distinct()
    same = wanted.join(sources, "doc_id").select("query_id", "source").distinct()
    hits = ranked.where(F.col("rank") <= k).join(sources, "doc_id", "left").join(wanted.withColumn("exact", F.lit(True)), ["query_id", "doc_id"], "left").join(same.withColumn("near", F.lit(True)), ["query_id", "source"], "left")
    worth = F.when(F.col("exact"), 1.0).when(F.col("near"), gain)
    first = hits.where(worth.isNotNull()).groupBy("query_id").agg(F.min_by(worth / F.log2(F.col("rank") + 1), "rank").alias("ndcg"))
    return wanted.select("query_id").distinct().join(first, "query_id", "left").select("query_id", F.round(F.coalesce("ndcg", F.lit(0.0)), 6).alias("ndcg"))
