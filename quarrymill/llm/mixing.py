"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each source's distinct texts, shuffled by a hash, form a stream of tokens; a repeat is another shuffle of the same texts. The
stream is cut into blocks of `block_tokens` tokens. Slot n of the mix belongs to the source whose part of the cumulative
weights holds frac(n * golden ratio), and gets that source's next block. All running sums are taken in two levels (sums
of buckets, then inside a bucket), so that no source is gathered in one task.
"""

from __future__ import annotations

import base64
import math
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import texts_of
from quarrymill.session import durable, parallelism

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BLOCK_TOKENS = 128
#: Slots that are laid out beyond those that the scarcest source fills by its weight: the discrepancy of the golden-ratio sequence is logarithmic. The mix is cut where a source runs out.
SPARE = 64
_GOLDEN = (math.sqrt(5) - 1) / 2
_CHUNK = 8192
_MOST_SOURCES = 1_000_000
#: Fixed value: how the vocabulary's authors split text before merging, as the README of the files gives it.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("mix", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


def source_name(column: str):
    """One spelling of a source: its letters and digits in lower case; null where there are none."""
    return F.nullif(F.regexp_replace(F.lower(F.col(column)), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def _counted(name: str):
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(SparkFiles.get(name))
        for batch in batches:
            texts = texts_of(batch, "text")
            tokens = [len(encoder.encode_ordinary(t)) for t in texts]
            digests = [xxhash.xxh3_128_digest(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(tokens, pa.int64())], ["doc", "s", "digest", "tokens"])

    return run


def token_stock(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc, s, tokens): each distinct non-empty text once, under its smallest document id that has a source."""
    chosen = documents.select(F.col("doc_id").alias("doc"), source_name("source").alias("s"), "text").where("text is not null and text != '' and s is not null")
    documents.sparkSession.sparkContext.addFile(tokenizer)  # only the driver needs to have it
    counted = chosen.mapInArrow(_counted(os.path.basename(tokenizer)), "doc bigint, s string, digest binary, tokens bigint")
    return counted.where("tokens > 0").groupBy("digest").agg(F.min_by(F.struct("doc", "s", "tokens"), "doc").alias("x")).select("x.*")


def _plan(stock: DataFrame, targets: DataFrame, block_tokens: int, total_tokens: int | None) -> tuple[list[tuple], int]:
    """Rows (source, name, share, weight, stock, repeats) in order of name, and the number of slots."""
    wanted = targets.where("target_share > 0").select(source_name("source").alias("s"), "source", "target_share", "max_repeats").where("s is not null").orderBy("s").limit(_MOST_SOURCES + 1).collect()
    if len(wanted) > _MOST_SOURCES or len({r.s for r in wanted}) < len(wanted):
        raise ValueError("mix targets must name each source once, and at most a million of them")
    have = {r.s: r.n for r in stock.groupBy("s").agg(F.sum("tokens").alias("n")).join(targets.select(source_name("source").alias("s")).distinct(), "s").collect()}
    usable = [r for r in wanted if have.get(r.s) and r.max_repeats and r.max_repeats > 0]
    whole = sum(r.target_share for r in usable)
    rows = [(r.s, r.source, float(r.target_share), float(r.target_share) / whole if r in usable else 0.0, have.get(r.s, 0), int(r.max_repeats or 0)) for r in wanted]
    if not usable:
        return rows, 0
    if total_tokens is not None:
        return rows, total_tokens // block_tokens
    # the first slot whose source has no whole block left ends the mix
    slots = int(min(r[4] * r[5] // block_tokens / r[3] for r in rows if r[3])) + SPARE
    full = stock.sparkSession.createDataFrame([(r[0], r[4] * r[5] // block_tokens) for r in rows if r[3]], "s string, block bigint")
    out = slot_schedule(stock.sparkSession, rows, slots).join(F.broadcast(full), ["s", "block"]).agg(F.min("slot")).first()[0]
    return rows, slots if out is None else out


def mix(documents: DataFrame, targets: DataFrame, block_tokens: int = BLOCK_TOKENS, total_tokens: int | str | None = None, tokenizer: str = TOKENIZER, seed: int = 1) -> DataFrame:
    """(slot, place, source, doc_id, repeat_no, first_token, token_count): the mix, in order of slot and place.

    Without `total_tokens` the mix is as long as it can be with every source at its share; with it (a number, or "stock" for as many tokens as all texts have), a source whose stock times
    max_repeats is used up falls short. Sources without texts get nothing and the others share their part in proportion. Null and empty texts, and texts
    of no or no wanted source, are left out; equal texts count as one. first_token counts from 0 within the text; a text may go on in its source's next slot.
    """
    spark = documents.sparkSession
    stock = durable(token_stock(documents, tokenizer))
    if total_tokens == "stock":
        total_tokens = stock.agg(F.sum("tokens")).first()[0] or 0
    rows, slots = _plan(stock, targets, block_tokens, total_tokens)
    size = block_tokens
    known = spark.createDataFrame(rows, "s string, source string, share double, weight double, stock bigint, repeats int")
    # the stream of each source: one line for each use of a text, in shuffled order
    uses = stock.join(F.broadcast(known.where("weight > 0")), "s").select("s", "doc", "tokens", "stock", F.explode(F.sequence(F.lit(1), "repeats")).alias("repeat_no"))
    uses = uses.withColumn("h", F.xxhash64(F.lit(seed), "repeat_no", "doc")).withColumn("bucket", F.shiftrightunsigned("h", 64 - _bucket_bits(stock)))
    sums = uses.groupBy("s", "repeat_no", "bucket").agg(F.sum("tokens").alias("n"))
    before = sums.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("s", "repeat_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = Window.partitionBy("s", "repeat_no", "bucket").orderBy("h", "doc").rowsBetween(Window.unboundedPreceding, -1)
    placed = uses.withColumn("own", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(before, ["s", "repeat_no", "bucket"])
    start = F.col("base") + F.col("own") + (F.col("repeat_no") - 1) * F.col("stock")
    placed = placed.select("s", "doc", "repeat_no", "tokens", start.alias("start"))
    cut = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("tokens") - 1) / size))))
    first = F.greatest(F.col("start"), F.col("block") * size)
    last = F.least(F.col("start") + F.col("tokens"), (F.col("block") + 1) * size)
    cut = cut.select("s", "block", "doc", "repeat_no", (first - F.col("start")).alias("first_token"), (last - first).alias("token_count"), (first - F.col("block") * size).alias("place"))
    cut = cut.join(slot_schedule(spark, rows, slots), ["s", "block"]).join(F.broadcast(known.select("s", "source")), "s")
    return cut.select("slot", F.col("place").cast("int").alias("place"), "source", F.col("doc").alias("doc_id"), "repeat_no", F.col("first_token").cast("int").alias("first_token"), F.col("token_count").cast("int").alias("token_count"))


def _bucket_bits(stock: DataFrame) -> int:
    """So many bits of the shuffle hash that a bucket holds about 10,000 texts."""
    return max(2, min(20, math.ceil(math.log2(max(1, stock.count()) / 10_000 + 1))))


def slot_schedule(spark, rows: list[tuple], slots: int) -> DataFrame:
    """(slot, s, block): the source of each slot, and its rank among that source's slots."""
    edges, at = [], 0.0
    for s, _, _, weight, _, _ in rows:
        if weight:
            at += weight
            edges.append((s, at))
    point = F.col("slot") * F.lit(_GOLDEN) - F.floor(F.col("slot") * F.lit(_GOLDEN))
    limits, names = np.array([e for _, e in edges[:-1]]), pa.array([s for s, _ in edges], pa.string())

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(limits, batch.column(1).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([batch.column(0), names.take(pa.array(at))], ["slot", "s"])

    numbered = spark.range(0, slots if edges else 0, 1, parallelism(spark, 4)).withColumnRenamed("id", "slot").select("slot", point.alias("point")).mapInArrow(named, "slot bigint, s string").withColumn("chunk", F.floor(F.col("slot") / _CHUNK))
    counts = numbered.groupBy("s", "chunk").count()
    before = counts.withColumn("base", F.coalesce(F.sum("count").over(Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    ranked = numbered.withColumn("own", F.row_number().over(Window.partitionBy("s", "chunk").orderBy("slot")) - 1).join(before, ["s", "chunk"])
    return ranked.select("slot", "s", (F.col("base") + F.col("own")).alias("block"))


def mix_shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, tokens, actual_share, most_repeats): what a mix consists of, a row for each target."""
    got = mixed.groupBy("source").agg(F.sum("token_count").alias("tokens"), F.max("repeat_no").alias("most_repeats"))
    whole = got.agg(F.sum("tokens").alias("whole"))
    joined = targets.select("source", "target_share").join(got, "source", "left").crossJoin(F.broadcast(whole))  # one row
    return joined.select("source", "target_share", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.round(F.coalesce(F.col("tokens") / F.col("whole"), F.lit(0.0)), 9).alias("actual_share"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))
