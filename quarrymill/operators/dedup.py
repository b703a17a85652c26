"""Duplicates: exact copies, exact set-similarity joins, links to components, survivors by key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import fold, words
from quarrymill.session import durable


def survivors(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by `order`; rows with a null key form one key. All columns stay.

    Spark cuts the window to one row a key before the shuffle, so a hot key sends one row a partition.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def exact_groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """(content_hash, winner, copies): groups of equal folded text with the smallest key; null texts are left out."""
    hashed = df.where(F.col(text).isNotNull()).select(F.sha2(fold(F.col(text)), 256).alias("content_hash"), F.col(key).alias("k"))
    return hashed.groupBy("content_hash").agg(F.min("k").alias("winner"), F.count(F.lit(1)).alias("copies"))


def shingle_sets(df: DataFrame, key: str, text: str, size: int = 5) -> DataFrame:
    """(id, shingles): hashes of the distinct runs of `size` words; a shorter text is one run; wordless texts are left out."""
    w = words(F.col(text))
    runs = F.when(F.size("w") < size, F.array(F.array_join("w", " "))).otherwise(F.transform(F.sequence(F.lit(0), F.size("w") - size), lambda i: F.array_join(F.slice("w", i + 1, size), " ")))
    return df.select(F.col(key).alias("id"), w.alias("w")).where(F.size("w") > 0).select("id", F.array_sort(F.array_distinct(F.transform(runs, lambda x: F.xxhash64(x)))).alias("shingles"))


def similar_sets(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity): pairs of ids whose sets have a Jaccard similarity of at least `threshold`, by prefix filtering; exact.

    Elements are ordered by how rare they are; two sets that similar share one of their first n - ceil(t n) + 1 elements, so only
    those meet in the join, and a shared element that many sets have is in few prefixes. Sets of too different size are dropped at the join.
    """
    sets = durable(sets)
    spread = sets.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    ranked = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("s")).join(spread, "s")
    ordered = ranked.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("o"))  # bounded by one set
    prefix = ordered.select("id", "n", F.explode(F.slice("o", F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))).alias("e")).select("id", "n", "e.s")
    a, b = prefix.select(F.col("id").alias("a"), F.col("n").alias("na"), "s"), prefix.select(F.col("id").alias("b"), F.col("n").alias("nb"), "s")
    met = a.join(b, "s").where((F.col("a") < F.col("b")) & (F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9)).select("a", "b").distinct()
    both = met.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    scored = both.select("a", "b", (common / (F.size("x") + F.size("y") - common)).alias("similarity"))
    return scored.where(F.col("similarity") >= threshold)


#: 32 bands of 4 min-hashes: two sets of similarity 0.8 share none with a probability of 5 in 10^8, of 0.7 with 2 in 10^4.
BANDS, ROWS = 32, 4


def minhash_bands(sets: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, band): a 64-bit key for each band of a set's min-hashes. `sets` is (id, shingles), shingles being hashes."""
    rng = np.random.default_rng(1)
    seeds = rng.integers(1, 1 << 62, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = batch.column(1)
            if not batch.num_rows:
                continue
            values, starts = shingles.flatten().to_numpy().view(np.uint64), shingles.offsets.to_numpy()[:-1] - shingles.offsets[0].as_py()
            keys = np.zeros((bands, batch.num_rows), dtype=np.uint64)
            for n, seed in enumerate(seeds):
                h = (values ^ (seed >> np.uint64(9))) * seed
                h ^= h >> np.uint64(32)
                keys[n // rows] = (keys[n // rows] ^ np.minimum.reduceat(h, starts)) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
            keys += np.arange(bands, dtype=np.uint64)[:, None]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.tile(np.arange(batch.num_rows), bands))), pa.array(keys.ravel().view(np.int64))], ["id", "band"])

    return sets.select("id", "shingles").where("size(shingles) > 0").mapInArrow(run, "id bigint, band bigint")


def lsh_pairs(sets: DataFrame, threshold: float, spread: int = 2000) -> DataFrame:
    """(a, b, similarity): pairs of ids whose sets have a Jaccard similarity of at least `threshold`, among those that share a band.

    A band key of very many sets is cut into pieces of about `spread` sets by a hash of the id; each pair of pieces is joined in its own group, so no bucket ends in one task and no pair is
    lost. Sets follow only for the pairs that met.
    """
    sets = durable(sets)
    banded = durable(minhash_bands(sets))
    size = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band", F.ceil(F.col("n") / spread).cast("int").alias("pieces"))
    cut = banded.join(size, "band").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces").cast("bigint")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    a = cut.select("band", F.col("id").alias("a"), F.col("piece").alias("i"), others.alias("j"))
    b = cut.select("band", F.col("id").alias("b"), others.alias("i"), F.col("piece").alias("j"))
    met = a.join(b, ["band", "i", "j"]).where("a < b").select("a", "b").distinct()
    both = met.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    near = both.where(F.least(F.size("x"), F.size("y")) >= threshold * F.greatest(F.size("x"), F.size("y")) - 1e-9)
    common = F.size(F.array_intersect("x", "y"))
    return near.select("a", "b", (common / (F.size("x") + F.size("y") - common)).alias("similarity")).where(F.col("similarity") >= threshold)


def near_duplicates(df: DataFrame, key: str, text: str, threshold: float = 0.8, size: int = 5) -> tuple[DataFrame, DataFrame]:
    """(pairs between class representatives, members): exact copies are folded first, pairs join different texts.

    pairs(a, b, similarity), members(id, representative): the representative is the smallest key with exactly that text.
    """
    hashed = df.select(F.col(key).alias("id"), F.col(text).alias("t"), F.sha2(F.col(text), 256).alias("h")).where("t is not null")
    first = hashed.groupBy("h").agg(F.min("id").alias("representative"))
    members = hashed.select("id", "h").join(first, "h").select("id", "representative")
    texts = hashed.join(first.select(F.col("representative").alias("id")), "id", "left_semi")
    return lsh_pairs(shingle_sets(texts, "id", "t", size), threshold), members


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that links reach from each node, by alternating large-star and small-star steps.

    Every step is a grouped minimum, so a node with very many links is folded before the shuffle; the rounds grow with the logarithm of the component's
    diameter. Nodes without links are their own component; links to unknown nodes count as nodes.
    """
    edges = durable(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v").distinct())
    while True:  # each round but the last brings some node a smaller neighbour, so it ends
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        small = durable(small)
        changed = small.exceptAll(edges).head(1) or edges.exceptAll(small).head(1)
        edges = small
        if not changed:
            break
    root = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    known = nodes.select("id").union(links.select("a")).union(links.select("b")).distinct()
    return known.join(root, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def hamming_pairs(df: DataFrame, key: str, bits_hex: str, radius: int = 2) -> DataFrame:
    """(a, b, distance): different 64-bit values within `radius` bits, a < b as hex text.

    The bits are cut into radius + 1 parts; two values that near agree in one part, so only those meet. Values are folded to distinct ones first.
    """
    values = df.where(F.col(bits_hex).rlike("^[0-9a-f]{16}$")).select(F.col(bits_hex).alias("h")).distinct()
    high, low = F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint"), F.conv(F.substring("h", 9, 8), 16, 10).cast("bigint")
    values = values.select("h", F.shiftleft(high, 32).bitwiseOR(low).alias("v"))
    step = -(-64 // (radius + 1))
    part = F.array(*(F.struct(F.lit(n).alias("p"), F.shiftrightunsigned("v", n * step).bitwiseAND(F.lit((1 << min(step, 64 - n * step)) - 1)).alias("x")) for n in range(radius + 1)))
    cut = values.select("h", "v", F.explode(part).alias("k")).select("h", "v", "k.p", "k.x")
    a, b = cut.select(F.col("h").alias("a"), F.col("v").alias("va"), "p", "x"), cut.select(F.col("h").alias("b"), F.col("v").alias("vb"), "p", "x")
    distance = F.bit_count(F.col("va").bitwiseXOR(F.col("vb")))
    return a.join(b, ["p", "x"]).where(F.col("a") < F.col("b")).select("a", "b", distance.alias("distance")).where(F.col("distance") <= radius).distinct()


def unique_by_id(df: DataFrame, key: str, content: str) -> DataFrame:
    """One row an id; an id with different contents makes the reading fail, equal rows fold. Other columns come from one of the equal rows."""
    others = [c for c in df.columns if c != key]
    folded = df.groupBy(key).agg(F.count_distinct(content).alias("_n"), F.min_by(F.struct(*others), F.struct(content)).alias("_r"))
    clash = F.concat(F.lit("conflicting contents of id "), F.col(key).cast("string"))
    return folded.select(F.when(F.col("_n") > 1, F.raise_error(clash)).otherwise(F.col(key)).alias(key), *(F.col(f"_r.{c}").alias(c) for c in others))
