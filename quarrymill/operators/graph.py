"""Graphs of (id) nodes and (source_id, target_id, edge_type) edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.session import durable


def reachable(edges: DataFrame, seeds: DataFrame, hops: int = 2, types: list[str] | None = None) -> DataFrame:
    """(seed, id, depth): nodes within `hops` directed edges of each seed (id), with the least depth; the seed itself at 0.

    Each hop joins only the nodes first seen in the hop before.
    """
    used = edges.where(F.col("edge_type").isin(types)) if types else edges
    used = used.select("source_id", "target_id").distinct()
    seen = seeds.select(F.col("id").alias("seed"), "id", F.lit(0).alias("depth")).distinct()
    front = seen
    for hop in range(1, hops + 1):
        near = front.join(used, F.col("id") == F.col("source_id")).select("seed", F.col("target_id").alias("id")).distinct()
        front = durable(near.join(seen.select("seed", "id"), ["seed", "id"], "left_anti").withColumn("depth", F.lit(hop)))
        seen = durable(seen.union(front))
    return seen


def adjacency(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, outgoing, incoming): numbers of distinct neighbours each way, isolated nodes included."""
    out = edges.groupBy(F.col("source_id").alias("id")).agg(F.count_distinct("target_id").alias("outgoing"))
    into = edges.groupBy(F.col("target_id").alias("id")).agg(F.count_distinct("source_id").alias("incoming"))
    zero = F.lit(0).cast("bigint")
    return nodes.select("id").distinct().join(out, "id", "left").join(into, "id", "left").select("id", F.coalesce("outgoing", zero).alias("outgoing"), F.coalesce("incoming", zero).alias("incoming"))


def issues(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(issue, id, n): missing and repeated node ids, and edge ends that are no node."""
    n = F.count(F.lit(1)).alias("n")
    repeated = nodes.where("id is not null").groupBy("id").agg(n).where("n > 1").select(F.lit("repeated_node").alias("issue"), F.col("id").cast("string").alias("id"), "n")
    missing = nodes.where("id is null").agg(n).where("n > 0").select(F.lit("node_without_id").alias("issue"), F.lit("").alias("id"), "n")
    ends = edges.select(F.col("source_id").alias("id")).union(edges.select("target_id"))
    dangling = ends.groupBy("id").agg(n).join(nodes.select("id").distinct(), "id", "left_anti").select(F.lit("dangling_edge").alias("issue"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "n")
    return repeated.union(missing).union(dangling)


def label_communities(nodes: DataFrame, edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """(id, community): label propagation with ties to the smallest label; communities of at least two keep their label, others null.

    In each round a node takes the label that most of its neighbours (and itself, counted once) have; nodes take turns by a hash of their id (one half each round), so that
    the two sides of a bipartite graph do not swap labels for ever. It ends when both halves stay as they are; if that has not happened in `most_rounds`, it raises. Counts
    are combined on the map side, so a hub sends one line a label.
    """
    both = durable(edges.select("source_id", "target_id").union(edges.select("target_id", "source_id")).where("source_id != target_id").distinct())
    labels = durable(nodes.select("id", F.col("id").alias("label")).distinct())
    still = 0
    for turn in range(most_rounds):
        said = both.join(labels, F.col("source_id") == F.col("id")).select(F.col("target_id").alias("id"), "label").union(labels)
        votes = said.groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))
        best = votes.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("best")).select("id", F.col("best.label").alias("best"))
        mine = F.pmod(F.xxhash64("id"), F.lit(2)) == turn % 2
        new = durable(labels.join(best, "id").select("id", F.when(mine, F.col("best")).otherwise(F.col("label")).alias("label"), (mine & (F.col("best") != F.col("label"))).alias("moved")))
        still = 0 if new.where("moved").head(1) else still + 1
        labels = new.select("id", "label")
        if still == 2:
            break
    else:
        raise RuntimeError(f"labels still change after {most_rounds} rounds")
    size = labels.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    return labels.join(size, "label").select("id", F.when(F.col("members") > 1, F.col("label")).alias("community"))


def pair_links(mentions: DataFrame, group: str, item: str) -> DataFrame:
    """(a, b, n): how many groups hold both of two items, a < b; each group counts once. Meant for groups of bounded size, such as fields of a record."""
    held = mentions.select(group, item).distinct()
    left, right = held.select(group, F.col(item).alias("a")), held.select(group, F.col(item).alias("b"))
    return left.join(right, group).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def ranked_within(df: DataFrame, group: str, *order) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
