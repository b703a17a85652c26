"""Assertions: merging provenance, conflicts between objects, promotion; media matched to chunks; greedy survivors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.session import durable

KEY = ["subject_name", "predicate", "answer_subtype"]


def merged(assertions: DataFrame) -> DataFrame:
    """One row for each subject, predicate, subtype and object: distinct sources in order, best scores, how many were merged."""
    listed = assertions.groupBy(*KEY, "object_value").agg(
        F.max("confidence").alias("confidence"), F.max("authority_score").alias("authority_score"), F.max("freshness_score").alias("freshness_score"), F.count(F.lit(1)).alias("merged"),
    )
    sources = assertions.select(*KEY, "object_value", F.explode("source_chunk_ids").alias("c")).distinct().groupBy(*KEY, "object_value").agg(F.array_sort(F.collect_list("c")).alias("source_chunk_ids"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*KEY, "object_value")]
    return listed.alias("a").join(sources.alias("b"), same, "left").select("a.*", F.coalesce("b.source_chunk_ids", F.array().cast("array<string>")).alias("source_chunk_ids"))


def governed(assertions: DataFrame, margin: float = 0.03) -> DataFrame:
    """`assertions` (merged) with validity: of several objects for one key the best stays active and the others are superseded; within `margin` all are quarantined.

    An object's standing is the sum of authority, freshness and confidence; ties go to more sources, then to the smaller object.
    """
    key = Window.partitionBy(*KEY)
    scored = assertions.withColumn("standing", F.col("authority_score") + F.col("freshness_score") + F.col("confidence"))
    order = key.orderBy(F.desc("standing"), F.desc(F.size("source_chunk_ids")), "object_value")
    ranked = scored.withColumn("place", F.row_number().over(order)).withColumn("objects", F.count(F.lit(1)).over(key))
    best = F.max(F.when(F.col("place") == 1, F.col("standing"))).over(key)
    second = F.max(F.when(F.col("place") == 2, F.col("standing"))).over(key)
    validity = F.when(F.col("objects") == 1, "active").when(best - second <= margin + 1e-9, "quarantined").when(F.col("place") == 1, "active").otherwise("superseded")
    return ranked.withColumn("validity", validity).drop("standing", "place", "objects")


def promoted(assertions: DataFrame, confidence: float = 0.58, authority: float = 0.40, allow_ambiguous: bool = False) -> DataFrame:
    """`assertions` with promotion: promoted where supported (or ambiguous, if allowed) and both scores reach their limits, else quarantined."""
    supported = (F.col("validator_decision") == "supported") | (F.lit(allow_ambiguous) & (F.col("validator_decision") == "ambiguous"))
    good = F.coalesce(supported & (F.col("confidence") >= confidence) & (F.col("authority_score") >= authority), F.lit(False))
    return assertions.withColumn("promotion", F.when(good, "promoted").otherwise("quarantined"))


def media_matches(media: DataFrame, chunks: DataFrame) -> DataFrame:
    """(media_id, chunk_id, score, reason): the best chunk of the same document for each media item.

    Page numbers on both sides decide alone: equal is 100, unequal no match. Else the same section is 95, an ancestor's section 90, the heading in the
    section 85, the context inside the chunk's text 82.
    """
    both = media.alias("m").join(chunks.alias("c"), "document_id")
    paged = F.col("m.page_number").isNotNull() & (F.size("c.page_numbers") > 0)
    sections = (F.size("m.section_path") > 0) & (F.size("c.section_path") > 0)
    context = F.length(F.trim(F.coalesce("m.context", F.lit("")))) >= 20
    score = (
        F.when(paged & F.array_contains("c.page_numbers", F.col("m.page_number")), 100).when(paged, 0).when(sections & (F.col("m.section_path") == F.col("c.section_path")), 95)
        .when(sections & (F.slice("c.section_path", F.lit(1), F.size("m.section_path")) == F.col("m.section_path")), 90).when(F.array_contains("m.section_path", F.col("c.heading")), 85)
        .when(context & F.contains(F.lower("c.text"), F.lower(F.trim("m.context"))), 82).otherwise(0)
    )
    reason = F.when(F.col("score") == 100, "exact_page").when(F.col("score") == 95, "exact_section").when(F.col("score") == 90, "ancestor_section").when(F.col("score") == 85, "heading").otherwise("context")
    scored = both.select("m.media_id", "c.chunk_id", score.alias("score")).where("score > 0")
    ranked = scored.withColumn("r", F.row_number().over(Window.partitionBy("media_id").orderBy(F.desc("score"), "chunk_id"))).where("r = 1")
    return ranked.select("media_id", "chunk_id", "score", reason.alias("reason"))


def greedy_survivors(ranks: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, winner): in order of rank, a row is lost if it is linked to a row that is kept, else kept; winner is the best kept neighbour, null for kept rows.

    ranks(id, rank) has distinct ranks; pairs(a, b) links similar rows. Each round settles every row whose better neighbours are all settled, so the number of rounds is the
    length of the longest chain of falling ranks, and nothing is gathered. This differs from components: of a chain a-b-c with a better than b and b better than c, c is kept.
    """
    both = pairs.select("a", "b").union(pairs.select("b", "a")).distinct()
    r = ranks.select("id", "rank")
    better = durable(both.join(r.withColumnsRenamed({"id": "a", "rank": "ra"}), "a").join(r.withColumnsRenamed({"id": "b", "rank": "rb"}), "b").where("rb < ra").select(F.col("a").alias("id"), F.col("b").alias("other"), "rb"))
    state = durable(r.join(better.select("id").distinct(), "id", "left_anti").select("id", F.lit(None).cast(r.schema["id"].dataType).alias("winner")))
    left = durable(better)
    while left.head(1):
        # a kept better neighbour settles a row as lost; all better neighbours lost settles it as kept
        seen = left.join(state.withColumnsRenamed({"id": "other", "winner": "w"}).withColumn("known", F.lit(True)), "other", "left")
        fold = seen.groupBy("id").agg(F.min(F.when(F.col("known") & F.col("w").isNull(), F.struct("rb", "other"))).alias("best"), F.min(F.coalesce("known", F.lit(False))).alias("settled"), F.min(F.when(F.col("known").isNull(), F.col("rb"))).alias("open"))
        # the winner is only sure once no better neighbour is still open
        sure = fold.where(F.col("best").isNotNull() & (F.col("open").isNull() | (F.col("open") > F.col("best.rb"))) | (F.col("best").isNull() & F.col("settled")))
        new = durable(sure.select("id", F.col("best.other").alias("winner")))
        state = durable(state.union(new))
        left = durable(left.join(new.select("id"), "id", "left_anti"))
    return state
