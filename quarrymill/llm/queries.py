"""The queries of this subpackage, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrymill.llm.boilerplate import page_bodies, page_boilerplate
from quarrymill.llm.knn import nearest_pairs
from quarrymill.llm.language import corpus_language, language_cases
from quarrymill.llm.leakage import leaked_items
from quarrymill.llm.mixing import mix, mix_shares
from quarrymill.llm.near_edit import near_edit_groups, near_edit_pairs
from quarrymill.llm.ocr import page_defects, repaired_pages
from quarrymill.llm.pii import masked_documents, personal_spans
from quarrymill.llm.residue import indexable, residue_values
from quarrymill.llm.split import oversized
from quarrymill.session import table


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return near_edit_pairs(table(spark, root, "embedding_records"), threshold=0.7, least_words=30)


def p1_groups(spark: SparkSession, root: str) -> DataFrame:
    return near_edit_groups(table(spark, root, "embedding_records"))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return nearest_pairs(table(spark, root, "embedding_records"))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return residue_values(table(spark, root, "media"))


def p3_indexable(spark: SparkSession, root: str) -> DataFrame:
    return indexable(table(spark, root, "media")).select("id", "media_type", "url", "caption", "description", "document_id", "source_url")


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return page_defects(table(spark, root, "corpus_merge_formatter"))


def p4_repaired(spark: SparkSession, root: str) -> DataFrame:
    return repaired_pages(table(spark, root, "corpus_merge_formatter"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return p5_pieces(spark, root).where("piece_no = 1").select("row_id")


def p5_pieces(spark: SparkSession, root: str) -> DataFrame:
    return oversized(table(spark, root, "embedding_records"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return language_cases(p6_segments(spark, root))


def p6_segments(spark: SparkSession, root: str) -> DataFrame:
    return corpus_language(spark, table(spark, root, "embedding_records"), table(spark, root, "mbzuai_preprod_answer_completeness_v1"))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return page_boilerplate(table(spark, root, "embedding_records"))


def p7_bodies(spark: SparkSession, root: str) -> DataFrame:
    return page_bodies(table(spark, root, "embedding_records"))


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    items = table(spark, root, "mbzuai_preprod_answer_completeness_v1")
    return leaked_items(table(spark, root, "documents"), items, ["query", "reference_answer"]).select("doc_id", "item_id")


def p8_passages(spark: SparkSession, root: str) -> DataFrame:
    items = table(spark, root, "mbzuai_preprod_answer_completeness_v1")
    return leaked_items(table(spark, root, "documents"), items, ["query", "reference_answer"], most_edits=2)


def p9_mix(spark: SparkSession, root: str) -> DataFrame:
    return mix(table(spark, root, "documents"), table(spark, root, "mix_targets"))


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    return mix_shares(p9_mix(spark, root), table(spark, root, "mix_targets"))


def p9_stock_shares(spark: SparkSession, root: str) -> DataFrame:
    """A mix of as many tokens as all texts have: sources whose repeats are used up fall short of their share."""
    documents, targets = table(spark, root, "documents"), table(spark, root, "mix_targets")
    return mix_shares(mix(documents, targets, total_tokens="stock"), targets)


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return personal_spans(table(spark, root, "documents")).select("doc_id", "kind", "val").distinct()


def p10_masked(spark: SparkSession, root: str) -> DataFrame:
    return masked_documents(table(spark, root, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_groups": p1_groups,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_indexable": p3_indexable,
    "p4_found": p4_found,
    "p4_repaired": p4_repaired,
    "p5_found": p5_found,
    "p5_pieces": p5_pieces,
    "p6_found": p6_found,
    "p6_segments": p6_segments,
    "p7_bodies": p7_bodies,
    "p7_found": p7_found,
    "p8_found": p8_found,
    "p8_passages": p8_passages,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p9_stock_shares": p9_stock_shares,
    "p10_found": p10_found,
    "p10_masked": p10_masked,
}

_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"

ORACLES: dict[str, str] = {
    "p5_found": f"SELECT row_id FROM embedding_records WHERE len({_WORDS.format('retrieval_text')}) > 650",
}
