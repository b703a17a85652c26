"""Sources and sinks on files: JSON lines, file trees, sitemaps, keyed journals, record stores."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad): the parsed lines of a folder of JSON lines, and the lines (file, line) that are no JSON of that schema; blank lines are neither."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where("trim(value) != ''")
    parsed = raw.withColumn("r", F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    names = [f.name for f in parsed.schema["r"].dataType.fields if f.name != "_bad"]
    return parsed.where("r._bad is null").select(*(F.col(f"r.{n}") for n in names)), parsed.where("r._bad is not null").select("file", F.col("value").alias("line"))


def write_json_lines(df: DataFrame, path: str) -> None:
    """Writes a folder of JSON lines beside `path`, then puts it in place by renames: what was there is set aside first and deleted last.

    A reader sees the old folder, for a moment none, or the new one, never half of it; after a crash the old one still lies beside, under `path`.old.
    """
    spark = df.sparkSession
    draft, aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}", f"{path.rstrip('/')}.old"
    df.write.json(draft)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target, old = hadoop.Path(draft), hadoop.Path(path), hadoop.Path(aside)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target):
        system.delete(old, True)
        if not system.rename(target, old):
            raise OSError(f"{path} could not be set aside")
    if not system.rename(source, target):
        system.rename(old, target)
        raise OSError(f"{draft} could not be put at {path}")
    system.delete(old, True)


def read_json_or(spark: SparkSession, path: str, schema: str, default: list[tuple]) -> DataFrame:
    """The JSON lines of a folder, or `default` where the folder is missing or holds a line that is no JSON of that schema."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        rows, bad = read_json_lines(spark, path, schema)
        if not bad.head(1):
            return rows
    return spark.createDataFrame(default, schema)


def read_tree(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """(path, modified, text): all files below `path` that match; bytes that are no UTF-8 come out as replacement signs."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b.decode("utf-8", errors="replace") if b is not None else None for b in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["path", "modified", "text"])

    return files.select("path", F.col("modificationTime").alias("modified"), "content").mapInArrow(run, "path string, modified timestamp, text string")


def sitemap_entries(files: DataFrame, content: str = "content") -> DataFrame:
    """(kind, url): pages and child sitemaps of sitemap files, plain or gzipped; broken files have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, str]] = []
            for raw in batch.column(0).to_pylist():
                try:
                    raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                    if b"<!DOCTYPE" in raw or b"<!ENTITY" in raw:
                        continue
                    top = ElementTree.fromstring(raw)
                except (ElementTree.ParseError, OSError, EOFError, TypeError):
                    continue
                kind = "sitemap" if top.tag.endswith("sitemapindex") else "page"
                rows += [(kind, loc.text.strip()) for entry in top for loc in entry if loc.tag.endswith("loc") and loc.text and loc.text.strip()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], ["kind", "url"])

    return files.select(content).mapInArrow(run, "kind string, url string")


def compact_journal(journal: DataFrame, key: str = "key", order: str = "sequence") -> DataFrame:
    """The last line of each key of an append-only journal; a line is replaced only by one of higher `order`."""
    others = [c for c in journal.columns if c != key]
    latest = journal.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_last"))
    return latest.select(key, *(F.col(f"_last.{c}").alias(c) for c in others))


def upserted(stored: DataFrame, incoming: DataFrame, keys: list[str], releases: DataFrame | None = None) -> DataFrame:
    """`stored` with `incoming` put over it by key; of equal incoming keys the last by updated_at, then row_id, wins.

    With `releases` (release_id, status) only records of releases that are being built get in.
    """
    if releases is not None:
        incoming = incoming.join(releases.where("status = 'building'").select("release_id"), "release_id", "left_semi")
    others = [c for c in incoming.columns if c not in keys]
    latest = incoming.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct("updated_at", "row_id")).alias("_last")).select(*keys, *(F.col(f"_last.{c}").alias(c) for c in others))
    return stored.join(latest.select(*keys), keys, "left_anti").unionByName(latest.select(*stored.columns))
