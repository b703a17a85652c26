"""Queries stated once as SQL and run by Spark, with the few functions whose names differ between Spark and DuckDB spelt by a dialect.

The statement that Spark runs and the one that checks it come from the same text but from different engines; where a query needs a lane of ranked documents, Spark takes
the operator's result and DuckDB states it in SQL.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrymill.plans import catalog, ranking
from quarrymill.session import table


class Duck:
    """DuckDB's spelling."""

    spark = False

    def lit(self, text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def words(self, c: str) -> str:
        return rf"regexp_extract_all(lower(coalesce({c}, '')), '[\p{{L}}\p{{N}}]+')"

    def has(self, c: str, pattern: str) -> str:
        return f"regexp_matches({c}, {self.lit(pattern)})"

    def sub(self, c: str, pattern: str, by: str = "") -> str:
        return f"regexp_replace({c}, {self.lit(pattern)}, {self.lit(by.replace('$', chr(92)))}, 'g')"

    def cut(self, c: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract({c}, {self.lit(pattern)}, {group})"

    def every(self, c: str, pattern: str) -> str:
        return f"regexp_extract_all({c}, {self.lit(pattern)})"

    def each(self, a: str) -> str:
        return f"unnest({a})"

    def size(self, a: str) -> str:
        return f"CAST(len({a}) AS INTEGER)"

    def map(self, a: str, x: str, e: str) -> str:
        return f"list_transform({a}, lambda {x}: {e})"

    def keep(self, a: str, x: str, e: str) -> str:
        return f"list_filter({a}, lambda {x}: {e})"

    def join(self, a: str, sep: str = " ") -> str:
        return f"array_to_string({a}, {self.lit(sep)})"

    def stack(self, a: str) -> str:
        return f"array_to_string({a}, chr(10))"

    def unique(self, a: str) -> str:
        return f"list_distinct({a})"

    def ordered(self, a: str) -> str:
        return f"list_sort({a})"

    def gathered(self, c: str) -> str:
        return f"list_sort(list(DISTINCT {c}) FILTER (WHERE {c} IS NOT NULL))"

    def slice(self, a: str, first: int, n: int) -> str:
        return f"{a}[{first}:{first + n - 1}]"

    def item(self, a: str, n: str | int) -> str:
        return f"{a}[{n}]"

    def member(self, a: str, x: str) -> str:
        return f"list_contains({a}, {x})"

    def flat(self, a: str) -> str:
        return f"flatten({a})"

    def meta(self, c: str, key: str) -> str:
        return f"{c}['{key}']"

    def entries(self, c: str) -> str:
        return f"map_entries({c})"

    def lines(self, c: str) -> str:
        return f"string_split({c}, chr(10))"

    def split(self, c: str, by: str) -> str:
        return f"string_split({c}, {self.lit(by)})"

    def upto(self, a: str, b: str) -> str:
        return f"range({a}, {b} + 1)"

    def sha256(self, c: str) -> str:
        return f"sha256({c})"

    def starts(self, c: str, p: str) -> str:
        return f"starts_with({c}, {p})"

    def percentile(self, c: str, q: float) -> str:
        return f"quantile_cont({c}, {q})"

    def bytes(self, c: str) -> str:
        return f"strlen({c})"


class Spark(Duck):
    """Spark's spelling."""

    spark = True

    def lit(self, text: str) -> str:
        return "r'" + text + "'" if "'" not in text else 'r"' + text + '"'

    def words(self, c: str) -> str:
        return rf"regexp_extract_all(lower(coalesce({c}, '')), r'[\p{{L}}\p{{N}}]+', 0)"

    def has(self, c: str, pattern: str) -> str:
        return f"regexp_like({c}, {self.lit(pattern)})"

    def sub(self, c: str, pattern: str, by: str = "") -> str:
        return f"regexp_replace({c}, {self.lit(pattern)}, {self.lit(by)})"

    def every(self, c: str, pattern: str) -> str:
        return f"regexp_extract_all({c}, {self.lit(pattern)}, 0)"

    def each(self, a: str) -> str:
        return f"explode({a})"

    def size(self, a: str) -> str:
        return f"size({a})"

    def map(self, a: str, x: str, e: str) -> str:
        return f"transform({a}, {x} -> {e})"

    def keep(self, a: str, x: str, e: str) -> str:
        return f"filter({a}, {x} -> {e})"

    def join(self, a: str, sep: str = " ") -> str:
        return f"array_join({a}, {self.lit(sep)})"

    def stack(self, a: str) -> str:
        return f"array_join({a}, char(10))"

    def unique(self, a: str) -> str:
        return f"array_distinct({a})"

    def ordered(self, a: str) -> str:
        return f"array_sort({a})"

    def gathered(self, c: str) -> str:
        return f"array_sort(collect_set({c}))"

    def slice(self, a: str, first: int, n: int) -> str:
        return f"slice({a}, {first}, {n})"

    def item(self, a: str, n: str | int) -> str:
        return f"get({a}, {n} - 1)"

    def member(self, a: str, x: str) -> str:
        return f"array_contains({a}, {x})"

    def meta(self, c: str, key: str) -> str:
        return f"try_element_at({c}, '{key}')"

    def lines(self, c: str) -> str:
        return f"split({c}, r'\\n')"

    def split(self, c: str, by: str) -> str:
        return f"split({c}, r'[{by}]')"

    def upto(self, a: str, b: str) -> str:
        return f"CASE WHEN {b} >= {a} THEN sequence({a}, {b}) ELSE array() END"

    def sha256(self, c: str) -> str:
        return f"sha2({c}, 256)"

    def starts(self, c: str, p: str) -> str:
        return f"startswith({c}, {p})"

    def percentile(self, c: str, q: float) -> str:
        return f"percentile({c}, {q})"

    def bytes(self, c: str) -> str:
        return f"octet_length({c})"


_PREFIX = "quarrymill_"
ITEMS = "mbzuai_preprod_answer_completeness_v1"


def stated(*tables: str, lanes: bool = False):
    """Registers a function from a dialect to SQL as a query of its name over the named tables; with `lanes` it may use bk and ok, the ranked BM25 and overlap lanes."""

    def register(f: Callable[[Duck], str]) -> Callable[[Duck], str]:
        def run(spark: SparkSession, root: str) -> DataFrame:
            used = list(tables)
            for name in tables:
                table(spark, root, name).createOrReplaceTempView(f"{_PREFIX}{name}")
            if lanes:
                ranking.bm25_topk(spark, root).createOrReplaceTempView(f"{_PREFIX}bk")
                ranking.lexical_overlap_topk(spark, root).createOrReplaceTempView(f"{_PREFIX}ok")
                used += ["bk", "ok"]
            return spark.sql(re.sub(rf"\b(FROM|JOIN) ({'|'.join(used)})\b", rf"\1 {_PREFIX}\2", f(Spark())))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        catalog.QUERIES[f.__name__] = run
        sql = f(Duck())
        if lanes:
            body = sql[5:] if sql.startswith("WITH ") else sql
            sql = f"WITH {ranking._BM25_SQL}, {ranking._OVERLAP_SQL}" + (", " if sql.startswith("WITH ") else " ") + body
        catalog.ORACLES[f.__name__] = sql
        return f

    return register
