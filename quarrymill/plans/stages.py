"""Named stages of DataFrames, each kept as a table, so that a run can be resumed, restarted from a stage or stopped after one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
STAGES: dict[str, Stage] = {}


def stage(name: str) -> Callable[[Stage], Stage]:
    """Registers a stage; a name can be taken once."""

    def register(f: Stage) -> Stage:
        if name in STAGES:
            raise ValueError(f"stage {name} is registered already")
        STAGES[name] = f
        return f

    return register


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def run_stages(spark: SparkSession, names: list[str], folder: str, inputs: dict[str, DataFrame], restart_at: str | None = None, stop_after: str | None = None) -> dict[str, DataFrame]:
    """All tables by name after the stages have run in order.

    A stage whose table is complete (it has its _SUCCESS file) is read instead of run, until the first that is not or `restart_at`; from there on all run anew.
    """
    unknown = [n for n in names if n not in STAGES]
    if unknown:
        raise KeyError(f"no such stage: {', '.join(unknown)}")
    tables = dict(inputs)
    fresh = False
    for name in names:
        path = f"{folder.rstrip('/')}/{name}"
        fresh = fresh or name == restart_at or not _exists(spark, f"{path}/_SUCCESS")
        if fresh:
            STAGES[name](spark, tables).write.mode("overwrite").parquet(path)
        tables[name] = spark.read.parquet(path)
        if name == stop_after:
            break
    return tables
