"""Pipelines as lists of named steps with skips, resume from written results, and hooks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Step = Callable[[SparkSession, dict[str, DataFrame]], DataFrame | None]


@dataclass
class Pipeline:
    """Steps run in order; each result is written under ``root`` and later steps read it by name.

    A step whose result is there already is not run again (``resume``), so an interrupted run goes on. A failing
    optional step is reported and skipped; other failures end the run.
    """

    name: str
    steps: list[tuple[str, Step]]
    optional: set[str] = field(default_factory=set)
    after: Callable[[str, DataFrame], None] | None = None

    def run(self, spark: SparkSession, root: str, *, skip: set[str] | None = None, resume: bool = True, inputs: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
        done: dict[str, DataFrame] = dict(inputs or {})
        jvm = spark.sparkContext._jvm
        path_of = jvm.org.apache.hadoop.fs.Path
        fs = path_of(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.report: dict[str, str] = {}
        for step, fn in self.steps:
            target = f"{root.rstrip('/')}/{self.name}/{step}"
            if step in (skip or set()):
                self.report[step] = "skipped"
                continue
            if resume and fs.exists(path_of(f"{target}/_SUCCESS")):
                done[step] = spark.read.parquet(target)
                self.report[step] = "resumed"
                continue
            spark.sparkContext.setJobGroup(f"{self.name}/{step}", step)
            try:
                out = fn(spark, done)
                if out is not None:
                    out.write.mode("overwrite").parquet(target)
                    done[step] = spark.read.parquet(target)
                    if self.after:
                        self.after(step, done[step])
                self.report[step] = "done"
            except Exception as e:
                if step not in self.optional:
                    raise
                self.report[step] = f"failed: {type(e).__name__}"
        return done
