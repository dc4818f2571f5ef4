"""Append-only log of evaluation and cross-validation results.

A run appends one version of kind ``metrics``: tidy rows (model, kind of
run, metric, fold, value).  Nothing is rewritten; the trend is a window over
the log.  It holds some dozen rows a run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import versions as V

SCHEMA = "model string, run_kind string, metric string, fold string, value double"
KFOLD_METRICS = ("roc_auc", "pr_auc", "n")


def _tidy(df: DataFrame, model: str, run_kind: str, fold, metrics: list[str]) -> DataFrame:
    items = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return df.select(F.lit(model).alias("model"), F.lit(run_kind).alias("run_kind"), fold.cast("string").alias("fold"),
                     F.explode(F.array(*items)).alias("s")).select("model", "run_kind", "s.metric", "fold", "s.value")


def evaluation_rows(ev: DataFrame, model: str) -> DataFrame:
    """Rows of a one-row evaluation (no fold)."""
    return _tidy(ev, model, "evaluation", F.lit(None), ev.columns)


def kfold_rows(res: DataFrame, model: str) -> DataFrame:
    """Rows of a cross-validation: every fold, ``mean`` and ``std``."""
    return _tidy(res, model, "kfold", F.col("fold"), [m for m in KFOLD_METRICS if m in res.columns])


def append(rows: DataFrame, root: str) -> dict:
    return V.write_version(rows, root, "metrics")


def history(spark: SparkSession, root: str) -> DataFrame:
    """The log in time: each row with the number of its run (per kind of
    run), the value of the run before and the change."""
    log = V.read_versions(spark, root, "metrics", SCHEMA)
    when = ["created_at", "version"]
    run = F.dense_rank().over(Window.partitionBy("run_kind").orderBy(*when)).cast("int")
    before = F.lag("value").over(Window.partitionBy("run_kind", "metric", "fold").orderBy(*when))
    return (log.withColumn("run", run).withColumn("previous", before)
            .withColumn("change", F.col("value") - F.col("previous")))
