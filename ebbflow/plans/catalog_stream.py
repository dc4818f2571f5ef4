"""Catalog: streaming ingest, scoring and quality jobs, each run with an
``availableNow`` trigger over files derived from the fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import features as FE
from ..operators import monitor as MO
from ..operators import split as S
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.fixtures import oracle_cte
from ..streaming import jobs as J
from .catalog_models import prepared
from .catalog_monitor import _SPLIT_SRC, PSI_COLS, _psi_sql
from ..operators import models as ML
from .registry import query
from .sqltext import dbl, prep_cte, q


def _drop_files(df, path: str, fmt: str) -> None:
    """Land the input as files, one or more per input partition."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False) \
            .option("ignoreTrailingWhiteSpace", False).csv(path)
    else:
        w.parquet(path)


@query("stream_ingest", prep_cte("cleaned") + "SELECT * EXCLUDE (row_id) FROM cleaned")
def stream_ingest(spark, sf):
    src, sink, ck = (scratch_path(spark, n) for n in ("in-csv", "ingest", "ck-ingest"))
    _drop_files(fx.subscribers(spark, sf), src, "csv")
    q = J.stream_ingest(spark, src, sink, ck)
    q.awaitTermination()
    return spark.read.parquet(sink).drop("source_file", "_corrupt_record")


@query("stream_score")
def stream_score(spark, sf):
    """Raw rows arrive as files; the fitted feature state and the saved
    model score them; the sink holds row_id, probability, prediction."""
    d, st = prepared(spark, sf)
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "logistic")
    mp = scratch_path(spark, "model")
    m.write().save(mp)
    raw = fx.subscribers(spark, sf, keyed=True)
    src, sink, ck = (scratch_path(spark, n) for n in ("in-raw", "scores", "ck-score"))
    _drop_files(raw, src, "parquet")
    q = J.stream_score(spark, src, sink, ck, FE.state_from_json(FE.state_to_json(st)), mp, raw.schema)
    q.awaitTermination()
    return spark.read.parquet(sink)


def _quality(spark, sf, name: str, n_files: int):
    """The monitor over ``n_files`` files, one a batch, against the training side."""
    raw = fx.subscribers(spark, sf, keyed=True)
    base = MO.fit_drift_baseline(S.stratified_split(raw).where(F.col("split") == "train"), PSI_COLS)
    src, sink, ck = (scratch_path(spark, f"{n}-{name}") for n in ("in-q", "quality", "ck-quality"))
    raw = fx.subscribers(spark, sf)
    _drop_files(raw.repartition(n_files), src, "csv")
    q = J.stream_quality(spark, src, sink, ck, max_files=1, baseline=MO.DriftBaseline.from_json(base.to_json()))
    q.awaitTermination()
    return spark.read.schema(J.QUALITY_SCHEMA).parquet(sink)


@query("stream_quality")
def stream_quality(spark, sf):
    """Nulls, running null rates and drift of every micro-batch.  Rows-only:
    which rows share a batch follows the files."""
    return _quality(spark, sf, "batches", 4)


@query("stream_quality_totals", oracle_cte("subscribers") + "\nUNION ALL ".join(
    f"SELECT {q(c)} AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS running_null, count(*) AS running_rows, "
    f"count_if({c} IS NULL) / CAST(count(*) AS DOUBLE) AS running_null_rate FROM subscribers" for c in K.RAW_COLUMNS),
    doubles=["running_null_rate"])
def stream_quality_totals(spark, sf):
    """After the last batch the running totals are those of the whole table."""
    d = _quality(spark, sf, "totals", 3)
    last = d.groupBy("column_name").agg(F.max_by(F.struct("running_null", "running_rows", "running_null_rate"), "batch_id").alias("s"))
    return last.select("column_name", "s.*")


@query("stream_drift", _SPLIT_SRC.replace("sp AS (", "sides AS (") + "sp AS (SELECT * EXCLUDE (split), 'train' AS split FROM sides WHERE split = 'train' "
       "UNION ALL SELECT * EXCLUDE (split), 'test' AS split FROM sides),\n" + _psi_sql("sp")
       + f"\nSELECT column_name, psi, psi > {dbl(MO.PSI_ALERT)} AS alert FROM drift", doubles=["psi"])
def stream_drift(spark, sf):
    """One batch of the whole table against the training side: the drift the
    monitor reports is the batch PSI."""
    return _quality(spark, sf, "drift", 1).where(F.col("psi").isNotNull()).select("column_name", "psi", "alert")
