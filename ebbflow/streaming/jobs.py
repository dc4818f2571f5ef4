"""Structured Streaming jobs: file ingest, scoring, data-quality monitor.

Ingest and scoring are stateless per record, the monitor carries running
totals from batch to batch (the data carry no event time, so no watermark
is needed).  All use a checkpoint location under the shared work
folder, and run with any trigger; ``available_now`` processes what is
there and stops (what the catalog and tests use).  Scoring applies the
*fitted* feature state and a saved model — never statistics
recomputed from a micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import constants as K
from ..operators import features as FE
from ..operators import monitor as MO
from ..operators.models import load_model, with_probability
from ..session import path_exists
from ..sources import files


def _start(df: DataFrame, sink: str, ckpt: str, available_now: bool, fmt: str = "parquet",
           processing_time: str = "10 seconds") -> StreamingQuery:
    w = df.writeStream.format(fmt).option("path", sink).option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def ingest_frame(spark: SparkSession, src: str, schema: T.StructType = files.RAW_SCHEMA,
                 max_files: int | None = None) -> DataFrame:
    """Streaming CSV source -> typed, cleaned rows, with the raw text of a
    malformed row in ``_corrupt_record``, plus the source file name."""
    typed = files.typed_from_text(files.csv_text(spark, src, stream=True, max_files=max_files), schema)
    return FE.clean_all(typed).withColumn("source_file", F.input_file_name())


def stream_ingest(spark: SparkSession, src: str, sink: str, ckpt: str, available_now: bool = True,
                  schema: T.StructType = files.RAW_SCHEMA) -> StreamingQuery:
    return _start(ingest_frame(spark, src, schema), sink, ckpt, available_now)


def score_frame(raw: DataFrame, state: FE.FeatureState, model_path: str, threshold: float = K.THRESHOLD_DEFAULT,
                key: str = "row_id") -> DataFrame:
    """Raw rows (stream or batch) -> key, probability, prediction; both null
    where a feature is missing."""
    feats = FE.align_features(FE.transform_features(raw, state, keep=(key,)), state.feature_names, keep=(key,))
    out, p = with_probability(load_model(model_path), feats, "_p"), F.col("_p")
    return out.select(key, p.alias("probability"), (p >= F.lit(float(threshold))).cast("int").alias("prediction"))


def stream_score(spark: SparkSession, src: str, sink: str, ckpt: str, state: FE.FeatureState, model_path: str,
                 schema: T.StructType, threshold: float = K.THRESHOLD_DEFAULT,
                 available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return _start(score_frame(r.parquet(src), state, model_path, threshold), sink, ckpt, available_now)


QUALITY_SCHEMA = ("batch_id bigint, column_name string, n_null bigint, n_rows bigint, running_null bigint, running_rows bigint, "
                  "running_null_rate double, psi double, alert boolean")


def batch_quality(batch: DataFrame, batch_id: int, before: DataFrame | None = None, baseline: MO.DriftBaseline | None = None) -> DataFrame:
    """Quality of one micro-batch, a row per column: nulls of the batch, the
    running totals with those of ``before`` (the rows of the batch before),
    and for the columns of ``baseline`` the batch's drift from it.  One
    aggregate over the batch gives all counts."""
    cols = batch.columns
    drift = baseline.bin_counts() if baseline else []
    wide = batch.agg(F.count(F.lit(1)).alias("_n"),
                     *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(cols)], *drift)
    row = wide.collect()  # counts: one row, whatever the batch's size
    wide = batch.sparkSession.createDataFrame(row, wide.schema)
    out = wide.select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").cast("bigint").alias("n_null"),
                 F.col("_n").cast("bigint").alias("n_rows")) for i, c in enumerate(cols)])).alias("s")
    ).select("batch_id", "s.*")
    if before is None:
        before = batch.sparkSession.createDataFrame([], QUALITY_SCHEMA)
    known = before.select("column_name", F.col("running_null").alias("_rn"), F.col("running_rows").alias("_rr"))
    psi = baseline.psi_of(wide) if baseline else batch.sparkSession.createDataFrame([], "column_name string, psi double, alert boolean")
    out = out.join(F.broadcast(known), "column_name", "left").join(F.broadcast(psi), "column_name", "left")  # one row a column
    out = out.withColumn("running_null", F.col("n_null") + F.coalesce("_rn", F.lit(0))) \
        .withColumn("running_rows", F.col("n_rows") + F.coalesce("_rr", F.lit(0)))
    return out.select("batch_id", "column_name", "n_null", "n_rows", "running_null", "running_rows",
                      F.try_divide("running_null", "running_rows").alias("running_null_rate"), "psi", "alert")


def _state_before(spark: SparkSession, sink: str, batch_id: int) -> DataFrame | None:
    """Rows of the newest batch before ``batch_id`` in the sink: the running totals so far."""
    for k in range(batch_id - 1, -1, -1):  # the batch before, unless its folder was taken away
        if path_exists(spark, f"{sink}/batch_id={k}"):
            return spark.read.parquet(f"{sink}/batch_id={k}")
    return None


def stream_quality(spark: SparkSession, src: str, sink: str, ckpt: str, available_now: bool = True,
                   schema: T.StructType = files.RAW_SCHEMA, max_files: int | None = None,
                   baseline: MO.DriftBaseline | None = None) -> StreamingQuery:
    """Per column and micro-batch: null counts, running null rate over all
    batches and drift from a fitted baseline, appended to ``sink``.

    The running totals are state kept in the sink: each batch continues the
    rows of the batch before.  ``foreachBatch`` is idempotent per batch id: a
    retried batch reads the same predecessor and overwrites its own
    partition instead of counting twice."""
    typed = files.typed_from_text(files.csv_text(spark, src, stream=True, max_files=max_files), schema).drop(files.CORRUPT)
    sink = sink.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch_quality(batch, batch_id, _state_before(batch.sparkSession, sink, batch_id), baseline)
        rows.drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    w = typed.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
