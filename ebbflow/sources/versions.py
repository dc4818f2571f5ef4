"""Versioned tables: feature tables, splits and metric history.

Layout below a root folder (on a cluster: a folder under the shared
``spark.checkpoint.dir``)::

    {root}/{kind}/version={v}/part-*.parquet   one directory per version
    {root}/{kind}/version={v}/_{name}          texts kept with it (fitted state)
    {root}/_versions/part-*.parquet            append-only manifest, one record a version

A version exists once its record does: data and texts are written first,
the record (with the data files and their sizes) last, in one small append.
A writer that dies before leaves files that no reader sees and ``vacuum``
removes; a reader takes the files its record names and nothing else.
"Latest" is the newest record, not a second copy of the data.  Version names
carry a microsecond stamp and a random suffix, so two writes in the same
second never collide.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.fingerprint import fingerprint_row

VERSIONS = "_versions"
RECORD_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("version", T.StringType()),
    T.StructField("created_at", T.TimestampType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("n_columns", T.IntegerType()),
    T.StructField("columns", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("n_files", T.IntegerType()), T.StructField("n_bytes", T.LongType()),
])


def new_version(fingerprint: str) -> str:
    ts = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    return f"v_{ts}_{fingerprint[:8]}_{uuid.uuid4().hex[:4]}"


def _utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _data_files(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the data files below ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    it = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    n = size = 0
    while it.hasNext():
        f = it.next()
        if f.getPath().getName().endswith(".parquet"):
            n, size = n + 1, size + f.getLen()
    return n, size


def _commit(spark: SparkSession, root: str, rec: dict) -> dict:
    """Appends the record that makes a version visible: the last write of all."""
    spark.createDataFrame([rec], RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{VERSIONS}")
    return rec


def write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()["value"]


def write_version(df: DataFrame, root: str, kind: str, version: str | None = None,
                  partition_by: tuple[str, ...] = (), texts: dict[str, str] | None = None) -> dict:
    """Write ``df`` as a new version of ``kind``, the ``texts`` next to it
    (each a folder ``_{name}``), and then its record: all become visible
    together.

    The fingerprint is one distributed aggregate (row count plus an
    order-independent content hash); the data are written once, by the
    executors, with no driver round trip."""
    spark = df.sparkSession
    fp = fingerprint_row(df)
    version = version or new_version(fp["fingerprint"])
    path = f"{root.rstrip('/')}/{kind}/version={version}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    n_files, n_bytes = _data_files(spark, path)
    for name, text in (texts or {}).items():
        write_text(spark, f"{path}/_{name}", text)
    return _commit(spark, root, {
        "kind": kind, "version": version, "created_at": _utc_now(), "fingerprint": fp["fingerprint"], "n_rows": int(fp["n_rows"]),
        "n_columns": len(df.columns), "columns": ",".join(df.columns), "path": path, "n_files": n_files, "n_bytes": n_bytes})


def record_version(spark: SparkSession, root: str, kind: str, version: str, path: str,
                   n_rows: int = 0, columns: list[str] | None = None, fingerprint: str = "",
                   created_at: _dt.datetime | None = None) -> dict:
    """Append a record for an artefact written elsewhere (e.g. a saved
    model directory)."""
    return _commit(spark, root, {
        "kind": kind, "version": version, "created_at": created_at or _utc_now(), "fingerprint": fingerprint, "n_rows": int(n_rows),
        "n_columns": len(columns or []), "columns": ",".join(columns or []), "path": path, "n_files": None, "n_bytes": None})


def last_created(spark: SparkSession, root: str, kind: str, as_of: _dt.date) -> DataFrame:
    """One row, ``last_trained``: the day of the newest version of ``kind``
    that existed at the end of ``as_of`` (null: none)."""
    day = F.to_date("created_at")
    return list_versions(spark, root, kind).agg(F.max(F.when(day <= F.lit(as_of), day)).alias("last_trained"))


def vacuum(spark: SparkSession, root: str, kind: str, older_than: _dt.datetime) -> list[str]:
    """Removes the version folders of ``kind`` without a record that were
    last written before ``older_than`` (UTC; leave time for running writers);
    returns their paths.  A folder listing and one read of the records."""
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{kind}")
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    known = {r["version"] for r in list_versions(spark, root, kind).select("version").collect()}  # one name a version
    limit = older_than.replace(tzinfo=_dt.timezone.utc).timestamp() * 1000
    gone = []
    for s in fs.listStatus(base):
        name = s.getPath().getName()
        if name.startswith("version=") and name.removeprefix("version=") not in known and s.getModificationTime() < limit:
            fs.delete(s.getPath(), True)
            gone.append(s.getPath().toString())
    return gone


def status(spark: SparkSession, root: str) -> DataFrame:
    """Newest version per kind with its time, shape and path (one small
    aggregate over the version records)."""
    newest = F.max_by(F.struct("version", "created_at", "n_rows", "n_columns", "path"),
                      F.struct("created_at", "version"))
    return (list_versions(spark, root).groupBy("kind")
            .agg(F.count(F.lit(1)).alias("n_versions"), newest.alias("s"))
            .select("kind", "n_versions", F.col("s.version").alias("latest_version"),
                    F.col("s.created_at").alias("created_at"), F.col("s.n_rows").alias("n_rows"),
                    F.col("s.n_columns").alias("n_columns"), F.col("s.path").alias("path")))


def list_versions(spark: SparkSession, root: str, kind: str | None = None) -> DataFrame:
    try:
        v = spark.read.schema(RECORD_SCHEMA).parquet(f"{root.rstrip('/')}/{VERSIONS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD_SCHEMA)
    return v.where(F.col("kind") == kind) if kind else v


def latest_version(spark: SparkSession, root: str, kind: str) -> str:
    """Newest version name of ``kind``; ``FileNotFoundError`` when none."""
    row = list_versions(spark, root, kind).agg(
        F.max_by("version", F.struct("created_at", "version")).alias("v")).collect()
    if not row or row[0]["v"] is None:
        raise FileNotFoundError(f"no {kind!r} version under {root}")
    return row[0]["v"]


def read_version(spark: SparkSession, root: str, kind: str, version: str | None = None) -> DataFrame:
    """One version of ``kind`` (latest by default), without the
    ``version`` partition column.  Only recorded versions can be read, and a
    version that has lost files since raises ``IOError``."""
    version = version or latest_version(spark, root, kind)
    recs = list_versions(spark, root, kind).where(F.col("version") == version).select("n_files", "n_bytes").collect()
    if not recs:
        raise FileNotFoundError(f"no {kind!r} version {version} under {root}")
    base = f"{root.rstrip('/')}/{kind}"
    if recs[0]["n_files"] is not None and _data_files(spark, f"{base}/version={version}") != (recs[0]["n_files"], recs[0]["n_bytes"]):
        raise IOError(f"{kind} version {version} does not have the files its record names")
    df = spark.read.option("basePath", base).parquet(f"{base}/version={version}")
    return df.drop("version")


def read_versions(spark: SparkSession, root: str, kind: str, schema: str) -> DataFrame:
    """Rows of all recorded versions of ``kind``, with ``version`` and ``created_at``."""
    recs = list_versions(spark, root, kind).select("version", "created_at")
    names = sorted(r["version"] for r in recs.select("version").collect())  # one name a version
    if not names:
        return spark.createDataFrame([], f"{schema}, version string, created_at timestamp")
    base = f"{root.rstrip('/')}/{kind}"
    rows = (spark.read.schema(f"{schema}, version string").option("basePath", base)
            .parquet(*[f"{base}/version={v}" for v in names]))
    return rows.join(F.broadcast(recs), "version")  # one row a version
