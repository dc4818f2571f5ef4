"""File sources and sinks: the raw CSV with pandas null rules, the scoring
payload document, and round trips used by the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..session import scratch_path

_NUMERIC = {"seniorcitizen": T.IntegerType(), "months_with_provider": T.DoubleType(),
            "monthly_fee": T.DoubleType(), "lifetime_spend": T.DoubleType(),
            "churned": T.IntegerType(), "marketing_opt_in": T.IntegerType()}

RAW_SCHEMA = T.StructType([T.StructField(c, _NUMERIC.get(c, T.StringType()), True)
                           for c in K.RAW_COLUMNS])


CORRUPT = "_corrupt_record"


def null_tokens(col: F.Column) -> F.Column:
    """pandas' default NA tokens become null; upper-case ``NAN`` stays text."""
    return F.when(col.isin(*K.CSV_NULL_TOKENS), F.lit(None).cast("string")).otherwise(col)


def _from_text(v: F.Column, dt: T.DataType) -> F.Column:
    """Text -> number as pandas writes numbers: ``1.0`` is an integer and
    ``True`` / ``False`` are 1 / 0; other text becomes null, never an error."""
    flag = F.when(F.lower(v) == "true", F.lit(1)).when(F.lower(v) == "false", F.lit(0)).cast(dt)
    if isinstance(dt, T.IntegerType):
        d = v.try_cast("double")
        whole = F.when(d == F.floor(d), d.try_cast(dt))
        return F.coalesce(v.try_cast(dt), whole, flag)
    return F.coalesce(v.try_cast(dt), flag)


def typed_from_text(txt: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Text columns by name -> typed: NA tokens nulled, numbers parsed, a
    column the file lacks null, columns beyond ``schema`` left out.  Shared
    by the batch reader and the streaming ingest job."""
    out = []
    for f in schema.fields:
        if f.name not in txt.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        v = null_tokens(F.col(f"`{f.name}`"))
        if not isinstance(f.dataType, T.StringType):
            v = _from_text(v, f.dataType)
        out.append(v.alias(f.name))
    return txt.select(*out, *([CORRUPT] if CORRUPT in txt.columns else []))


def csv_text(spark: SparkSession, path: str, stream: bool = False, multi_line: bool = False,
             max_files: int | None = None) -> DataFrame:
    """CSV file(s) as text columns named by their header, in any order, plus
    ``_corrupt_record`` (the raw row where its field count is wrong, else
    null).  Quotes are doubled inside quotes.  Files of one path share one
    header.  ``multi_line`` allows line breaks inside quotes; such a file
    cannot be split, so it is off by default."""
    opts = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False, "mode": "PERMISSIVE", "multiLine": multi_line}
    names = spark.read.options(**opts).csv(path).columns  # reads the header line only
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*names, CORRUPT]])
    r = (spark.readStream if stream else spark.read).schema(schema).options(**opts)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def read_subscribers_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
                         multi_line: bool = False, corrupt: bool = False) -> DataFrame:
    """Header CSV -> typed table with the pandas rules; ``corrupt`` keeps
    ``_corrupt_record``."""
    d = typed_from_text(csv_text(spark, path, multi_line=multi_line), schema)
    return d if corrupt else d.drop(CORRUPT)


def with_row_key(raw: DataFrame, key: str = "row_id") -> DataFrame:
    """Add an integer key that the row's content decides, whatever the
    partitioning: 60 bits of the md5 of its text and of its running number
    among identical rows."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in raw.columns])
    nth = F.row_number().over(Window.partitionBy("_m").orderBy("_m"))
    d = raw.withColumn("_m", F.md5(text)).withColumn("_m", F.md5(F.concat_ws("#", "_m", nth)))
    return d.select(F.conv(F.substring("_m", 1, 15), 16, 10).cast("bigint").alias(key), *raw.columns)


def write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def csv_round_trip(spark: SparkSession, raw: DataFrame) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(raw, path)
    return read_subscribers_csv(spark, path)


# ------------------------------------------------------------- payloads
def features_schema(raw: DataFrame, drop: tuple[str, ...] = (K.LABEL, "account_id", "customer_hash", "row_id")) -> T.StructType:
    return T.StructType([f for f in raw.schema.fields if f.name not in drop])


def write_payload(cohorts: DataFrame, fschema: T.StructType, path: str) -> None:
    """Cohort rows (name, description, features JSON, ...) -> one payload
    document ``{description, format, examples: [...]}``.  The document
    holds the handful of cohort examples only (bounded), so one writer
    task is right."""
    ex = cohorts.select(F.struct(
        "name", "description", F.from_json("features", fschema).alias("features"),
        "expected_churn", "actual_churned").alias("ex"))
    doc = ex.agg(F.collect_list("ex").alias("examples")).select(
        F.lit("Customer inference examples").alias("description"),
        F.lit("Features per example; nulls omitted").alias("format"), "examples")
    doc.coalesce(1).write.mode("overwrite").json(path)


def read_payload_json(spark: SparkSession, path: str, fschema: T.StructType | None = None) -> DataFrame:
    """Payload document(s) -> one row per example with its features
    flattened (absent keys become null) and its known outcome."""
    reader = spark.read.option("multiLine", True)
    if fschema is not None:
        ex = T.StructType([T.StructField("name", T.StringType()), T.StructField("description", T.StringType()),
                           T.StructField("features", fschema), T.StructField("expected_churn", T.BooleanType()),
                           T.StructField("actual_churned", T.BooleanType())])
        reader = reader.schema(T.StructType([T.StructField("description", T.StringType()),
                                             T.StructField("format", T.StringType()),
                                             T.StructField("examples", T.ArrayType(ex))]))
    doc = reader.json(path)
    return doc.select(F.explode("examples").alias("ex")).select("ex.name", "ex.features.*", "ex.expected_churn", "ex.actual_churned")


def payload_round_trip(spark: SparkSession, raw: DataFrame) -> DataFrame:
    from ..operators.split import cohort_export
    fs = features_schema(raw)
    path = scratch_path(spark, "payload")
    write_payload(cohort_export(raw), fs, path)
    return read_payload_json(spark, path, fs)
