"""Table fingerprint: schema text plus an order-independent content hash.

The content hash is ``sum(xxhash64(row))`` over all rows, accumulated as
DECIMAL(38,0) so it cannot overflow; a sum (unlike XOR) does not cancel
repeated rows.  It is one partial aggregate: the same table gives the
same value whatever its partitioning or row order.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_text(df: DataFrame) -> str:
    return ";".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: n_rows, n_columns, content_hash, schema, fingerprint (first
    8 hex digits of md5 over shape, schema and content hash)."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("content_hash"))
    st = schema_text(df)
    return agg.select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), "content_hash", F.lit(st).alias("schema"),
        F.substring(F.md5(F.concat_ws("|", F.col("n_rows").cast("string"), F.lit(str(len(df.columns))),
                                      F.lit(st), F.col("content_hash"))), 1, 8).alias("fingerprint"))


def fingerprint_row(df: DataFrame) -> dict:
    return fingerprint(df).collect()[0].asDict()
