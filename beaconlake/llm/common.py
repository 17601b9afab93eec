"""What several operators need: session settings, and keys that find a document again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.session import tune

# Rows and bytes of an Arrow batch: texts can be long, and a Python worker holds one batch.
BATCH_ROWS = 1000
BATCH_BYTES = "16m"


def prepared(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(row_id: Column, text: Column) -> Column:
    """128 bits of an id and a text, to find a document again. Null differs from empty."""
    named = F.coalesce(row_id.cast("string"), F.lit("null"))
    return F.md5(F.concat(named, F.when(text.isNull(), "|0").otherwise("|1"), F.coalesce(text, F.lit(""))).cast("binary"))


def spare_prefix(columns: list[str]) -> str:
    """A prefix that no column begins with, for columns that stand beside those of a caller."""
    prefix = "_w_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix = "_" + prefix
    return prefix


def filtered(docs: DataFrame, keys: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text", out: str | None = None) -> DataFrame:
    """Documents whose `row_key` does (left_semi) or does not (left_anti) stand in the only column of `keys`.

    With `out`, the key stays as a column of that name.
    """
    key = out or spare_prefix(docs.columns) + "key"
    rows = docs.withColumn(key, row_key(F.col(id_col), F.col(text_col)))
    wanted = keys.select(F.col(keys.columns[0]).alias(key + "_wanted"))
    found = rows.join(wanted, F.col(key) == F.col(key + "_wanted"), how)
    return found if out else found.drop(key)
