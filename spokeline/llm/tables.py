"""Small helpers the operators share."""

from __future__ import annotations

import gc
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What separates words everywhere in this subpackage: space and the five controls 9 to 13.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
# Parts of a group that may hold a third of all rows.
SALTS = 64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(column: str = "text") -> Column:
    """Words of a text in order; none for null."""
    return F.regexp_extract_all(text_of(column), F.lit(WORD), F.lit(0))


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def parts_for(spark: SparkSession, n_bytes: int, each: int) -> int:
    """Number of parts of about ``each`` bytes, and at least one per shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / each))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one number, which sizes the parts of a job."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows in the shared checkpoint folder, without their lineage.

    The folder is the cluster's ``spark.checkpoint.dir``; a session that names
    none, as in tests, gets one of its own.
    """
    from spokeline.session import scratch_root

    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files and checkpoints that nothing refers to any more.

    It does so when the driver's garbage is collected, which a loop of small jobs outruns.
    """
    gc.collect()
    spark._jvm.System.gc()


def with_minimum(df: DataFrame, keys: list[str], value: str, spread: str, name: str = "least") -> DataFrame:
    """Adds the least ``value`` and the number of rows of each group of equal (non-null) keys.

    Groups are summed per salt of ``spread`` first, and joined back per salt, so
    a group of any size is dealt over ``SALTS`` tasks.
    """
    salted = df.withColumn("salt__", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    group = Window.partitionBy(*keys)
    totals = (
        salted.groupBy(*keys, "salt__")
        .agg(F.min(value).alias("m__"), F.count(F.lit(1)).alias("n__"))
        .select(
            *keys, "salt__", F.min("m__").over(group).alias(name), F.sum("n__").over(group).alias(f"{name}_of")
        )
    )
    return salted.join(totals, [*keys, "salt__"]).drop("salt__")
