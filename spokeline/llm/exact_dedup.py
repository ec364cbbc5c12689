"""Exact duplicates by distributed most-significant-digit radix partitioning.

Texts are split by their length and then by successive bytes. A round looks at
the bytes up to its depth: documents that no other one equals so far are done,
groups whose texts end there are done as well, and only the rest, with its
texts, goes to the next and deeper round. Groups are told apart by the bytes
themselves, so equality needs no digest.

Each round counts its groups per salt first and then sums at most ``SALTS``
counts a group, so that a group holding a third of all documents is dealt over
many tasks, both in the count and in the join that takes the count back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spokeline.llm.tables import checkpointed, text_of

# Bytes seen by each round. The last one sees all that is left.
DEPTHS = (64, 4096, 262144, None)
SALTS = 64
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def exact_duplicates(docs: DataFrame, depths: tuple[int | None, ...] = DEPTHS) -> DataFrame:
    """Every document with the one that stands for its group of equal texts.

    Texts are equal when identical after lower-casing A to Z; a null text counts
    as the empty one. Returns doc_id, keep_id (largest doc_id of the group),
    group_size, kept and text_sha256 of the normalised text.

    * Rows that repeat a doc_id with the same text count each, and all are kept
      if their doc_id is. The same doc_id with another text is another group.
    * A null doc_id is smaller than any other. If a group has no other, keep_id
      is null and all its rows are kept.
    * An empty table gives no rows; further columns are ignored.
    """
    body = F.encode(F.translate(text_of(), UPPER, UPPER.lower()), "UTF-8")
    active = (
        docs.select("doc_id", body.alias("body"))
        .withColumn("n_bytes", F.octet_length("body"))
        .withColumn("text_sha256", F.sha2("body", 256))
    )
    done = None
    for depth in depths:
        split = checkpointed(_round(active, depth))
        ended = split.where("body is null").select("doc_id", "keep_id", "group_size", "text_sha256")
        done = ended if done is None else done.unionByName(ended)
        if depth is None:
            break
        active = split.where("body is not null").select("doc_id", "body", "n_bytes", "text_sha256")
        if active.isEmpty():
            break
    return done.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _round(active: DataFrame, depth: int | None) -> DataFrame:
    """Documents with their group's size; the text stays with those not settled yet."""
    digits = F.col("body") if depth is None else F.substring("body", 1, depth)
    keyed = active.withColumn("digits", digits).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    )
    group = Window.partitionBy("n_bytes", "digits")
    totals = (
        keyed.groupBy("n_bytes", "digits", "salt")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top"))
        .select(
            "n_bytes",
            "digits",
            "salt",
            F.sum("n").over(group).alias("group_size"),
            F.max("top").over(group).alias("keep_id"),
        )
    )
    settled = F.col("group_size") == 1
    if depth is None:
        settled = F.lit(True)
    else:
        settled = settled | (F.col("n_bytes") <= depth)
    return keyed.join(totals, ["n_bytes", "digits", "salt"]).select(
        "doc_id",
        "n_bytes",
        "text_sha256",
        "keep_id",
        "group_size",
        F.when(~settled, F.col("body")).alias("body"),
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns.

    It is one with the group's keep_id, a null one included; of several such rows
    (a repeated doc_id, or only null ones) the smallest by its columns. They are
    reduced in each task before they meet.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    order = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    digest = F.sha2(F.encode(F.translate(text_of(), UPPER, UPPER.lower()), "UTF-8"), 256)

    def key(of_text):
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), of_text).alias("key__")

    rows = docs.groupBy(key(digest)).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("row__"))
    kept = exact_duplicates(docs).where("kept").select(key(F.col("text_sha256"))).distinct()
    return rows.join(kept, "key__", "left_semi").select("row__.*")
