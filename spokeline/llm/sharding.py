"""Shards of near equal size by sampled splitters.

Records are ordered by a key that keeps equal texts side by side. Keys are
sampled with chances in proportion to record sizes; quantiles of the sample cut
the key order into ranges, and a range that turns out overfull is sampled anew
and cut again. Within ranges records are counted exactly, and the ranges' totals
place them in the whole order, which is cut into shards of equal size.

A group of equal texts goes on in the order of doc_id, so a group of any size is
cut like the rest. Only functions of Spark are used; what the driver sees are
the splitters, whose number is bounded by ``ranges`` and ``MOST_SPLITTERS``.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokeline.llm.tables import checkpointed, text_of

RANGES = 256
SAMPLES_PER_RANGE = 48
MOST_SPLITTERS = 4096
OVERFULL = 2.0


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the key: text digest, then doc_id."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
        F.concat(
            F.md5(F.encode(text_of(), "UTF-8")),
            F.coalesce(F.lpad(F.hex("doc_id"), 16, "0"), F.lit("")),
        ).alias("key"),
    )


def splitters(rows: DataFrame, ranges: int = RANGES) -> list[str]:
    """Ascending keys that cut the rows into ranges of similar size.

    A range is cut again while it holds more than ``OVERFULL`` times its share
    and more than one key.
    """
    found: list[str] = []
    while True:
        sizes = (
            rows.groupBy(range_of(F.col("key"), found).alias("range"))
            .agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()
        )
        share = sum(r["bytes"] for r in sizes) / ranges
        over = {r["range"]: r["bytes"] for r in sizes if r["bytes"] > OVERFULL * share and r["low"] < r["high"]}
        if not over or len(found) > MOST_SPLITTERS:
            return found
        new = _quantiles(rows, found, over, share)
        grown = sorted(set(found) | set(new))
        if len(grown) == len(found):
            return found
        found = grown


def _quantiles(rows: DataFrame, found: list[str], over: dict[int, int], share: float) -> list[str]:
    """Splitters inside overfull ranges from a sample weighted by size."""
    bytes_of = F.element_at(F.create_map(*[F.lit(x) for r, b in over.items() for x in (r, b)]), F.col("range"))
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(SAMPLES_PER_RANGE / share))
    # A number in [0, 1) that depends on the key and the round only, so that a rerun draws the same sample.
    drawn = F.shiftrightunsigned(F.xxhash64("key", F.lit(len(found))), 11) / F.lit(float(1 << 53))
    order = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    sample = (
        rows.select("key", "size", range_of(F.col("key"), found).alias("range"))
        .where(F.col("range").isin(list(over)))
        .where(drawn < chance)
        .withColumn("weight", F.col("size") / chance)
    )
    parts = F.greatest(F.lit(2.0), F.ceil(bytes_of / F.lit(share)))
    part = F.floor(
        F.sum("weight").over(order) * parts / (F.sum("weight").over(Window.partitionBy("range")) * 1.0000001)
    )
    return [
        r["splitter"]
        for r in sample.withColumn("part", part)
        .groupBy("range", "part")
        .agg(F.min("key").alias("splitter"))
        .collect()
    ]


def range_of(key: Column, ascending: list[str]) -> Column:
    """Number of splitters not above the key, by binary search in a constant array."""
    if not ascending:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(ascending).bit_length()))]
    table = F.lit(ascending)
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(ascending)) & (F.get(table, at + step - 1) <= key), at + step
        ).otherwise(at),
    )


def shards(docs: DataFrame, n_shards: int = 16, ranges: int = RANGES) -> DataFrame:
    """Every document with its shard, 0 to ``n_shards`` - 1, and its place there.

    Law ``bytes``: a document goes to the shard in which the middle of its bytes
    falls when all bytes, in key order, are cut into equal lengths. Shards
    differ from the mean by less than one document at each end.

    Returns doc_id, size (bytes of the text, none for null, plus 1), text_crc32,
    law, shard, slot (from 0 without gaps) and grown_shard (null for this law).

    * Null and empty texts have size 1; a null doc_id comes first among equal texts.
    * Rows equal in doc_id and text have slots in any order: they do not differ.
    * An empty table gives no rows; further columns are ignored.
    """
    rows = checkpointed(keyed(docs))  # texts are read once
    cuts = splitters(rows, ranges)
    ranged = checkpointed(rows.withColumn("range", range_of(F.col("key"), cuts)))
    # A sum per range: at most MOST_SPLITTERS and a few more.
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    found = {r["range"]: (r["bytes"], r["n"]) for r in totals.collect()}
    each = [found.get(i, (0, 0)) for i in range(len(cuts) + 1)]
    all_bytes = max(1, sum(x[0] for x in each))
    inside = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("size").over(inside) + _at(_before([x[0] for x in each]), "range")
    ranked = ranged.select(
        "doc_id",
        "size",
        "text_crc32",
        (F.row_number().over(inside) + _at(_before([x[1] for x in each]), "range")).alias("rank"),
        F.least(F.lit(n_shards - 1), _middle(upto, n_shards, all_bytes)).alias("shard"),
    )
    counts = {r["shard"]: r["count"] for r in ranked.groupBy("shard").count().collect()}
    first = _before([counts.get(i, 0) for i in range(n_shards)])
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - 1 - _at(first, "shard")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _middle(upto: Column, n_shards: int, all_bytes: int) -> Column:
    """Shard in which the middle of a record falls."""
    middle = (upto - F.col("size") / 2) / F.lit(float(all_bytes))
    return F.floor(middle * n_shards).cast("int")


def _before(counts: list[int]) -> list[int]:
    return [0, *accumulate(counts)][:-1]


def _at(values: list[int], index: str) -> Column:
    return F.get(F.lit(values).cast("array<bigint>"), F.col(index))
