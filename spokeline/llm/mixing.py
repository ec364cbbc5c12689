"""A mix of sources at target weights by weighted fair queueing.

Each source's documents stand in a shuffled order, up to ``MOST_TIMES`` times
over. The virtual finish time of a document is the number of its source's words
up to and including it, divided by the source's target. All sources are served
in the order of finish times until the total budget is used up, so every source
is served in proportion to its target at any time.

Running sums are made in two levels. The shuffled order of a source falls into
slices, which are summed first and then run through independently, so that a
source with a third of all documents is dealt over many tasks. The global order
falls into ranges of finish time; whole ranges are taken by their sums, and only
the one in which the budget ends is put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokeline.llm.tables import checkpointed, word_count

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
# Hex digits of the shuffled order that name a slice: 4,096 slices a source.
SLICE_DIGITS = 3
# Ranges of finish time per unit, and the time beyond which they are one.
RANGES, LAST = 4096, 4


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Target words of each source: (source, source_size) -> and target.

    Sources in code point order, null last, have the weights in turn. They share
    the sum of all sizes; a target stops at ``MOST_TIMES`` its source's size and
    the others share what is left. With sources ordered by limit per weight,
    those that stop come first, so one pass over running sums finds them.
    """
    weight = F.element_at(F.lit(list(weights)), (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))
    placed = (
        sizes.withColumn("nth", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("long"))
        .withColumn("most", MOST_TIMES * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("left", left)
        .withColumn("weights", F.sum("weight").over(after))
        .withColumn("stops", F.col("most") * F.col("weights") <= F.col("left") * F.col("weight"))
    )
    # The first that does not stop fixes the share of all that follow.
    first = F.min(F.when(~F.col("stops"), F.struct(F.col("source_size") / F.col("weight"), "nth", "left", "weights")))
    open_ = first.over(Window.partitionBy())
    share = F.col("open.left") * F.col("weight") / F.col("open.weights")
    return placed.withColumn("open", open_).select(
        "source",
        "source_size",
        F.when(F.col("stops"), F.col("most").cast("double")).otherwise(share).alias("target"),
    )


def _shuffled(sized: DataFrame) -> DataFrame:
    """Adds upto: words of the source up to and including the document in shuffled order."""
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select(
        F.col("source").alias("of"),
        F.col("slice").alias("in"),
        F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("start"),
    )
    inside = (
        Window.partitionBy("source", "slice")
        .orderBy("shuffled", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    here = F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("in"))
    return (
        sized.withColumn("inside", F.sum("size").over(inside))
        .join(starts, here)
        .withColumn("upto", F.col("start") + F.col("inside"))
    )


def _order(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string")).cast("binary"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix", order: Column | None = None
) -> DataFrame:
    """Every document with the words that the mix takes from it.

    Size is the number of words. Returns doc_id, source, size, source_size, target (both
    of its source) and taken: size times the number of times it is taken, 0 to
    ``MOST_TIMES``. The order comes from a digest of ``seed`` and doc_id, or from ``order``, hex
    digits as well, so reruns agree.

    * Null texts have size 0 and are not taken; documents without a source are
      one source. A source without words has target 0.
    * Rows that repeat a doc_id stand next to each other and are taken alike or
      not, each for itself, unless the budget ends between them; rows equal in
      doc_id, source and size are taken as one.
    * An empty table gives no rows; further columns are ignored.
    """
    shuffled = _order(F.col("doc_id"), seed) if order is None else order
    sized = checkpointed(
        docs.select("doc_id", "source", word_count().alias("size"), shuffled.alias("shuffled")).withColumn(
            "slice", F.substring("shuffled", 1, SLICE_DIGITS)
        )
    )
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(64)).cast("int")
    of = sources.withColumnRenamed("source", "of_source").withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(63))))
    queued = checkpointed(
        _shuffled(sized)
        .select("doc_id", "source", "size", "upto", slot.alias("slot"))
        .join(of, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("slot") == F.col("s")))
        .select("doc_id", "source", "size", "source_size", "target", "upto")
    )
    cut = _cut(queued)
    times = sum((_up_to(_turn(time), cut).cast("long") for time in range(MOST_TIMES)), F.lit(0))
    return queued.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken")
    )


def _finish(time: Column | int) -> Column:
    words = F.col("source_size") * time + F.col("upto")
    return F.when((F.col("target") > 0) & (F.col("size") > 0), words / F.col("target"))


def _turn(time: int) -> tuple[Column, ...]:
    """What orders the turns of all documents: finish time, then source (null last), document, time."""
    return (_finish(time), F.col("source").isNull(), F.col("source"), F.col("doc_id"), F.col("size"), F.lit(time))


def _up_to(turn: tuple[Column, ...], cut: tuple | None) -> Column:
    """Whether a turn is not after the cut."""
    if cut is None:
        return F.lit(False)
    up_to = F.lit(True)
    for value, limit in reversed(list(zip(turn, cut, strict=True))):
        if limit is None:  # nulls come first, so only a null is not after it
            up_to = value.isNull() & up_to
        else:
            up_to = value.isNull() | (value < F.lit(limit)) | ((value == F.lit(limit)) & up_to)
    return F.coalesce(turn[0].isNotNull() & up_to, F.lit(False))


def _cut(queued: DataFrame) -> tuple | None:
    """The last turn within the budget, which is the sum of all sizes."""
    turns = (
        queued.select("*", F.explode(F.sequence(F.lit(0), F.lit(MOST_TIMES - 1))).alias("time"))
        .withColumn("finish", _finish(F.col("time")))
        .where("finish is not null")
        .withColumn("range", F.floor(F.least("finish", F.lit(float(LAST))) * RANGES))
    )
    # At most LAST * RANGES + 1 rows, ordered here.
    sums = sorted(turns.groupBy("range").agg(F.sum("size").alias("words")).collect())
    left = queued.agg(F.sum("size")).first()[0] or 0
    for at, words in sums:
        if words > left or at == sums[-1][0]:
            break
        left -= words
    else:
        return None
    keys = ("finish", "no_source", "source", "doc_id", "size", "time")
    ordered = (
        turns.where(F.col("range") == at)
        .withColumn("no_source", F.col("source").isNull())
        .withColumn("used", F.sum("size").over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)))
    )
    last = ordered.where(F.col("used") <= left).agg(F.max(F.struct(*keys))).first()[0]
    if last is None:  # not even its first turn fits: the budget ended with the range before
        last = turns.withColumn("no_source", F.col("source").isNull()).where(F.col("range") < at)
        last = last.agg(F.max(F.struct(*keys))).first()[0]
    return tuple(last) if last is not None else None


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """The mix as documents: each as often as it is taken, with all its columns, whatever they are called.

    Rows are told apart by doc_id, text and source, so that the mix has the words that ``mix`` takes,
    also where doc_ids repeat or are null. Repeated rows share what is taken of them, row by row as
    their columns sort. Null and empty texts are not taken. An empty table gives no rows.
    """
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    doc_id, source, digest = F.col("doc.doc_id"), F.col("doc.source"), F.sha2(text, 256)
    name = F.concat_ws(
        ":",
        F.coalesce(doc_id.cast("string"), F.lit("-")),
        digest,
        F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source)),
    )
    rows = docs.select(F.struct("*").alias("doc")).select("doc", name.alias("name"))
    order = F.when(doc_id.isNotNull(), _order(doc_id, seed)).otherwise(_order(digest, seed))
    named = rows.select(F.col("name").alias("doc_id"), text.alias("text"), source.alias("source"), order.alias("order__"))
    taken = mix(named, weights, seed, F.col("order__")).where("taken > 0")
    shares = taken.groupBy(F.col("doc_id").alias("name")).agg(
        F.sum(F.col("taken") / F.col("size")).cast("long").alias("times")
    )
    kinds = [f"doc.`{c}`" for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    alike = Window.partitionBy("name")
    nth = F.row_number().over(alike.orderBy(*kinds))
    shared = rows.join(shares, "name").withColumns({"nth": nth, "rows": F.count(F.lit(1)).over(alike)})
    own = F.expr("times div rows") + F.when(F.col("nth") <= F.col("times") % F.col("rows"), 1).otherwise(0)
    return (
        shared.withColumn("own", own)
        .where("own > 0")
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("own").cast("int"))))
        .select("doc.*")
    )
