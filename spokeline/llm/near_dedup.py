"""Near duplicates by SetSketch registers.

A sketch has ``REGISTERS`` registers, each the exponentially spaced, truncated
minimum of a hash over the document's word shingles; sketches of parts of a set
merge by the larger register. Registers are banded: documents that agree in all
registers of a band are candidates. With similarity 0.8 a pair agrees in none of
``BANDS`` bands with a chance below one in a million.

* Documents with equal sets are one class; its smallest doc_id goes on.
* Every document of a band value is tried with the value's hub, its smallest document: at
  most one row per document and band, and first with the hub it shares most bands with. Links
  found so make components, and hubs of a document's own component need no further test.
* What is left are values whose other documents lie in several components. There, documents of
  different components are tried with each other; a pair inside one needs no test, as it
  can't change the result. In a group, the largest component is the crowd. Its documents meet
  the other ones in blocks of about ``BLOCK`` and never each other, so that a group of near
  copies costs work in proportion to its size, and one of any size is dealt over many tasks.
* To be tried means: the likelihood of the similarity, given all registers and both set
  sizes, is looked at first, on sketches alone. Pairs that it puts clearly below the limit
  (five standard errors) are left out. What remains is confirmed on the full sets.
  Tasks return spanning forests of links, so no pairs become rows beyond those with hubs.
* Components of these links, and the classes, are the result.

Shingles are told apart by 64-bit digests. What still grows with the square of a group are
comparisons of documents that share band values, or are likely links, and yet are not linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokeline.llm import text_hashes
from spokeline.llm.components import components
from spokeline.llm.shared_files import ship
from spokeline.llm.tables import checkpointed, release, text_of, with_minimum

SHINGLE_WORDS = 5
PERCENT = 80
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
# Registers of 16 bits: with a small base, sets that share nothing hardly ever agree in one.
BASE, RATE, LARGEST, REGISTER = 1.001, 20.0, 65535, np.dtype("<u2")
# How far below the limit a likely similarity may lie and still be confirmed: five standard errors.
MARGIN = 5 * (0.25 / REGISTERS) ** 0.5
BLOCK = 256
BLOCK_BYTES = 32 << 20
SALTS = 8

_ODD = text_hashes.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = text_hashes.mix(np.arange(1001, REGISTERS + 1001, dtype=np.uint64))


def shingles(text: str | None, length: int) -> np.ndarray:
    """Sorted digests of a text's set of shingles."""
    digests = text_hashes.word_digests(text_hashes.words(text, lower=True))
    if not len(digests):
        return digests
    # A text with fewer words is one shingle, which differs from any longer one.
    return np.unique(text_hashes.runs(digests, min(length, len(digests)), seed=min(length, len(digests))))


def sketch(found: np.ndarray) -> np.ndarray:
    """Registers of a set of digests."""
    least = np.full(REGISTERS, 2**64 - 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), 2048):
            least = np.minimum(least, (found[at : at + 2048, None] * _ODD + _ADD).min(axis=0))
    minimum = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(minimum) / np.log(BASE)), 0, LARGEST).astype(REGISTER)


def likely(above: np.ndarray, below: np.ndarray, n: np.ndarray, m: np.ndarray, limit: float) -> np.ndarray:
    """Whether the most likely similarity is at least ``limit``.

    ``above`` and ``below`` count registers of the first set that are larger and
    smaller; n and m are set sizes. The likelihood has one maximum, so the sign
    of its slope at the limit tells.
    """
    u, v, c = n / (n + m), m / (n + m), (BASE - 1) / BASE

    def chance(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * c) / np.log(BASE)

    def slope(x):
        return c / (1 - np.clip(x, 1e-12, 1) * c) / np.log(BASE)

    more, less = u - v * limit, v - u * limit
    equal = np.maximum(1 - chance(more) - chance(less), 1e-12)
    rise_more, rise_less = -v * slope(more), -u * slope(less)
    total = above * rise_more / chance(more) + below * rise_less / chance(less)
    return total - (REGISTERS - above - below) * (rise_more + rise_less) / equal >= 0


def _sketches(length: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            ids, sizes, digests, sketches = batch.column("doc_id"), [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), length)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sketches.append(sketch(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "digest", "sketch"],
            )

    return make


def _likely_pairs(limit: float):
    """Pairs of sketches whose likely similarity is at least ``limit``."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (_registers(batch.column(n).to_pylist()) for n in ("one", "two"))
            n, m = (batch.column(c).to_numpy().astype(float) for c in ("n", "m"))
            found = likely((one > two).sum(axis=1), (one < two).sum(axis=1), n, m, limit)
            yield batch.select(["a", "b", "bands"]).filter(pa.array(found))

    return pick


def _registers(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), REGISTER).reshape(len(sketches), REGISTERS)


def _with_sets(length: int):
    """Sets of documents in place of their texts. Texts that share a doc_id only are told apart by their sets."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sets = [shingles(t.as_py(), length).tobytes() for t in batch.column("text")]
            meant = [xxhash.xxh3_128_digest(s) == d for s, d in zip(sets, batch.column("digest").to_pylist())]
            at = batch.schema.get_field_index("text")
            found = batch.set_column(at, "set", pa.array(sets, pa.binary())).filter(pa.array(meant, pa.bool_()))
            yield found.drop_columns(["digest"])

    return make


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from the members that two sets or more share."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, member, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[member] > 1
    column = (np.cumsum(count > 1) - 1)[member[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total, width = np.zeros((n, n), dtype=np.float32), 4096
    for begin in range(0, int((count > 1).sum()), width):
        low, high = np.searchsorted(column, [begin, begin + width])
        marks = np.zeros((n, width), dtype=np.float32)
        marks[owner[low:high], column[low:high] - begin] = 1
        total += marks @ marks.T
    return total.astype(np.int64)


def _forest(ids: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links of a matrix."""
    root, found = list(range(len(ids))), []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(linked)):
        x, y = top(int(i)), top(int(j))
        if x != y:
            root[max(x, y)] = min(x, y)
            found.append((int(ids[i]), int(ids[j])))
    return found


def _tried(table: pa.Table, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of a task's documents are likely links, i before j, and set sizes.

    Pairs within a block have a task of their own, and pairs of one component need none.
    """
    block, component, size = (table.column(c).to_numpy() for c in ("block", "component", "n_shingles"))
    registers = _registers(table.column("sketch").to_pylist())
    above = np.zeros((len(size), len(size)), dtype=np.int32)
    for register in registers.T:
        above += register[:, None] > register[None, :]
    tried = likely(above, above.T, size[:, None].astype(float), size[None, :].astype(float), limit)
    tried &= np.triu(np.ones_like(tried), 1).astype(bool) & (component[:, None] != component[None, :])
    if block.min() != block.max():
        tried &= block[:, None] != block[None, :]
    return tried, size


def _links_of(table: pa.Table, percent: int, limit: float) -> list[tuple[int, int]]:
    """A spanning forest of a task's links: likely ones, or confirmed ones where sets are given."""
    tried, size = _tried(table, limit)
    some = np.flatnonzero(tried.any(axis=0) | tried.any(axis=1))
    if not len(some):
        return []
    ids, tried = table.column("doc_id").to_numpy()[some], tried[np.ix_(some, some)]
    if "set" in table.column_names:
        sets = table.column("set").take(pa.array(some)).to_pylist()
        both = _overlaps([np.frombuffer(s, np.uint64) for s in sets])
        tried &= 100 * both >= percent * (size[some][:, None] + size[some][None, :] - both)
    return _forest(ids, tried)


TASK = ("group", "one", "two")


def _in_tasks(percent: int, limit: float):
    """Links of all tasks of a partition, which come sorted, one task after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            found = _links_of(table, percent, limit) if table.num_rows > 1 else []
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one task each, from rows sorted by task. A task is held whole, of other rows a batch."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(c)[row].as_py() for c in TASK)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in TASK])
        begins = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        bounds = [0, *begins.tolist(), batch.num_rows]
        for at, end in zip(bounds, bounds[1:]):
            if held and key(held[-1], 0) != key(batch, at):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(at, end - at))
    if held:
        yield pa.Table.from_batches(held)


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Every document with its shingles, its component and whether it stays.

    Texts are compared as sets of ``shingle_words`` consecutive words, A to Z in
    lower case; a shorter text is one shingle. Documents are linked if the
    intersection is at least ``percent`` of the union. Returns doc_id,
    n_shingles, component_id (smallest doc_id reachable over links) and kept
    (doc_id = component_id).

    * Documents without words, null texts included, are linked with nothing.
    * Rows that repeat a doc_id belong to the same document if their sets are
      equal; otherwise each row's set is linked under that doc_id.
    * A null doc_id has no component and is not kept; it links nothing.
    * An empty table gives no rows; further columns are ignored.
    """
    ship(docs.sparkSession)
    sketched = checkpointed(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            _sketches(shingle_words), "doc_id long, n_shingles long, digest binary, sketch binary"
        )
    )
    named = sketched.where("digest is not null and doc_id is not null")
    classed = checkpointed(with_minimum(named, ["digest"], "doc_id", "doc_id", "first").drop("first_of"))
    firsts = checkpointed(classed.where("doc_id = first").select("doc_id", "n_shingles", "digest", "sketch").distinct())
    limit = percent / 100 - MARGIN
    members = checkpointed(_shared_values(firsts))
    stars = checkpointed(_likely_stars(members, firsts, limit))
    ends = stars.select(F.col("a").alias("doc_id")).unionByName(stars.select(F.col("b").alias("doc_id"))).distinct()
    sets = checkpointed(_sets(docs, ends, firsts, shingle_words))
    main = stars.groupBy("b").agg(F.max_by("a", F.struct(F.col("bands"), -F.col("a"))).alias("a"))
    nearest = checkpointed(_confirmed(sets, _star_tasks(main, firsts), percent))
    apart = _apart(stars.join(main, ["a", "b"], "left_anti"), _roots(nearest))
    linked = nearest.unionByName(checkpointed(_confirmed(sets, _star_tasks(apart, firsts), percent)))
    release(docs.sparkSession)
    parts = checkpointed(_parts(linked))
    release(docs.sparkSession)
    likely_ = checkpointed(_linked_in(_open_values(members, parts), firsts, percent, limit))
    more = linked.limit(0)
    if not likely_.isEmpty():
        tasks = checkpointed(_tasks(_open_groups(likely_, parts), firsts))
        rest = tasks.select("doc_id").distinct().join(ends, "doc_id", "left_anti")
        both = sets.unionByName(_sets(docs, rest, firsts, shingle_words)) if not rest.isEmpty() else sets
        more = checkpointed(_confirmed(both, tasks, percent))
    found = linked.unionByName(more)
    release(docs.sparkSession)
    # Rows of one doc_id have one component, its classes' smallest.
    of_first = classed.select("doc_id", "first").distinct()
    joined = components(
        found.unionByName(
            of_first.select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
        )
    )
    return (
        sketched.join(joined, F.col("doc_id") == F.col("node"), "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        )
    )


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")


def _per_salt(df: DataFrame) -> DataFrame:
    """A row for every salt, to be joined to rows that are dealt by theirs."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _shared_values(firsts: DataFrame) -> DataFrame:
    """Documents of every band value that several have: value, hub (the smallest of them), doc_id.

    Counts are summed in each task before they are shuffled. Values that several
    share are a small part of all; each is repeated per salt, so that documents
    with a very common one are dealt over ``SALTS`` tasks.
    """
    width = ROWS * REGISTER.itemsize
    values = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(k, F.substring("sketch", k * width + 1, F.lit(width))),
    )
    banded = firsts.select("doc_id", F.explode(values).alias("value"))
    shared = banded.groupBy("value").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last"))
    salted = _per_salt(shared.where("hub <> last").select("value", "hub"))
    return banded.withColumn("salt", _salt("doc_id")).join(salted, ["value", "salt"]).select("value", "hub", "doc_id")


def _likely_stars(members: DataFrame, firsts: DataFrame, limit: float) -> DataFrame:
    """(a hub, b document, bands they share) of all band values that are likely links."""
    pairs = (
        members.where("doc_id <> hub")
        .groupBy(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
        .agg(F.count(F.lit(1)).alias("bands"))
    )
    one = firsts.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("one"))
    two = firsts.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("two"))
    hubs = _per_salt(one.join(pairs.select("a").distinct(), "a", "left_semi"))
    both = pairs.withColumn("salt", _salt("b")).join(hubs, ["a", "salt"]).join(two, "b")
    tried = both.select("a", "b", "bands", "n", "m", "one", "two")
    return tried.mapInArrow(_likely_pairs(limit), "a long, b long, bands long").distinct()


def _parts(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("doc_id"), "component")


def _roots(nearest: DataFrame) -> DataFrame:
    """Documents and what they hang on: the hub they are linked with, or that hub's own.

    A document has one such hub, which is smaller. Chains are followed for two steps, which is enough to
    skip most tests; no result depends on it.
    """
    up = nearest.select(F.col("b").alias("doc_id"), F.col("a").alias("hub")).distinct()
    above = up.select(F.col("doc_id").alias("hub"), F.col("hub").alias("top"))
    return up.join(above, "hub", "left").select("doc_id", F.coalesce("top", "hub").alias("component"))


def _apart(stars: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs whose documents are not connected yet. Parts of hubs are repeated per salt."""
    of_b = stars.join(parts.select(F.col("doc_id").alias("b"), F.col("component").alias("of_b")), "b", "left")
    hubs = parts.join(stars.select(F.col("a").alias("doc_id")).distinct(), "doc_id", "left_semi")
    of_a = _per_salt(hubs.select(F.col("doc_id").alias("a"), F.col("component").alias("of_a")))
    both = of_b.withColumn("salt", _salt("b")).join(of_a, ["a", "salt"], "left")
    return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _star_tasks(stars: DataFrame, firsts: DataFrame) -> DataFrame:
    """Hubs and the documents that are likely linked with them, in tasks: the hub meets all, they don't meet."""
    hub = F.col("a").alias("group")
    rays = stars.select(hub, F.col("b").alias("doc_id"), F.lit(1).alias("side"))
    hubs = stars.select(hub, F.col("a").alias("doc_id"), F.lit(0).alias("side")).distinct()
    return _tasks(rays.unionByName(hubs).withColumn("component", F.col("doc_id")), firsts)


def _open_values(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Documents of values that, without the hub, which all were tried with, lie in several components."""
    placed = members.where("doc_id <> hub").select(F.col("value").alias("group"), "doc_id").distinct()
    labelled = placed.join(parts, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    return _sided(labelled)


def _open_groups(likely_: DataFrame, parts: DataFrame) -> DataFrame:
    """Documents that likely links connect beyond their components, by group."""
    groups = components(likely_).select(F.col("node").alias("doc_id"), F.col("component").alias("group"))
    labelled = groups.join(parts, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    return _sided(labelled)


def _sided(labelled: DataFrame) -> DataFrame:
    """Groups of several components, with side 1 for documents of the largest and 0 for the others."""
    counted = labelled.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n"))
    crowds = counted.groupBy("group").agg(
        F.max_by("component", F.struct(F.col("n"), -F.col("component"))).alias("crowd"), F.count(F.lit(1)).alias("parts")
    )
    salted = _per_salt(crowds.where("parts > 1").select("group", "crowd"))
    placed = labelled.withColumn("salt", _salt("doc_id")).join(salted, ["group", "salt"])
    return placed.select("group", "doc_id", "component", (F.col("component") == F.col("crowd")).cast("int").alias("side"))


def _tasks(members: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows (group, one, two, block, doc_id, component) of the tasks that let side 0 meet all of its group.

    Blocks of side 0 are numbered before those of side 1. A document of side 0 goes to a task for
    every block, one of side 1 to a task for every block of side 0.
    """
    sized = members.join(firsts.select("doc_id", "n_shingles"), "doc_id")
    own = F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles")
    sides = sized.groupBy("group", "side").agg(*own)
    needed = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES)).cast("int")
    blocks = sides.groupBy("group").agg(
        *[F.coalesce(F.max(F.when(F.col("side") == k, needed)), F.lit(0)).alias(f"blocks_{k}") for k in (0, 1)]
    )
    placed = sized.withColumn("salt", _salt("doc_id")).join(_per_salt(blocks), ["group", "salt"])
    few, many = F.col("blocks_0"), F.col("blocks_1")
    hashed = F.xxhash64("doc_id", F.lit("block"))
    block = F.when(F.col("side") == 0, F.pmod(hashed, few)).otherwise(few + F.pmod(hashed, F.greatest(many, F.lit(1))))
    met = F.when(F.col("side") == 0, few + many).otherwise(few)
    return (
        placed.withColumn("block", block.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), met - 1)))
        .select(
            "group",
            F.least("block", "other").alias("one"),
            F.greatest("block", "other").alias("two"),
            "block",
            "doc_id",
            "component",
        )
    )


def _run(rows: DataFrame, percent: int, limit: float) -> DataFrame:
    dealt = rows.repartition(*TASK).sortWithinPartitions(*TASK, "doc_id")
    return dealt.mapInArrow(_in_tasks(percent, limit), "a long, b long")


def _linked_in(members: DataFrame, firsts: DataFrame, percent: int, limit: float) -> DataFrame:
    """Likely links between documents of different components, by sketches alone."""
    tasks = _tasks(members, firsts).join(firsts, "doc_id")
    return _run(tasks.select(*TASK, "block", "doc_id", "component", "n_shingles", "sketch"), percent, limit)


def _sets(docs: DataFrame, ids: DataFrame, firsts: DataFrame, shingle_words: int) -> DataFrame:
    """Sets and sketches of some documents, made from their texts."""
    wanted = firsts.join(ids, "doc_id", "left_semi").withColumnRenamed("doc_id", "id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, F.col("doc_id") == F.col("id"))
    return texts.select("doc_id", "n_shingles", "digest", "sketch", "text").mapInArrow(
        _with_sets(shingle_words), "doc_id long, n_shingles long, sketch binary, set binary"
    )


def _confirmed(sets: DataFrame, tasks: DataFrame, percent: int) -> DataFrame:
    """Links confirmed on full sets, which go to the tasks of their documents."""
    of = tasks.groupBy("doc_id").agg(
        F.collect_list(F.struct("group", "one", "two", "block", "component")).alias("tasks")
    )
    rows = sets.join(of, "doc_id").select("doc_id", "n_shingles", "sketch", "set", F.explode("tasks").alias("task"))
    rows = rows.select("task.*", "doc_id", "n_shingles", "sketch", "set")
    return _run(rows, percent, percent / 100 - MARGIN)


def _numbered(docs: DataFrame) -> DataFrame:
    """A number per different doc_id and text, in the order of doc_id, null ones last, and of the texts' digests."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text_of(), 256).alias("digest")).distinct()
    ordered = named.orderBy(F.asc_nulls_last("doc_id"), "digest")
    return checkpointed(ordered.withColumn("number", F.monotonically_increasing_id()))


def representatives(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with all its columns, whatever they are called.

    A document is a doc_id and a text. Of each group the one with the smallest doc_id stays; null
    ones come after all others, equal ones go by the digests of their texts. Rows that repeat a document
    stay or go together. Texts of any length are compared whole; an empty table gives no rows.
    """
    numbers = _numbered(docs)
    if numbers.where("doc_id is null").isEmpty() and numbers.count() == numbers.select("doc_id").distinct().count():
        # Here doc_ids tell documents apart as well as the numbers would, and in the same order.
        known = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("number"))
    else:
        whole = docs.select(
            F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text_of(), 256).alias("digest")
        )
        on = whole["doc_id"].eqNullSafe(numbers["doc_id"]) & (whole["digest"] == numbers["digest"])
        known = checkpointed(whole.join(numbers, on).select("doc", "number"))
    texts = known.select(F.col("number").alias("doc_id"), F.col("doc.text").alias("text"))
    kept = near_duplicates(texts, shingle_words, percent).where("kept").select(F.col("doc_id").alias("kept")).distinct()
    return known.join(kept, F.col("number") == F.col("kept"), "left_semi").select("doc.*")
