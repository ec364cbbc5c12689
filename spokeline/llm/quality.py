"""Quality rules on documents, and verdicts on their hosts.

Each document is measured by itself. Failures of each rule are then summed by
host, a host's failure rate is shrunk towards the mean of all hosts with a beta
prior fitted to the hosts themselves, and a host whose shrunk rate of some rule
passes ``HOST_LIMIT`` takes all its documents with it: a host with few documents
needs more evidence than its own rate.

Only functions of Spark are used. Sums by host are made per salt first, so that
a host with a third of all documents is dealt over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokeline.llm.tables import SPACES, checkpointed, text_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
HOST_LIMIT = 0.5
SALTS = 64
# Bounds of the prior's weight, in documents, for hosts that differ too much or too little to fit it.
PRIOR_MIN, PRIOR_MAX = 1.0, 10_000.0


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """Base measures of each document, with its host; a null text has no words."""
    chars = F.char_length(F.translate(text_of(), SPACES, ""))
    symbols = F.octet_length(text_of()) - F.octet_length(F.translate(text_of(), SYMBOLS, ""))
    lines = F.filter(F.split(text_of(), "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select(
        "doc_id",
        F.col(host).alias("host"),
        chars.cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        lines.alias("lines"),
        words_of().alias("words"),
    )
    return _repeated(split).select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )


def _repeated(split: DataFrame) -> DataFrame:
    """Adds the number of words in windows found twice or more in their text.

    Window digests are sorted only where some are equal; neighbours in that order
    count as equal if their words are.
    """

    def window(start: Column) -> Column:
        return F.slice("words", start + 1, WINDOW)

    n_windows = F.size("words") - (WINDOW - 1)
    starts = F.sequence(F.lit(0), n_windows - 1)
    digests = F.when(n_windows > 1, F.transform(starts, lambda i: F.xxhash64(window(i))))
    ordered = F.when(
        F.size(F.array_distinct("digests")) < F.size("digests"),
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size("digests") - 1),
                lambda i: F.struct(F.get("digests", i).alias("digest"), i.alias("at")),
            )
        ),
    )

    def equal(one: Column, other: Column) -> Column:
        same = one["digest"] == other["digest"]
        return F.coalesce(F.when(same, window(one["at"]) == window(other["at"])), F.lit(False))

    found = F.filter(
        "ordered",
        lambda x, k: equal(x, F.get("ordered", k - 1)) | equal(x, F.get("ordered", k + 1)),
    )
    places = F.when(F.size("ordered") > 0, F.sort_array(F.transform(found, lambda x: x["at"])))
    covered = F.aggregate(
        F.sequence(F.lit(1), F.size("places") - 1),
        F.lit(WINDOW),
        lambda total, k: total + F.least(F.lit(WINDOW), F.get("places", k) - F.get("places", k - 1)),
    )
    return (
        split.withColumn("digests", digests)
        .withColumn("ordered", ordered)
        .withColumn("places", places)
        .withColumn(
            "n_repeat_words",
            F.when(F.size("places") > 1, covered).otherwise(F.lit(0)).cast("long"),
        )
    )


def rules() -> dict[str, Column]:
    """What a document fails by itself."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"),
    }


def host_verdicts(measured: DataFrame) -> DataFrame:
    """host, salt, host_docs, host_rejected and a shrunk failure rate per rule.

    A row per host and salt in use, to be joined to documents on both. With n
    documents and f failures a rate is (f + a) / (n + a + b). The prior's mean
    a / (a + b) is the rate over all documents; a + b comes from the spread of
    the hosts' rates beyond what chance gives, by moments.
    """
    names = list(rules())
    salted = measured.groupBy("host", "salt").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("long")).alias(f"f_{r}") for r, c in rules().items()]
    )
    of_host = Window.partitionBy("host")
    sums = salted.select(
        "host",
        "salt",
        F.sum("n").over(of_host).alias("host_docs"),
        *[F.sum(f"f_{r}").over(of_host).alias(f"f_{r}") for r in names],
        F.row_number().over(of_host.orderBy("salt")).alias("nth"),
    )
    prior = _priors(sums.where("nth = 1"), names)
    rates = {
        f"rate_{r}": (F.col(f"f_{r}") + mean * weight) / (F.col("host_docs") + weight)
        for r, (mean, weight) in prior.items()
    }
    bad = F.greatest(F.lit(0.0), *rates.values()) > HOST_LIMIT
    return sums.select(
        "host",
        "salt",
        "host_docs",
        *[rate.alias(name) for name, rate in rates.items()],
        bad.alias("host_rejected"),
    )


def _priors(hosts: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and weight of each rule's prior: a few sums over all hosts."""
    n = F.col("host_docs")
    row = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum(n).alias("docs"),
        *[F.sum(f"f_{r}").alias(f"f_{r}") for r in names],
        *[F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / n).alias(f"sq_{r}") for r in names],
    ).first()
    if not row["docs"]:
        return dict.fromkeys(names, (0.0, PRIOR_MAX))
    out = {}
    for r in names:
        mean = row[f"f_{r}"] / row["docs"]
        chance = mean * (1 - mean)
        # Weighted variance of the hosts' rates, less what drawing documents alone would give.
        spread = row[f"sq_{r}"] / row["docs"] - mean * mean - chance * row["hosts"] / row["docs"]
        weight = chance / spread - 1 if spread > 0 else PRIOR_MAX
        out[r] = (mean, min(PRIOR_MAX, max(PRIOR_MIN, weight)))
    return out


def quality(docs: DataFrame, host: str = "source") -> DataFrame:
    """Every document with its measures, the verdict on it and on its host.

    ``base_failed`` is the document's own failure, ``kept`` is false for it and
    for all documents of a rejected host.

    * Null and empty texts have no words and fail. Documents without a host are
      one host. Repeated rows count each.
    * An empty table gives no rows; other columns are ignored, whatever they are called.
    """
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    # The measures are the costly part and are needed for hosts and documents.
    measured = checkpointed(measures(docs, host).withColumn("salt", salt))
    verdicts = host_verdicts(measured).withColumnsRenamed({"host": "h", "salt": "s"})
    failed = None
    for rule in rules().values():
        failed = rule if failed is None else failed | rule
    on = F.col("host").eqNullSafe(F.col("h")) & (F.col("salt") == F.col("s"))
    return (
        measured.join(verdicts, on)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .drop("h", "s", "salt")
    )


def passing(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns, whatever they are called.

    A row is judged by its own text and host: rows that share a doc_id, or have none, are told
    apart by their texts, and repeated rows stay or go together. Null and empty texts go, a null
    host is a host. Texts of any length are measured whole. An empty table gives no rows.
    """
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    name = F.concat_ws(":", F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("-")), F.sha2(text, 256))
    of = F.col(f"doc.`{host}`")
    rows = docs.select(F.struct("*").alias("doc")).select("doc", name.alias("doc_id"), text.alias("text"), of.alias("host"))
    kept = quality(rows, "host").where("kept").select(F.col("doc_id").alias("name"), F.col("host").alias("of")).distinct()
    on = (rows["doc_id"] == kept["name"]) & rows["host"].eqNullSafe(kept["of"])
    return rows.join(kept, on, "left_semi").select("doc.*")
