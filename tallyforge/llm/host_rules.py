"""Quality rules per document and per host, in DataFrame functions only.

Every text gets a few counts and a base verdict. Failures are then summed per host, the failure
rate of each host is shrunk towards the rate of all hosts by a beta prior that is fitted to the
hosts themselves, and the host's verdict is joined back: documents of a host that mostly publishes
text failing the rules are rejected even if they pass on their own.

Defined results: a null text counts as no words and fails; a null host is no host, so its documents
have only their own verdict and take no part in the prior; repeated rows are judged like any other
row and each gives one result row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.tables import let, small, written

#: Characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"
BLANK_RUN = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
#: Up to so many repeated runs, their places are found by lookup, else by sorting all runs.
FEW_REPEATS = 16
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A host is rejected if its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
#: A host table of more rows is joined by a shuffle.
MAX_BROADCAST_HOSTS = 100_000


def words(text: Column) -> Column:
    """The runs of other characters than blanks, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), "")


def repeated_words(w: Column, window: int = 3) -> Column:
    """How many words lie in a run of ``window`` words that occurs at least twice.

    ``w`` is bound to an array of words. Runs are compared by a 64-bit hash of their words.
    """
    nothing = F.lit(0).cast("long")

    def by_lookup(hashes: Column, twice: Column) -> Column:
        return F.filter(
            F.transform(hashes, lambda h, i: F.when(F.array_contains(twice, h), i)),
            lambda i: i.isNotNull(),
        )

    def by_sorting(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda ps: F.sort_array(
                F.transform(
                    F.filter(
                        ps,
                        lambda p, k: F.get(ps, k - 1)["h"].eqNullSafe(p["h"])
                        | F.get(ps, k + 1)["h"].eqNullSafe(p["h"]),
                    ),
                    lambda p: p["i"],
                )
            ),
        )

    def covered(starts: Column) -> Column:
        gaps = F.transform(
            starts,
            lambda p, k: F.least(
                F.lit(window), F.coalesce(F.get(starts, k + 1) - p, F.lit(window))
            ),
        )
        return F.aggregate(gaps, nothing, lambda total, n: total + n)

    def of_hashes(hashes: Column) -> Column:
        twice = let(
            F.sort_array(hashes),
            lambda s: F.array_distinct(F.filter(s, lambda h, k: F.get(s, k - 1).eqNullSafe(h))),
        )
        return let(
            twice,
            lambda t: F.when(F.size(t) == 0, nothing)
            .when(F.size(t) <= FEW_REPEATS, let(by_lookup(hashes, t), covered))
            .otherwise(let(by_sorting(hashes), covered)),
        )

    runs = F.transform(
        F.sequence(F.lit(0), F.size(w) - window),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]),
    )
    return F.when(F.size(w) < window, nothing).otherwise(let(runs, of_hashes))


def base_counts(text: Column) -> Column:
    """The counts of the base rules as one struct."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda x: x.rlike(NOT_BLANK))
    return let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(plain, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("long")
            .alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def host_rates(judged: DataFrame, host: str, failed: str = "base_failed") -> DataFrame:
    """One row per host: documents, failures, and the failure rate shrunk by an empirical prior.

    The prior is the beta distribution whose mean and variance are those of the hosts' rates, each
    host weighing as much as any other. Hosts that do not differ give no variance; then all rates
    are the mean.
    """
    hosts = (
        judged.where(F.col(host).isNotNull())
        .groupBy(host)
        .agg(F.count("*").alias("host_docs"), F.sum(F.col(failed).cast("long")).alias("host_failed"))
    )
    rate = F.col("host_failed") / F.col("host_docs")
    prior = hosts.agg(
        F.avg(rate).alias("mean"),
        F.var_pop(rate).alias("spread"),
        # Rates of finite hosts vary by chance as well; that part is not the prior's.
        F.avg(rate * (1 - rate) / F.col("host_docs")).alias("chance"),
    )
    mean, between = F.col("prior.mean"), F.col("prior.spread") - F.col("prior.chance")
    weight = F.when(between > 0, F.greatest(mean * (1 - mean) / between - 1, F.lit(0.0)))
    shrunk = F.when(
        weight.isNotNull(),
        (F.col("host_failed") + weight * mean) / (F.col("host_docs") + weight),
    ).otherwise(mean)
    # The prior is one row, read as a scalar subquery.
    return hosts.withColumn(
        "prior", prior.select(F.struct("mean", "spread", "chance")).scalar()
    ).select(host, "host_docs", "host_failed", shrunk.alias("host_rate"))


def judge(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    keep: tuple[str, ...] = ("doc_id",),
    max_host_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """Counts, base verdict, host rate and final verdict of every document.

    ``keep`` names the columns of ``docs`` to carry along; one that shares its name with a result
    column gives way to it.
    """
    results = {*COUNTS, "base_failed", "host_docs", "host_failed", "host_rate", "kept"}
    keep = tuple(c for c in keep if c not in results)
    source = docs.select(
        F.struct(*keep).alias("kept_columns"), F.col(host).alias("host"), F.col(text).alias("body")
    )
    judged = written(
        source.select("kept_columns", "host", base_counts(F.col("body")).alias("counts"))
        .select("kept_columns", "host", "counts.*")
        .withColumn("base_failed", base_failed()),
        "judged",
    )
    hosts = small(written(host_rates(judged, "host"), "hosts"), MAX_BROADCAST_HOSTS)
    bad = F.coalesce(F.col("host_rate") > max_host_rate, F.lit(False))
    return judged.join(hosts, "host", "left").select(
        "kept_columns.*",
        *COUNTS,
        "base_failed",
        "host_docs",
        "host_failed",
        "host_rate",
        (~F.col("base_failed") & ~bad).alias("kept"),
    )
