"""Quality rules with host-level verdicts.

Rule failures are counted per document, summed by host, and each host's
failure rate is shrunk towards the mean of all hosts by an empirical beta
prior (method of moments over the hosts).  The verdicts on the hosts are then
joined back to their documents: a document of a host that is strict for a
rule is rejected when it fails that rule; elsewhere it takes two failures.  A
document that fails no rule is kept whatever its host.  Only DataFrame
functions are used.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored, without

SPACE = "[\\x20\\x09-\\x0D]+"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: rule name -> failure, from the measures of a document; a gross failure
#: breaks two rules
RULES = {
    "symbols": "10 * n_symbols > n_words",
    "mostly_symbols": "n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "mostly_dup_lines": "100 * n_dup_lines > 60 * n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
    "repetition": "100 * n_repeat_words > 30 * n_words",
}
#: a host is strict for a rule from this shrunk failure rate on
HOST_LIMIT = 0.2
ADDED = [*MEASURES, "n_lines", "base_failed", "n_failed", "host_rejects", "kept"]


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more.  Windows are told
    apart by their 64-bit hashes; sorting brings equal ones together."""
    n = F.size(words)
    windows = F.sort_array(F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
                           i.alias("i"))))

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda x, k: F.coalesce(F.least(F.lit(3), x - F.get(starts, k - 1)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def repeated(sorted_: Column) -> Column:
        twice = F.filter(sorted_, lambda x, k: F.coalesce(F.get(sorted_, k - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(sorted_, k + 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    return F.when(n >= 3, let(windows, repeated)).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of every whole text; a null text measures as ''."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counts = let(F.filter(F.split(t, SPACE), lambda w: w != ""),
                 lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")))
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                                F.size(F.array_distinct(x)).cast("long").alias("d")))
    docs = without(docs, ADDED)
    docs = docs.select("*", counts.alias("__t_w"), line_counts.alias("__t_l"),
                       F.char_length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
                       (F.char_length(t) - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"))
    return (docs.withColumn("n_words", F.col("__t_w.n")).withColumn("n_repeat_words", F.col("__t_w.r"))
            .withColumn("n_lines", F.col("__t_l.n")).withColumn("n_dup_lines", F.col("__t_l.n") - F.col("__t_l.d"))
            .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
            .drop("__t_w", "__t_l"))


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """One row per host: rows, failures and shrunk failure rate of each rule.

    With m and v the mean and variance of the hosts' raw rates, the prior is
    beta(m*s, (1-m)*s), s = m(1-m)/v - 1; where v is 0 or s not positive the
    prior weighs as much as one average host."""
    fails = [F.sum(F.expr(rule).cast("long")).alias(f"f_{r}") for r, rule in RULES.items()]
    hosts = measured.groupBy(F.col(host).alias("__t_host")).agg(F.count(F.lit(1)).alias("n"), *fails)
    moments = hosts.select(F.struct(
        F.avg("n").alias("n"),
        *[F.avg(F.col(f"f_{r}") / F.col("n")).alias(f"m_{r}") for r in RULES],
        *[F.var_pop(F.col(f"f_{r}") / F.col("n")).alias(f"v_{r}") for r in RULES])).scalar()
    hosts = hosts.withColumn("_all", moments)
    for r in RULES:
        m, v = F.col(f"_all.m_{r}"), F.col(f"_all.v_{r}")
        strength = F.when(v > 0, m * (1 - m) / v - 1)
        strength = F.when(strength > 0, strength).otherwise(F.col("_all.n"))
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"f_{r}") + m * strength) / (F.col("n") + strength))
    return hosts.drop("_all")


def judge(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``n_failed`` (rules),
    ``host_rejects`` and ``kept``.

    A null host is a host of its own; repeated rows are judged alike; an empty
    table gives no rows.  Input columns named like the added ones are
    replaced."""
    return verdicts(measure(docs, text), host)


def verdicts(measured: DataFrame, host: str = "source") -> DataFrame:
    """Measured rows with the verdicts.  They are written to the shared folder
    once, as both the host rates and the result are made from them; the host
    table is written too, so that Spark knows its size when it picks the join."""
    rows = stored(measured, "quality")
    hosts = stored(host_rates(rows, host).select(
        "__t_host", *[(F.col(f"rate_{r}") >= HOST_LIMIT).alias(f"__t_strict_{r}") for r in RULES]), "hosts")
    rows = rows.join(hosts, F.col(host).eqNullSafe(F.col("__t_host")), "left")
    failed = {r: F.expr(rule) for r, rule in RULES.items()}
    n_failed, rejects = F.lit(0), F.lit(False)
    for r, f in failed.items():
        n_failed = n_failed + f.cast("int")
        rejects = rejects | (f & F.col(f"__t_strict_{r}"))
    rows = rows.withColumn("n_failed", n_failed).withColumn("host_rejects", rejects)
    rows = rows.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejects") & (F.col("n_failed") < 2))
    return rows.drop("__t_host", *[f"__t_strict_{r}" for r in RULES])
