"""Quality rules per document, and verdicts on hosts.

Every document is measured by itself. A host's share of documents that fail a rule is
shrunk towards a beta prior fitted to all hosts, so that a host with two documents is not
condemned for one. On a condemned host the softer rules count as well: a document goes
if it fails the base rules anywhere, or any rule on a condemned host. A document that
fails no rule always stays.

Defined cases: a NULL or empty text has no words and fails. A NULL host is no host: such
documents are judged alone. Repeated rows are judged, and counted for their host, one by
one. Without any host, or with hosts that are all alike, the prior is flat. Columns of
the input are never read by a name other than the two given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .native import bound, shingle_hashes, words_of
from .store import neutral, salted_join, saved

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
# Softer rules, which count on condemned hosts only.
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINE_SHARE = 0.3
MIN_MEAN_WORD, MAX_MEAN_WORD = 2.0, 15.0
MAX_HOST_RATE = 0.5

_M = "__q"
_WORDS, _LINES, _HASHES = "__q_words", "__q_lines", "__q_hashes"


def _covered(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from the hash of each window."""

    def places(ordered: Column) -> Column:
        near = lambda x, i: (x["h"] == F.get(ordered, i - 1)["h"]) | (
            x["h"] == F.get(ordered, i + 1)["h"]
        )
        found = F.transform(ordered, lambda x, i: F.when(near(x, i), x["i"]))
        return F.sort_array(F.array_compact(found))

    def total(starts: Column) -> Column:
        size = F.lit(REPEAT_WINDOW)
        own = lambda x, i: F.least(size, F.coalesce(F.get(starts, i + 1) - x, size))
        return F.aggregate(F.transform(starts, own), F.lit(0), lambda a, b: a + b)

    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeats, bound(bound(keyed, places), total)).otherwise(F.lit(0))


def measure(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Columns ``keep``, and a struct ``__q`` with counts and failed rules of each text."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in keep]
    split = df.select(
        *kept,
        words_of(value).alias(_WORDS),
        F.filter(F.split(value, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]")).alias(_LINES),
        F.length(F.regexp_replace(value, "[^#*$%&|<>]+", "")).cast("bigint").alias("__q_symbols"),
    )
    hashed = split.select("*", shingle_hashes(F.col(_WORDS), REPEAT_WINDOW).alias(_HASHES))
    n = F.size(_WORDS).cast("bigint")
    counts = hashed.select(
        *kept,
        n.alias("__q_n"),
        F.length(F.array_join(_WORDS, "")).cast("bigint").alias("__q_chars"),
        "__q_symbols",
        F.size(_LINES).cast("bigint").alias("__q_lines_n"),
        (F.size(_LINES) - F.size(F.array_distinct(_LINES))).cast("bigint").alias("__q_dup"),
        _covered(F.col(_HASHES)).cast("bigint").alias("__q_rep"),
    )
    n, chars, symbols = F.col("__q_n"), F.col("__q_chars"), F.col("__q_symbols")
    base = (n < MIN_WORDS) | (100 * F.col("__q_rep") > MAX_REPEAT_PERCENT * n)
    soft = (
        (symbols > MAX_SYMBOLS_PER_WORD * n)
        | (F.col("__q_dup") > MAX_DUP_LINE_SHARE * F.col("__q_lines_n"))
        | (chars < MIN_MEAN_WORD * n)
        | (chars > MAX_MEAN_WORD * n)
    )
    return counts.select(
        *kept,
        F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            symbols.alias("n_symbols"),
            F.col("__q_dup").alias("n_dup_lines"),
            F.col("__q_rep").alias("n_repeat_words"),
            base.alias("base_failed"),
            soft.alias("soft_failed"),
        ).alias(_M),
    )


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """Per host: documents, failures, and the rate shrunk by the prior of all hosts.

    The prior's two numbers are found by the method of moments; they are all that passes
    through the driver.
    """
    failed = F.col(f"{_M}.base_failed") | F.col(f"{_M}.soft_failed")
    hosts = saved(
        measured.where(F.col(f"`{host}`").isNotNull())
        .groupBy(F.col(f"`{host}`").alias("__q_host"))
        .agg(F.count("*").alias("n"), F.sum(failed.cast("bigint")).alias("k")),
        "hosts",
    )
    rate = F.col("k") / F.col("n")
    mean, var = hosts.agg(F.avg(rate), F.var_samp(rate)).first()
    alpha, beta = beta_prior(mean, var)
    shrunk = (F.col("k") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    return hosts.select("__q_host", "n", "k", shrunk.alias("rate"))


def beta_prior(mean: float | None, var: float | None) -> tuple[float, float]:
    """Beta parameters with this mean and variance; flat where the moments give none."""
    if mean is None or not 0 < mean < 1 or not var or var >= mean * (1 - mean):
        return 1.0, 1.0
    weight = min(mean * (1 - mean) / var - 1, 1e6)
    return mean * weight, (1 - mean) * weight


def judge(measured: DataFrame, host: str, spread: Column) -> DataFrame:
    """Add ``__q_host_bad`` and ``__q_kept``. Only documents that a host's verdict can
    change are joined with the hosts; ``measured`` must be cheap to read twice."""
    bad = host_rates(measured, host).where(F.col("rate") > MAX_HOST_RATE).select("__q_host")
    bad = bad.withColumn("__q_host_bad", F.lit(True))
    base, soft = F.col(f"{_M}.base_failed"), F.col(f"{_M}.soft_failed")
    asks = soft & ~base & F.col(f"`{host}`").isNotNull()
    settled = measured.where(~asks).withColumn("__q_kept", ~base)
    asked = salted_join(
        measured.where(asks).withColumn("__q_host", F.col(f"`{host}`")), bad, ["__q_host"], spread, "left"
    ).withColumn("__q_kept", F.col("__q_host_bad").isNull())
    columns = [*(F.col(f"`{c}`") for c in measured.columns), F.col("__q_kept")]
    return settled.select(*columns).unionAll(asked.select(*columns))


def quality_report(df: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """One row per document: its counts, whether it fails the base rules, and the verdict."""
    keep = [doc_id, host]
    measured = saved(measure(df, text, keep), "quality")
    judged = judge(measured, host, F.col(f"`{doc_id}`"))
    return judged.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        *[
            f"{_M}.{c}"
            for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        ],
        F.col("__q_kept").alias("kept"),
        f"{_M}.soft_failed",
    )


def keep_good(df: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    rows, names, back = neutral(df)
    measured = saved(measure(rows, names[text], rows.columns), "quality")
    return back(judge(measured, names[host], F.col(names[doc_id])).where("__q_kept"))
