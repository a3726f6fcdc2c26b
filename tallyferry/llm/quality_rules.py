"""Quality rules judged by host: document rules, pooled per host with an empirical beta prior.

Each document gets text measures and four rules. Rule failures are summed by host (map-side
partial sums, so a host that holds a third of all rows costs no more than the others), each
host's failure rate is shrunk towards the mean of all hosts with a beta prior fitted by the method
of moments, and a host whose shrunk rate passes ``host_limit`` loses its documents. Everything is
DataFrame functions; repeated windows are found inside the row, without a shuffle of words.

Defined results: a null or blank text has no words and fails ``short``; a null host is the host
``''``; repeated rows are judged one by one; an empty table gives an empty result; texts of any
length are measured whole inside their row; hosts at the limit itself keep their documents; columns of the
input other than the id, text and host are ignored by :func:`document_rules` and kept by
:func:`keep_good`, whose helper columns start with ``__qr_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.shared import BLANK, bind, broadcast_if_small, durable, few, split_words, text_or_empty

RULES = ("short", "repeats", "symbols", "dup_lines")


def host_of(column: Column) -> Column:
    """Lower-case host of an address, or the lower-case name itself."""
    return F.regexp_replace(F.lower(F.coalesce(column.cast("string"), F.lit(""))), r"^[a-z]+://|[/?#:].*$", "")


def _covered(hashes: Column) -> Column:
    """How many words lie in windows of three whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(p: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    def length(q: Column) -> Column:
        first = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
        step = lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["to"])).alias("n"), (i + 3).alias("to"))
        return F.aggregate(q, first, step, lambda a: a["n"])

    return bind(bind(pairs, starts), length)


def measures(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words."""
    t, w, h, lines = (f"__qr_{x}" for x in ("t", "w", "h", "lines"))
    named = lambda x: prefix + x
    own = docs.columns
    out = docs.withColumn(t, text_or_empty(text))
    out = out.withColumns({w: split_words(F.col(t)), lines: F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(f"[^{BLANK}]"))})
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    out = out.withColumn(h, F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(windows))
    repeats = F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(F.col(h)))
    return out.select(
        *[F.col(f"`{c}`") for c in own],
        F.size(w).cast("long").alias(named("n_words")),
        F.length(F.array_join(w, "")).cast("long").alias(named("word_chars")),
        (F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]", ""))).cast("long").alias(named("n_symbols")),
        F.size(lines).cast("long").alias(named("n_lines")),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(named("n_dup_lines")),
        repeats.cast("long").alias(named("n_repeat_words")),
    )


def rule_flags(prefix: str = "", symbol_share: float = 0.1, dup_line_share: float = 0.3, min_words: int = 50) -> dict[str, Column]:
    c = lambda x: F.col(prefix + x)
    return {
        "short": c("n_words") < min_words,
        "repeats": 100 * c("n_repeat_words") > 50 * c("n_words"),
        "symbols": c("n_symbols") > symbol_share * c("word_chars"),
        "dup_lines": c("n_dup_lines") > dup_line_share * c("n_lines"),
    }


def bad_hosts(rated: DataFrame, host: str, flags: dict[str, Column], host_limit: float = 0.5) -> DataFrame:
    """Hosts (one column, ``host``) whose shrunk failure rate of some rule is over ``host_limit``.

    The prior of a rule is Beta(m*k, (1-m)*k): m is the mean and v the variance of the hosts'
    rates, k = m*(1-m)/v - 1 within 1 and 1e6 (1e6 if all hosts have one rate).
    """
    per_host = rated.groupBy(host).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(F.when(f, 1).otherwise(0)).alias(f"__f_{r}") for r, f in flags.items()])
    prior = per_host.agg(*[x for r in flags for x in (F.avg(F.col(f"__f_{r}") / F.col("__n")).alias(f"__m_{r}"), F.var_pop(F.col(f"__f_{r}") / F.col("__n")).alias(f"__v_{r}"))])
    over = F.lit(False)
    for r in flags:
        m, v, f, n = F.col(f"__m_{r}"), F.col(f"__v_{r}"), F.col(f"__f_{r}"), F.col("__n")
        k = F.when(v > 0, F.least(F.greatest(m * (1 - m) / v - 1, F.lit(1.0)), F.lit(1e6))).otherwise(F.lit(1e6))
        over = over | ((f + m * k) / (n + k) > host_limit)
    # the prior is one row
    return broadcast_if_small(per_host.join(F.broadcast(prior), F.lit(True)).where(over).select(host))


def document_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", host_limit: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: the id, the measures, base_failed, host_rejected, kept."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__qr_text"), host_of(F.col(host)).alias("__qr_host"))
    rated = durable(measures(slim, "__qr_text").drop("__qr_text"))
    flags = rule_flags()
    bad = bad_hosts(rated, "__qr_host", flags, host_limit)
    base = flags["short"] | flags["repeats"]
    out = rated.join(bad.withColumnRenamed("__qr_host", "__qr_bad"), F.col("__qr_host") == F.col("__qr_bad"), "left")
    rejected = F.col("__qr_bad").isNotNull()
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), rejected.alias("host_rejected"), (~base & ~rejected).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", host_limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that pass the rules and whose host passes.

    The measures are taken once, in a slim table of text hashes, hosts and measures. Texts that fail
    are left out by their hashes if these are few enough to broadcast, else by measuring again: a text
    is never shuffled.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    t = text_or_empty(text)
    rated = durable(measures(docs.select(t.alias("__qr_text"), F.xxhash64(t).alias("__qr_key"), host_of(F.col(host)).alias("__qr_host")), "__qr_text", "__qr_").drop("__qr_text"))
    flags = rule_flags("__qr_")
    fails = flags["short"] | flags["repeats"]
    bad = bad_hosts(rated, "__qr_host", flags, host_limit).withColumnRenamed("__qr_host", "__qr_bad")
    failed = rated.where(fails).select(F.col("__qr_key").alias("__qr_failed")).distinct()
    hosted = docs.select(*own, host_of(F.col(host)).alias("__qr_host"))
    if few(failed):
        good = hosted.withColumn("__qr_key", F.xxhash64(t)).join(F.broadcast(failed), F.col("__qr_key") == F.col("__qr_failed"), "left_anti")
    else:
        # the row number keeps the optimizer from moving the filter below the measures, which would
        # compute them once per mention
        again = measures(hosted, text, "__qr_").withColumn("__qr_row", F.monotonically_increasing_id())
        good = again.where((F.col("__qr_row") >= 0) & ~fails)
    return good.join(bad, F.col("__qr_host") == F.col("__qr_bad"), "left_anti").select(*own)
