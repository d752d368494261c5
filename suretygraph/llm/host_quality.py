"""Quality rules for documents and, over them, for the hosts they come from.

Every document is measured against a few rules. Failures are counted for each host and rule, the rates are shrunk towards
those of all hosts by a beta prior that is fitted to the hosts themselves (by moments), and hosts whose shrunk rate is too
high in a rule are rejected with all their documents.

Built-in functions only. The measures are taken inside each row, so only counts for each host are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suretygraph.llm.arrow import put, row_of
from suretygraph.llm.staging import stored, with_small

GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more in the text.

    Windows are sorted by a 64-bit hash and place. A place whose neighbour in that order has the same hash is repeated;
    back in the order of the text, each of these covers the words up to three on, or up to the next one.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))

    def places(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        again = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    covered = lambda p: F.aggregate(
        p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return F.when(F.size(words) < 4, 0).otherwise(_let(F.sort_array(hashes), lambda s: covered(places(s)))).cast("long")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the measures of each text to its row, in place of input columns of the same name."""
    return put(_measured(docs.select(row_of(docs).alias("_own"), F.col(text_col).alias("text"))), "_own", *MEASURES)


def _measured(rows: DataFrame) -> DataFrame:
    """The measures in place of ``text``; other columns are the caller's."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = _let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"),
    ))
    duplicates = _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    own = [c for c in rows.columns if c != "text"]
    counted = rows.select(
        *own, found.alias("_found"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicates.alias("n_dup_lines"))
    return counted.select(*own, "n_symbols", "n_dup_lines", "_found.*")


def rule_failures(least_words: int = 50) -> dict[str, Column]:
    """The rules: what fails them."""
    n = F.col("n_words")
    return {
        "short": n < least_words,
        "repetitive": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "lines": F.col("n_dup_lines") * 10 > n,
        "lengths": (F.col("word_chars") > 12 * n) | (F.col("word_chars") < 2 * n),
    }


#: Rules that reject a document by themselves.
BASE = ("short", "repetitive")


def host_verdicts(measured: DataFrame, host_col: str, most: float = 0.6, least_words: int = 50) -> DataFrame:
    """A row for each host: ``host``, ``documents``, the shrunk rate of each rule, and ``rejected``.

    With mean m and variance v of a rule's rate over hosts, each weighted by its documents, the prior has the strength
    m(1 - m)/v - 1, at least 1 and at most 10,000. The rate of a host with f failures in n documents becomes
    (f + m * strength) / (n + strength). Documents without a host are not counted.
    """
    rules = rule_failures(least_words)
    hosts = stored(
        measured.filter(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("host"))
        .agg(F.count("*").alias("documents"), *[F.sum(F.coalesce(x, F.lit(False)).cast("long")).alias(f"f_{r}") for r, x in rules.items()]),
        "hosts",
    )
    n, rate = F.col("documents"), {r: F.col(f"f_{r}") / F.col("documents") for r in rules}
    mean = hosts.agg(*[(F.sum(f"f_{r}") / F.sum(n)).alias(r) for r in rules]).first()
    mean = {r: mean[r] or 0.0 for r in rules}  # null without hosts
    spread = hosts.agg(*[(F.sum(n * (rate[r] - mean[r]) * (rate[r] - mean[r])) / F.sum(n)).alias(r) for r in rules]).first()
    beside = hosts
    for r, m in mean.items():
        strength = min(max(m * (1 - m) / spread[r] - 1, 1.0), 1e4) if spread[r] else 1e4
        beside = beside.withColumn(r, (F.col(f"f_{r}") + m * strength) / (n + strength))
    rejected = reduce(lambda a, b: a | b, [F.col(r) > most for r in rules])
    return beside.select("host", "documents", *rules, rejected.alias("rejected"))


def judge(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", most: float = 0.6, least_words: int = 50,
    keep_text: bool = True,
) -> DataFrame:
    """Adds the measures, ``base_failed`` and ``kept`` to every row, in place of columns of these names.

    Every text is measured once: the rows are written with their measures, for the hosts and then for the verdicts. Without
    ``keep_text`` they are written, and returned, without their text.

    A document fails by itself if it is short or repetitive; else it is kept unless its host is rejected. Null and empty
    texts have no words and are short. Documents without a host have no host to be rejected with. Repeated rows count each.
    """
    rows = docs.select(
        row_of(docs, () if keep_text else (text_col,)).alias("_own"), F.col(host_col).alias("_of"), F.col(text_col).alias("text"))
    measured = stored(_measured(rows), "measured")
    verdicts = stored(host_verdicts(measured, "_of", most, least_words), "verdicts").filter("rejected").select(
        F.col("host").alias("_host"), F.lit(True).alias("_rejected"))
    rules = rule_failures(least_words)
    failed = reduce(lambda a, b: a | b, [rules[r] for r in BASE])
    judged = with_small(measured.withColumn("base_failed", failed), verdicts, F.col("_of") == F.col("_host"), "left")
    return put(judged.withColumn("kept", ~F.col("base_failed") & F.col("_rejected").isNull()), "_own", *MEASURES, "base_failed", "kept")
