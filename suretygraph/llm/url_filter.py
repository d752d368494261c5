"""URL filter by the ratio of two character language models.

Rules decide the URLs they fit. All accepted and all rejected ones give one smoothed Markov model of variable order each:
the probability of a character after up to ORDER others mixes in that of the next shorter context, the more the fewer and
the more varied the longer one was seen (Witten-Bell). A URL that no rule fits is judged by the difference of its two
log-likelihoods, divided by its length and turned into a probability by a logistic curve, which is fitted on a third of
the rule-judged URLs kept out of the models for that.

The counts are aggregated over all rule-judged URLs by Spark under the full 64-bit hashes of contexts and n-grams. Up to
2**SLOT_BITS n-grams they are broadcast; beyond, they stay tables, and the distinct n-grams of each block of URLs are
looked up by a join. Both ways give the same counts, whatever the size of the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suretygraph.llm.arrow import arrow_map, batch, longs, put
from suretygraph.llm.split import held_out
from suretygraph.llm.staging import session_of, small, stored
from suretygraph.llm.tokens import U, mix

ORDER = 5
SLOT_BITS = 20
#: URLs of a block, which is looked up and judged as one.
BLOCK = 512
BINS = 400
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next of / ? #, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def text_of(url: Column) -> Column:
    """The whole URL for the models, A-Z of scheme and host lower-cased as they mean the same; null: empty."""
    url = F.coalesce(url, F.lit(""))
    begin = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*", 0)
    return F.concat(F.translate(begin, _UPPER, _LOWER), F.substr(url, F.length(begin) + 1))


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host/path

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


def _choose(rules: Sequence[Rule], value) -> Column:
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        out = F.when(rule.fits(), F.lit(value(rule))).otherwise(out)
    return out


# -- models -----------------------------------------------------------------------------------------


def contexts(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order the context hash and the n-gram hash of each character, an end mark included; then each character's
    text and the lengths."""
    data = [x.as_py() or b"" for x in texts.cast(pa.binary())]
    pad = b"\0" * ORDER
    flat = np.frombuffer(b"".join(pad + x + b"\1" for x in data), np.uint8).astype(U)
    length = np.array([len(x) + 1 for x in data], np.int64)
    begin = np.concatenate([[0], np.cumsum(length + ORDER)])[:-1] + ORDER
    text = np.repeat(np.arange(len(data)), length)
    at = np.arange(length.sum()) - np.repeat(np.concatenate([[0], np.cumsum(length)])[:-1] - begin, length)
    context = np.full(len(at), 1, U)
    names, grams = [], []
    for k in range(ORDER + 1):
        if k:
            context = context * U(0x9E3779B97F4A7C15) + flat[at - k] + U(3)
        name = mix(context + U(k << 32))
        names.append(name)
        grams.append(mix(name * U(0xC2B2AE3D27D4EB4F) + flat[at]))
    return names, grams, text, length


def _place(keys: np.ndarray, names: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, names)
    return np.where(np.append(keys, U(0))[at] == names, at, len(keys)) if len(keys) else np.zeros(len(names), np.int64)


def _keyed(found: pa.Table) -> Models:
    """From rows (kind, key, n0, n1, kinds0, kinds1): kind 0 are n-grams, kind 1 contexts."""
    kind, key = found["kind"].to_numpy(), found["key"].to_numpy().astype(np.int64).view(U)
    parts = []
    for k in (0, 1):
        own = np.flatnonzero(kind == k)
        own = own[np.argsort(key[own])]
        columns = [found[c].to_numpy().astype(np.float64)[own] for c in ("n0", "n1", "kinds0", "kinds1")]
        n0, n1, kinds0, kinds1 = (np.append(c, 0.0) for c in columns)
        parts.append((key[own], np.stack([n0, n1]), np.stack([kinds0, kinds1])))
    (gram_keys, grams, _), (context_keys, totals, kinds) = parts
    return Models(gram_keys, context_keys, grams, totals, kinds)


def _count_rows(batches):
    for b in batches:
        accepted = b["accepted"].to_numpy(zero_copy_only=False).astype(bool)
        names, grams, text, _ = contexts(b["text"])
        if not len(text):
            continue
        for side in (False, True):
            own = accepted[text] == side
            name = np.concatenate([x[own] for x in names])
            gram, first, n = np.unique(np.concatenate([x[own] for x in grams]), return_index=True, return_counts=True)
            yield batch(accepted=pa.array(np.full(len(gram), side)), context=longs(name[first]), gram=longs(gram), n=longs(n))


@dataclass
class Models:
    """N-gram counts, context counts and numbers of different successors, for rejected and accepted URLs: of the sorted
    keys, with one place more for all others, which is 0."""

    gram_keys: np.ndarray
    context_keys: np.ndarray
    grams: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray

    def difference(self, texts: pa.Array) -> np.ndarray:
        """log P(accepted) - log P(rejected) of each text, divided by its length."""
        names, grams, text, length = contexts(texts)
        out = np.zeros(len(length))
        for side, sign in ((1, 1.0), (0, -1.0)):
            p = np.full(len(text), 1 / 257)
            for name, gram in zip(names, grams):
                at = _place(self.context_keys, name)
                total, kinds = self.totals[side][at], self.kinds[side][at]
                seen = total > 0
                p = np.where(seen, (self.grams[side][_place(self.gram_keys, gram)] + kinds * p) / np.where(seen, total + kinds, 1), p)
            out += sign * np.bincount(text, np.log(p), len(length))
        return out / length


def logistic(x: np.ndarray, yes: np.ndarray, no: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the curve through counted answers at x, slightly held to slope 0."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    n = yes + no
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (yes - n * p) - 1e-3 * w
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def counted(judged: DataFrame) -> DataFrame:
    """Rows (kind, key, n0, n1, kinds0, kinds1) from rows (accepted boolean, text), 0 for rejected and 1 for accepted."""
    rows = arrow_map(judged.select("accepted", "text"), _count_rows, "accepted boolean, context long, gram long, n long")
    side = lambda name, which: F.sum(F.when(F.col("accepted") == which, F.col(name)).otherwise(0))
    both = lambda *names: [side(x, w).alias(f"{x}{int(w)}") for x in names for w in (False, True)]
    grams = stored(rows.groupBy("accepted", "context", "gram").agg(F.sum("n").alias("n")), "grams")
    one = lambda key, kind: grams.select(
        F.lit(kind).alias("kind"), F.col(key).alias("key"), "accepted", "n", F.lit(1).alias("kinds"))
    return stored(one("gram", 0).union(one("context", 1)).groupBy("kind", "key").agg(*both("n", "kinds")), "counts")


def _wanted(batches):
    for b in batches:
        names, grams, text, _ = contexts(b["text"])
        block = b["block"].to_numpy()[text]
        for number in np.unique(block):
            own = block == number
            for kind, all_of in ((0, grams), (1, names)):
                key = np.unique(np.concatenate([x[own] for x in all_of]))
                yield batch(block=longs(np.full(len(key), number)), kind=pa.array(np.full(len(key), kind, np.int32)), key=longs(key))


def _judge_block(texts: pa.Table, found: pa.Table) -> pa.Table:
    difference = _keyed(found).difference(texts["text"].combine_chunks())
    return pa.table({"_row": texts["_row"], "calibrate": texts["calibrate"], "host": texts["host"], "path": texts["path"],
                     "rule": texts["rule"], "by_rule": texts["by_rule"], "difference": pa.array(difference)})


def _judge(models):
    def run(batches):
        for b in batches:
            kept = ["_row", "calibrate", "host", "path", "rule", "by_rule"]
            yield pa.RecordBatch.from_arrays(
                [*[b[x] for x in kept], pa.array(models.value.difference(b["text"]))], names=[*kept, "difference"])

    return run


def _with_difference(rows: DataFrame, counts: DataFrame, most_keys: int) -> DataFrame:
    """The rows without ``text`` and with ``difference``."""
    schema = T.StructType([
        *[rows.schema[x] for x in ("_row", "calibrate", "host", "path", "rule", "by_rule")], T.StructField("difference", T.DoubleType())])
    if small(counts, 2 * most_keys):  # a context has an n-gram at least
        return arrow_map(rows, _judge(session_of(rows).sparkContext.broadcast(_keyed(counts.toArrow()))), schema)
    rows = stored(rows.withColumn("block", F.floor(F.monotonically_increasing_id() / BLOCK)), "blocks")
    wanted = arrow_map(rows.select("block", "text"), _wanted, "block long, kind int, key long").distinct()
    found = wanted.join(counts, ["kind", "key"])
    return rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_judge_block, schema)


def curve(judged: DataFrame) -> tuple[float, float]:
    """Slope and shift from rows (accepted boolean, difference)."""
    bins = (
        judged.groupBy("accepted", F.floor(F.least(F.greatest(F.col("difference"), F.lit(-8.0)), F.lit(8.0)) * BINS / 16).alias("bin"))
        .count().toArrow()
    )
    x = bins["bin"].to_numpy().astype(float) * 16 / BINS + 8 / BINS
    yes = bins["accepted"].to_numpy(zero_copy_only=False).astype(bool)
    count = bins["count"].to_numpy().astype(float)
    if yes.any() and not yes.all():
        return logistic(x, np.where(yes, count, 0), np.where(yes, 0, count))
    return 1.0, 0.0


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
               most_keys: int = 1 << SLOT_BITS) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``accept`` (the models' probability) and ``verdict`` to every row.

    The rule with the longest text that fits decides; rules are for hosts and their subdomains and the beginning of the
    path. Without one a URL is allowed if the models, which read all of it, find it acceptable with 0.5 or more. A URL
    without :// has neither host nor path, so no rule fits. A null URL is the empty text. Every URL without a rule is allowed
    if the rules accept none or reject none. Input columns of these names are replaced.
    """
    url = F.col(url_col)
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"), F.col(id_col).alias("_id"),
        host_of(url).alias("host"), path_of(url).alias("path"), text_of(url).alias("text"),
    )
    rows = rows.select(
        "*", _choose(rules, lambda r: r.text).alias("rule"), _choose(rules, lambda r: r.verdict).alias("by_rule"))
    rows = rows.withColumn("calibrate", held_out("_id")).drop("_id")
    accepted = (F.col("by_rule") == "allow").alias("accepted")
    counts = counted(rows.filter("by_rule is not null and not calibrate").select(accepted, "text"))
    sides = counts.filter("kind = 1").agg(F.max("n0"), F.max("n1")).first()
    if not all(sides):
        out = rows.withColumn("accept", F.lit(1.0))
    else:
        scored = stored(_with_difference(rows, counts, most_keys), "scored")
        slope, shift = curve(scored.filter("by_rule is not null and calibrate").select(accepted, "difference"))
        z = F.least(F.greatest(F.lit(slope) * F.col("difference") + F.lit(shift), F.lit(-30.0)), F.lit(30.0))
        out = scored.withColumn("accept", 1 / (1 + F.exp(-z)))
    verdict = F.coalesce("by_rule", F.when(F.col("accept") >= 0.5, "allow").otherwise("block"))
    return put(out.withColumn("verdict", verdict), "_row", "host", "path", "rule", "accept", "verdict")
