"""Secrets in texts: three fixed patterns, and strings of high entropy found by sliding windows.

**Patterns** (``BASE``): assignments to names like password or token, access keys, long hexadecimal numbers. Matches of a kind
are leftmost and don't overlap; those that are too short are dropped after they were matched. A span covers the whole match.

**Entropy.** Candidates are runs of at least ``least`` characters that tokens are written in. In each candidate, and for each
character class, a window of the class's width slides over the runs of that class. Counts of its characters are kept up as one
enters and one leaves, and with them the sum of n log2 n that the Shannon entropy follows from; the sum is an integer (of
n log2 n in 2**-20 bits, rounded), so it is exact whatever the way there. Windows with letters, digits and at least the class's
entropy are joined to spans where they overlap or touch. A candidate that matches the allow-list (UUIDs, named digests,
placeholders, alphabets) gives none, and a span inside one of the patterns' is left out. The patterns' spans always stay.

Built-in functions only; a text is one row throughout, nothing is shuffled. Each pattern searches a text once, and again only
where it matched; what several expressions use is worked out once (``bound``). Long runs are cut to overlapping pieces of ``PIECE``
windows, so that a window's state stays small. Positions are code points, ends exclusive.

A null text is empty; empty texts have no spans. Repeated rows and ids are rows of their own. Other columns pass through, but
for one named ``spans``, which is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suretygraph.llm.arrow import put, row_of

# Fixed values of the patterns; letters of the names are written in both cases.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
_NAMES = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name) for name in NAMES)
ASSIGN = rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_ASSIGNED = 8
#: As ``AKIA[A-Z0-9]+`` of 16 characters and ``[0-9a-f]+`` of 32: these runs can't hold another match that begins later.
ACCESS, HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
BASE = ("assign", "access", "hex")
#: What the first letters of the names can be, to be looked at before the names are tried one after the other.
_FIRST = "".join("[" + "".join(sorted({c for name in NAMES for c in (name[k].upper(), name[k])})) + "]" for k in range(3))


def spelled(pattern: str) -> str:
    """The same pattern with the ranges of its classes written out: Java looks single characters up in one table, ranges it tries
    one after the other."""
    return re.sub(r"(\w)-(\w)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), pattern)


@dataclass(frozen=True)
class CharacterClass:
    """Characters (digits first), the window's width (63 at most) and the least entropy of a window in bits."""

    name: str
    characters: str
    width: int
    bits: float

    @property
    def pattern(self) -> str:
        return "[" + "".join("\\-" if c == "-" else c for c in self.characters) + "]"


_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharacterClass("hex_entropy", _DIGITS + "ABCDEFabcdef", 24, 3.0),
    CharacterClass("alnum_entropy", _DIGITS + _UPPER + _LOWER, 20, 3.6),
    CharacterClass("base64_entropy", _DIGITS + _UPPER + _LOWER + "+/_=-", 32, 4.25),
)
CANDIDATE, LEAST_CANDIDATE = "[A-Za-z0-9+/_=-]", 20
# What is no secret. UUIDs, digests named as such, placeholders, alphabets typed in order.
ALLOWED = (
    "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    "^[Ss][Hh][Aa](1|256|384|512)[-=]",
    "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Cc][Hh][Aa][Nn][Gg][Ee][Mm][Ee]",
    "abcdefgh|ABCDEFGH|01234567|qwertyui",
)

PIECE = 2048
SCALE = 1 << 20
_BITS, _PER_LONG = 6, 10
_CHUNK = 256


def n_log_n(most: int) -> list[int]:
    """n log2 n in 2**-20 bits for n from 0."""
    return [round(n * log2(n) * SCALE) if n else 0 for n in range(most + 1)]


def largest_sum(c: CharacterClass) -> int:
    """The largest sum of n log2 n over a window's characters that still has the class's entropy."""
    return floor(n_log_n(c.width)[-1] - c.bits * c.width * SCALE)


SPANS = "array<struct<start:int,end:int,s:string>>"
RANGES = "array<struct<start:int,end:int>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value worked out once however often it is used: functions over arrays are not among the expressions
    whose common parts Spark shares."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The states of a fold after each value. Appending to an array copies it, so the fold goes chunk by chunk."""
    return bound(values, lambda known: _running(known, zero, step))


def _running(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:

    def states(chunk: Column, begin: Column) -> Column:
        every = F.aggregate(chunk, F.array(begin), lambda seen, x: F.array_append(seen, step(F.element_at(seen, -1), x)))
        return F.slice(every, F.lit(2), F.size(chunk))

    def from_begins(chunks: Column) -> Column:
        totals = states(F.transform(chunks, lambda chunk: F.aggregate(chunk, zero, step)), zero)
        begins = bound(totals, lambda t: F.concat(F.array(zero), F.slice(t, F.lit(1), F.size(t) - 1)))
        return F.flatten(F.zip_with(chunks, begins, states))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int")), lambda k: F.slice(values, k * _CHUNK + 1, _CHUNK))
    return F.when(F.size(values) > 0, bound(chunks, from_begins)).otherwise(F.array().cast("array<int>"))


def located(text: Column, pattern: str) -> Column:
    """All matches (``start``, ``end``, ``s``) of a pattern that never matches the empty text. Most texts have none and are
    searched once, the others twice."""

    def spans(matches: Column) -> Column:
        sizes = F.zip_with(matches, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)), lambda m, b: F.length(m) + F.length(b))
        ends = running(sizes, F.lit(0), lambda total, n: total + n)
        found = F.zip_with(ends, matches, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("s")))
        return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(SPANS))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def base_spans(text: Column) -> list[Column]:
    """The spans of each of ``BASE``."""
    assigned = F.filter(located(text, f"(?={_FIRST}){ASSIGN}"), lambda m: F.length(F.regexp_extract(m["s"], ASSIGN, 1)) >= LEAST_ASSIGNED)
    return [assigned, located(text, ACCESS), located(text, spelled(HEX))]


def _advance(s: Column, start: Column, end: Column) -> list[Column]:
    """The open range joined with one that begins no earlier; the range before a gap goes to the found ones."""
    gap = (s["start"] >= 0) & (start > s["end"])
    found = F.when(gap, F.array_append(s["found"], F.struct(s["start"].alias("start"), s["end"].alias("end")))).otherwise(s["found"])
    return [F.when(gap | (s["start"] < 0), start).otherwise(s["start"]).alias("start"), F.greatest(s["end"], end).alias("end"), found.alias("found")]


def _closed(s: Column) -> Column:
    return F.when(s["start"] >= 0, F.array_append(s["found"], F.struct(s["start"].alias("start"), s["end"].alias("end")))).otherwise(s["found"])


def _nothing() -> list[Column]:
    return [F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast(RANGES).alias("found")]


def joined(ranges: Column) -> Column:
    """Ranges ordered by start, those that overlap or touch made one."""
    return F.aggregate(ranges, F.struct(*_nothing()), lambda s, x: F.struct(*_advance(s, x["start"], x["end"])), _closed)


def windows(piece: Column, c: CharacterClass) -> Column:
    """Ranges of a run of the class's characters that windows of enough entropy cover, joined.

    The state holds the window's counts, ten to a long, their sum of n log2 n, and how many digits there are. Each step first
    settles the window that ended before it, then lets one character in and the one a width behind it out.
    """
    table = F.array(*[F.lit(n) for n in n_log_n(c.width)])
    weight = lambda n: F.element_at(table, n + 1)
    behind = lambda codes: F.slice(F.concat(F.array_repeat(F.lit(0), c.width), codes), F.lit(1), F.size(codes))
    pairs = bound(F.transform(F.split(piece, ""), lambda x: F.instr(F.lit(c.characters), x)), lambda codes: F.zip_with(
        codes, behind(codes), lambda i, o: F.struct(i.alias("i"), o.alias("o"))))
    limit = largest_sum(c)

    def times(counts: Column, code: Column) -> Column:
        held = F.element_at(counts, (code / _PER_LONG).cast("int") + 1)
        return F.call_function("shiftright", held, code % _PER_LONG * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")

    def one(code: Column, k: Column) -> Column:
        unit = F.call_function("shiftleft", F.lit(1).cast("long"), code % _PER_LONG * _BITS)
        return F.when((code / _PER_LONG).cast("int") == k, unit).otherwise(F.lit(0).cast("long"))

    def settled(s: Column) -> Column:
        good = (s["n"] >= c.width) & (s["total"] <= limit) & (s["digits"] > 0) & (s["digits"] < c.width)
        return F.when(good, F.struct(*_advance(s["spans"], s["n"] - c.width, s["n"]))).otherwise(s["spans"])

    def step(s: Column, x: Column) -> Column:
        leaves = x["o"] > 0
        n_out = times(s["counts"], x["o"])
        n_in = times(s["counts"], x["i"]) - (x["i"] == x["o"]).cast("int")
        total = s["total"] + weight(n_in + 1) - weight(n_in) + F.when(leaves, weight(n_out - 1) - weight(n_out)).otherwise(0)
        counts = F.transform(s["counts"], lambda v, k: v + one(x["i"], k) - F.when(leaves, one(x["o"], k)).otherwise(0))
        digits = s["digits"] + (x["i"] <= 10).cast("int") - (leaves & (x["o"] <= 10)).cast("int")
        return F.struct((s["n"] + 1).alias("n"), counts.alias("counts"), total.alias("total"), digits.alias("digits"), settled(s).alias("spans"))

    start = F.struct(F.lit(0).alias("n"), F.array_repeat(F.lit(0).cast("long"), len(c.characters) // _PER_LONG + 1).alias("counts"),
                     F.lit(0).alias("total"), F.lit(0).alias("digits"), F.struct(*_nothing()).alias("spans"))
    return F.aggregate(pairs, start, step, lambda s: _closed(settled(s)))


def candidates_of(text: Column, allowed: Sequence[str] = ALLOWED) -> Column:
    """The candidates that aren't allowed, as matches."""
    candidates = located(text, f"{spelled(CANDIDATE)}{{{LEAST_CANDIDATE},}}")
    if allowed:
        candidates = F.filter(candidates, lambda m: ~m["s"].rlike("|".join(f"(?:{a})" for a in allowed)))
    return candidates


def entropy_spans(candidates: Column, classes: Sequence[CharacterClass] = CLASSES) -> list[Column]:
    """For each class the ranges of high entropy in the candidates. Each class asks for them, so they should be a column."""

    def shifted(ranges: Column, by: Column) -> Column:
        return F.transform(ranges, lambda r: F.struct((r["start"] + by).alias("start"), (r["end"] + by).alias("end")))

    def of_run(run: Column, c: CharacterClass) -> Column:
        last = F.floor((F.length(run["s"]) - c.width) / PIECE).cast("int")
        return joined(F.flatten(F.transform(F.sequence(F.lit(0), last), lambda k: shifted(
            windows(F.substring(run["s"], k * PIECE + 1, F.lit(PIECE + c.width - 1)), c), run["start"] + k * PIECE))))

    def of_class(c: CharacterClass) -> Column:
        runs = lambda m: located(m["s"], f"{c.pattern}{{{c.width},}}")
        return F.flatten(F.transform(candidates, lambda m: shifted(
            F.flatten(F.transform(runs(m), lambda run: of_run(run, c))), m["start"])))

    return [of_class(c) for c in classes]


def find_secrets(
    docs: DataFrame, text_col: str = "text", classes: Sequence[CharacterClass] = CLASSES, allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """Adds ``spans``, an array of (``kind``, ``start``, ``end``) ordered by start, then by kind as in ``BASE`` and ``classes``."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    kinds = [*BASE, *(c.name for c in classes)]
    own = docs.select(row_of(docs).alias("_own"), F.col(f"`{text_col}`").alias("_text"))
    found = own.select("_own", *[s.alias(f"_k{k}") for k, s in enumerate(base_spans(text))], candidates_of(text, allowed).alias("_candidates"))
    found = found.withColumns({f"_k{k}": s for k, s in enumerate(entropy_spans(F.col("_candidates"), classes), len(BASE))})

    def of_kind(k: int) -> Column:
        return F.transform(f"_k{k}", lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end")))

    every = F.array_sort(F.concat(*[of_kind(k) for k in range(len(kinds))]))
    ordered = found.select("_own", every.alias("_all"))
    # How far the patterns' spans that begin no later reach.
    reach = running(F.transform("_all", lambda m: F.when(m["kind"] < len(BASE), m["end"]).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
    marked = ordered.select("_own", F.zip_with("_all", reach, lambda m, r: F.struct(m.alias("m"), r.alias("r"))).alias("_all"))
    kept = F.filter("_all", lambda x: (x["m"]["kind"] < len(BASE)) | (x["r"] < x["m"]["end"]))
    names = F.array(*[F.lit(k) for k in kinds])
    spans = F.transform(kept, lambda x: F.struct(
        F.element_at(names, x["m"]["kind"] + 1).alias("kind"), x["m"]["start"].alias("start"), x["m"]["end"].alias("end")))
    return put(marked.select("_own", spans.alias("spans")), "_own", "spans")


def written(spans: Column, kinds: Sequence[str] | None = None) -> Column:
    """Spans as ``kind:start:end``, joined by commas; those of some kinds only where these are named."""
    if kinds is not None:
        spans = F.filter(spans, lambda m: m["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Numbers of the patterns' spans, the digest of their list, and the list of all spans."""
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(id_col, *[count(k) for k in BASE], F.sha2(written(spans, BASE), 256).alias("base_sha256"), written(spans).alias("spans"))
