"""Language of the words of a text by a linear-chain conditional random field.

Labels are the languages. A chain's positions are the words; a word of more than ``LONGEST`` bytes, as a line of a script without
spaces is, takes several, cut between characters, so that all of it is labelled and a switch inside is seen. A position's
features are its character n-grams (those that reach into the word's next position too), the word's affixes where it begins
and ends, and what a lexicon of word counts per language, taken over all documents to learn from, says about the whole word.
Transitions between the labels of neighbouring positions are learnt too. Forward-backward gives each position's probabilities,
so code-switched texts are labelled word by word; a document's language is the one with the most expected positions.

The lexicon counts every word of every document to learn from, under its whole hash. Of these the most frequent are
broadcast: those above the least count that leaves at most ``most_words`` of them (and at most LEXICON_BYTES in all, so the more
languages, the fewer words). Rarer words are told by their characters alone. The weights of the other features lie in
2**FEATURE_BITS buckets. They are fitted on a bounded sample: of up to ``most_texts`` documents of each language, up to SPANS
spans each of up to SPAN positions drawn from the whole text. Spans of different languages are strung together, which shows the
field what a switch looks like, and half of the words are shown without their entry in the lexicon. A span that begins or ends inside a long word takes the cut for the word's end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suretygraph.llm.arrow import arrow_map, batch, longs, put
from suretygraph.llm.split import draw, held_out
from suretygraph.llm.staging import session_of, stored
from suretygraph.llm.tokens import FOLDED, U, Words, mix, words

MOST_TEXTS, SPANS, SPAN = 500, 4, 24
MOST_WORDS, LEXICON_BYTES, FEATURE_BITS = 1 << 18, 64 << 20, 16
#: Bytes of one position of a chain at most; a longer word takes several.
LONGEST = 48
#: So many positions' features are worked out at once.
BLOCK = 1 << 14
#: Totals of words are told apart up to here when the least count is chosen.
COUNTED = 1 << 16
_GRAMS = (1, 2, 3)
UNDETERMINED = "und"


# -- positions and their features -------------------------------------------------------------------


@dataclass
class Positions:
    """Positions of consecutive rows' chains: row i has those from first[i] to first[i + 1]. ``word`` is the number of the word,
    ``piece`` counts the word's positions from 0, ``finishes`` says which is its last."""

    starts: np.ndarray
    ends: np.ndarray
    word: np.ndarray
    piece: np.ndarray
    finishes: np.ndarray
    first: np.ndarray


def positions(w: Words) -> Positions:
    length = w.ends - w.starts
    n = np.maximum(-(-length // LONGEST), 1)
    word = np.repeat(np.arange(len(length)), n)
    offset = np.concatenate([[0], np.cumsum(n)])
    piece = np.arange(offset[-1]) - offset[word]
    starts, finishes = w.starts[word] + piece * LONGEST, piece + 1 == n[word]
    for _ in range(3):  # back to the first byte of a character
        starts = starts - ((piece > 0) & (w.buffer[starts] & 0xC0 == 0x80))
    ends = np.where(finishes, w.ends[word], np.append(starts[1:], 0)) if len(word) else starts
    return Positions(starts, ends, word, piece, finishes, offset[w.first])


def character_features(w: Words, p: Positions, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of the positions numbered ``at``, and the place in ``at`` of each: n-grams of up to three
    bytes that begin in the position, and those at the word's beginning and end, which are its affixes."""
    starts, length = p.starts[at], p.ends[at] - p.starts[at]
    left = w.ends[p.word[at]] - starts  # bytes to the word's end
    begin = np.concatenate([[0], np.cumsum(length)])
    owner = np.repeat(np.arange(len(at)), length)
    inside = np.arange(begin[-1]) - begin[owner]
    place = starts[owner] + inside
    opens = (p.piece[at] == 0)[owner] & (inside == 0)
    names, owners = [], []
    for n in _GRAMS:
        whole = np.flatnonzero(inside + n <= left[owner])
        gram = np.full(len(whole), n, U)
        for k in range(n):
            gram = gram * U(257) + FOLDED.of(w.buffer[place[whole] + k]).astype(U) + U(1)
        own = owner[whole]
        for kind, some in ((0, slice(None)), (1, opens[whole]), (2, inside[whole] + n == left[own])):
            names.append(mix(gram[some] * U(3) + U(kind)) & U((1 << FEATURE_BITS) - 1))
            owners.append(own[some])
    return np.concatenate(names).astype(np.int64), np.concatenate(owners)


# -- the lexicon ------------------------------------------------------------------------------------


@dataclass
class Lexicon:
    """Words by whole hash, ascending, and the log share of each language among a word's uses."""

    hashes: np.ndarray
    shares: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """0 for every language where a word isn't known."""
        out = np.zeros((len(hashes), self.shares.shape[1]), np.float32)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            out[hit] = self.shares[at[hit]]
        return out


def _word_rows(batches):
    for b in batches:
        language = b["language"].to_numpy(zero_copy_only=False)
        for w in words(b["text"], FOLDED):
            own = language[w.row + np.repeat(np.arange(len(w)), np.diff(w.first))]
            for j in np.unique(own):
                hashes, n = np.unique(w.hashes[own == j], return_counts=True)
                yield batch(hash=longs(hashes), language=longs(np.full(len(hashes), j)), n=longs(n))


def lexicon(texts: DataFrame, k: int, most_words: int = MOST_WORDS) -> Lexicon:
    """From rows (language from 0 to k, text). Counts are taken over all words; the table that comes to the driver has at most
    ``most_words`` of them and LEXICON_BYTES."""
    most_words = min(most_words, LEXICON_BYTES // (8 + 4 * k))
    each = arrow_map(texts, _word_rows, "hash long, language long, n long").groupBy("hash", "language").agg(F.sum("n").alias("n"))
    pairs = F.collect_list(F.struct("language", "n")).alias("pairs")  # one for each language at most
    counts = stored(each.groupBy("hash").agg(F.sum("n").alias("total"), pairs), "words")
    # How many words there are of each total; beyond COUNTED the totals aren't told apart at first.
    histogram = counts.groupBy(F.least("total", F.lit(COUNTED)).alias("total")).agg(F.count("*").alias("n")).collect()
    least, known = COUNTED, 0
    for r in sorted(histogram, key=lambda r: -r["total"]):
        known += r["n"]
        if known > most_words:
            break
        least = r["total"]
    while counts.filter(F.col("total") >= least).count() > most_words:
        least *= 2
    rows = counts.filter(F.col("total") >= least).select("hash", F.inline("pairs")).toArrow()
    hashes, at = np.unique(rows["hash"].to_numpy().view(U), return_inverse=True)
    table = np.zeros((len(hashes), k))
    table[at, rows["language"].to_numpy()] = rows["n"].to_numpy()
    in_all = counts.select(F.inline("pairs")).groupBy("language").agg(F.sum("n").alias("n")).collect()
    sizes = np.ones(k)
    for r in in_all:
        sizes[r["language"]] = r["n"]
    smooth = table / sizes * 1e6 + 0.05
    return Lexicon(hashes, np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32))


# -- forward-backward -------------------------------------------------------------------------------


def chain(emission: np.ndarray, first: np.ndarray, transition: np.ndarray, block: int = 64):
    """Marginals (words x labels) of chains whose words lie from first[i] to first[i + 1], and the log-likelihood's
    normaliser. Chains are cut into blocks that are worked on together: one pass multiplies up each block, one carries
    the messages from block to block, one fills in the words, so a long chain costs as many steps as a short one."""
    n, k = emission.shape
    top = emission.max(axis=1, keepdims=True) if n else emission
    e = np.exp(emission - top)
    a = np.exp(transition)
    starts = np.zeros(n, bool)
    starts[first[:-1][np.diff(first) > 0]] = True
    pad = -n % block
    ones = np.ones((pad, k))
    e3 = np.concatenate([e, ones]).reshape(-1, block, k)
    s3 = np.concatenate([starts, np.ones(pad, bool)]).reshape(-1, block)
    m = len(e3)
    # Step matrix of word t: message' = (message @ A or total at a chain's start) * e[t].
    product, scale = np.broadcast_to(np.eye(k), (m, k, k)).copy(), np.zeros(m)
    for t in range(block):
        moved = product @ a
        fresh = s3[:, t]
        moved[fresh] = product[fresh].sum(axis=2, keepdims=True)
        product = moved * e3[:, t, None, :]
        size = product.sum(axis=(1, 2))
        product /= size[:, None, None]
        scale += np.log(size)
    forward_in = np.empty((m, k))
    message, total = np.ones(k), 0.0
    for i in range(m):
        forward_in[i] = message
        message = message @ product[i]
        size = message.sum()
        message, total = message / size, total + np.log(size) + scale[i]
    backward_in = np.empty((m, k))
    message = np.ones(k)
    for i in range(m - 1, -1, -1):
        backward_in[i] = message
        message = product[i] @ message
        message = message / message.sum()
    alpha, beta = np.empty_like(e3), np.empty_like(e3)
    message = forward_in
    for t in range(block):
        moved = message @ a
        moved[s3[:, t]] = message[s3[:, t]].sum(axis=1, keepdims=True)
        message = moved * e3[:, t]
        message /= message.sum(axis=1, keepdims=True)
        alpha[:, t] = message
    message = backward_in
    for t in range(block - 1, -1, -1):
        beta[:, t] = message
        back = message * e3[:, t]
        moved = back @ a.T
        fresh = s3[:, t]
        moved[fresh] = back[fresh].sum(axis=1, keepdims=True)
        message = moved / moved.sum(axis=1, keepdims=True)
    alpha, beta = alpha.reshape(-1, k)[:n], beta.reshape(-1, k)[:n]
    marginal = alpha * beta
    marginal /= marginal.sum(axis=1, keepdims=True)
    return marginal, alpha, beta, e, starts


def transition_marginals(alpha, beta, e, starts, transition) -> np.ndarray:
    """Expected number of each transition (label before, label after)."""
    inner = np.flatnonzero(~starts)
    pair = alpha[inner - 1][:, :, None] * np.exp(transition) * (e[inner] * beta[inner])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return pair.sum(axis=0)


# -- the model --------------------------------------------------------------------------------------


@dataclass
class Field:
    languages: list[str]
    lexicon: Lexicon
    characters: np.ndarray  # 2**FEATURE_BITS x languages
    word: float  # weight of the lexicon
    bias: np.ndarray
    transition: np.ndarray

    def emission(self, w: Words, p: Positions) -> np.ndarray:
        """Scores of all positions; each different one is worked out once, a block of them at a time."""
        hashes = w.hashes[p.word]
        whole = (p.piece == 0) & p.finishes
        key = np.where(whole, hashes, mix(hashes + (p.piece + 1).astype(U) * U(0x9E3779B97F4A7C15)))
        _, one, which = np.unique(key, return_index=True, return_inverse=True)
        out = np.empty((len(one), len(self.languages)))
        for begin in range(0, len(one), BLOCK):
            at = one[begin : begin + BLOCK]
            names, owner = character_features(w, p, at)
            size = np.sqrt(np.maximum(np.bincount(owner, minlength=len(at)), 1))
            scores = self.bias + self.word * self.lexicon.of(hashes[at])
            for k in range(len(self.languages)):
                scores[:, k] += np.bincount(owner, self.characters[names, k], len(at)) / size
            out[begin : begin + BLOCK] = scores
        return out[which]

    def marginals(self, w: Words) -> tuple[Positions, np.ndarray]:
        """The positions and each language's probability there."""
        p = positions(w)
        if not len(p.word):
            return p, np.zeros((0, len(self.languages)))
        return p, chain(self.emission(w, p), p.first, self.transition)[0]

    def shares(self, w: Words) -> np.ndarray:
        """Mean probability of each language over the positions of each text."""
        out = np.zeros((len(w), len(self.languages)))
        p, marginal = self.marginals(w)
        filled = np.diff(p.first) > 0
        if filled.any():
            out[filled] = np.add.reduceat(marginal, p.first[:-1][filled]) / np.diff(p.first)[filled, None]
        return out


def _span_rows(batches):
    for b in batches:
        for w in words(b["text"], FOLDED):
            p, spans, row = positions(w), [], []
            for i in range(len(w)):
                lo, hi = p.first[i], p.first[i + 1]
                seed = int(w.hashes[w.first[i] : w.first[i + 1]].sum(dtype=U) & U(0xFFFFFFFF))
                drawn = np.random.default_rng(seed).integers(lo, max(hi - SPAN, lo) + 1, SPANS)
                for at in sorted(set(drawn.tolist())) if hi > lo else []:
                    parts = [(b" " if p.piece[j] == 0 else b"") + bytes(w.buffer[p.starts[j] : p.ends[j]]) for j in range(at, min(at + SPAN, hi))]
                    spans.append(b"".join(parts).lstrip(b" "))
                    row.append(w.row + i)
            yield batch(language=b["language"].take(pa.array(row, pa.int32())), at=b["at"].take(pa.array(row, pa.int32())), span=pa.array(spans, pa.binary()))


def fit_weights(spans: list[bytes], language: np.ndarray, languages: list[str], lexicon: Lexicon, epochs: int = 40) -> Field:
    """Gradient ascent with a rate for each coordinate on the conditional likelihood of the sample."""
    k = len(languages)
    order = np.random.default_rng(2).permutation(len(spans))
    spans, language = [spans[i] for i in order], language[order]
    w = next(words(pa.array([b" ".join(spans)]), FOLDED))
    p = positions(w)
    # Where each span's positions begin: its first word's first one.
    in_words = np.concatenate([[0], np.cumsum([len(s.split()) for s in spans])])
    bounds = np.append(np.flatnonzero(p.piece == 0), len(p.word))[in_words]
    label = np.repeat(language, np.diff(bounds))
    # Three spans are one chain, so that a third or more of the spans begin without a switch.
    first = np.unique(np.append(bounds[::3], bounds[-1]))
    hashes = w.hashes[p.word]
    key = mix(hashes + p.piece.astype(U) * U(0x9E3779B97F4A7C15))
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    names, owner = character_features(w, p, one)
    size = np.sqrt(np.maximum(np.bincount(owner, minlength=len(one)), 1))
    # Half of the words are shown as unknown, or their characters would never have to tell.
    known = lexicon.of(hashes[one]) * (mix(hashes[one]) & U(1) == 0)[:, None]
    theta = {"c": np.zeros((1 << FEATURE_BITS, k)), "w": np.ones(1), "b": np.zeros(k), "t": np.zeros((k, k))}
    squares = {x: np.full_like(v, 1e-8) for x, v in theta.items()}
    truth = np.eye(k)[label]
    for _ in range(epochs):
        emission = theta["b"] + theta["w"][0] * known
        for j in range(k):
            emission[:, j] += np.bincount(owner, theta["c"][names, j], len(one)) / size
        marginal, alpha, beta, e, starts = chain(emission[which], first, theta["t"])
        wrong = truth - marginal
        per_word = np.stack([np.bincount(which, wrong[:, j], len(one)) for j in range(k)], axis=1)
        seen = np.zeros((k, k))
        inner = np.flatnonzero(~starts)
        np.add.at(seen, (label[inner - 1], label[inner]), 1)
        spread = (per_word / size[:, None])[owner]
        gradient = {
            "c": np.stack([np.bincount(names, spread[:, j], 1 << FEATURE_BITS) for j in range(k)], axis=1) / len(label) - 1e-6 * theta["c"],
            "w": np.array([(per_word * known).sum() / len(label)]),
            "b": wrong.sum(axis=0) / len(label),
            "t": (seen - transition_marginals(alpha, beta, e, starts, theta["t"])) / len(label),
        }
        for x, g in gradient.items():
            squares[x] += g * g
            theta[x] += 0.3 * g / np.sqrt(squares[x])
    return Field(languages, lexicon, theta["c"], float(theta["w"][0]), theta["b"], theta["t"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_texts: int = MOST_TEXTS,
        most_words: int = MOST_WORDS) -> Field | None:
    """Learns from documents with a language that aren't held out; None if there are none with words.

    The languages are collected: their number is that of the label set, not of the documents.
    """
    spark = session_of(docs)
    known = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id"))
    languages = sorted(r[0] for r in known.select("lang").distinct().collect())
    if not languages:
        return None
    number = spark.createDataFrame(list(zip(languages, range(len(languages)))), "lang string, language int")
    numbered = known.join(F.broadcast(number), "lang")  # one row for each language
    table = lexicon(numbered.select("language", "text"), len(languages), most_words)
    sample = None
    order = draw("id", "language")
    for j in range(len(languages)):
        part = numbered.filter(F.col("language") == j).select("language", "id", order.alias("at")).orderBy("at", "id").limit(most_texts)
        sample = part if sample is None else sample.union(part)
    sample = stored(sample.distinct(), "sample")
    spans = arrow_map(
        numbered.select("id", "language", "text").join(F.broadcast(sample), ["id", "language"]).select("language", "at", "text"),
        _span_rows, "language int, at long, span binary",
    ).orderBy("at", "language", "span").toArrow()  # at most most_texts * SPANS spans of SPAN * LONGEST bytes for each language
    if not spans.num_rows:
        return None
    return fit_weights(spans["span"].to_pylist(), spans["language"].to_numpy(), languages, table)


def _label(field):
    def run(batches):
        for b in batches:
            parts = [field.value.shares(w) for w in words(b["text"], FOLDED)]
            shares = np.concatenate(parts) if parts else np.zeros((0, 1))
            best = shares.argmax(axis=1)
            name = pa.array(field.value.languages).take(pa.array(best))
            yield pa.RecordBatch.from_arrays(
                [b["_row"], b["letters"], name, pa.array(shares[np.arange(len(best)), best])],
                names=["_row", "letters", "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, field: Field | None, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the language's mean probability over the text's words, to every row.

    Null texts, texts without a letter, and all texts if there is no model, get ``und`` with score 0. Equal scores go to
    the language first in order. Input columns of these names are replaced.
    """
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("text"), letters.alias("letters"))
    if field is None:
        out = rows.select("_row", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
        return put(out, "_row", "lang_pred", "score")
    shared = session_of(docs).sparkContext.broadcast(field)
    schema = T.StructType([
        rows.schema["_row"], T.StructField("letters", T.BooleanType()), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])
    out = arrow_map(rows, _label(shared), schema)
    return put(
        out.select("_row", F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
                   F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score")),
        "_row", "lang_pred", "score",
    )
