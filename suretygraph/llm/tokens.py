"""Words of whole texts as 64-bit hashes, taken from Arrow buffers with array operations.

A word's hash is a polynomial over a random value for each of its bytes, mixed once more, so equal words have
equal hashes wherever they stand and two different words share one with a probability near 2**-58.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Texts are taken together up to so many bytes; a longer text is hashed in pieces of this length.
PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(U)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {}


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        _POWERS.update(up=_powers(_BASE, n), down=_powers(_INVERSE, n))
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


@dataclass(frozen=True)
class Alphabet:
    """Maps each byte to the one to hash, 0 for those between words."""

    lut: bytes

    def of(self, buffer: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.lut, np.uint8)[buffer]


def _alphabet(gap, fold: bool) -> Alphabet:
    lower = bytes(range(256)).lower() if fold else bytes(range(256))
    return Alphabet(bytes(0 if gap(b) else b for b in lower))


def _space(b: int) -> bool:
    return b == 0x20 or 0x09 <= b <= 0x0D


#: Words between spaces and the controls 09 to 0D. Byte 0 is a word's byte and gets a value no text has.
PLAIN = _alphabet(_space, fold=False)
FOLDED = _alphabet(_space, fold=True)
#: Words of lower-case letters, digits and all beyond ASCII.
ALNUM = _alphabet(lambda b: b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F, fold=True)
PLAIN, FOLDED = (Alphabet(bytes([0xFF]) + a.lut[1:]) for a in (PLAIN, FOLDED))


@dataclass
class Words:
    """Words of consecutive rows: row i has those from first[i] to first[i + 1]."""

    row: int
    first: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    buffer: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1


def _hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        begin = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, begin + PIECE, "right")))
        end = ends[to - 1]
        if end - begin > PIECE:  # one very long word
            out[at] = _long_hash(values[begin:end])
        else:
            up, down = _table(PIECE + 1)
            total = np.zeros(end - begin + 1, U)
            np.cumsum(_BYTES[values[begin:end]] * up[: end - begin], out=total[1:])
            out[at:to] = (total[ends[at:to] - begin] - total[starts[at:to] - begin]) * down[starts[at:to] - begin]
        at = to
    return mix(out + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def _long_hash(values: np.ndarray) -> np.uint64:
    up, _ = _table(PIECE + 1)
    total, shift = 0, 1
    for at in range(0, len(values), PIECE):
        piece = _BYTES[values[at : at + PIECE]]
        total = (total + int((piece * up[: len(piece)]).sum(dtype=U)) * shift) % (1 << 64)
        shift = shift * pow(_BASE, PIECE, 1 << 64) % (1 << 64)
    return U(total)


def words(texts: pa.Array, alphabet: Alphabet) -> Iterator[Words]:
    """The words of each row's whole text, some rows at a time. A null text has none."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    missing = np.asarray(texts.is_null()) if texts.null_count else None
    row = 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
        bounds = offsets[row : to + 1] - offsets[row]
        buffer = data[offsets[row] : offsets[to]]
        values = alphabet.of(buffer)
        if missing is not None:
            for i in np.flatnonzero(missing[row:to]):
                values[bounds[i] : bounds[i + 1]] = 0
        inside = values != 0
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        before[bounds[:-1][bounds[:-1] < len(inside)]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[bounds[1:][bounds[1:] > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        yield Words(row, np.searchsorted(starts, bounds), _hashes(values, starts, ends), starts, ends, buffer)
        row = to


_NEXT = U(0x8CB92BA72F3D8DD7)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """For each word the hash of the ``size`` words from it on, as far as there are so many."""
    out = mix(hashes)
    for k in range(1, size):
        out = mix(out[: max(len(hashes) - k, 0)] * _NEXT + hashes[k:]) if len(hashes) > k else out[:0]
    return out


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """Of all the words given, and of their number."""
    out = np.array([len(hashes)], U)
    for k in range(len(hashes)):
        out = mix(out * _NEXT + hashes[k : k + 1])
    return out[0]
