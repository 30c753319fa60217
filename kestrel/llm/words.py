"""Words of UTF-8 texts and their 64-bit hashes, computed with numpy over whole batches.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z are lower-cased first. All of
these are ASCII, so bytes and code points agree on where a word starts and ends.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_SEG = 1 << 17
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_BASE2 = 0xC2B2AE3D27D4EB4F | 1
_INV2 = pow(_BASE2, -1, 1 << 64)
_STATE: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix1(x: int) -> int:
    return int(mix(np.array([x & _MASK], dtype=np.uint64))[0])


def _tables() -> dict[str, np.ndarray]:
    if not _STATE:
        low = np.arange(256, dtype=np.uint8)
        low[65:91] += 32
        space = np.zeros(256, dtype=bool)
        space[[32, *range(9, 14)]] = True
        _STATE["low"], _STATE["space"] = low, space
        _STATE["marks"] = space | np.isin(np.arange(256), [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
        _STATE["value"] = mix(low.astype(np.uint64) + np.uint64(0x1234567))
        _STATE["pow"], _STATE["inv"] = _powers(_BASE, _SEG), _powers(_INV, _SEG)
        _STATE["pow2"], _STATE["inv2"] = _powers(_BASE2, _SEG), _powers(_INV2, _SEG)
    return _STATE


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _segment(data: np.ndarray, gaps: str = "space") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = _tables()
    gap = np.ones(len(data) + 2, dtype=np.int8)
    gap[1:-1] = t[gaps][data]
    edge = np.diff(gap)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return start, end, np.empty(0, dtype=np.uint64)
    n = len(data)
    power, inverse = (t["pow"], t["inv"]) if n <= _SEG else (_powers(_BASE, n), _powers(_INV, n))
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(t["value"][data] * power[:n], dtype=np.uint64, out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    return start, end, mix(h + (end - start).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def hash_words(text: bytes, gaps: str = "space") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, ends and hashes of the words of one text, in segments cut between words.

    With ``gaps="marks"`` ASCII punctuation parts words too.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    if len(data) <= _SEG:
        return _segment(data, gaps)
    space, parts, at = _tables()["space"], [], 0
    while at < len(data):
        stop = min(len(data), at + _SEG)
        while stop < len(data):
            back = np.flatnonzero(space[data[at:stop]])
            if len(back):
                stop = at + int(back[-1]) + 1
                break
            stop = min(len(data), stop + _SEG)
        s, e, h = _segment(data[at:stop], gaps)
        parts.append((s + at, e + at, h))
        at = stop
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def each_text(texts: Sequence[bytes], gaps: str = "space") -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, starts, ends, word hashes) of each text; short texts are hashed together."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) < _SEG - 16 * 1024):
            size += len(texts[stop]) + 1
            stop += 1
        if stop == at + 1:
            yield (at, *hash_words(texts[at], gaps))
        else:
            s, e, h = hash_words(b"\n".join(texts[at:stop]), gaps)
            ends = np.cumsum([len(x) + 1 for x in texts[at:stop]])
            cut = [0, *np.searchsorted(s, ends).tolist()]
            base = 0
            for k in range(stop - at):
                lo, hi = cut[k], cut[k + 1]
                yield at + k, s[lo:hi] - base, e[lo:hi] - base, h[lo:hi]
                base = int(ends[k])
        at = stop


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words; a shorter text is one run, no words give none."""
    if not len(h):
        return h
    if len(h) < n:
        return sequence_hash(h)[None]
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = (out + h[k:len(h) - n + 1 + k]) * np.uint64(_BASE)
        out ^= out >> np.uint64(29)
    return mix(out)


def sequence_hash(h: np.ndarray, seed: int = 0) -> np.uint64:
    """Order-sensitive hash of a run of word hashes."""
    total = int((h * powers(max(1, len(h)))[:len(h)]).sum(dtype=np.uint64))
    return mix(np.array([(total + len(h) * 0x2545F4914F6CDD1D + seed * 0x632BE59BD9B4E019) & _MASK], dtype=np.uint64))[0]


def powers(n: int, second: bool = False) -> np.ndarray:
    """1, b, b^2, ... of the order-sensitive hash, modulo 2^64."""
    return _tables()["pow2" if second else "pow"][:n] if n <= _SEG else _powers(_BASE2 if second else _BASE, n)


def inverses(n: int, second: bool = False) -> np.ndarray:
    return _tables()["inv2" if second else "inv"][:n] if n <= _SEG else _powers(_INV2 if second else _INV, n)


class Runs:
    """Hashes of any runs of one sequence of word hashes, from sums taken once.

    A hash with the ``second`` base does not follow from one with the first: the two are 128 bits.
    """

    def __init__(self, h: np.ndarray, second: bool = False):
        n = len(h)
        h = mix(h) if second else h
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(h * powers(max(1, n), second)[:n], dtype=np.uint64, out=self.total[1:])
        self.inverse = inverses(n + 1, second)

    def hash(self, lo: np.ndarray, hi: np.ndarray, seed: int = 0) -> np.ndarray:
        """Hashes of the runs [lo, hi): equal for equal runs wherever they stand."""
        size = (hi - lo).astype(np.uint64)
        return mix((self.total[hi] - self.total[lo]) * self.inverse[lo] + size * np.uint64(0xC2B2AE3D27D4EB4F)
                   + np.uint64((seed * 0x9FB21C651E98DF25) & _MASK))

    def without_each(self, seed: int = 0) -> np.ndarray:
        """Hashes of the sequence with one word left out, for each word; equal to ``hash`` of that run."""
        n = len(self.total) - 1
        rest = self.total[:-1] + (self.total[-1] - self.total[1:]) * np.uint64(_INV)
        return mix(rest + np.uint64(((n - 1) * 0xC2B2AE3D27D4EB4F + seed * 0x9FB21C651E98DF25) & _MASK))
