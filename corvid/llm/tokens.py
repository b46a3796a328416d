"""Vectorised tokens: boundaries and 64-bit hashes of all tokens of a batch of texts.

A token is a maximal run of bytes (UTF-8) of the same class; class 0 separates tokens. The
hash of a token is a polynomial over its bytes modulo 2**64, read off prefix sums, then
mixed. It depends on the bytes alone, so it is the same in every process.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from corvid.llm.common import SPACE

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at a time.
_SEGMENT = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS, _INVERSES = _powers(_BASE, _SEGMENT), _powers(_INVERSE, _SEGMENT)

#: Word classes: white space [\x20\x09-\x0D] separates, all else is one class.
WORDS = np.ones(256, dtype=np.uint8)
WORDS[np.frombuffer(SPACE.encode(), dtype=np.uint8)] = 0


class Tokens(NamedTuple):
    hash: np.ndarray    # uint64, in order of the texts
    counts: np.ndarray  # tokens per text
    starts: np.ndarray  # byte offsets in ``data``
    ends: np.ndarray
    data: np.ndarray    # all bytes, a line feed after each text


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _SEGMENT, side="right")))
        stop = ends[j - 1]
        if stop - base > _SEGMENT:  # one token longer than a segment
            h = 0
            for at in range(base, stop, _SEGMENT):
                part = data[at:min(stop, at + _SEGMENT)].astype(np.uint64) + np.uint64(1)
                h = (h * 31 + int((part * _POWERS[: len(part)]).sum(dtype=np.uint64))) % (1 << 64)
            out[i] = h
        else:
            part = (data[base:stop].astype(np.uint64) + np.uint64(1)) * _POWERS[: stop - base]
            sums = np.concatenate([[np.uint64(0)], np.cumsum(part, dtype=np.uint64)])
            s, e = starts[i:j] - base, ends[i:j] - base
            out[i:j] = (sums[e] - sums[s]) * _INVERSES[s]
        i = j
    return mix(out)


def tokenise(texts: list[str], classes: np.ndarray = WORDS) -> Tokens:
    """Tokens of all texts. Nothing runs over the border of two texts."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    kind = classes[data]
    kind[data == 10] = 0
    edges = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts = np.concatenate([[0], edges])
    ends = np.concatenate([edges, [len(data)]])
    token = kind[starts] > 0
    starts, ends = starts[token], ends[token]
    borders = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64) if parts else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, borders), prepend=0)
    return Tokens(_span_hash(data, starts, ends), counts, starts, ends, data)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` hashes."""
    out = np.zeros(max(0, len(h) - n + 1), dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(_BASE) + h[i: i + len(out)]
    return mix(out)
