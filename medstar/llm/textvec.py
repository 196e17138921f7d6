"""Word and shingle hashes of whole texts with numpy, many texts at a time.

A word is a maximal run of ASCII letters and digits and of non-ASCII
characters in the lower-cased text; everything else separates words.  The
hash of a word is a polynomial over its UTF-8 bytes modulo 2**64, taken from
prefix sums, so the work per text is a few passes over its bytes.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)                      # odd: has an inverse mod 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLOCK = 1 << 20                                           # bytes hashed at a time
_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_LETTER = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n."""
    size = max(_BLOCK, 1 << (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            _powers[size] = tuple(
                np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)], dtype=np.uint64)
                for b in (_BASE, _INVERSE))
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of every word of UTF-8 bytes."""
    raw = np.frombuffer(data, np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(raw):
        end = min(at + _BLOCK, len(raw))
        while end < len(raw) and _WORD[raw[end]] and _WORD[raw[end - 1]]:
            back = np.flatnonzero(~_WORD[raw[at:end]])      # not within a word
            if len(back):
                end = at + int(back[-1]) + 1
                break
            end = min(end + _BLOCK, len(raw))
        part = raw[at:end]
        word = _WORD[part]
        edge = np.flatnonzero(np.diff(np.r_[False, word, False].astype(np.int8)))
        first, last = edge[0::2], edge[1::2]
        power, inverse = _power(len(part))
        with np.errstate(over="ignore"):
            total = np.r_[np.uint64(0), np.cumsum(_LETTER[part] * power[:len(part)],
                                                  dtype=np.uint64)]
            hashes.append(mix((total[last] - total[first]) * inverse[first]))
        starts.append(first + at)
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin
    (one more entry than texts)."""
    encoded = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    where = np.cumsum([0] + [len(b) + 1 for b in encoded])
    starts, hashes = hash_words(b" ".join(encoded))
    return hashes, np.searchsorted(starts, where)


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every text, in text order, and where
    each text's shingles begin.  A text of 1 to k-1 words has one shingle,
    all its words; a text without words has none."""
    n = np.diff(bounds)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begin = np.r_[0, np.cumsum(count)]
    owner = np.repeat(np.arange(len(n)), count)
    at = np.arange(begin[-1]) - begin[owner] + bounds[owner]
    end = bounds[owner + 1]
    out = np.zeros(len(at), np.uint64)
    padded = np.r_[words, np.zeros(k, np.uint64)]
    with np.errstate(over="ignore"):
        for j in range(k):
            w = padded[at + j]
            short = at + j >= end
            if short.any():
                w = np.where(short, np.uint64(0), w)
            out = out * _BASE + w
    return mix(out), begin


def labelled(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Shingles of one text made unique by their occurrence number: the second
    occurrence of a shingle gets another hash than the first, and so on."""
    if not len(hashes):
        return hashes
    owner = np.repeat(np.arange(len(begin) - 1, dtype=np.uint64), np.diff(begin))
    with np.errstate(over="ignore"):
        own = mix(hashes + owner * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(own, kind="stable")
    same = np.r_[False, own[order[1:]] == own[order[:-1]]]
    if not same.any():
        return hashes
    index = np.arange(len(order))
    run = np.maximum.accumulate(np.where(same, 0, index))
    out = hashes.copy()
    again = order[same]
    with np.errstate(over="ignore"):
        out[again] = mix(hashes[again] + (index - run)[same].astype(np.uint64) * _BASE)
    return out


def groups_of(sizes: list[int], limit: int = 4 << 20):
    """Ranges of neighbours with about ``limit`` bytes together (at least one)."""
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if i > at and total + size > limit:
            yield at, i
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield at, len(sizes)
