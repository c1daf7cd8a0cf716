"""Vectorised tokenisation and n-gram hashing, run inside Spark tasks on
batches of texts.  Words are maximal runs of bytes other than ASCII white
space (``bytes.split`` splits on exactly 0x20 and 0x09-0x0D)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

MULT = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D
MASK = (1 << 64) - 1
#: Code points handled at a time; bounds the memory that one very long text takes.
CHUNK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes (splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * MULT)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & MASK, dtype=np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


BASE_INV = pow(BASE, -1, 1 << 64)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ranges [start, end) of bytes or code points: equal
    items, equal hash."""
    n = len(data)
    with np.errstate(over="ignore"):
        codes = _byte_codes()[data] if data.dtype == np.uint8 else mix(data.astype(np.uint64) * MULT + MULT)
        prefix = np.concatenate([np.zeros(1, np.uint64),
                                 np.cumsum(codes * powers(BASE, n), dtype=np.uint64)])
        inverse = powers(BASE_INV, n + 1)
        h = (prefix[ends] - prefix[starts]) * inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * MULT)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of a whole text."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """Hash of every n-word window, in text order; one window of all words
    when there are fewer than n; none without words.  The words' XXH64 are
    chained by a bijective mixer, so that no structure of the text makes
    different windows meet."""
    if not words:
        return np.zeros(0, np.uint64)
    k = min(n, len(words))
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    m = len(words) - k + 1
    h = np.full(m, k, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            h = mix(h * MULT + each[i: i + m])
    return h


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text with every run of other characters
    than letters as one space, and a space at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = _letters()[codes]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of a run of others stays, as the space
    codes = np.where(is_letter, codes, np.uint32(32))[keep]
    if not len(codes) or codes[-1] != 32:
        codes = np.append(codes, np.uint32(32))
    return codes if codes[0] == 32 else np.concatenate([np.array([32], np.uint32), codes])


def gram_buckets(codes: np.ndarray, n: int, bits: int, salt: int = 0) -> np.ndarray:
    """Hash buckets (``bits`` wide) of all n-grams of a code point sequence."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    h = np.full(m, (n * 0x632BE59BD9B4E019 + salt * 0x9E3779B9) & MASK, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = (h + codes[i: i + m]) * MULT
            h ^= h >> np.uint64(29)
        h *= MULT
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def windows(codes: np.ndarray, overlap: int):
    """Cut a long sequence into pieces of CHUNK items that overlap by
    ``overlap``, so that every n-gram of up to overlap + 1 lies in just one
    (the shorter ones of the overlap repeat, hence one order per call)."""
    if len(codes) <= CHUNK:
        yield codes
        return
    for start in range(0, len(codes) - overlap, CHUNK):
        yield codes[start: start + CHUNK + overlap]
