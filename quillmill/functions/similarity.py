"""Shingles, signatures and similarities of long texts."""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.text import IGNORED

SHINGLE, STRIDE, SLOTS, SEED = 12, 3, 64, 42

#: The salts of stored signatures: one value for all slots, so that signatures that were made
#: earlier stay comparable.  Two such signatures agree in all slots or in none.
SAME_SALTS = (random.Random(SEED).getrandbits(64),) * SLOTS


def distinct_salts(n: int = SLOTS, seed: int = SEED) -> tuple[int, ...]:
    """A salt of its own for each slot: the share of equal slots estimates Jaccard similarity."""
    source = random.Random(seed)
    return tuple(source.getrandbits(64) for _ in range(n))


def shingle_set(text: str, size: int = SHINGLE, stride: int = STRIDE) -> set[str]:
    """Every ``stride``-th run of ``size`` characters; a shorter text is its own shingle."""
    return {text[i : i + size] for i in range(0, max(len(text) - size, 0) + 1, stride)}


def signature(text: str, salts=SAME_SALTS, size: int = SHINGLE, stride: int = STRIDE) -> list[str]:
    """16 hex digits per slot: the least of shingle hash XOR salt."""
    hashes = [int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "big") for s in shingle_set(text, size, stride)]
    least = {salt: f"{min(h ^ salt for h in hashes):016x}" for salt in set(salts)}
    return [least[s] for s in salts]


def shingles(c: Column, size: int = SHINGLE, stride: int = STRIDE) -> Column:
    """Distinct shingles of a text, by an Arrow UDF: linear in long texts, where substring is not."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(shingle_set(t or "", size, stride)))

    return run(c)


def shingle_hashes(c: Column, size: int = SHINGLE, stride: int = STRIDE) -> Column:
    """Sorted distinct 64-bit hashes of the shingles, for set comparisons."""

    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        def of(t: str) -> list[int]:
            return sorted(int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "big", signed=True) for s in shingle_set(t or "", size, stride))

        return texts.map(of)

    return run(c)


def minhash(c: Column, salts=SAME_SALTS) -> Column:
    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: signature(t or "", salts))

    return run(c)


def md5_minhash(c: Column, slots: int = 4) -> Column:
    """A signature in SQL functions only: per slot the least md5 of slot and shingle.

    For short texts: substring makes it quadratic in the length.
    """
    n = F.greatest(F.length(c) - SHINGLE, F.lit(0))
    parts = F.array_distinct(F.transform(F.sequence(F.lit(0), n, F.lit(STRIDE)), lambda i: F.substring(c, i + 1, F.lit(SHINGLE))))
    return F.array(*(F.array_min(F.transform(parts, _salted(k))) for k in range(slots)))


def _salted(k: int):
    def f(s: Column) -> Column:
        return F.md5(F.concat(F.lit(f"{k}:"), s).cast("binary"))

    return f


def equal_share(a: Column, b: Column) -> Column:
    """Share of equal slots of two signatures."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) <= 0) | (F.size(b) <= 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(a, b) / F.greatest(a, b)


def bands(sig: Column, slots: int = SLOTS, threshold: float = 0.8) -> Column:
    """array<struct(band, key)>: two signatures with the share ``threshold`` of equal slots have
    an equal key in some band (there is one band more than slots that may differ)."""
    n = slots - int(-(-slots * threshold // 1)) + 1
    size = [slots // n + (i < slots % n) for i in range(n)]
    start = [sum(size[:i]) for i in range(n)]
    return F.array(*(F.struct(F.lit(i).alias("band"), F.xxhash64(F.array_join(F.slice(sig, start[i] + 1, size[i]), "")).alias("key")) for i in range(n)))


def _gram_hashes(text: str, gram: int) -> np.ndarray:
    """A 64-bit hash of every run of ``gram`` characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    n = len(codes) - gram + 1
    out = np.zeros(max(n, 0), "u8")
    for i in range(gram if n > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def codes_of(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def form_codes(text: str) -> np.ndarray:
    """The code points of ``dedup_form`` of a text."""
    codes = codes_of(text)
    return codes[~_ignored()[codes]]


@functools.cache
def _ignored() -> np.ndarray:
    """Whether a code point does not count when chapters are compared."""
    out = np.zeros(0x110000, bool)
    out[[i for i in range(0x10000) if re.match(IGNORED.removeprefix("(?Ud)"), chr(i))]] = True
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes with all bits spread over all others."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` code points, by doubling; those of different
    widths differ too."""
    base, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
    if len(codes) < width or width < 1:
        return np.zeros(0, "u8")
    part, step, out, done = codes.astype("u8") + np.uint64(1), 1, None, 0
    while True:
        if width & step:
            n = len(codes) - done - step + 1
            out = part if out is None else out[:n] * np.uint64(pow(base, step, mask + 1)) + part[done : done + n]
            done += step
        if done == width:
            return mixed(out[: len(codes) - width + 1])
        part = part[:-step] * np.uint64(pow(base, step, mask + 1)) + part[step:]
        step *= 2


def shingle_array(codes: np.ndarray, size: int = SHINGLE, stride: int = STRIDE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text's code points; none of no text."""
    return np.unique(window_hashes(codes, min(size, len(codes)))[::stride])


def minimizers(text: str, length: int = 30, gram: int = 8) -> list[int]:
    """The least gram hash of every run of ``length`` characters, each value once: a text that
    contains another of that length has its one value among its own."""
    hashes = _gram_hashes(text, gram)
    width = length - gram + 1
    if len(hashes) < width:
        return []
    least = hashes.copy()
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        least = np.minimum(least[: len(least) - step], least[step:])
        covered += step
    return np.unique(least).view("i8").tolist()
