"""Quality classifier from overlapping weak labellers.

Nine heuristics each vote good, junk or nothing on a text.  Expectation-maximisation over the
counts of all vote patterns (at most 3**9, whatever the corpus) estimates how accurate each
labeller is and the posterior of every pattern, with no gold label.  The posteriors label a
sample, on which a hashed linear scorer is trained; it scores every text by its words' shapes.

Sizes: no text is shuffled.  The pattern counts cover all documents; the scorer is fitted on
at most MAX_SAMPLE texts, chosen by a hash over all rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import table

BITS = 16
#: Texts that the scorer is fitted on at most.
MAX_SAMPLE = 8000
THRESHOLD = 0.5
JUNK, GOOD, NONE = 0, 1, 2

#: Function words of the languages that the corpus may hold (fixed values of a labeller).
STOP_WORDS = frozenset(
    "the of and to in a is that for it was on are as with his they be at this have from or by not but which you an we de la le et les des en un une du que est pour qui dans par sur au "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an el y los del se las por con no su para al lo como más o pero sus".split()
)

_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()\-|]")
_RUN = re.compile(r"[^\w\s]{2,}")


def _vote(junk: bool, good: bool) -> int:
    return JUNK if junk else GOOD if good else NONE


def votes(text: str | None) -> tuple[int, ...]:
    """The vote of each labeller, in the order of ``LABELLERS``; an empty text is junk to the
    length labeller and nothing to the others."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return (NONE, NONE, NONE, JUNK, NONE, NONE, NONE, NONE, NONE)
    symbols = len(_SYMBOL.findall(text)) / len(text)
    shouting = sum(map(str.isupper, words)) / n
    runs = len(_RUN.findall(text)) / n
    low = list(map(str.lower, words))
    cells = low.count("|") / n
    distinct = len(set(low))
    triples = len(set(zip(low, low[1:], low[2:], strict=False))) / (n - 2) if n > 2 else 1.0
    twice = sum(map(str.__eq__, low, low[1:])) / n
    length = sum(map(len, words)) / n
    stops = sum(map(STOP_WORDS.__contains__, low)) / n
    ended = sum(line.rstrip()[-1:] in ".!?\"')" for line in text.split("\n")) / (text.count("\n") + 1)
    return (
        _vote(symbols > 0.05, symbols < 0.015),
        _vote(shouting > 0.4, shouting < 0.15),
        _vote(runs > 0.2, runs < 0.05),
        _vote(n < 3, n >= 20),
        _vote(n >= 20 and triples < 0.6, n >= 20 and triples > 0.9),
        _vote(length > 14 or length < 2.2, 3 <= length <= 10),
        _vote(n >= 30 and stops < 0.03, stops > 0.08),
        _vote(n >= 10 and cells > 0.1, cells < 0.02),
        _vote(n >= 20 and (twice > 0.1 or distinct / n < 0.1), n >= 20 and twice < 0.03 and ended > 0.5),
    )


LABELLERS = ("symbols", "shouting", "runs", "length", "repetition", "word_length", "function_words", "cells", "loops")


def pattern(text: str | None) -> int:
    code = 0
    for v in votes(text):
        code = 3 * code + v
    return code


def unpack(code: int) -> tuple[int, ...]:
    out = []
    for _ in LABELLERS:
        out.append(code % 3)
        code //= 3
    return tuple(reversed(out))


def em(counts: dict[int, int], iterations: int = 100) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of good for each pattern, and rates[class, labeller, vote] among the votes cast, from the counts.

    The start is the share of good among the votes cast, so class 1 is the good one; without
    any vote it is a half.
    """
    codes = sorted(counts)
    if not codes:
        return {}, np.full((2, len(LABELLERS), 2), 0.5)
    cast = np.array([unpack(c) for c in codes])
    n = np.array([counts[c] for c in codes], "f8")
    good, junk = (cast == GOOD).sum(1), (cast == JUNK).sum(1)
    # One junk vote weighs as much as three good ones: each labeller looks for one kind of junk.
    post = (good + 0.5) / (good + 3 * junk + 1)
    rates = np.zeros((2, len(LABELLERS), 2))
    for _ in range(iterations):
        for y, p in ((0, 1 - post), (1, post)):
            w = n * p
            for v in (JUNK, GOOD):
                rates[y, :, v] = (w[:, None] * (cast == v)).sum(0) + 1.0
            rates[y] /= rates[y].sum(1, keepdims=True)
        share = np.clip((n * post).sum() / n.sum(), 1e-6, 1 - 1e-6)
        # A labeller that casts no vote says nothing.
        said = np.log(rates[1] / rates[0])
        odds = np.log(share / (1 - share)) + sum(np.where(cast == v, said[:, v], 0.0).sum(1) for v in (JUNK, GOOD))
        post = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return dict(zip(codes, post.tolist(), strict=True)), rates


_MARKS = ".,;:!?'\"()[]{}*#$%&|<>/\\=+-_~^@`"


def shape(word: str) -> str:
    """``Word,`` -> ``A1,``: the kind of the word inside its marks, its length by fours, the
    first marks after it and whether there are any before it."""
    core = word.strip(_MARKS)
    kind = "" if not core else "9" if core.isdigit() else "AA" if core.isupper() and len(core) > 1 else "A" if core[0].isupper() else "a" if core.isalpha() else "x"
    after = word[len(word.rstrip(_MARKS)) :][:3]
    return f"{kind}{min(len(core) // 4, 5)}{after}{'<' if word[0] in _MARKS else ''}"


def bucket(name: str) -> int:
    return zlib.crc32(name.encode()) & ((1 << BITS) - 1)


class _Weights(dict):
    """word -> its shape's weight, for the words met lately."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = float(self.weights[bucket("s " + shape(word))])
        return value


def _whole(code: int) -> list[int]:
    """Hashed features of the whole text: its votes."""
    return [bucket(f"v{i} {v}") for i, v in enumerate(unpack(code))]


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.words = weights, bias, _Weights(weights)

    def score(self, text: str | None, code: int) -> float:
        w = (text or "").split()
        z = self.bias + float(self.weights[_whole(code)].sum())
        if w:
            z += sum(map(self.words.__getitem__, w)) / len(w)
        return float(1 / (1 + np.exp(-max(-50.0, min(50.0, z)))))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        codes, index, value = [], [], []
        for text in b.column(0).to_pylist():
            code, words = pattern(text), (text or "").split()
            at, n = np.unique(np.array([bucket("s " + shape(w)) for w in words], "u4"), return_counts=True)
            codes.append(code)
            index.append(np.concatenate([at, _whole(code)]).astype("<u4").tobytes())
            value.append(np.concatenate([n / max(len(words), 1), np.ones(len(LABELLERS))]).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(index, pa.binary()), pa.array(value, pa.binary())], names=["code", "at", "value"])


def fit(rows: list[tuple[int, bytes, bytes]], posterior: dict[int, float], iterations: int = 120) -> tuple[np.ndarray, float]:
    """Weights and bias of the scorer, from (pattern, feature indexes, values) rows."""
    weights = np.zeros(1 << BITS, "f4")
    if not rows:
        return weights, 0.0
    y = np.array([posterior.get(r[0], 0.5) for r in rows])
    index = [np.frombuffer(r[1], "<u4") for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(i) for i in index])
    used, col = np.unique(np.concatenate(index), return_inverse=True)
    value = np.concatenate([np.frombuffer(r[2], "<f4") for r in rows]).astype("f8")
    w, bias, m, v, mb, vb = np.zeros(len(used)), 0.0, np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, iterations + 1):
        z = np.bincount(row, value * w[col], len(y)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
        grad = np.bincount(col, value * error[row], len(used)) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.99 * vb + 0.01 * error.sum() ** 2
        rate = 0.1 / (1 + step / 50)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-9)
    weights[used] = w
    return weights, float(bias)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from collections import Counter

    seen: Counter[int] = Counter()
    for b in batches:
        seen.update(map(pattern, b.column(0).to_pylist()))
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["code", "n"])


def train(docs: DataFrame, max_sample: int = MAX_SAMPLE) -> tuple[dict[int, float], np.ndarray, float, np.ndarray]:
    """(posterior of each pattern, weights, bias, labeller rates) from ``docs`` (text)."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_patterns, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    posterior, rates = em({r.code: r.n for r in counted})
    # A hash of the text picks the sample; it is at most max_sample numbers, so they go to every task.
    order = F.xxhash64("text", F.lit("quality sample"))
    chosen = texts.select(order.alias("h")).distinct().orderBy("h").limit(max_sample)
    sample = texts.withColumn("h", order).join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("text")
    rows = sorted((r.code, bytes(r["at"]), bytes(r["value"])) for r in sample.mapInArrow(_features, "code long, at binary, value binary").collect())
    weights, bias = fit(rows, posterior)
    return posterior, weights, bias, rates


def score_texts(df: DataFrame, posterior: dict[int, float], weights: np.ndarray, bias: float) -> DataFrame:
    """``df`` with score (0 to 1, higher: better), keep, posterior and votes for its ``text``.

    Null counts as empty; repeated rows get equal results; columns of these names are replaced.
    """
    new = ("score", "keep", "posterior", "votes")
    df = df.drop(*new)
    sent = df.sparkSession.sparkContext.broadcast((posterior, weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        post, w, b0 = sent.value
        scorer = Scorer(w, b0)
        for b in batches:
            scores, posts, cast = [], [], []
            for text in b.column(b.schema.get_field_index("text")).to_pylist():
                code = pattern(text)
                scores.append(scorer.score(text, code))
                posts.append(post.get(code, 0.5))
                cast.append("".join("-+."[v] for v in unpack(code)))
            columns = [pa.array(scores, pa.float64()), pa.array([s >= THRESHOLD for s in scores], pa.bool_()), pa.array(posts, pa.float64()), pa.array(cast, pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*b.schema.names, *new])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{schema}, score double, keep boolean, posterior double, votes string")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    posterior, weights, bias, _ = train(docs)
    return score_texts(docs, posterior, weights, bias).drop("text")
