"""Toxicity by a counterfactually regularised hashed linear classifier.

A text's score is the logistic of a bias plus, for each distinct word, the weights of the
word and of its beginnings (hashed).  The fit minimises the weighted log loss over labelled
texts plus the mean squared change of score when an identity term is swapped for another of its
set or left out.  The swaps are those of the terms that labelled sentences hold, and one swap-in
per labelled text: a term of a set, chosen by a hash of the text, is put into a sentence and
swapped and left out there.  The score is linear in the words, so a change does not depend on
the rest of the sentence, and equal swaps merge into one with a count.  A term that only keeps
bad company in the labelled texts so gets no weight of its own, and neutral mentions of a group
keep the score of their sentence.

Bounds: the fit sees at most MAX_PER_CLASS labelled texts of each class, chosen by a hash of
the id over all labelled rows.  Features are counted by the executors; the driver receives the
features that tell the classes apart and the texts' counts of these.  All documents are scored,
whole, in one pass without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import materialise, table

BITS = 18
#: Labelled texts of each class that a fit may use at most.
MAX_PER_CLASS = 4000
#: Lengths of word beginnings that are features.
PREFIXES = (4, 5, 6)
#: Weights of the penalties on the weights themselves and on counterfactual changes.
L2, COUNTERFACTUAL = 1e-4, 5.0
#: Least z value of the difference of a feature's frequency between the classes.
LEAST_Z = 3.0
THRESHOLD = 0.3

#: Interchangeable terms, by set; a parameter of ``fit``.
IDENTITY_SETS: tuple[tuple[str, ...], ...] = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "transgender"),
    ("immigrants", "refugees", "migrants", "foreigners"), ("disabled", "deaf", "blind", "elderly", "young"),
    ("american", "chinese", "mexican", "french", "german", "spanish", "russian", "turkish", "polish", "indian"),
    ("frauen", "männer", "juden", "christen", "muslime", "türken", "ausländer", "flüchtlinge"),
    ("femmes", "hommes", "juifs", "chrétiens", "musulmans", "arabes", "étrangers", "immigrés"),
    ("mujeres", "hombres", "judíos", "cristianos", "musulmanes", "gitanos", "extranjeros", "inmigrantes"),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word."""
    names = [f"w {word}", *(f"p{k} {word[:k]}" for k in PREFIXES if len(word) >= k)]
    return [zlib.crc32(x.encode()) & ((1 << BITS) - 1) for x in names]


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


class _Sums(dict):
    """word -> sum of its weights, for the words met lately."""

    LIMIT = 400_000

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = float(sum(self.weights[features(word)]))
        return value


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.sums, self.bias = _Sums(weights), bias

    def score(self, text: str | None) -> float:
        # Words in order, so that equal texts get equal sums everywhere.
        z = self.bias + sum(map(self.sums.__getitem__, sorted(w for w in words(text) if self.sums[w])))
        return float(1 / (1 + np.exp(-max(-60.0, min(60.0, z)))))


def swaps(text: str | None, sets=IDENTITY_SETS) -> list[tuple[str, str]]:
    """(term, what replaces it; empty: left out) for each mention in the text's sentences, and
    for the swap-in of a text that has words."""
    place = {t: s for s in sets for t in s}
    low = (text or "").lower()
    out = []
    for sentence in _SENTENCE.split(low):
        for t in sorted(place.keys() & set(_WORD.findall(sentence))):
            out += [(t, ""), *((t, x) for x in place[t] if x != t)]
    if sets and _WORD.search(low):
        at = zlib.crc32(low.encode())
        terms = sets[at % len(sets)]
        a = (at // len(sets)) % len(terms)
        out += [(terms[a], ""), (terms[a], terms[(a + 1) % len(terms)])]
    return out


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, hashed features, their counts, swaps) of labelled texts."""
    for batch in batches:
        labels, feats, counts, pairs = [], [], [], []
        for label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found, n = np.unique(np.array([x for w in words(text) for x in features(w)], "<u4"), return_counts=True)
            labels.append(label)
            feats.append(found.tobytes())
            counts.append(n.astype("<u4").tobytes())
            pairs.append(["|".join(x) for x in swaps(text)])
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(feats, pa.binary()), pa.array(counts, pa.binary()), pa.array(pairs, pa.list_(pa.string()))], names=["label", "feats", "counts", "pairs"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros((2, 1 << BITS), "i8")
    for batch in batches:
        for label, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            df[int(label > 0), np.frombuffer(found, "<u4")] += 1
    some = np.flatnonzero(df.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[0, some], pa.int64()), pa.array(df[1, some], pa.int64())], names=["i", "n0", "n1"])


def labelled(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """(label, text) of the training sample.  Ids with several labels count as toxic if any is;
    rows without an id or label are left out; labels without a document give no row."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    order = F.xxhash64("doc_id", F.lit("toxicity sample"))
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(order, "doc_id").limit(max_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * max_per_class pairs of numbers, so they go to every task.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("label").cast("int").alias("label"), F.col("text").cast("string").alias("text"))


class Problem:
    """The labelled texts over some features (columns), and the swaps, as sparse matrices."""

    def __init__(self, columns: np.ndarray, rows: list[tuple[int, np.ndarray, np.ndarray]], pairs: dict[tuple[str, str], int]):
        self.columns = columns
        self.y = np.array([r[0] for r in rows], "f8")
        n1 = self.y.sum()
        # Balanced: each class has half of the weight; the scores are set for the prior afterwards.
        self.weight = np.where(self.y == 1, 0.5 / max(n1, 1), 0.5 / max(len(self.y) - n1, 1))
        self.row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
        self.col = np.searchsorted(columns, np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, "i8"))
        self.value = np.concatenate([r[2] for r in rows]).astype("f8") if rows else np.zeros(0)
        self.share = np.array(list(pairs.values()), "f8") / max(sum(pairs.values()), 1)
        row, col, sign = [], [], []
        for i, pair in enumerate(pairs):
            for term, by in zip(pair, (1.0, -1.0), strict=True):
                for at in self._places(term):
                    row.append(i)
                    col.append(at)
                    sign.append(by)
        self.swap_row, self.swap_col, self.swap_sign = np.array(row, "i8"), np.array(col, "i8"), np.array(sign)

    def _places(self, term: str) -> list[int]:
        found = np.array(features(term) if term else [], "i8")
        at = np.searchsorted(self.columns, found)
        return [int(a) for a, f in zip(at, found, strict=True) if a < len(self.columns) and self.columns[a] == f]

    def scores(self, w: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.col], len(self.y)) + bias

    def objective(self, w: np.ndarray, bias: float) -> tuple[float, np.ndarray, float]:
        """Value, and slopes by weights and bias."""
        z = np.clip(self.scores(w, bias), -60, 60)
        error = self.weight * (1 / (1 + np.exp(-z)) - self.y)
        change = np.bincount(self.swap_row, self.swap_sign * w[self.swap_col], len(self.share))
        value = (self.weight * (np.logaddexp(0, z) - self.y * z)).sum() + L2 / 2 * (w @ w) + COUNTERFACTUAL * (self.share * change**2).sum()
        slope = np.bincount(self.col, self.value * error[self.row], len(w)) + L2 * w
        slope += 2 * COUNTERFACTUAL * np.bincount(self.swap_col, self.swap_sign * (self.share * change)[self.swap_row], len(w))
        return float(value), slope, float(error.sum())


def fit(problem: Problem, prior: float, iterations: int = 600) -> tuple[np.ndarray, float]:
    """Weights and bias.  ``prior``: the share of toxic rows among all labelled rows."""
    weights, y = np.zeros(1 << BITS, "f4"), problem.y
    if not len(y) or y.min() == y.max():
        return weights, float(np.log((prior + 1e-3) / (1 - prior + 1e-3)))
    w, bias = np.zeros(len(problem.columns)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, iterations + 1):
        _, grad, by_bias = problem.objective(w, bias)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * by_bias, 0.99 * vb + 0.01 * by_bias**2
        rate = 0.1 / (1 + step / 50)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    slope, shift = calibrate(problem.scores(w, bias), y, min(max(prior, 1e-3), 1 - 1e-3))
    weights[problem.columns] = slope * w
    return weights, float(slope * bias + shift)


def calibrate(z: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift that make slope * z + shift the log odds at the given prior (Platt
    scaling with its smoothed targets, by Newton steps)."""
    n1, n0 = y.sum(), len(y) - y.sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, prior / n1, (1 - prior) / n0)
    a, b = 1.0, float(np.log(prior / (1 - prior)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        g, h = weight * (p - goal), weight * p * (1 - p) + 1e-9 * weight
        ga, gb = (g * z).sum(), g.sum()
        haa, hab, hbb = (h * z * z).sum() + 1e-9, (h * z).sum(), h.sum() + 1e-9
        det = haa * hbb - hab * hab
        if det <= 1e-15:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db) / 3)
        a, b = a - da / size, b - db / size
    return (a, b) if a > 0 else (1.0, float(np.log(prior / (1 - prior))))


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> tuple[np.ndarray, float]:
    """Fit on the bounded sample of ``labels`` joined to ``docs``."""
    counts = labels.where(F.col("toxic").isNotNull()).agg(F.count("*").alias("n"), F.sum(F.col("toxic").cast("double")).alias("s")).first()
    sample = labelled(docs, labels, max_per_class).mapInArrow(_sparse, "label int, feats binary, counts binary, pairs array<string>")
    sample = materialise(sample)
    size = {bool(r.label): r["count"] for r in sample.groupBy(F.col("label") > 0).count().toDF("label", "count").collect()}
    n0, n1 = size.get(False, 0), size.get(True, 0)
    # Features whose frequencies differ between the classes by more than chance.
    p0, p1 = (F.col("n0") + 0.5) / (n0 + 1), (F.col("n1") + 0.5) / (n1 + 1)
    spread = F.greatest(p1 * (1 - p1), F.lit(1e-6)) / max(n1, 1) + F.greatest(p0 * (1 - p0), F.lit(1e-6)) / max(n0, 1)
    df = sample.select("label", "feats").mapInArrow(_frequencies, "i long, n0 long, n1 long").groupBy("i").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    telling = df.where(F.abs(p1 - p0) / F.sqrt(spread) > LEAST_Z).select("i").toArrow().column("i").to_numpy()
    identity = [x for s in IDENTITY_SETS for t in s for x in features(t)]
    columns = np.unique(np.concatenate([telling, np.array(identity, "i8")]))
    sent = docs.sparkSession.sparkContext.broadcast(columns)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            feats, values = [], []
            for found, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found, n = np.frombuffer(found, "<u4").astype("i8"), np.frombuffer(n, "<u4")
                kept = np.isin(found, sent.value, assume_unique=True)
                feats.append(found[kept].astype("<u4").tobytes())
                values.append(n[kept].tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(feats, pa.binary()), pa.array(values, pa.binary())], names=["label", "feats", "counts"])

    rows = sample.select("label", "feats", "counts").mapInArrow(chosen, "label int, feats binary, counts binary").collect()
    rows = [(int(label > 0), np.frombuffer(f, "<u4").astype("i8"), np.frombuffer(n, "<u4")) for label, f, n in sorted((r.label, bytes(r.feats), bytes(r.counts)) for r in rows)]
    pairs = Counter({tuple(r.pair.split("|")): r["count"] for r in sample.select(F.explode("pairs").alias("pair")).groupBy("pair").count().orderBy("pair").collect()})
    return fit(Problem(columns, rows, pairs), (counts.s or 0.0) / counts.n if counts.n else 0.0)


def neutral_false_positives(texts: list[str], model: Model, sets=IDENTITY_SETS) -> tuple[int, int]:
    """(mentions, mentions that turn a text that is not rejected into one that is): each term of
    ``sets`` put at the end of each text, for measurements."""
    mentions = wrong = 0
    for text in texts:
        if model.score(text) >= THRESHOLD:
            continue
        for term in (t for s in sets for t in s):
            mentions += 1
            wrong += model.score(f"{text} {term}") >= THRESHOLD
    return mentions, wrong


def score_texts(df: DataFrame, weights: np.ndarray, bias: float, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the score (0 to 1) of its column ``text``; null counts as empty.  A column
    named ``out`` is replaced."""
    sent = df.sparkSession.sparkContext.broadcast(weights)
    df = df.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(sent.value, bias)
        for b in batches:
            at = b.schema.get_field_index(text)
            scores = pa.array([model.score(x) for x in b.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], names=[*b.schema.names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{schema}, `{out}` double")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels are learned only from rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights, bias = train(docs, labels.where(~held_out()))
    scored = score_texts(docs.select("doc_id", "text"), weights, bias)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose score stays below the threshold."""
    labels = table(spark, sf_dir, "labels")
    weights, bias = train(docs, labels.where(~held_out()))
    return score_texts(docs, weights, bias, out="__score").where(F.col("__score") < THRESHOLD).select(*docs.columns)
