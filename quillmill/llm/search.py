"""Exact top-k search by BM25 over sharded inverted indexes with block-max WAND pruning.

Every task turns its documents into shards of at most SHARD_DOCS documents and SHARD_POSTINGS
postings: sorted terms, postings and lengths, compressed, one row each.  Document counts,
average length and the queries' document frequencies are summed over all shards, so every
shard scores with the global statistics.

In a shard, documents stand in blocks of BLOCK_DOCS, and every term has the maximum of its
impacts in each block in which it occurs.  A block's sum of the query's terms' maxima bounds the
scores in it.  Documents are taken in order, many queries at a time: a query's pivot is the next
block whose bound reaches the k-th best score that it has found (a bound by the terms' maxima
over the whole list is never less, so it needs no look of its own).  Blocks before the pivot are
passed over without touching their postings.  In the pivot's block all documents get a score
in single precision, whose error is bounded; the k-th best of these rounded down is the threshold,
and in the end the documents that reach it rounded up are scored term by term.  The merged lists
are the exact top k; ties go to the lesser id.

One shard in SEED_SHARE is searched first; the k-th best score of each query in these is the
threshold with which all other shards start, and below which they return nothing.  So the rows
that travel are few beyond k a query.

Queries are taken in blocks of at most BLOCK_TERMS terms, which go to every task.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.llm.common import materialise, table
from quillmill.llm.decontaminate import WordHashes, tokens

K1, B = 1.2, 0.75
TOP_K = 10
SHARD_DOCS, SHARD_POSTINGS = 4096, 4_000_000
BLOCK_DOCS = 32
#: A term is frequent in a shard if one document of so many has it; queries in one product.
FREQUENT, BATCH = 24, 512
#: More than the relative error of a sum of 10,000 terms in single precision.
ROUND_UP = 1 + 1e-3
#: One shard of so many is searched first, for thresholds.
SEED_SHARE = 8
#: Terms of the queries that are searched in one pass.
BLOCK_TERMS = 2_000_000

_INDEX_SCHEMA = "n_docs long, total_length long, ids binary, lengths binary, terms binary, starts binary, docs binary, tfs binary"


def _pack(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _terms(hashes: WordHashes, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(hashes.of(words), return_counts=True)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    held: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    postings = 0

    def shard() -> pa.RecordBatch:
        # Documents whose most frequent term is the same (texts of one language) stand together.
        held.sort(key=lambda d: (int(d[2][np.argmax(d[3])]) if len(d[2]) else 0, d[1], d[0]))
        size = [len(d[2]) for d in held]
        term = np.concatenate([d[2] for d in held])
        doc = np.repeat(np.arange(len(held), dtype="<u4"), size)
        tf = np.minimum(np.concatenate([d[3] for d in held]), 2**32 - 1).astype("<u4")
        order = np.argsort(term, kind="stable")
        names, starts = np.unique(term[order], return_index=True)
        row = {
            "n_docs": len(held), "total_length": sum(d[1] for d in held), "ids": _pack(np.array([d[0] for d in held], "<i8")),
            "lengths": _pack(np.array([d[1] for d in held], "<u4")), "terms": _pack(names), "starts": _pack(np.append(starts, len(term)).astype("<u4")),
            "docs": _pack(doc[order].astype("<u2")), "tfs": _pack(tf[order]),
        }
        held.clear()
        return pa.RecordBatch.from_pylist([row])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = tokens(text)
            names, counts = _terms(hashes, words)
            if held and postings + len(names) > SHARD_POSTINGS:
                yield shard()
                postings = 0
            held.append((doc_id, len(words), names, counts))
            postings += len(names)
            if len(held) >= SHARD_DOCS:
                yield shard()
                postings = 0
    if held:
        yield shard()


def build_index(docs: DataFrame) -> DataFrame:
    """Shards of ``docs`` (doc_id, text), one row each.  Rows without an id cannot be found and
    are left out; null and empty texts are documents without terms; repeated rows stay."""
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_index, _INDEX_SCHEMA)


class Shard:
    """A shard ready for scoring with the global average length.

    ``passed`` and ``met`` count (query, block) pairs; with ``counting``, ``skipped`` and
    ``touched`` count the postings of rarer terms in them.
    """

    def __init__(self, row: dict, average: float, counting: bool = False):
        self.ids = _unpack(row["ids"], "<i8")
        lengths = _unpack(row["lengths"], "<u4").astype("f8")
        self.terms, starts = _unpack(row["terms"], "<u8"), _unpack(row["starts"], "<u4").astype("i8")
        self.docs = _unpack(row["docs"], "<u2").astype("i8")
        tf = _unpack(row["tfs"], "<u4").astype("f8")
        norm = K1 * (1 - B + B * lengths / average)
        self.impact = tf * (K1 + 1) / (tf + norm[self.docs])
        self.n_blocks = -(-len(self.ids) // BLOCK_DOCS)
        self.passed = self.met = self.skipped = self.touched = 0
        self.counting = counting
        self.local = self.docs % BLOCK_DOCS
        term = np.repeat(np.arange(len(self.terms)), np.diff(starts))
        self.key = term << 16 | self.docs
        # An entry is a term in a block: its postings and the maximum of their impacts.
        place = term * self.n_blocks + self.docs // BLOCK_DOCS
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, "i8")
        self.entry = np.append(first, len(place))
        self.entry_block = self.docs[first] // BLOCK_DOCS
        self.entry_max = np.maximum.reduceat(self.impact, first) if len(first) else np.zeros(0)
        self.entries = np.searchsorted(term[first], np.arange(len(self.terms) + 1))
        # Frequent terms: row of the matrices for each term, else -1.
        frequent = np.flatnonzero(np.diff(starts) * FREQUENT >= len(self.ids))
        self.row = np.full(len(self.terms), -1)
        self.row[frequent] = np.arange(len(frequent))
        self.matrix = np.zeros((len(frequent), self.n_blocks * BLOCK_DOCS), "f4")
        posts, of = _ranges(starts[frequent], starts[frequent + 1])
        self.matrix[of, self.docs[posts]] = self.impact[posts]
        self.maxima = self.matrix.reshape(len(frequent), self.n_blocks, BLOCK_DOCS).max(axis=2, initial=0)

    def search(self, queries: list[tuple[int, np.ndarray, np.ndarray]], heaps: list[list[tuple[float, int]]], k: int, floors: np.ndarray | None = None) -> None:
        """Put the shard's best for each (id, terms, weights) into its heap of (score, -id), at
        most k long; scores below the query's floor may be left out."""
        if not len(self.terms):
            return
        for start in range(0, len(queries), BATCH):
            batch = queries[start : start + BATCH]
            self._batch(batch, heaps[start : start + BATCH], k, np.zeros(len(batch)) if floors is None else floors[start : start + BATCH])

    def _batch(self, batch, heaps, k: int, floors: np.ndarray) -> None:
        n_blocks = self.n_blocks
        known, some, entries, pair_weight = [], [], [], []
        weights = np.zeros((len(batch), len(self.matrix)), "f4")
        for i, (_, names, weight) in enumerate(batch):
            at = np.searchsorted(self.terms, names)
            at[at == len(self.terms)] = 0
            hit = self.terms[at] == names
            at, weight = at[hit], weight[hit]
            row = self.row[at]
            weights[i, row[row >= 0]] = weight[row >= 0]
            rare = np.flatnonzero(row < 0)
            found, of = _ranges(self.entries[at[rare]], self.entries[at[rare] + 1])
            some.append(np.full(len(found), i))
            entries.append(found)
            pair_weight.append(weight[rare][of])
            known.append((at, weight))
        query, entry, pair_weight = np.concatenate(some), np.concatenate(entries), np.concatenate(pair_weight)
        bounds = (weights @ self.maxima) * ROUND_UP
        bounds = bounds + np.bincount(query * n_blocks + self.entry_block[entry], pair_weight * self.entry_max[entry] * (1 + 1e-9), len(batch) * n_blocks).reshape(len(batch), n_blocks)
        block = self.entry_block[entry].astype("u2")
        order = np.argsort(block, kind="stable")
        query, entry, pair_weight = query[order], entry[order], pair_weight[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(block, minlength=n_blocks))])
        # The k best lower bounds of scores met so far, for each query; the least is its threshold.
        lower = np.zeros((len(batch), k))
        for i, heap in enumerate(heaps):
            lower[i, : len(heap)] = [score for score, _ in heap]
        least = np.maximum(floors, lower.min(axis=1))
        line = np.empty(len(batch), "i8")
        candidates = []
        for block in range(n_blocks):
            # The queries whose pivot is this block.
            here = np.flatnonzero((bounds[:, block] >= least) & (bounds[:, block] > 0))
            part = slice(ends[block], ends[block + 1])
            self.passed += len(batch) - len(here)
            self.met += len(here)
            line.fill(-1)
            line[here] = np.arange(len(here))
            to, of = line[query[part]], entry[part]
            seen = np.flatnonzero(to >= 0)
            if self.counting:
                sizes = self.entry[of + 1] - self.entry[of]
                self.touched += int(sizes[seen].sum())
                self.skipped += int(sizes.sum() - sizes[seen].sum())
            if not len(here):
                continue
            scores = weights[here] @ self.matrix[:, block * BLOCK_DOCS : (block + 1) * BLOCK_DOCS]
            of = of[seen]
            posts, which = _ranges(self.entry[of], self.entry[of + 1])
            adds = self.impact[posts] * pair_weight[part][seen][which]
            scores = scores + np.bincount(to[seen][which] * BLOCK_DOCS + self.local[posts], adds, len(here) * BLOCK_DOCS).reshape(len(here), BLOCK_DOCS)
            good = (scores * ROUND_UP >= least[here][:, None]) & (scores > 0)
            some = np.flatnonzero(good.any(axis=1))
            if not len(some):
                continue
            at, doc = np.nonzero(good)
            candidates.append((here[at], doc + block * BLOCK_DOCS, scores[at, doc] * ROUND_UP))
            rows = here[some]
            lower[rows] = -np.partition(-np.concatenate([lower[rows], scores[some] / ROUND_UP], axis=1), k - 1, axis=1)[:, :k]
            least[rows] = np.maximum(floors[rows], lower[rows].min(axis=1))
        if candidates:
            of, doc, upper = (np.concatenate(c) for c in zip(*candidates, strict=True))
            kept = np.flatnonzero(upper >= least[of])
            kept = kept[np.argsort(of[kept], kind="stable")]
            of, doc = of[kept], doc[kept]
            for part in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1):
                if len(part):
                    q = int(of[part[0]])
                    self._score(doc[part], *known[q], heaps[q], k, floors[q])

    def _score(self, docs: np.ndarray, at: np.ndarray, weight: np.ndarray, best: list[tuple[float, int]], k: int, floor: float) -> None:
        """Full scores of ``docs``, summed in the order of the query's terms, so that equal texts
        get equal scores in any shard."""
        keys = (at << 16)[:, None] | docs
        place = np.searchsorted(self.key, keys)
        place[place == len(self.key)] = 0
        parts = np.where(self.key[place] == keys, self.impact[place], 0.0) * weight[:, None]
        # A running sum adds one by one, whatever the shape.
        total = np.cumsum(parts, axis=0)[-1]
        for d, score in zip(docs.tolist(), total.tolist(), strict=True):
            if score <= 0 or score < floor:
                continue
            entry = (score, -int(self.ids[d]))
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges in order, and the range of each."""
    size = ends - starts
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + starts[of], of


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        got = [_terms(hashes, tokens(t)) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(n) for n, _ in got], pa.int64()), pa.array([n.astype("<u8").tobytes() for n, _ in got], pa.binary()), pa.array([c.astype("<u4").tobytes() for _, c in got], pa.binary())],
            names=["line", "query_id", "n_terms", "terms", "counts"],
        )


_RESULT = "line long, query_id long, doc_id long, score double"


def _weighted(index: DataFrame, queries: list, n_docs: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(line, terms, weights) of queries, weighted by document frequencies over all shards."""
    names = np.unique(np.concatenate([np.frombuffer(q.terms, "<u8") for q in queries])) if queries else np.zeros(0, "u8")
    sent = index.sparkSession.sparkContext.broadcast(names)

    def frequencies(batches):
        total = np.zeros(len(sent.value), "i8")
        for b in batches:
            for terms, starts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                terms, sizes = _unpack(terms, "<u8"), np.diff(_unpack(starts, "<u4").astype("i8"))
                at = np.searchsorted(sent.value, terms)
                at[at == len(total)] = 0
                hit = sent.value[at] == terms if len(total) else np.zeros(len(terms), bool)
                total[at[hit]] += sizes[hit]
        some = np.flatnonzero(total)
        for at in range(0, len(some), 100_000):
            part = some[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(total[part], pa.int64())], names=["i", "n"])

    df = np.zeros(len(names))
    counted = index.select("terms", "starts").mapInArrow(frequencies, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    df[counted.column("i").to_numpy()] = counted.column("n").to_numpy()
    idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    out = []
    for q in sorted(queries, key=lambda q: q.line):
        own = np.frombuffer(q.terms, "<u8")
        out.append((q.line, q.query_id, own, idf[np.searchsorted(names, own)] * np.frombuffer(q.counts, "<u4")))
    return out


def _search_shards(index: DataFrame, sent, average: float, k: int, floors: np.ndarray) -> DataFrame:
    """Each task's best k of its shards for each of the broadcast queries, none below its floor."""

    def run(batches):
        queries = [(line, names, weights) for line, _, names, weights in sent.value]
        best: list[list] = [[] for _ in queries]
        for b in batches:
            for row in b.to_pylist():
                Shard(row, average).search(queries, best, k, floors)
        rows = [(q[0], q[1], -i, s) for q, heap in zip(sent.value, best, strict=True) for s, i in heap]
        for at in range(0, len(rows), 50_000):
            part = list(zip(*rows[at : at + 50_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["line", "query_id", "doc_id", "score"])

    return index.mapInArrow(run, _RESULT)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("line").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(index: DataFrame, queries: list, n_docs: int, average: float, k: int) -> DataFrame:
    """The best k of each of the (bounded) queries, in two rounds."""
    ready = _weighted(index, queries, n_docs)
    sent = index.sparkSession.sparkContext.broadcast(ready)
    seed = F.pmod(F.xxhash64("ids"), F.lit(SEED_SHARE)) == 0
    first = materialise(_best(_search_shards(index.where(seed), sent, average, k, np.zeros(len(ready))), k).drop("rank"))
    # At most one number per query of the block.
    full = first.groupBy("line").agg(F.min("score").alias("s"), F.count("*").alias("n")).where(F.col("n") == k).select("line", "s").toArrow()
    floors = np.zeros(len(ready))
    lines = np.array([q[0] for q in ready], "i8")
    floors[np.searchsorted(lines, full.column("line").to_numpy())] = full.column("s").to_numpy()
    return first.unionByName(_search_shards(index.where(~seed), sent, average, k, floors))


def top_k(docs: DataFrame, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best of ``docs`` (doc_id, text) for each of
    ``queries`` (query_id, text).

    Terms are lower-case runs of letters, digits and underscores; a query term counts as often
    as it occurs.  Only documents with a term of the query are returned, so null and empty
    queries have no rows.  A query id that occurs in several rows is one query per row, each
    with its ranks; repeated documents are listed as often as they occur.
    """
    index = materialise(build_index(docs))
    stats = index.agg(F.sum("n_docs").alias("n"), F.sum("total_length").alias("l")).first()
    n_docs, average = stats.n or 0, max((stats.l or 0) / max(stats.n or 0, 1), 1e-9)
    rows = queries.where("query_id IS NOT NULL").select(F.monotonically_increasing_id().alias("line"), F.col("query_id").cast("long").alias("query_id"), F.col("text").cast("string").alias("text"))
    asked = materialise(rows.mapInArrow(_queries, "line long, query_id long, n_terms long, terms binary, counts binary").where("n_terms > 0"))
    total = asked.agg(F.coalesce(F.sum("n_terms"), F.lit(0)).alias("n")).first().n
    blocks = max(1, math.ceil(total / BLOCK_TERMS * 1.25))
    found = None
    for block in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("line"), F.lit(blocks)) == block)
        got = _search_block(index, part.collect(), n_docs, average, k)
        found = got if found is None else found.unionByName(got)
    return _best(found, k).select("query_id", "rank", "doc_id", "score")


def brute_force(docs: list[tuple[int, str]], queries: list[tuple[int, str]], k: int = TOP_K) -> list[tuple[int, int, int]]:
    """(query_id, rank, doc_id) by scoring everything; for tests."""
    bags = [(i, Counter(tokens(t))) for i, t in docs]
    average = sum(b.total() for _, b in bags) / max(len(bags), 1)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for qid, text in queries:
        scores = []
        for i, b in bags:
            s = sum(n * math.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * (K1 + 1) / (b[w] + K1 * (1 - B + B * b.total() / average)) for w, n in Counter(tokens(text)).items() if b[w])
            if s > 0:
                scores.append((-round(s, 9), i))
        out += [(qid, r + 1, i) for r, (_, i) in enumerate(sorted(scores)[:k])]
    return out


def op3_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each document whose id is divisible by 100, as a query."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return top_k(docs, docs.where(F.col("doc_id") % 100 == 0).withColumnRenamed("doc_id", "query_id"))
