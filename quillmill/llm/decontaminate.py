"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by their number of five-word shingles (powers of two).  Each partition
keeps, per item, the k shingles of least hash (a bottom-k MinHash sketch); k is set by the
partition's largest size n so that any text with at least the share THRESHOLD of the item's
shingles must hold one of them: k = n - ceil(THRESHOLD * n) + 1.  The search so loses nothing,
however long the document.  Candidates are verified by the exact share of the item's shingles.

Sizes: documents are read once per block of items and are never shuffled.  A block holds at
most BLOCK_CHARS characters of items and goes to every task; a benchmark beyond that is
searched in several blocks.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import table

SHINGLE = 5
THRESHOLD = 0.8
#: Characters of benchmark items sent to every task at once.
BLOCK_CHARS = 16_000_000

_WORD = re.compile(r"\w+")
_P = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 20


def tokens(text: str | None) -> list[str]:
    """Words in lower case; a word is a run of letters, digits and underscores."""
    return _WORD.findall((text or "").lower())


class WordHashes(dict):
    """word -> 64-bit hash, for the words met lately."""

    LIMIT = 400_000

    def __init__(self):
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = self.hash(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), "u8", len(words))


def shingle_hashes(hashes: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hash of each n consecutive words; texts of fewer words have none."""
    if len(hashes) < n:
        return np.zeros(0, "u8")
    out = np.zeros(len(hashes) - n + 1, "u8")
    for i in range(n):
        out = (out + hashes[i : len(hashes) - n + 1 + i]) * _P
        out ^= out >> np.uint64(31)
    return out


def item_shingles(words: list[str]) -> tuple[int, set[tuple[str, ...]]]:
    """Words per shingle and the set of shingles: an item of fewer than SHINGLE words is one."""
    n = min(SHINGLE, len(words))
    return n, {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class Index:
    """Sketches of a block of items, by shingle width and size partition."""

    def __init__(self, items: list[tuple[int, str]], threshold: float):
        self.threshold, self.items = threshold, []
        self.sketches: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        self.hash = WordHashes()
        for item_id, text in items:
            n, grams = item_shingles(tokens(text))
            if not grams:
                continue
            by_hash = {int(shingle_hashes(self.hash.of(list(g)), n)[0]): g for g in sorted(grams)}
            largest = (1 << len(grams).bit_length()) - 1
            k = largest - math.ceil(threshold * largest) + 1
            for h in sorted(by_hash)[:k]:
                self.sketches[n][h].append(len(self.items))
            self.items.append((item_id, n, grams))
        self.tables = {}
        for n, sketch in self.sketches.items():
            bits = np.zeros(1 << _TABLE_BITS, bool)
            bits[np.fromiter(sketch, "u8", len(sketch)) & np.uint64((1 << _TABLE_BITS) - 1)] = True
            self.tables[n] = bits

    def search(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item id, shingles shared, shingles of the item) of the items that ``text`` contains."""
        words = tokens(text)
        hashes = self.hash.of(words)
        found = []
        for n, sketch in self.sketches.items():
            grams = shingle_hashes(hashes, n)
            near = grams[self.tables[n][grams & np.uint64((1 << _TABLE_BITS) - 1)]]
            candidates = sorted({i for h in near.tolist() if h in sketch for i in sketch[h]})
            if not candidates:
                continue
            own = {tuple(words[p : p + n]) for p in range(len(words) - n + 1)}
            for i in candidates:
                item_id, _, shingles = self.items[i]
                if (shared := len(shingles & own)) >= self.threshold * len(shingles):
                    found.append((item_id, shared, len(shingles)))
        return found


_SCHEMA = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) of all items that documents contain.

    ``items``: item_id, text.  Items and documents without words match nothing; items of fewer
    than five words match as one shingle; repeated documents give repeated rows, repeated items
    (same id and text) count once; an empty side gives an empty result.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, math.ceil(chars / BLOCK_CHARS * 1.2))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        sent = spark.sparkContext.broadcast([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()])

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value, threshold)
            for b in batches:
                rows = [(doc, i, s, n, s / n) for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for i, s, n in index.search(text)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _SCHEMA.split(", ")])

        found = texts.mapInArrow(run, _SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items inside documents."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that contain no benchmark item.

    Row by row, so that rows of the same or no id are each judged by their own text.
    """
    items = table(spark, sf_dir, "benchmark")
    hit = contained_items(docs.select(F.xxhash64("text").alias("doc_id"), "text"), items).select(F.col("doc_id").alias("__h")).distinct()
    return docs.withColumn("__h", F.xxhash64("text")).join(hit, "__h", "left_anti").select(*docs.columns)


OP7_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+') AS w FROM documents
), i AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+') AS w FROM benchmark
), ig AS (
  SELECT DISTINCT item_id, array_to_string(w[p:p + 4], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS p FROM i WHERE len(w) >= 5)
), n AS (SELECT item_id, count(*) AS n FROM ig GROUP BY item_id
), dg AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)
)
SELECT doc_id, item_id, count(*)::BIGINT AS n_shared, any_value(n)::BIGINT AS n_shingles, count(*) / any_value(n)::DOUBLE AS containment
FROM dg JOIN ig USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n)
"""
