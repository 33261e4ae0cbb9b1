"""Near duplicates by BagMinHash over multisets of five-word shingles.

A shingle of weight w owns the weight interval (0, w], cut into (0, 1], (1, 2], (2, 4], (4, 8],
...  Each piece of each shingle has a Poisson process of its own, with the piece's length as
rate, whose points carry a slot of the signature and a place in the piece; points beyond w are
thinned out.  The processes depend on shingle and piece alone, so the least time per slot
agrees between two texts with exactly the probability of their weighted Jaccard similarity.
Points are drawn in order of time and only until they pass the text's largest slot, so light
and heavy shingles cost about the same.

Signatures are banded.  Texts with the same words are one node from the start.  In a band's
bucket every node is first compared with its hub (a star, not all pairs): the node that shares
most buckets with most others, which in a group of copies is what they were copied from.  Links
are verified by exact multiset overlap, and their components found.  Buckets whose nodes are
then in one component are done.  In the others the nodes of different components are compared
in square blocks, by signature and then by exact overlap, so that no link between components
is lost in a bucket, whatever its size.  A pair is compared in the first bucket that it shares,
and a block gives no more links than it has nodes.

With 21 bands of 3, a pair of similarity 0.8 shares no bucket with probability 3e-7; the
signature test (half of the slots) misses it with less than 1e-7.

Sizes: texts are shuffled once (those in a bucket with others are fetched by hash); the rest
moves 250 bytes a text, and 16 bytes a band.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import materialise, table, text_or_empty
from quillmill.llm.decontaminate import SHINGLE, WordHashes, item_shingles, shingle_hashes, tokens

BANDS, ROWS = 21, 3
SLOTS = BANDS * ROWS
THRESHOLD = 0.8
#: Slots that must agree before a pair is verified.
LEAST_EQUAL = SLOTS // 2 + 1
#: Nodes of a bucket in one block of the second comparison, and characters of their texts.
BLOCK, BLOCK_CHARS = 512, 8_000_000

_U64 = np.uint64


def _step(n: int, by: int) -> np.uint64:
    return _U64(n * by & 0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def bag_minhash(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """Signatures (one row of 32-bit values per bag) of non-empty bags (hashes, weights >= 1)."""
    least = np.full(len(bags) * slots, np.inf)
    doc = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    element = np.concatenate([b[0] for b in bags]).astype("u8") if bags else np.zeros(0, "u8")
    weight = np.concatenate([b[1] for b in bags]).astype("i8") if bags else np.zeros(0, "i8")
    seeds, rates, shares, docs = [], [], [], []
    low, high, piece = 0, 1, 0
    while len(element):
        seeds.append(_mix(element + _step(piece + 1, 0xD1B54A32D192ED03)))
        rates.append(np.full(len(element), float(high - low)))
        shares.append(np.minimum((weight - low) / (high - low), 1.0))
        docs.append(doc)
        more = weight > high
        element, weight, doc = element[more], weight[more], doc[more]
        low, high, piece = high, 2 * high, piece + 1
    if not seeds:
        return np.zeros((len(bags), slots), "u4")
    seed, rate, share, doc = map(np.concatenate, (seeds, rates, shares, docs))
    time = np.zeros(len(seed))
    draw = 0
    while len(seed):
        draw += 1
        chance = _mix(seed + _step(2 * draw, 0x9E3779B97F4A7C15))
        time = time - np.log(((chance >> _U64(11)).astype("f8") + 0.5) / 2.0**53) / rate
        live = time < least.reshape(len(bags), slots).max(axis=1)[doc]
        if not live.all():
            seed, rate, share, doc, time = seed[live], rate[live], share[live], doc[live], time[live]
        mark = _mix(seed + _step(2 * draw + 1, 0x9E3779B97F4A7C15))
        slot = ((mark & _U64(0xFFFFFFFF)) % _U64(slots)).astype("i8")
        inside = (mark >> _U64(32)).astype("f8") / 2.0**32 < share
        np.minimum.at(least, doc[inside] * slots + slot[inside], time[inside])
    return (_mix(least.view("u8")) >> _U64(32)).astype("<u4").reshape(len(bags), slots)


def bag(text: str | None) -> Counter:
    """The multiset of five-word shingles; a text of one to four words is one shingle."""
    w = tokens(text)
    n, _ = item_shingles(w[:SHINGLE])
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else Counter()


def overlap(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets; 0 if either is empty."""
    if not a or not b:
        return 0.0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    both = sum(min(n, large[x]) for x, n in small.items() if x in large)
    return both / (a.total() + b.total() - both)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            bags, keys = [], []
            for text in part.column(2).to_pylist():
                w = tokens(text)
                if w:
                    grams = shingle_hashes(hashes.of(w), min(SHINGLE, len(w)))
                    bags.append(np.unique(grams, return_counts=True))
                    keys.append(hashlib.blake2b(" ".join(w).encode(), digest_size=16).digest())
                else:
                    keys.append(None)
            signed = iter(bag_minhash(bags))
            sigs = [None if k is None else next(signed).tobytes() for k in keys]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], names=["doc_id", "text_key", "node", "sig"])


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of (a, b, sig_a, sig_b) whose signatures agree enough."""
    for b in batches:
        if b.num_rows:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), "<u4").reshape(-1, SLOTS) for c in (b.column(2), b.column(3)))
            keep = pa.array((x == y).sum(axis=1) >= LEAST_EQUAL)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of (a, b, text_a, text_b) with enough overlap; rows come sorted by a."""
    last, left = None, Counter()
    for batch in batches:
        out = []
        for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if a != last:
                last, left = a, bag(text_a)
            if overlap(left, bag(text_b)) >= THRESHOLD:
                out.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], names=["a", "b"])


def elements(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The multiset of shingles as a sorted set: the n-th copy of a shingle is an element."""
    w = tokens(text)
    grams, counts = np.unique(shingle_hashes(hashes.of(w), min(SHINGLE, len(w))), return_counts=True)
    parts = [grams]
    for copy in range(2, int(counts.max(initial=1)) + 1):
        parts.append(_mix(grams[counts >= copy] + _step(copy, 0xD1B54A32D192ED03)))
    return np.unique(np.concatenate(parts))


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for b in batches:
        sets = [elements(t, hashes).astype("<u8").tobytes() for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["node", "elements"])


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between components within a block pair; rows (place, i, node, sig, side,
    component, elements) come sorted by place."""

    def links(rows):
        left = [r for r in rows if r[4] == 0]
        right = [r for r in rows if r[4] == 1] or left
        x, y = (np.frombuffer(b"".join(r[3] for r in side), "<u4").reshape(-1, SLOTS) for side in (left, right))
        names = sorted({r[5] for r in rows})
        number = {c: n for n, c in enumerate(names)}
        part, other = (np.array([number[r[5]] for r in side]) for side in (left, right))
        sets = [np.frombuffer(r[6], "<u8") for r in right]
        for i, row in enumerate(left):
            open_ = np.flatnonzero(other != part[i])
            equal = y[open_] == x[i]
            shared = equal.reshape(-1, BANDS, ROWS).all(axis=2)
            # The first shared band decides which bucket compares a pair.
            open_ = open_[(equal.sum(axis=1) >= LEAST_EQUAL) & (shared.argmax(axis=1) == row[1])]
            own = np.frombuffer(row[6], "<u8")
            for j in open_.tolist():
                if other[j] == part[i] or not THRESHOLD <= len(own) / len(sets[j]) <= 1 / THRESHOLD:
                    continue
                at = np.searchsorted(own, sets[j])
                at[at == len(own)] = 0
                both = int((own[at] == sets[j]).sum())
                if both >= THRESHOLD * (len(own) + len(sets[j]) - both):
                    yield row[2], right[j][2]
                    gone, to = other[j], part[i]
                    part[part == gone] = to
                    other[other == gone] = to

    held, out = [], []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][0] != row[0]:
                out += links(held)
                held = []
            held.append(row)
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], names=["a", "b"])
            out = []
    out += links(held) if held else []
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node connected to it, for all nodes in ``edges`` (a, b).

    Alternating large-star and small-star steps; each step is written to the shared folder.
    """

    def undirected(e):
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def mark(e):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = mark(edges)
    while before[0]:
        both = undirected(edges)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # Small star: a node's smaller neighbours, and itself, go to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        edges = materialise(small)
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _text_key(col: str = "text"):
    return F.unhex(F.md5(text_or_empty(col).cast("binary")))


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts overlap enough."""
    a, b = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify, "a binary, b binary")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, node, component) for each row of ``docs`` (doc_id, text).

    Rows with the same component are near duplicates of each other, directly or by way of
    others.  Texts without words (null, empty, marks only) have no node and no component: they
    duplicate nothing.  Repeated rows are copies; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    signed = materialise(docs.select("doc_id", _text_key().alias("text_key"), "text").mapInArrow(_sign, "doc_id long, text_key binary, node binary, sig binary"))
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("text_key").alias("text_key"), F.first("sig").alias("sig"))
    nodes = materialise(nodes)
    width = 4 * ROWS
    keys = F.array(*(F.xxhash64(F.lit(i), F.substring("sig", i * width + 1, width)) for i in range(BANDS)))
    bands = nodes.select("node", F.posexplode(keys).alias("i", "band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = materialise(bands.join(shared, "band"))
    fame = members.groupBy("node").agg(F.sum("n").alias("fame"))
    hubs = members.join(fame, "node").groupBy("band").agg(F.max(F.struct("fame", "node"))["node"].alias("hub"))

    sigs = nodes.select("node", "sig")
    sig_a, sig_b = (sigs.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab")
    stars = members.join(hubs, "band").where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = stars.join(sig_b, "b").join(sig_a, "a").select("a", "b", "sig_a", "sig_b").mapInArrow(_agree, "a binary, b binary")

    fetch = members.select("node").distinct().join(nodes.select("node", "text_key"), "node")
    # Copies are merged before the shuffle, so that a hot text is one row per task.
    texts = docs.select(_text_key().alias("text_key"), "text").dropDuplicates(["text_key"]).join(fetch, "text_key")
    texts = materialise(texts.select("node", "text", F.length("text").cast("long").alias("size")))
    links = materialise(_linked(stars, texts))
    found = materialise(components(links))

    # Buckets that are not in one component: compare across components.
    placed = members.join(found, "node", "left").join(texts.select("node", "size"), "node").select("i", "band", "node", "size", F.coalesce("component", "node").alias("component"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("chars") / BLOCK_CHARS)).cast("int")
    mixed = placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"), F.sum("size").alias("chars"))
    mixed = mixed.where("x != y").select("band", blocks.alias("blocks"))
    rows = materialise(placed.drop("size").join(mixed, "band"))
    sets = rows.select("node").distinct().join(texts, "node").select("node", "text").mapInArrow(_elements, "node binary, elements binary")
    rows = rows.join(sigs, "node").join(sets, "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    rows = rows.select(F.xxhash64("band", low, high).alias("place"), "i", "node", "sig", (F.col("block") > F.col("other")).cast("int").alias("side"), "component", "elements")
    more = materialise(rows.repartition("place").sortWithinPartitions("place").mapInArrow(_cross, "a binary, b binary"))
    if not more.isEmpty():
        found = materialise(components(links.unionByName(more)))
    per_node = signed.select("doc_id", "text_key", "node").join(found, "node", "left")
    return per_node.select("doc_id", "text_key", "node", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size): class_id is the least doc_id of the class; texts without
    words are each their own class."""
    rows = materialise(classes(docs).select("doc_id", "component"))
    # Written first: the join can then split the rows of a large class over tasks.
    sizes = materialise(rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")))
    joined = rows.select("doc_id", "component").join(sizes, "component", "left")
    return joined.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class the row of least id, null ids last; texts without words
    stay; of rows that agree in id and text one stays."""

    def row_key(doc_id, text_key):
        return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")).cast("binary"), text_key)))

    rows = classes(docs)
    kept = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("k")).select("k.doc_id", "k.text_key")
    kept = kept.unionByName(rows.where("component IS NULL").select("doc_id", "text_key")).select(row_key(F.col("doc_id"), F.col("text_key")).alias("__row")).distinct()
    keyed = docs.withColumn("__row", row_key(F.col("doc_id").cast("long"), _text_key()))
    return keyed.join(kept, "__row", "left_semi").dropDuplicates(["__row"]).select(*docs.columns)
