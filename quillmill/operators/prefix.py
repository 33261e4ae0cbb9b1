"""Candidates for similar sets by a prefix filter, with elements packed for the shuffle.

Sets of one group that are similar share one of their rarest elements in the group: ordered by
frequency, the first ``size - ceil(threshold * size) + 1`` of either.  What a whole group has in
common comes last and makes no pairs.  An element is a hash of 42 bits with its group, and equal
hashes of unequal elements only add candidates.  Elements are counted in ``PARTS`` parts by
hash; they travel there sorted, as differences, and come back, those that several sets have, to
the stretch of sets that they came from.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions.similarity import mixed
from quillmill.operators.tables import written

#: Parts of the elements; elements of a stretch of sets.
PARTS, STRETCH = 1024, 1 << 20


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of 32 bits, of one length, with like bytes side by side."""
    return zlib.compress(b"".join(np.ascontiguousarray(a.astype("<u4").view("u1").reshape(-1, 4).T).tobytes() for a in arrays), 1)


def _unpacked(blob: bytes, n: int) -> list[np.ndarray]:
    planes = np.frombuffer(zlib.decompress(blob), "u1").reshape(n, 4, -1)
    return [np.ascontiguousarray(p.T).view("<u4").reshape(-1) for p in planes]


def _stretch(ids: list[int], groups: list[int], sets: list[np.ndarray]) -> pd.DataFrame:
    """Rows (stretch, part, blob): the elements of some sets by part, and the sets' ids and sizes
    as a part below 0."""
    size = np.array([len(s) for s in sets])
    number = np.repeat(np.arange(len(sets)), size)
    h = mixed(np.concatenate(sets) ^ mixed(np.array(groups, "i8").view("u8"))[number])
    order = np.argsort(h)
    h, number = h[order], number[order]
    x, part = (h >> np.uint64(22)).astype("u4"), (h >> np.uint64(54)).astype("i4")
    edges = np.searchsorted(part, np.arange(PARTS + 1))
    name = ids[0] ^ groups[0]
    rows = [(name, -1 - (name % PARTS), _packed(np.array(ids, "i8").view("u8") >> np.uint64(32), np.array(ids, "i8").view("u8"), size))]
    for p in range(PARTS):
        a, b = edges[p], edges[p + 1]
        if a < b:
            rows.append((name, p, _packed(np.diff(x[a:b], prepend=np.uint32(0)), number[a:b])))
    return pd.DataFrame(rows, columns=["stretch", "part", "blob"])


def _several(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of a part, the elements that several sets have, with their frequency."""
    part = int(pdf.part.iloc[0])
    if part < 0:
        return pdf
    got = [_unpacked(b, 2) for b in pdf.blob]
    x = [np.cumsum(d, dtype="u4") for d, _ in got]
    _, inverse, counts = np.unique(np.concatenate(x), return_inverse=True, return_counts=True)
    df, at, rows = counts[inverse], 0, []
    for name, xs, (_, number) in zip(pdf.stretch, x, got, strict=True):
        n = df[at : at + len(xs)]
        at, keep = at + len(xs), n > 1
        if keep.any():
            rows.append((name, part, _packed(np.diff(xs[keep], prepend=np.uint32(0)), number[keep], n[keep])))
    return pd.DataFrame(rows, columns=["stretch", "part", "blob"])


def _prefixes(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Of a stretch, (id, size, x) of the elements in prefixes that several sets have."""
    high, low, size = _unpacked(pdf.blob[pdf.part < 0].iloc[0], 3)
    ids = (high.astype("u8") << np.uint64(32) | low).view("i8")
    rest = pdf[pdf.part >= 0]
    if rest.empty:
        return pd.DataFrame({"id": [], "size": [], "x": []})
    got = [_unpacked(b, 3) for b in rest.blob]
    x = np.concatenate([np.uint64(p) << np.uint64(32) | np.cumsum(d, dtype="u4") for p, (d, _, _) in zip(rest.part, got, strict=True)])
    number, df = (np.concatenate([g[k] for g in got]) for k in (1, 2))
    shared = np.bincount(number, minlength=len(ids))
    # Elements that one set alone has come first; only their number matters.
    size = size.astype("i8")
    wanted = size - np.ceil(size * threshold - 1e-9).astype("i8") + 1 - (size - shared)
    keep = wanted[number] > 0
    number, df, x = number[keep], df[keep], x[keep]
    order = np.lexsort((x, df, number))
    number, x = number[order], x[order]
    first = np.searchsorted(number, number)
    few = np.arange(len(number)) - first < wanted[number]
    return pd.DataFrame({"id": ids[number[few]], "size": size[number[few]], "x": x[few].view("i8")})


def _given(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    for i, g, s in zip(*(batch.column(k) for k in ("id", "g", "s")), strict=True):
        yield i.as_py(), g.as_py(), s.values.to_numpy().view("u8")


def alike(rows: DataFrame, threshold: float, sets_of: Callable[[pa.RecordBatch], Iterator[tuple[int, int, np.ndarray]]] = _given) -> DataFrame:
    """(a, b), a < b: ids of sets of one group that may be similar by ``threshold``, none lost.

    ``sets_of``: the (id, the group's hash, distinct 64-bit hashes) of a batch of ``rows``, as
    columns id, g and s where it is not given; an id may be in several groups.
    """

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n = [], 0
        for batch in batches:
            for row in sets_of(batch):
                if len(row[2]):
                    rows.append(row)
                    n += len(row[2])
                if n >= STRETCH:
                    yield pa.RecordBatch.from_pandas(_stretch(*zip(*rows, strict=True)), schema=schema, preserve_index=False)
                    rows, n = [], 0
        if n:
            yield pa.RecordBatch.from_pandas(_stretch(*zip(*rows, strict=True)), schema=schema, preserve_index=False)

    schema = pa.schema([("stretch", pa.int64()), ("part", pa.int32()), ("blob", pa.binary())])
    packed = "stretch long, part int, blob binary"
    parts = rows.mapInArrow(stretches, packed)
    several = parts.groupBy("part").applyInPandas(_several, packed)
    few = written(several.groupBy("stretch").applyInPandas(lambda pdf: _prefixes(pdf, threshold), "id long, size long, x long"))
    a, b = (few.select("x", F.col("id").alias(k), F.col("size").alias(f"size_{k}")) for k in "ab")
    near = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * threshold - 1e-9
    return a.join(b, "x").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
