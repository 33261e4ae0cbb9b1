"""Exact and near duplicates among books, and among the chapters of a book."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.similarity import bands, codes_of, equal_share, form_codes, length_ratio, minhash, mixed, shingle_array, window_hashes
from quillmill.functions.text import dedup_form, first_paragraph, is_blank
from quillmill.operators.filters import bloom, held, held_column
from quillmill.operators.prefix import alike
from quillmill.operators.tables import written

LEAST_RATIO, LEAST_SIMILARITY = 0.85, 0.8
#: Characters of a first paragraph that are looked for in other chapters.
KEY = 30


def fingerprint(books: DataFrame, text: str = "text", **options) -> DataFrame:
    """``books`` with hash (md5), fp (signature) and char_count."""
    t = F.coalesce(F.col(text), F.lit(""))
    return books.withColumn("hash", F.md5(t.cast("binary"))).withColumn("fp", minhash(t, **options)).withColumn("char_count", F.length(t))


def keep_first(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row by ``order`` of each ``by``."""
    first = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def unseen(new: DataFrame, index: DataFrame, force: bool = False) -> DataFrame:
    """New books whose name the index does not have, whatever their status there."""
    return new if force else new.join(index.select("book").distinct(), "book", "left_anti")


def _banded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, F.explode(bands(F.col("fp"))).alias("__b")).select(*columns, "__b.*")


def _near(a_count: Column, b_count: Column, a_fp: Column, b_fp: Column) -> Column:
    return (length_ratio(a_count, b_count) >= LEAST_RATIO) & (equal_share(a_fp, b_fp) >= LEAST_SIMILARITY)


def near_pairs(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """(a, b) of near duplicates between two fingerprinted tables: an equal band is needed, so
    this is an equi-join, and no pair is lost.

    Where all slots share one salt a signature has one value, and all bands are equal or none.
    """
    a = _banded(left, key, "char_count", "fp").select(F.col(key).alias("a"), F.col("char_count").alias("ac"), F.col("fp").alias("af"), "band", "key")
    b = _banded(right, key, "char_count", "fp").select(F.col(key).alias("b"), F.col("char_count").alias("bc"), F.col("fp").alias("bf"), "band", "key")
    near = _near(F.col("ac"), F.col("bc"), F.col("af"), F.col("bf"))
    return a.join(b, ["band", "key"]).where(near).select("a", "b").distinct()


def _first_two(df: DataFrame, *by: str) -> DataFrame:
    """The two rows of least ``pos`` of each key: enough, as a book skips at most its own."""
    order = Window.partitionBy(*by).orderBy("pos")
    return df.withColumn("__n", F.row_number().over(order)).where("__n <= 2").drop("__n")


def _cached_near(new: DataFrame, c: DataFrame, same_salts: bool) -> DataFrame:
    """(book, pos, duplicate_of, ch, hash) of near matches; with same salts the least positions
    per signature and length stand for all, so that a large group is not paired with itself."""
    if not same_salts:
        near = near_pairs(new.withColumn("id", F.col("book")), c.select(F.col("pos").alias("id"), F.col("cf").alias("fp"), F.col("cc").alias("char_count")))
        near = near.join(c.select(F.col("pos").alias("b"), "duplicate_of", "ch"), "b").join(new.select(F.col("book").alias("a"), "hash"), "a")
        return near.select(F.col("a").alias("book"), F.col("b").alias("pos"), "duplicate_of", "ch", "hash")
    few = _first_two(c.withColumn("slot", F.col("cf")[0]).select("duplicate_of", "pos", "ch", "cc", "slot"), "slot", "cc")
    rows = new.select("book", "hash", "char_count", F.col("fp")[0].alias("slot"))
    return rows.join(few, "slot").where(length_ratio(F.col("char_count"), F.col("cc")) >= LEAST_RATIO).select("book", "pos", "duplicate_of", "ch", "hash")


def against_index(new: DataFrame, cached: DataFrame, same_salts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rest, dropped): new books that equal or resemble a cleaned book of the index are
    dropped with reason and duplicate_of, the first match by index position.

    ``new``: book, hash, fp, char_count, ...; ``cached``: book, pos, hash, fp, char_count.  A
    cached book of the same name is no match.
    """
    c = cached.select(F.col("book").alias("duplicate_of"), "pos", F.col("hash").alias("ch"), F.col("fp").alias("cf"), F.col("char_count").alias("cc"))
    exact = _first_two(c.select("duplicate_of", "pos", F.col("ch").alias("hash")), "hash")
    same = new.select("book", "hash").join(exact, "hash").select("book", "pos", "duplicate_of", F.lit("exact_duplicate").alias("reason"))
    near = _cached_near(new, c, same_salts).where("hash != ch").select("book", "pos", "duplicate_of", F.lit("near_duplicate").alias("reason"))
    hit = same.unionByName(near).where("book != duplicate_of").groupBy("book").agg(F.min_by(F.struct("reason", "duplicate_of"), "pos").alias("m"))
    dropped = new.join(hit.select("book", "m.*"), "book")
    return new.join(hit, "book", "left_anti"), dropped


def exact_among(new: DataFrame, order: str = "path") -> tuple[DataFrame, DataFrame]:
    """(unique, dropped): the first book by ``order`` of each hash stays.

    Firsts are aggregated before the shuffle and joined back, so a hash that many books share
    is no single task's work.
    """
    first = new.groupBy("hash").agg(F.min(F.struct(order, "book")).alias("f")).select("hash", F.col(f"f.{order}").alias("__at"), F.col("f.book").alias("duplicate_of"))
    marked = new.join(first, "hash")
    is_first = F.col(order).eqNullSafe(F.col("__at")) & F.col("book").eqNullSafe(F.col("duplicate_of"))
    unique = marked.where(is_first).select(new.columns)
    return unique, marked.where(~is_first).select(*new.columns, "duplicate_of", F.lit("exact_duplicate").alias("reason"))


def greedy(near, count) -> list[tuple[int, int]]:
    """(dropped, kept) by going through positions in order: of two near duplicates the shorter
    is dropped, the earlier where they are as long; a position dropped before its turn is
    skipped, one dropped during its turn goes on comparing.

    ``near(i)``: the later positions that are near duplicates of i, ascending.  A position that
    loses to several is listed once, with the first of them.
    """
    gone = np.zeros(len(count), bool)
    out = []
    for i in range(len(count)):
        if gone[i]:
            continue
        others = near(i)
        others = others[~gone[others]]
        shorter = count[others] < count[i]
        gone[others[shorter]] = True
        out += [(j, i) for j in others[shorter].tolist()]
        if not shorter.all():
            gone[i] = True
            out.append((i, int(others[~shorter][0])))
    return out


def greedy_by_length(count: np.ndarray, ratio: float) -> list[tuple[int, int]]:
    """``greedy`` where positions are near by their lengths alone (the shorter is at least
    ``ratio`` of the longer), in n log n steps.

    What is left and near at a position's turn lies after it: an earlier one would have dropped
    it or have gone.  So the lengths from ``ratio`` times its own up to its own are dropped in
    one sweep, and the first position among those up to its own over ``ratio`` is the least of a
    range in a tree of minima.
    """
    n = len(count)
    by = np.lexsort((np.arange(n), count))
    ordered = np.asarray(count)[by]
    rank = np.empty(n, "i8")
    rank[by] = np.arange(n)
    low = np.searchsorted(ordered, ratio * np.asarray(count, "f8"), "left").tolist()
    same = np.searchsorted(ordered, count, "left").tolist()
    high = np.searchsorted(ratio * ordered.astype("f8"), count, "right").tolist()
    rank, by = rank.tolist(), by.tolist()
    size = 1 << max(n - 1, 1).bit_length()
    least = [n] * (2 * size)
    least[size : size + n] = by
    for k in range(size - 1, 0, -1):
        least[k] = min(least[2 * k], least[2 * k + 1])
    after = list(range(n + 1))

    def left(k):
        """The first place from k on that is not dropped."""
        while after[k] != k:
            after[k] = after[after[k]]
            k = after[k]
        return k

    def drop(k):
        after[k] = k + 1
        k += size
        least[k] = n
        while k > 1:
            k //= 2
            least[k] = min(least[2 * k], least[2 * k + 1])

    def first(a, b):
        found, a, b = n, a + size, b + size
        while a < b:
            if a & 1:
                found, a = min(found, least[a]), a + 1
            if b & 1:
                b -= 1
                found = min(found, least[b])
            a, b = a // 2, b // 2
        return found

    out = []
    for i in range(n):
        at = rank[i]
        if after[at] != at:
            continue
        k = left(low[i])
        while k < same[i]:
            out.append((by[k], i))
            drop(k)
            k = left(k)
        other = min(first(same[i], at), first(at + 1, high[i]))
        if other < n:
            out.append((i, other))
            drop(at)
    return out


def components(pairs: DataFrame) -> DataFrame:
    """(id, component) of the nodes in ``pairs`` (a, b): least ids spread until none changes."""
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both)
    label = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component")).withColumnRenamed("a", "id")
    while True:
        label = written(label)
        spread = both.join(label.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("component").alias("m"))
        new = label.join(spread.withColumnRenamed("a", "id"), "id").select("id", F.least("component", "m").alias("component"))
        # Jump along labels: a label is a node with a label of its own.
        jump = label.select(F.col("id").alias("component"), F.col("component").alias("up"))
        new = written(new.join(jump, "component", "left").select("id", F.coalesce("up", "component").alias("component")))
        if new.exceptAll(label).isEmpty():
            return new
        label = new


def greedy_among(unique: DataFrame, order: str = "path", same_salts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) among fingerprinted books: the ordered greedy pass.

    With same salts two signatures agree in all slots or none, so books of one signature are
    passed through together and no pairs are made; each is an id, a place and a length.  With
    distinct salts the pass runs per component of near-duplicate pairs.
    """
    placed = unique.withColumn("id", F.xxhash64(order, "book"))
    info = placed.select("id", F.col(order).alias("place"), "char_count", F.col("fp")[0].alias("slot"))

    def passed(pdf):
        pdf = pdf.sort_values(["place", "id"]).reset_index(drop=True)
        out = greedy_by_length(pdf.char_count.to_numpy(), LEAST_RATIO)
        return pd.DataFrame([(pdf.id[a], pdf.id[b]) for a, b in out], columns=["id", "kept"])

    def paired(pdf):
        nodes = sorted({*zip(pdf.ap, pdf.a, pdf.ac, strict=True), *zip(pdf.bp, pdf.b, pdf.bc, strict=True)})
        rank = {i: n for n, (_, i, _) in enumerate(nodes)}
        after = [[] for _ in nodes]
        for a, b in zip(pdf.a, pdf.b, strict=True):
            after[min(rank[a], rank[b])].append(max(rank[a], rank[b]))
        out = greedy(lambda i: np.array(sorted(after[i]), int), np.array([c for _, _, c in nodes]))
        return pd.DataFrame([(nodes[a][1], nodes[b][1]) for a, b in out], columns=["id", "kept"])

    if same_salts:
        # A signature that one book alone has needs no pass.
        several = info.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1").select("slot")
        gone = info.join(several, "slot", "left_semi").groupBy("slot").applyInPandas(passed, "id long, kept long")
    else:
        pairs = near_pairs(placed, placed).where("a < b")
        a = info.select(F.col("id").alias("a"), F.col("place").alias("ap"), F.col("char_count").alias("ac"))
        b = info.select(F.col("id").alias("b"), F.col("place").alias("bp"), F.col("char_count").alias("bc"))
        edges = pairs.join(a, "a").join(b, "b").join(components(pairs).withColumnRenamed("id", "a"), "a")
        gone = edges.groupBy("component").applyInPandas(paired, "id long, kept long")
    named = gone.join(placed.select(F.col("id").alias("kept"), F.col("book").alias("duplicate_of")), "kept").drop("kept")
    dropped = placed.join(named, "id").drop("id").withColumn("reason", F.lit("near_duplicate"))
    return placed.join(gone.select("id").distinct(), "id", "left_anti").drop("id"), dropped


def dedup_books(new: DataFrame, cached: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) of new books: against the index, then exact, then greedy."""
    rest, a = against_index(new, cached)
    unique, b = exact_among(rest)
    kept, c = greedy_among(unique)
    columns = [*new.columns, "reason", "duplicate_of"]
    return kept, a.select(columns).unionByName(b.select(columns)).unionByName(c.select(columns))


def _in_group(members: DataFrame) -> DataFrame:
    """The ``members`` (book, norm, ...) that are not alone with their book and norm."""
    several = members.groupBy("book", "norm").agg(F.count("*").alias("m")).where("m > 1")
    return members.join(several, ["book", "norm"], "left_semi")


def _named_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(book, file_a, file_b, n_a, n_b, id_a, id_b), file_a < file_b: ``pairs`` (a, b) of the ids
    of ``members`` (id, book, norm, file, n) that are of one book and norm."""
    x, y = (members.select(F.col("id").alias(k), F.col("book").alias(f"book_{k}"), F.col("norm").alias(f"norm_{k}"), F.struct("file", "n", "id").alias(f"m_{k}")) for k in "ab")
    both = pairs.join(x, "a").join(y, "b").where("book_a = book_b AND norm_a = norm_b")
    first, second = F.least("m_a", "m_b"), F.greatest("m_a", "m_b")
    return both.select(
        F.col("book_a").alias("book"), first.file.alias("file_a"), second.file.alias("file_b"), first.n.alias("n_a"), second.n.alias("n_b"),
        first.id.alias("id_a"), second.id.alias("id_b"),
    )


def _alike_in_group(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(book, file_a, file_b, n_a, n_b, ...): pairs of ``members`` (book, norm, file, n) of equal
    book and norm whose shingle ``sets`` (book, file, s) may be similar by ``threshold``, none
    lost; see ``prefix``."""
    grouped = _in_group(members.withColumn("id", F.xxhash64("book", "file")))
    pairs = alike(grouped.join(sets, ["book", "file"]).select("id", F.xxhash64("book", "norm").alias("g"), "s"), threshold)
    return _named_pairs(pairs, grouped)


def _shingles_of(body: str) -> np.ndarray:
    return shingle_array(form_codes(body))


def _grouped_bodies(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    for i, g, body in zip(*(batch.column(k) for k in ("id", "g", "body")), strict=True):
        yield i.as_py(), g.as_py(), _shingles_of(body.as_py())


def _key_runs(body: str, book: int, keys) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes with the book's) of the runs of KEY characters that the filter may hold."""
    h = mixed(window_hashes(codes_of(body), KEY) ^ np.int64(book).view("u8"))
    at = held(keys.value, h)
    return at, h[at]


def _held_keys(bodies: DataFrame, keys) -> DataFrame:
    """(id, keys): the runs of each of ``bodies`` (id, book_hash, body) that the filter ``keys``
    may hold, each once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, book, body in zip(pdf.id, pdf.book_hash, pdf.body, strict=True):
                at, _ = _key_runs(body, book, keys)
                if len(at):
                    out.append((i, sorted({body[k : k + KEY] for k in at.tolist()})))
            yield pd.DataFrame(out, columns=["id", "keys"])

    return bodies.select("id", "book_hash", "body").mapInPandas(run, "id long, keys array<string>")


def _key_hash(key: Column, book: Column) -> Column:
    @F.pandas_udf("long")
    def run(keys: pd.Series, books: pd.Series) -> pd.Series:
        h = np.array([window_hashes(codes_of(k), KEY)[0] for k in keys], "u8")
        return pd.Series(mixed(h ^ books.to_numpy().view("u8")).view("i8"))

    return run(key, book)


def _probed(thin: DataFrame, chapters: DataFrame, threshold: float) -> DataFrame:
    """(book, gone, kept, stage, prober, other): pairs of the second stage that may be similar.

    A filter of all keys, with their books, picks the runs of a body that may be keys, and a join
    by book and run tells.  The chapters that hold a key are a group if they do not all share
    their first paragraph, which the first stage has compared; pairs come from the prefix filter.
    """
    # Below 10 characters a first paragraph was not compared: each is another.
    norm = F.coalesce("norm", F.concat(F.lit("#"), "file")).alias("norm")
    chapters = chapters.withColumn("book_hash", F.xxhash64("book"))
    probe = thin.where("key IS NOT NULL").select("book", "key", norm, F.struct("file", "n", "id").alias("p"), _key_hash(F.col("key"), F.xxhash64("book")).alias("h"))
    found = written(_held_keys(chapters, bloom(probe, "h")))
    inside = thin.select("id", "book", norm, F.struct("file", "n", "id").alias("o")).join(found, "id").select("book", F.explode("keys").alias("key"), "norm", "o")
    inside = written(inside.join(probe.select("book", "key").distinct(), ["book", "key"], "left_semi"))
    several = inside.groupBy("book", "key").agg(F.min("norm").alias("least"), F.max("norm").alias("most")).where("least != most").select("book", "key")
    probe, inside = (written(x.join(several, ["book", "key"], "left_semi")) for x in (probe, inside))
    keys = bloom(probe, "h")

    def sets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        for i, book, body in zip(*(batch.column(k).to_pylist() for k in ("id", "book_hash", "body")), strict=True):
            groups = np.unique(_key_runs(body, book, keys)[1]).view("i8").tolist()
            s = _shingles_of(body) if groups else None
            for g in groups:
                yield i, g, s

    members = chapters.where(held_column(F.col("id"), bloom(inside.select("o.id").distinct(), "id")))
    pairs = alike(members.select("id", "book_hash", "body"), threshold, sets_of)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    p = probe.select("book", "key", F.col("norm").alias("norm_p"), "p", F.col("p.id").alias("a"))
    o = inside.select("book", "key", F.col("norm").alias("norm_o"), "o", F.col("o.id").alias("b"))
    hits = both.join(p, "a").join(o, ["book", "key", "b"]).where("norm_p != norm_o")
    # Where each holds the other's key, the first file probes.
    hits = hits.groupBy("book", F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.min(F.struct("p", "o")).alias("h")).select("book", "h.p", "h.o")
    keep = F.col("p.n") >= F.col("o.n")
    return hits.select(
        "book", F.when(keep, F.col("o.id")).otherwise(F.col("p.id")).alias("gone"), F.when(keep, F.col("p.id")).otherwise(F.col("o.id")).alias("kept"),
        F.lit(2).alias("stage"), F.col("p.file").alias("prober"), F.col("o.file").alias("other"),
    )


def _text_similarity(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        def of(s: str, t: str) -> float:
            p, q = _shingles_of(s), _shingles_of(t)
            both = len(np.intersect1d(p, q, assume_unique=True))
            return both / (len(p) + len(q) - both) if len(p) and len(q) else 0.0

        return pd.Series([of(s, t) for s, t in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def _first_similar(pairs: DataFrame, chapters: DataFrame, threshold: float) -> DataFrame:
    """Of ``pairs`` (book, gone, kept, stage, prober, other) the first that is similar for each
    ``gone``, with its similarity.  Most are decided by their first pair; only the others meet
    the rest of theirs.  Pairs bring texts, which are smaller than sets of hashes."""
    order = Window.partitionBy("gone").orderBy("stage", "prober", "other")
    pairs = written(pairs.withColumn("place", F.row_number().over(order)))
    ids = pairs.select("gone").unionByName(pairs.select(F.col("kept").alias("gone"))).distinct()
    texts = written(chapters.where(held_column(F.col("id"), bloom(ids, "gone"))).select("id", "body"))

    def similar(some: DataFrame) -> DataFrame:
        x, y = (texts.select(F.col("id").alias(k), F.col("body").alias(f"body_{k}")) for k in ("gone", "kept"))
        s = some.select("gone", "kept", "place").join(y, "kept").join(x, "gone").select("gone", "place", _text_similarity(F.col("body_gone"), F.col("body_kept")).alias("similarity"))
        return s.where(F.col("similarity") >= threshold)

    first = written(similar(pairs.where("place = 1")))
    later = similar(pairs.where("place > 1").join(first, "gone", "left_anti")).groupBy("gone").agg(F.min("place").alias("place"), F.min_by("similarity", "place").alias("similarity"))
    return written(pairs.join(first.unionByName(later), ["gone", "place"]))


def chapter_duplicates(chapters: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(book, file, duplicate_of, similarity, reason) among the chapters of each book.

    ``chapters``: book, file (name, in order), body.  Stage 1: equal first paragraphs (10
    characters or more, without marks); the longer stays, the earlier of equals.  Stage 2: the
    first 30 characters of a first paragraph inside another body, for pairs that stage 1 did
    not compare; the longer stays, the prober of equals.  A file is listed once, with its first
    record.

    Files with the same body are compared as one, the first of them: each later one is a
    duplicate of the first file that deletes it in stage 1, which is the first of the same body
    or the first of a body that is similar and not shorter.  So copies make no pairs.

    Bodies are read anew for each step and, but for those of candidates, never shuffled or
    written; a chapter is a hash of its book and name on the way.
    """
    chapters = chapters.where(F.coalesce(F.length("body"), F.lit(0)) > 0).select(F.xxhash64("book", "file").alias("id"), "book", "file", "body")
    para = first_paragraph("body")
    norm = dedup_form(para)
    facts = chapters.select("id", "book", "file", F.length("body").alias("n"), F.md5(F.col("body").cast("binary")).alias("md5"), is_blank("body").alias("blank"), para.alias("para"), norm.alias("norm"))
    facts = facts.select(
        "id", "book", "file", "n", "blank", F.when(F.length("para") >= KEY, F.substring("para", 1, KEY)).alias("key"),
        F.when(F.length("norm") >= 10, F.md5(F.col("norm").cast("binary"))).alias("norm"),
        F.when((F.length("norm") < 10) | F.col("blank"), F.col("file")).otherwise(F.col("md5")).alias("same"),
    )
    # Everything but the bodies, made once.
    facts = written(facts)
    leads = written(facts.groupBy("book", "same").agg(F.min(F.struct("file", "id", "n", "blank", "key", "norm")).alias("f")).select("book", "same", "f.*"))
    copies = facts.join(leads.select("book", "same", F.col("file").alias("lead"), F.col("id").alias("gone")), ["book", "same"]).where("file != lead").select("book", "file", "lead", "gone")
    # Nothing is similar to a chapter of marks alone.
    thin = leads.where("NOT blank").drop("same", "blank")

    members = written(_in_group(thin.where("norm IS NOT NULL")).select("id", "book", "norm", "file", "n"))
    grouped = chapters.where(held_column(F.col("id"), bloom(members, "id")))
    first = alike(grouped.select("id", F.xxhash64("book", F.md5(norm.cast("binary"))).alias("g"), "body"), threshold, _grouped_bodies)
    first = _named_pairs(first, members)
    keep_a = F.col("n_a") >= F.col("n_b")
    first = first.select(
        "book", F.when(keep_a, F.col("id_b")).otherwise(F.col("id_a")).alias("gone"), F.when(keep_a, F.col("id_a")).otherwise(F.col("id_b")).alias("kept"),
        F.lit(1).alias("stage"), F.col("file_a").alias("prober"), F.col("file_b").alias("other"),
    )

    found = _first_similar(first.unionByName(_probed(thin, chapters, threshold)), chapters, threshold)
    names = thin.select("id", "file")
    found = found.join(names.withColumnRenamed("id", "gone"), "gone").withColumn("duplicate_of", F.when(F.col("prober") == F.col("file"), F.col("other")).otherwise(F.col("prober")))
    earlier = found.where("stage = 1 AND duplicate_of < file").select("gone", F.struct("duplicate_of", "similarity").alias("e"))
    copied = copies.join(earlier, "gone", "left").select(
        "book", "file", F.coalesce("e.duplicate_of", "lead").alias("duplicate_of"), F.coalesce("e.similarity", F.lit(1.0)).alias("similarity"),
        F.lit(1).alias("stage"),
    )
    share = F.format_string("%.1f%%", F.col("similarity") * 100)
    reason = F.concat(F.when(F.col("stage") == 1, "首段相同，全文相似").otherwise("首段命中，全文相似"), share)
    return found.select(copied.columns).unionByName(copied).select("book", "file", "duplicate_of", "similarity", reason.alias("reason"))


def without(chapters: DataFrame, duplicates: DataFrame) -> DataFrame:
    """The chapters that are no listed duplicate (nothing is deleted on disk)."""
    return chapters.join(duplicates.select("book", "file").distinct(), ["book", "file"], "left_anti")
