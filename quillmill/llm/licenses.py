"""License scans by sparse TF-IDF cosine, with inheritance along directories.

A text is compared with templates (licence headers, notices and whole licence texts) in windows
of as many words as the template has, at every word, so that neither line breaks nor comment
marks matter.  Vectors count words, weighted by how rare a word is in the documents (counted
over all of them) and in the templates; a word that no template has weighs as a rare one.  A
sliding sum bounds the cosine of all windows at once, and only windows whose bound reaches the
template's least cosine are compared, each from its neighbour by the two words that differ.  The
time is linear in the text.  Of windows that overlap the one with most evidence stays; the
licence with most evidence is the text's own.

A text whose words are mostly licence is a licence file of its directory.  A text without a
licence of its own takes that of the nearest directory above it that has a licence file.

Sizes: texts are read twice and never shuffled.  Inheritance is a join of directories (each
with its few ancestors) with licence files, by path; documents join their directory's result.
"""

from __future__ import annotations

import math
import pathlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import materialise, table
from quillmill.llm.licence_texts import TEMPLATES

#: Least share of its words in licence windows that makes a text a licence file.
FILE_SHARE = 0.5
_WORD = re.compile(r"[a-z]+|\d+")


def least_cosine(n_words: int) -> float:
    """The cosine that a window must reach: short notices must be met nearly word for word."""
    return 0.9 if n_words < 8 else 0.75


def terms(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def read_templates(folder: str) -> list[tuple[str, str]]:
    """(name, text) of the whole licence texts in a local folder of the driver, by file name.
    They go to every task, so the folder should hold licences only."""
    return [(p.name, p.read_text(encoding="utf-8", errors="replace")) for p in sorted(pathlib.Path(folder).iterdir()) if p.is_file()]


def vocabulary(templates: Sequence[tuple[str, str]]) -> dict[str, int]:
    """word -> number, of all words in the templates."""
    return {w: i for i, w in enumerate(sorted({t for _, text in templates for t in terms(text)}))}


class Matcher:
    """Compares texts with ``templates``; ``idf`` weighs the words of their vocabulary."""

    def __init__(self, idf: dict[str, float], templates: Sequence[tuple[str, str]] = TEMPLATES):
        self.number = vocabulary(templates)
        self.rare = max(idf.values(), default=1.0) ** 2
        # The last place is for all words that no template has.
        self.square = np.array([*(idf[w] ** 2 for w in self.number), self.rare])
        self.names, self.sizes, rows = [], [], []
        for name, text in templates:
            at = [self.number[w] for w in terms(text)]
            if not at:
                continue
            count = np.bincount(at, minlength=len(self.square)).astype("f8")
            self.names.append(name)
            self.sizes.append(len(at))
            rows.append(count / math.sqrt((count**2 * self.square).sum()))
        #: Per template and word: what a word of the text adds to the product, and its greatest share of a cosine.
        self.adds = np.array(rows).reshape(len(rows), -1) * self.square
        self.most = self.adds**2 / self.square
        self.least = np.array([least_cosine(n) for n in self.sizes])

    def windows(self, at: np.ndarray, template: int) -> list[tuple[float, int, int]]:
        """(cosine, start, end) of the windows that reach the template's least cosine, none
        overlapping, the best first."""
        n = min(self.sizes[template], len(at))
        least = self.least[template]
        dots = np.concatenate([[0.0], np.cumsum(self.adds[template][at])])
        sizes = np.concatenate([[0.0], np.cumsum(self.square[at])])
        dot, size = dots[n:] - dots[:-n], sizes[n:] - sizes[:-n]
        # Counts are whole numbers, so a window's squared length is at least the sum of its squares.
        open_ = np.flatnonzero(dot >= (least - 1e-9) * np.sqrt(size))
        found = []
        known, length, last = Counter(), 0.0, None
        other = len(self.square) - 1
        words = at.tolist()
        for start in open_.tolist():
            if last is not None and start - last < n:
                for p in range(last, start):
                    known, length = self._moved(known, length, words[p], -1, other)
                    known, length = self._moved(known, length, words[p + n], 1, other)
            else:
                known, length = Counter(), 0.0
                for p in range(start, start + n):
                    known, length = self._moved(known, length, words[p], 1, other)
            last = start
            cosine = float(dot[start]) / math.sqrt(length) if length > 1e-12 else 0.0
            if cosine >= least:
                found.append((cosine, start))
        taken = np.zeros(len(at), bool)
        out = []
        for cosine, start in sorted(found, key=lambda f: (-round(f[0], 9), f[1])):
            if not taken[start] and not taken[start + n - 1]:
                taken[start : start + n] = True
                out.append((cosine, start, start + n))
        return out

    def _moved(self, known: Counter, length: float, word: int, by: int, other: int) -> tuple[Counter, float]:
        if word == other:
            return known, length + by * self.rare
        n = known[word]
        known[word] = n + by
        return known, length + (2 * n * by + 1) * self.square[word]

    def scan(self, text: str) -> tuple[str | None, float, float]:
        """(licence, its best cosine, share of the words in licence windows) of a whole text;
        nothing reaches its least cosine: (None, 0, 0)."""
        other = len(self.square) - 1
        found = [self.number.get(w, other) for w in terms(text)]
        if not found:
            return None, 0.0, 0.0
        at = np.array(found)
        here = np.zeros(len(self.square))
        here[at] = 1.0
        here[other] = 0.0
        # A cosine is at most the length of the template's part in words that the text has.
        windows = []
        for t in np.flatnonzero(self.most @ here >= (self.least - 1e-9) ** 2).tolist():
            windows += [(cosine**2 * math.log1p(end - start), cosine, self.names[t], start, end) for cosine, start, end in self.windows(at, t)]
        taken = np.zeros(len(at), bool)
        evidence: Counter[str] = Counter()
        best: dict[str, float] = {}
        for _, cosine, name, start, end in sorted(windows, key=lambda w: (-round(w[0], 9), w[2], w[3])):
            if not taken[start] and not taken[end - 1]:
                taken[start:end] = True
                evidence[name] += cosine * (end - start)
                best[name] = max(best.get(name, 0.0), cosine)
        if not evidence:
            return None, 0.0, 0.0
        name = min(evidence, key=lambda x: (-round(evidence[x], 9), x))
        return name, best[name], float(taken.mean())


def idf_of(docs: DataFrame, text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of the vocabulary over all documents and templates."""
    words = frozenset(vocabulary(templates))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        n = 0
        for b in batches:
            for text in b.column(0).to_pylist():
                n += 1
                seen.update(words.intersection(terms(text or "")))
        seen[""] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    counted = docs.select(F.col(text).cast("string")).mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = Counter({r.term: r.n for r in counted})
    n = df.pop("", 0) + len(templates)
    for _, t in templates:
        df.update(set(terms(t)))
    return {t: math.log(1 + n / df[t]) for t in sorted(words)}


def directory(path: Column) -> Column:
    """The folder of a path; '' at the top."""
    return F.regexp_replace(F.regexp_replace(path, r"[^/]*\z", ""), r"/+\z", "")


def scan_licenses(files: DataFrame, path: str = "path", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``files`` without their text, with license, cosine, is_license_file, inherited_from.

    ``license`` is the text's own, else that of the nearest folder above (its own first) with
    a licence file; ``inherited_from`` names that folder.  Of several licence files in a folder
    a file named as one goes first, then greatest cosine, then least name.  Null paths have the folder '';
    null and empty texts have no licence of their own; repeated rows stay.  ``templates`` go to
    every task (``read_templates`` reads whole licence texts from a folder).
    """
    new = ("own_license", "cosine", "share")
    sent = files.sparkSession.sparkContext.broadcast((idf_of(files, text, templates), templates))
    keep = [c for c in files.columns if c not in (*new, "license", "is_license_file", "inherited_from", "__dir")]
    rows = files.select(*keep).withColumn("__dir", directory(F.coalesce(F.col(path).cast("string"), F.lit(""))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*sent.value)
        for b in batches:
            at = b.schema.get_field_index(text)
            got = [matcher.scan(t or "") for t in b.column(at).to_pylist()]
            columns = [pa.array([g[i] for g in got], k) for i, k in enumerate((pa.string(), pa.float64(), pa.float64()))]
            others = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in others), *columns], names=[*(b.schema.names[i] for i in others), *new])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != text)
    scanned = rows.mapInArrow(run, f"{schema}, own_license string, cosine double, share double")
    named = F.col(path).rlike(r"(?i)(^|/)(licen[sc]e|copying|unlicense)[^/]*\z")
    is_file = F.col("own_license").isNotNull() & ((F.col("share") >= FILE_SHARE) | F.coalesce(named, F.lit(False)))
    # Without the texts this is small; three branches read it.
    scanned = materialise(scanned.withColumn("is_license_file", is_file))
    order = F.struct(~F.coalesce(named, F.lit(False)), -F.col("cosine"), F.coalesce(F.col(path), F.lit("")), "own_license")
    granted = scanned.where("is_license_file").groupBy("__dir").agg(F.min(order).alias("o")).select(F.col("__dir").alias("__above"), F.col("o.own_license").alias("granted"))
    # Each folder with all above it; the nearest is the longest.
    folders = scanned.select("__dir").distinct()
    parts = F.split("__dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    nearest = folders.select("__dir", F.explode(F.array_distinct(above)).alias("__above")).join(granted, "__above")
    nearest = nearest.groupBy("__dir").agg(F.max(F.struct(F.length("__above").alias("l"), F.col("__above").alias("f"), "granted")).alias("g")).select("__dir", F.col("g.f").alias("folder"), F.col("g.granted").alias("granted"))
    out = scanned.join(nearest, "__dir", "left")
    own = F.col("own_license").isNotNull()
    return out.select(
        *(c for c in keep if c != text),
        F.coalesce("own_license", "granted").alias("license"),
        F.round("cosine", 6).alias("cosine"),
        "is_license_file",
        F.when(~own, F.col("folder")).alias("inherited_from"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, filed by source and thousand: ``src0/12/12345.txt``."""
    docs = table(spark, sf_dir, "documents")
    shelf = F.floor(F.col("doc_id") / 1000).cast("string")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), shelf, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return scan_licenses(docs.select("doc_id", path.alias("path"), "text"))
