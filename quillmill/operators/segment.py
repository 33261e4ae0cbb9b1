"""Books into chapters, and repeated blocks out of chapters."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import SPACE, preview, strip, strip_lf

#: White space that stays on a line.
_BLANK = rf"[{SPACE}&&[^\n]]"
#: Ornaments before a header, numerals, units.
_ORNAMENT = rf"[{SPACE}☆★●○◆♦•·\-—、.&&[^\n]]{{0,8}}"
_HEADER = rf"第{_BLANK}*[0-9〇零一二三四五六七八九十百千两萬万]+{_BLANK}*[章节回卷集].{{0,40}}|Chapter{_BLANK}*\d+.*|CHAPTER{_BLANK}*\d+.*"
_HEADER_LINE = rf"{_ORNAMENT}({_HEADER}){_BLANK}*(?=\n|\z)"
_NUMBER_LINE = rf"{_BLANK}*(\d{{1,4}}){_BLANK}*(?=\n|\z)"

#: Flags for people to look at.
FEW_CHAPTERS = "最多一章：请检查章节标题的写法"
NUMBER_HEADERS = "章节按纯数字行切分：请抽查"
REPEATED_BLOCKS = "删去了重复的段落：请核实"


def split_book(text: Column) -> Column:
    """struct(synopsis, chapters array<struct(title, body)>, used_fallback) of a book.

    A text is cut before each header line, within its row: no shuffle, however uneven the books.
    Lines of one to four digits are headers only where there is no other kind.
    """
    text = F.concat(F.lit("\n"), F.coalesce(text, F.lit("")))
    fallback = ~text.rlike(rf"(?Ud)(?<=\n){_HEADER_LINE}")

    def cut(line: str) -> Column:
        parts = F.split(text, rf"(?Ud)(?<=\n)(?={line})", -1)
        rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
        chapters = F.transform(
            rest,
            lambda p: F.struct(
                strip(F.regexp_extract(p, rf"(?Ud)\A{line}", 1)).alias("title"),
                strip_lf(F.regexp_replace(p, r"\A[^\n]*", "")).alias("body"),
            ),
        )
        return F.struct(strip_lf(parts[0]).alias("synopsis"), F.filter(chapters, lambda c: c["body"] != "").alias("chapters"))

    got = F.when(fallback, cut(_NUMBER_LINE)).otherwise(cut(_HEADER_LINE))
    return F.struct(got["synopsis"].alias("synopsis"), got["chapters"].alias("chapters"), fallback.alias("used_fallback"))


def chapters(books: DataFrame, text: str = "text") -> DataFrame:
    """``books`` without their text, one row per chapter: chapter_no from 1, title, body."""
    keys = [c for c in books.columns if c != text]
    cut = books.select(*keys, F.posexplode(split_book(F.col(text))["chapters"]).alias("__pos", "__chapter"))
    return cut.select(*keys, (F.col("__pos") + 1).alias("chapter_no"), F.col("__chapter.title").alias("title"), F.col("__chapter.body").alias("body"))


def split_flags(split: Column) -> Column:
    """Flags of a book from its ``split_book``."""
    flags = F.array(F.when(F.size(split["chapters"]) <= 1, FEW_CHAPTERS), F.when(split["used_fallback"], NUMBER_HEADERS))
    return F.filter(flags, lambda f: f.isNotNull())


def drop_repeats(body: str, window: int = 4, least_chars: int = 120, similarity: float = 0.6) -> tuple[str, list[str]]:
    """A body without blocks of lines that repeat earlier ones, and previews of what went.

    A block starts where ``window`` stripped lines, each of two characters or more, equal an
    earlier run.  It goes on while lines are equal or alike and ends at three misses in a row.
    Blocks of fewer than ``least_chars`` characters stay.
    """
    raw = body.split("\n")
    bare = [line.strip() for line in raw]

    def alike(a: str, b: str) -> bool:
        if a == b or not (a and b):
            return a == b
        m = SequenceMatcher(None, a, b)
        # Both quick ratios are upper bounds.
        return m.real_quick_ratio() >= similarity and m.quick_ratio() >= similarity and m.ratio() >= similarity

    def block_end(first: int, again: int) -> int:
        """The line after the block that repeats ``first`` from ``again`` on."""
        end, misses = again, 0
        for offset in range(min(len(raw) - again, again - first)):
            misses = 0 if alike(bare[again + offset], bare[first + offset]) else misses + 1
            if misses == 3:
                return again + offset + 1 - misses
            end = again + offset + 1
        return end - misses

    first_at: dict[str, int] = {}
    kept, gone, at = [], [], 0
    while at < len(raw):
        run = bare[at : at + window]
        if len(run) == window and all(len(x) >= 2 for x in run):
            first = first_at.setdefault("".join(run), at)
            if first < at:
                end = block_end(first, at)
                block = "\n".join(raw[at:end])
                if len(block) >= least_chars:
                    gone.append(block[:80].replace("\n", " "))
                    at = end
                    continue
        kept.append(raw[at])
        at += 1
    return "\n".join(kept), gone


def may_repeat(body: Column, window: int = 4) -> Column:
    """Whether some run of ``window`` lines stands twice; others need no Python."""
    def repeats(lines: Column) -> Column:
        last = F.size(lines) - window
        runs = F.transform(F.sequence(F.lit(1), F.greatest(last + 1, F.lit(1))), lambda i: F.array_join(F.slice(lines, i, window), ""))
        return F.when(last > 0, runs)

    # Lambda variables keep the lines and the runs from being made again for each of them.
    found = F.transform(F.array(F.transform(F.split(body, "\n", -1), strip)), repeats)
    again = F.transform(found, lambda runs: F.size(F.array_distinct(runs)) < F.size(runs))
    return F.coalesce(again[0], F.lit(False))


def remove_repeats(df: DataFrame, body: str = "body") -> DataFrame:
    """``df`` with ``body`` freed of repeated blocks, and ``removed`` (previews).

    Rows without a repeated run pass through the JVM alone.
    """

    @F.pandas_udf("struct<body:string,removed:array<string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for bodies in batches:
            yield pd.DataFrame([drop_repeats(b) if b else (b, []) for b in bodies], columns=["body", "removed"])

    other = [F.col(c) for c in df.columns if c != body]
    hit = df.withColumn("__may", may_repeat(F.col(body)))
    none = F.array().cast("array<string>")
    plain = hit.where(~F.col("__may")).select(*other, F.col(body), none.alias("removed"))
    done = hit.where(F.col("__may")).withColumn("__r", run(F.col(body))).select(*other, F.col("__r.body").alias(body), F.col("__r.removed").alias("removed"))
    return plain.unionByName(done)


def repeat_log(book: Column, title: Column, removed: Column) -> Column:
    """Lines ``book / title: preview`` for a log of removed blocks."""
    return F.transform(removed, lambda r: F.concat(book, F.lit(" / "), title, F.lit(": "), preview(r)))
