"""Scalar text functions, all as Spark SQL expressions.

Patterns are written for Java with ``(?Ud)``: Unicode classes, and a dot that stops at LF only.
``SPACE`` is the white space that a strip removes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\s\x1c-\x1f"

#: Lines that match one of these (from their start) are advertisements.
AD_PATTERNS = (
    r".*(关注|扫描|扫码).{0,10}(公众号|微信|订阅号).*",
    r".*(加入|欢迎进|欢迎加).{0,10}(书友群|读者群|交流群).*",
    r".*QQ\s*群[:：]?\s*\d{5,12}.*",
    r".*微信[:：]?\s*[a-zA-Z0-9_-]{4,20}.*",
    r".*(https?://|www\.)[^\s]+.*",
    r".*本书由.{0,20}(整理|制作|校对|上传).*",
    r".*(txt|TXT|电子书)下载.*",
    r".*(手机|移动)(阅读|端).{0,10}(更方便|更流畅).*",
    r".*为了(下一章|下章)更(精彩|快).*",
    r".*(未经允许|未经授权).{0,10}(禁止|不得)转载.*",
    r".*本站(首发|最新更新|地址)[:：].*",
    r".*笔趣阁.*",
    r".*都市小说网.*",
)
#: Lines that list tags; group 2 is the list.
TAG_PATTERNS = (
    r"^\s*.{0,4}?(标签|关键词|关键字|分类|题材|类型)[:：]\s*(.+)$",
    r"(?i)^\s*(tag\s*列表|tags?)[:：]\s*(.+)$",
)
SEPARATORS = ("/", "、", ",", "，", "|", ";", "；")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Without white space at both ends, full-width blanks included."""
    return F.regexp_replace(_c(c), rf"(?Ud)^[{SPACE}]+|[{SPACE}]+\z", "")


def strip_lf(c: str | Column) -> Column:
    return F.regexp_replace(_c(c), r"^\n+|\n+\z", "")


def missing(c: Column) -> Column:
    """Null or empty, for strings."""
    return F.coalesce(F.length(c), F.lit(0)) == 0


def missing_list(c: Column) -> Column:
    """Null or empty, for arrays."""
    return F.coalesce(F.size(c), F.lit(0)) <= 0


def lines(c: str | Column) -> Column:
    return F.split(_c(c), "\n", -1)


def normalise(c: str | Column) -> Column:
    """LF line ends, no zero-width characters, no blanks before LF, at most one empty line in a
    row, no LF at the ends.  Blanks at the end of the last line stay."""
    c = F.regexp_replace(_c(c), r"\r\n?", "\n")
    c = F.regexp_replace(c, "[﻿​‌‍]", "")
    c = F.regexp_replace(c, r"[ \t]+\n", "\n")
    return strip_lf(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def rule(pattern: str) -> str:
    """A rule as it is written in a configuration, for Java: its white space is ``SPACE``."""
    out, in_class, at = [], False, 0
    while at < len(pattern):
        part = pattern[at : at + 2] if pattern[at] == "\\" else pattern[at]
        at += len(part)
        in_class = part == "[" or in_class and part != "]"
        if part == r"\s":
            part = SPACE if in_class else f"[{SPACE}]"
        elif part == r"\S" and not in_class:
            part = f"[^{SPACE}]"
        out.append(part)
    return "(?Ud)" + "".join(out)


def any_start(patterns: Sequence[str]) -> str:
    """One pattern that holds where any of ``patterns`` matches from the start."""
    return "(?Ud)^(?:" + "|".join(f"(?:{rule(p)})" for p in patterns) + ")"


def remove_lines(c: str | Column, patterns: Sequence[str] = AD_PATTERNS) -> Column:
    if not patterns:
        return _c(c)
    return F.array_join(F.filter(lines(c), lambda x: ~x.rlike(any_start(patterns))), "\n")


def clean(c: str | Column, patterns: Sequence[str] = AD_PATTERNS) -> Column:
    return normalise(remove_lines(normalise(c), patterns))


def garbled(c: str | Column) -> Column:
    """Whether decoding left replacement characters."""
    return F.contains(_c(c), F.lit("�"))


def file_title(stem: str | Column) -> Column:
    """struct(title, author) of a file name: ``title-author``, ``title_author``, ``title(author)``."""
    stem = _c(stem)
    dash, bracket = r"(?Ud)^(.+?)[-_]([^-_]{1,20})$", r"(?Ud)^(.+?)[（(]([^)）]{1,20})[)）]$"

    def part(group: int, other: Column) -> Column:
        return F.when(stem.rlike(dash), strip(F.regexp_extract(stem, dash, group))).when(stem.rlike(bracket), strip(F.regexp_extract(stem, bracket, group))).otherwise(other)

    return F.struct(part(1, strip(stem)).alias("title"), part(2, F.lit(None).cast("string")).alias("author"))


def tags(c: str | Column, patterns: Sequence[str] = TAG_PATTERNS, head: int = 30) -> Column:
    """Tags of the first ``head`` lines, in order, repeats kept; take the text as it was read."""

    def of(line: Column) -> Column:
        found = []
        for p in patterns:
            p = rule(p)
            cut = F.split(F.regexp_extract(line, p, 2), rf"(?Ud)[，,、/{SPACE}]+", -1)
            found.append(F.when(line.rlike(p), F.filter(cut, lambda t: t != "")).otherwise(F.array().cast("array<string>")))
        return F.concat(*found)

    return F.flatten(F.transform(F.slice(lines(c), 1, head), of))


def strip_fence(c: str | Column) -> Column:
    """Without a code fence around the whole."""
    c = strip(c)
    bare = F.regexp_replace(F.regexp_replace(c, r"\A```[a-zA-Z]*\n", ""), r"\n```(?=\n?\z)", "")
    return strip(F.when(c.startswith("```"), bare).otherwise(c))


#: White space and marks that do not count when chapters are compared.
IGNORED = r"""(?Ud)[\s\x1c-\x1f，。！？、；：""''（）《》【】.,!?;:'"()\[\]{}]"""


def dedup_form(c: str | Column) -> Column:
    return F.regexp_replace(_c(c), IGNORED, "")


def is_blank(c: str | Column) -> Column:
    """Whether ``dedup_form`` leaves nothing."""
    return ~F.rlike(_c(c), F.lit(IGNORED.replace("[", "[^", 1)))


def paragraphs(c: str | Column, least: int = 20) -> Column:
    """Parts between blank lines, stripped, of at least ``least`` characters."""
    parts = F.transform(F.split(_c(c), rf"(?Ud)\n[{SPACE}]*\n", -1), strip)
    return F.filter(parts, lambda p: F.length(p) >= least)


def first_paragraph(c: str | Column) -> Column:
    return F.coalesce(F.get(paragraphs(c), F.lit(0)), F.substring(_c(c), 1, 100))


def sentences(c: str | Column, least: int = 5) -> Column:
    parts = F.transform(F.split(_c(c), r"[。！？!?；;\n]", -1), strip)
    return F.filter(parts, lambda s: F.length(s) >= least)


def without_dialogue(c: str | Column) -> Column:
    c = F.regexp_replace(_c(c), r'"[^"]*"', "")
    return strip(F.regexp_replace(F.regexp_replace(c, "「[^」]*」", ""), "『[^』]*』", ""))


def split_each(c: str | Column, separators: Sequence[str] = SEPARATORS) -> Column:
    """Parts by each separator that occurs, one after the other (not nested)."""
    c = _c(c)

    def by(sep: str) -> Column:
        cut = F.filter(F.transform(F.split(c, "\\Q" + sep + "\\E", -1), strip), lambda p: p != "")
        return F.when(F.contains(c, F.lit(sep)), cut).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*(by(s) for s in separators)))


def escape_html(c: str | Column) -> Column:
    c = _c(c)
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def yes_no(c: str | Column) -> Column:
    """true, false or null of a reply; a yes anywhere comes first."""
    c = F.upper(_c(c))
    return F.when(c.rlike("YES|是"), True).when(c.rlike("NO|否"), False)


def book_of_path(c: str | Column, root: str = "cleaned") -> Column:
    return F.regexp_extract(_c(c), rf"{root}[\\/]([^\\/]+)", 1)


def head(c: str | Column, n: int) -> Column:
    return F.substring(_c(c), 1, n)


def preview(c: str | Column, n: int = 80) -> Column:
    return F.replace(head(c, n), F.lit("\n"), F.lit(" "))


def ellipsis(c: str | Column, n: int = 300) -> Column:
    return F.concat(head(c, n), F.when(F.length(_c(c)) > n, "...").otherwise(""))


def merge_style(base: str | Column, overrides: str | Column) -> Column:
    """Two lists of (role, instruction): later ones win, at the place where the role first stood."""
    both = F.concat(F.coalesce(_c(base), F.array()), F.coalesce(_c(overrides), F.array()))
    roles = F.array_distinct(F.transform(both, lambda x: x["role"]))

    def last(role: Column) -> Column:
        return F.struct(role.alias("role"), F.element_at(F.filter(both, lambda x: x["role"].eqNullSafe(role)), -1)["instruction"].alias("instruction"))

    return F.transform(roles, last)
