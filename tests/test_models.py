"""Column functions against small models in plain Python, on random texts of awkward characters."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillmill.functions import names, text
from quillmill.operators import segment

PIECES = ["\n", "\n", "\n\n\n", "\r\n", "\r", " ", "\t", "　", "\x1c", "\x85", " ", "​", "﻿", "a", "B", "1", "12", "第", "章", "第1章", "第二回", "☆", "Chapter 3", "CHAPTER4", "标签：", "tags: ",
          "，", ",", "、", "/", "|", "；", "。", "！", "?", '"', "「", "」", "“", "（", "）", "(", ")", "-", "_", "公众号", "关注", "https://x", "笔趣阁", "长长的一段文字，超过五个字", "x" * 21, "😀"]


def texts(n=700):
    rng = random.Random(11)
    return ["", *("".join(rng.choices(PIECES, k=rng.randint(1, 25))) for _ in range(n))]


def normalise(t):
    t = re.sub("[﻿​-‍]", "", t.replace("\r\n", "\n").replace("\r", "\n"))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", t)).strip("\n")


def remove_lines(t):
    return "\n".join(x for x in t.split("\n") if not any(re.match(p, x) for p in text.AD_PATTERNS))


def paragraphs(t):
    return [p.strip() for p in re.split(r"\n\s*\n", t) if len(p.strip()) >= 20]


def file_title(t):
    for p in (r"^(.+?)[-_]([^-_]{1,20})$", r"^(.+?)[（(]([^)）]{1,20})[)）]$"):
        if m := re.match(p, t):
            return m[1].strip(), m[2].strip()
    return t.strip(), None


def tags(t):
    found = []
    for line in t.split("\n")[:30]:
        for p in text.TAG_PATTERNS:
            if m := re.match(p, line):
                found += [x for x in re.split(r"[，,、/\s]+", m[2]) if x]
    return found


HEADER = re.compile(r"^[\s☆★●○◆♦•·\-—、.]{0,8}(第\s*[0-9〇零一二三四五六七八九十百千两萬万]+\s*[章节回卷集].{0,40}|Chapter\s*\d+.*|CHAPTER\s*\d+.*)\s*$")
NUMBER = re.compile(r"^\s*(\d{1,4})\s*$")


def split_book(t):
    found = [HEADER.match(x) for x in t.split("\n")]
    fallback = not any(found)
    if fallback:
        found = [NUMBER.match(x) for x in t.split("\n")]
    parts = [[None, []]]
    for m, x in zip(found, t.split("\n"), strict=True):
        if m:
            parts.append([m[1].strip(), []])
        else:
            parts[-1][1].append(x)
    parts = [(title, "\n".join(body).strip("\n")) for title, body in parts]
    return parts[0][1], [p for p in parts[1:] if p[1]], fallback


CASES = {
    "strip": (text.strip, str.strip),
    "normalise": (text.normalise, normalise),
    "remove_lines": (text.remove_lines, remove_lines),
    "clean": (text.clean, lambda t: normalise(remove_lines(normalise(t)))),
    "paragraphs": (text.paragraphs, paragraphs),
    "first_paragraph": (text.first_paragraph, lambda t: (paragraphs(t) or [t[:100]])[0]),
    "sentences": (text.sentences, lambda t: [s.strip() for s in re.split(r"[。！？!?；;\n]", t) if len(s.strip()) >= 5]),
    "dedup_form": (text.dedup_form, lambda t: re.sub(r"[，。！？、；：\"'（）《》【】.,!?;:()\[\]{}]", "", re.sub(r"\s+", "", t))),
    "without_dialogue": (text.without_dialogue, lambda t: re.sub(r"『[^』]*』", "", re.sub(r"「[^」]*」", "", re.sub(r'"[^"]*"', "", t))).strip()),
    "split_each": (text.split_each, lambda t: [p.strip() for s in text.SEPARATORS if s in t for p in t.split(s) if p.strip()]),
    "file_title": (lambda c: F.array(text.file_title(c)["title"], text.file_title(c)["author"]), lambda t: list(file_title(t))),
    "tags": (text.tags, tags),
}


@pytest.mark.parametrize("name", CASES)
def test_function(spark, name):
    column, model = CASES[name]
    rows = texts()
    if name == "file_title":
        rows = [t.replace("\n", "") for t in rows]
    if name in ("tags", "remove_lines"):
        rows = [normalise(t) for t in rows]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string").select("i", "t", column(F.col("t")).alias("r"))
    for r in df.collect():
        assert r.r == model(r.t), (name, r.t)


def test_split_book(spark):
    rows = [normalise(t) for t in texts(1500)]
    df = spark.createDataFrame([(t,) for t in rows], "t string").select("t", segment.split_book(F.col("t")).alias("s"))
    for r in df.collect():
        assert (r.s.synopsis, [tuple(c) for c in r.s.chapters], r.s.used_fallback) == split_book(r.t), r.t


def without_dialogue(s):
    return re.sub(r"『[^』]*』", "", re.sub(r"「[^」]*」", "", re.sub(r'"[^"]*"', "", s))).strip()


def person_sentences(t):
    out = []
    for s in (s.strip() for s in re.split(r"[。！？!?；;\n]", t)):
        bare = without_dialogue(s)
        act = re.search("[一-龥]{2,4}(?:" + "|".join(names.ACTIONS) + ")", bare)
        if len(s) >= 5 and len(bare) >= 5 and (act or any(w in bare for w in names.DESCRIPTIVE_WORDS)):
            out.append(bare)
    return out


def is_person_name(t):
    bare = re.sub('".*?"', "", re.sub("[（(][^）)]*[）)]", "", t).strip()).strip()
    if any(m in bare for m in names.MARKERS):
        return False
    return bool(re.fullmatch("[一-龥]{2,4}|[一-龥]{1,3}·[一-龥]{1,4}|[A-Za-z]+", bare))


def found(parts, core, body):
    if any(p in body for p in parts):
        return "exact"
    if any(len(c) >= 2 and c in body for c in core):
        return "core"
    return "sentence" if any(p in s for s in person_sentences(body) for p in [*parts, *(c for c in core if len(c) >= 2)]) else None


def test_names(spark):
    rng = random.Random(12)
    bits = ["顾", "言", "李", "走", "看着", "部长", "神秘", "老人", "的", "者", "们", "等", "（", "）", '"', "·", "、", "/", " ", "a", "Tom", "。", "「", "」", "\n", "黄昏", "坐在", "门口"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 5))), "".join(rng.choices(bits, k=rng.randint(0, 25)))) for i in range(1500)]
    df = spark.createDataFrame(rows, "i int, n string, b string")
    n, b = F.col("n"), F.col("b")
    got = df.select("i", names.is_person_name(n).alias("p"), names.person_sentences(b).alias("s"), names.core_words(n).alias("c"), names.found_in_body(names.name_parts("n"), names.core_words(n), b).alias("f"))
    seen = set()
    for r in got.collect():
        _, name, body = rows[r.i]
        assert r.p == is_person_name(name), name
        assert r.s == person_sentences(body), body
        assert set(r.c) == {w for w in names.DESCRIPTIVE_WORDS if w in name}
        assert r.f == found(names.wide_parts(name), r.c, body), (name, body)
        seen.add(r.f)
    assert {"exact", None} <= seen
