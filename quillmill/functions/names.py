"""Character names: parts, core words, kinds, and whether a body mentions them."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.text import SEPARATORS, sentences, strip, without_dialogue

#: Words for persons by kind, work, relation, group or office.
DESCRIPTIVE_WORDS = (
    "男生", "女生", "男人", "女人", "青年", "少年", "女孩", "男孩",
    "男子", "女子", "老人", "老道", "道士", "道姑", "和尚", "尼姑",
    "前辈", "后辈", "长辈", "晚辈", "师父", "徒弟", "师兄", "师弟",
    "师姐", "师妹", "掌门", "长老", "弟子", "门徒",
    "alpha", "beta", "omega", "Alpha", "Beta", "Omega",
    "同学", "朋友", "同事", "老板", "店员", "服务员", "司机", "老师",
    "学生", "客人", "顾客", "陌生人", "路人", "医生", "护士", "警察",
    "姐妹", "兄弟", "父子", "母子", "夫妻", "情侣", "搭档", "伙伴",
    "三姐妹", "双胞胎", "孪生", "众人", "大家", "人群", "队伍",
    "甲", "乙", "丙", "丁", "A", "B", "C", "O", "a", "b", "c", "o",
    "部长", "经理", "总监", "总裁", "董事长", "社长", "会长",
    "队长", "组长", "班长", "主任", "主管", "助理", "秘书",
    "科长", "处长", "局长", "厅长", "院长", "校长",
    "太监", "宫女", "丫鬟", "嬷嬷", "官员", "国君", "首领", "管家",
)
#: Adjectives before a name.
ADJECTIVES = ("神秘", "陌生", "年轻", "年老", "漂亮", "英俊", "普通")
#: Acts that follow a name.
ACTIONS = ("走进", "来到", "出现", "站在", "坐在", "看向", "望着", "看着", "伸手", "转身", "点头", "摇头", "跑", "走", "坐", "站")
#: Relations and descriptions of the second check.
RELATIONS = (
    "父亲", "母亲", "爸爸", "妈妈", "父母", "爸妈", "儿子", "女儿",
    "哥哥", "姐姐", "弟弟", "妹妹", "奶奶", "爷爷", "祖母", "祖父",
    "丈夫", "妻子", "兄长", "姐妹", "兄弟", "室友", "同桌",
    "手下", "下属", "跟班", "同伙", "同伴", "伙伴",
)
DESCRIPTIONS = (
    "神秘人", "路人", "围观", "陌生", "邻居", "朋友", "同学",
    "老板", "店员", "服务员", "司机", "老师", "学生",
    "小贩", "伙计", "小二", "摊主", "店主",
)
#: A name with one of these describes and does not name.
MARKERS = (
    "人", "者", "男", "女", "老", "少", "小", "大", "哥", "姐", "弟", "妹",
    "父", "母", "爷", "奶", "夫", "妻", "子", "儿",
    "群", "众", "们", "队", "组", "团", "派", "军", "兵", "将", "官",
    "鬼", "尸", "妖", "魔", "神", "仙", "佛", "道", "僧", "尼",
    "猫", "狗", "鹰", "牛", "狼", "犬", "鼠", "萤", "鹦鹉",
    "员", "师", "生", "医", "警", "商", "贩", "匠", "工", "农",
    "主", "长", "首", "头", "领", "管", "卫", "侍", "仆", "奴", "婢",
    "修士", "弟子", "门生", "门人", "客卿", "家主", "族长",
    "摊主", "店主", "老板", "伙计", "小二", "小厮", "丫鬟",
    "观众", "网友", "粉丝", "住户", "邻居", "路人", "神秘",
    "陌生", "无名", "不明", "围观", "其他", "若干",
    "甲", "乙", "丙", "丁",
)

_BRACKETED = re.compile('[（("]([^）)"]+)[）)"]')
_SUFFIX = re.compile(r"[等们]+\s*$")


def _pieces(text: str) -> set[str]:
    """Parts by each separator that occurs."""
    return {p for s in SEPARATORS if s in text for p in map(str.strip, text.split(s)) if p}


def _inner_outer(name: str) -> tuple[str, str]:
    """What stands in the first brackets, without a plural ending, and what stands outside."""
    if not (m := _BRACKETED.search(name)):
        return "", ""
    return _SUFFIX.sub("", m[1].strip()).strip(), _BRACKETED.sub("", name).strip()


def wide_parts(name: str) -> set[str]:
    """Everything of two characters or more that may stand for the name in a body."""
    name = name.strip()
    inner, outer = _inner_outer(name)
    parts = {name, inner, outer} | _pieces(inner) | _pieces(name)
    if inner.endswith("者"):
        parts.add(inner[:-1])
    of = name.split("的")
    if len(of) > 1:
        parts |= {of[0].strip(), of[-1].strip()}
    for word in DESCRIPTIVE_WORDS:
        if word in name:
            before = name.partition(word)[0].strip()
            parts |= {word, before} | ({p.strip() for p in before.split("的")} if "的" in before else set())
    parts |= {_SUFFIX.sub("", p).strip() for p in parts}
    parts |= {p[:-1] for p in parts if p.endswith("者") and len(p) > 2}
    parts |= {name[len(a) :].strip() for a in ADJECTIVES if name.startswith(a)}
    return {p for p in parts if len(p) >= 2}


def narrow_parts(name: str) -> set[str]:
    """The parts of the second check: brackets, all sides of 的, separators."""
    name = name.strip()
    inner, outer = _inner_outer(name)
    parts = {name, inner, outer} | _pieces(name)
    if "的" in name:
        parts |= {p.strip() for p in name.split("的")}
    return {p for p in parts if len(p) >= 2}


def _listed(parts: Callable[[str], set[str]], c: str | Column) -> Column:
    @F.pandas_udf("array<string>")
    def run(names: pd.Series) -> pd.Series:
        return names.map(lambda n: sorted(parts(n or "")))

    return run(c)


def name_parts(c: str | Column) -> Column:
    return _listed(wide_parts, c)


def recheck_parts(c: str | Column) -> Column:
    return _listed(narrow_parts, c)


def contained_words(name: Column, words: Sequence[str]) -> Column:
    """The words that occur in ``name``, sorted."""
    found = F.filter(F.array(*(F.lit(w) for w in dict.fromkeys(words))), lambda w: F.contains(name, w))
    return F.array_sort(found)


def core_words(name: Column) -> Column:
    return contained_words(name, DESCRIPTIVE_WORDS)


def recheck_words(name: Column) -> Column:
    return contained_words(name, RELATIONS + DESCRIPTIONS)


def mentions_person(sentence: Column) -> Column:
    """Whether a sentence, without its dialogue, has a person in it."""
    words = "|".join(DESCRIPTIVE_WORDS)
    return without_dialogue(sentence).rlike(f"{words}|[\\u4e00-\\u9fa5]{{2,4}}(?:{'|'.join(ACTIONS)})")


def person_sentences(body: Column, least: int = 5) -> Column:
    kept = F.filter(sentences(body), mentions_person)
    return F.filter(F.transform(kept, without_dialogue), lambda s: F.length(s) >= least)


def is_person_name(name: Column) -> Column:
    """Whether it names a certain person: 2 to 4 Han characters, a dotted name, or letters, and
    nothing in it that describes."""
    bare = strip(F.regexp_replace(strip(F.regexp_replace(name, "[（(][^）)]*[）)]", "")), '(?d)".*?"', ""))
    form = r"^(?:[一-龥]{2,4}|[一-龥]{1,3}·[一-龥]{1,4}|[A-Za-z]+)$"
    return F.coalesce(~bare.rlike("|".join(MARKERS)) & bare.rlike(form), F.lit(False))


def _in(parts: Column, body: Column) -> Column:
    return F.exists(parts, lambda p: (F.length(p) >= 2) & F.contains(body, p))


def found_in_body(parts: Column, core: Column, body: Column) -> Column:
    """How the first check finds a name: exact, core, sentence, or null.

    The body goes first; sentences can add a match only where a dropped dialogue joins text.
    """
    spoken = F.array_join(person_sentences(body), "\n")
    return (
        F.when(_in(parts, body), "exact").when(_in(core, body), "core")
        .when(_in(F.concat(parts, core), spoken), "sentence")
    )


def found_again(parts: Column, core: Column, body: Column) -> Column:
    """Whether the second check finds a name."""
    return _in(F.concat(parts, core), body)
