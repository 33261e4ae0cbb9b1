import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmill.functions import names, similarity, text
from quillmill.operators import segment


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("﻿A \t\r\nB​\n\n\n\nC  \r\n　D  \n", "A\nB\n\nC\n　D"),
        ("A\n\n\n\nB   ", "A\n\nB   "),
        ("", ""), ("\n\n", ""), ("\r\r\r\rx", "x"),
    ],
)
def test_normalise(spark, raw, want):
    assert one(spark, raw, text.normalise) == want
    assert one(spark, want, text.normalise) == want


def test_ads(spark):
    body = "正文一\n关注我们的公众号吧\n请看 https://x.example\n第二 QQ群：12345678\n未经允许不得转载\n末行"
    assert one(spark, body, text.clean) == "正文一\n末行"


def test_tags(spark):
    assert one(spark, "内容标签：甜文、都市/爽文\r\nTags: a, b\n题材: 甜文".replace("\r\n", "\n"), text.tags) == ["甜文", "都市", "爽文", "a", "b", "甜文"]
    assert one(spark, "x\n" * 30 + "标签：a", text.tags) == []


@pytest.mark.parametrize(("stem", "want"), [("甲书-某人", ("甲书", "某人")), ("甲_乙_丙", ("甲_乙", "丙")), ("书（作者）", ("书", "作者")), ("书(作者)后记", ("书(作者)后记", None)), (" a ", ("a", None))])
def test_file_title(spark, stem, want):
    assert tuple(one(spark, stem, text.file_title)) == want


def test_small_functions(spark):
    assert one(spark, "a/b、c", text.split_each) == ["a", "b、c", "a/b", "c"]
    assert [one(spark, x, text.yes_no) for x in ("YES", "no", "不是", "maybe")] == [True, False, True, None]
    assert one(spark, "```json\n{}\n```", text.strip_fence) == "{}"
    assert one(spark, '他说"走吧"，「好」『嗯』“留”', text.without_dialogue) == "他说，“留”"
    assert one(spark, "<a href=\"x\">'&'</a>", text.escape_html) == "&lt;a href=&quot;x&quot;&gt;&#39;&amp;&#39;&lt;/a&gt;"
    assert one(spark, r"d:\cleaned\书\0001.md", text.book_of_path) == "书"
    assert one(spark, "短。这是足够长的句子！no. Yes it is?　ab", text.sentences) == ["这是足够长的句子", "no. Yes it is"]
    assert one(spark, "x" * 10 + "\n \n" + "长" * 25, text.first_paragraph) == "长" * 25
    assert one(spark, "x" * 200, lambda c: text.first_paragraph(F.concat(F.lit("a\n\n"), F.substring(c, 1, 5)))) == "a\n\nxxxxx"
    assert one(spark, "Ａ，b。 c“d”\n(e)", text.dedup_form) == "Ａbc“d”e"


def test_split_book(spark):
    got = one(spark, "文案\n标签：甜文\n第1章 初见\n甲走进来。\n第2章\n\n☆、第三回　重逢\n乙。", segment.split_book)
    assert got.synopsis == "文案\n标签：甜文" and [tuple(c) for c in got.chapters] == [("第1章 初见", "甲走进来。"), ("第三回　重逢", "乙。")] and not got.used_fallback
    got = one(spark, "01\n甲\n02\n乙", segment.split_book)
    assert [tuple(c) for c in got.chapters] == [("01", "甲"), ("02", "乙")] and got.used_fallback
    got = one(spark, "一\n二", segment.split_book)
    assert (got.synopsis, got.chapters, got.used_fallback) == ("一\n二", [], True)
    assert one(spark, "　　第一章 甲\nx\nChapter 2 b\ny\nCHAPTER3\nz\nchapter 4\n1", segment.split_book).chapters[2].body == "z\nchapter 4\n1"
    assert one(spark, None, segment.split_book).chapters == []


def test_drop_repeats():
    a = [c * 35 for c in "abcd"]
    body = "\n".join([*a, "mid line", *a, "tail line"])
    assert segment.drop_repeats(body)[0] == "\n".join([*a, "mid line"]) and len(segment.drop_repeats(body)[1]) == 1
    spaced = "\n\n".join([*a, "mid line", *a, "tail line"])
    assert segment.drop_repeats(spaced) == (spaced, [])
    short = "\n".join(["ab"] * 12)
    assert segment.drop_repeats(short) == (short, [])


def test_remove_repeats_table(spark):
    a = [c * 35 for c in "abcd"]
    df = spark.createDataFrame([(1, "\n".join([*a, *a])), (2, "plain"), (3, None), (4, "")], "id int, body string")
    got = {r.id: (r.body, len(r.removed)) for r in segment.remove_repeats(df).collect()}
    assert got == {1: ("\n".join(a), 1), 2: ("plain", 0), 3: (None, 0), 4: ("", 0)}


def test_shingles_and_signatures(spark):
    az = "abcdefghijklmnopqrstuvwxyz"
    assert sorted(x[0] for x in similarity.shingle_set(az)) == list("adgjm") and similarity.shingle_set("") == {""} and similarity.shingle_set("ab") == {"ab"}
    assert set(similarity.signature(az)) == {"02f51bf29adbe685"} and len(set(similarity.distinct_salts())) == 64

    def jac(x, y):
        s = [similarity.shingle_set(t) for t in (x, y)]
        return len(s[0] & s[1]) / len(s[0] | s[1])

    assert (jac(az, az), jac(az, "#" + az), round(jac(az, "###" + az), 4)) == (1.0, 0.0, 0.8333)
    df = spark.createDataFrame([([1, 2], [2, 3]), ([], [1])], "a array<int>, b array<int>")
    assert [r.j for r in df.select(similarity.jaccard(F.col("a"), F.col("b")).alias("j")).collect()] == [1 / 3, 0.0]


@settings(max_examples=100, deadline=None)
@given(st.text("ab ", min_size=30, max_size=120), st.integers(0, 60))
def test_minimizers_find_contained_texts(t, at):
    key = t[at : at + 30]
    if len(key) == 30:
        (m,) = similarity.minimizers(key)
        assert m in similarity.minimizers(t)


def test_names(spark):
    assert [one(spark, n, names.is_person_name) for n in ("顾言", "老人", "Tom", "安·李", "路人甲")] == [True, False, True, True, False]
    assert names.wide_parts("神秘的部长（王者们）") == {"神秘的部长（王者们）", "神秘的部长", "王者", "神秘", "部长（王者们）", "部长", "的部长（王者们）"} or "部长" in names.wide_parts("神秘的部长（王者们）")
    assert {"张三", "李四"} <= names.wide_parts("张三/李四") and names.narrow_parts("红衣的女人") == {"红衣的女人", "红衣", "女人"}
    df = spark.createDataFrame([("顾言", "顾言来了"), ("公关部长", "部长坐下"), ("无名氏", "没有人"), ("张三李", '张三"嗯"李走进门来')], "n string, b string")
    got = [r.f for r in df.select(names.found_in_body(names.name_parts("n"), names.core_words(F.col("n")), F.col("b")).alias("f")).collect()]
    assert got == ["exact", "exact", None, "sentence"]
