import pathlib
import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.functions.similarity import shingle_hashes
from quillmill.operators import dedup, export, qa, sample
from quillmill.plans import cli
from quillmill.sources import files, model, reports
from quillmill.streaming import incremental

PERSON = "struct<name:string,role:string,state:string,speech:string,importance:string,function:string>"
CHAPTER = f"file string, book string, world string, scene string, emotion string, plot string, style string, pov string, characters array<{PERSON}>, body string, flags array<string>, chapter_no int, title string"


def chapter(file, people=(), **kw):
    d = {"file": file, "book": "b", "world": None, "scene": None, "emotion": None, "plot": None, "style": None, "pov": None, "characters": [(*p, None, None, None)[:6] if len(p) == 3 else p for p in people], "body": "", "flags": [], "chapter_no": 1, "title": None}
    return tuple((d | kw).values())


def frame(spark, *rows):
    return spark.createDataFrame(rows, CHAPTER)


def test_scores(spark):
    df = frame(spark, chapter("1", [("甲", None, "x"), ("乙", None, None)], world="w", scene="s", plot="p" * 60), chapter("2"))
    one, two = qa.scores(df).orderBy("file").collect()
    assert (round(one.completeness, 6), one.conciseness, one.char_count_score, one.char_info, round(one.overall, 6)) == (57.142857, 80, 100, 50, 71.785714)
    assert tuple(two)[1:] == (0, 100, 0, 0, 25)
    assert [r.file for r in qa.low_scores(qa.scores(df)).collect()] == ["2"]


def test_issues_of_each_kind(spark):
    df = frame(
        spark, chapter("1", [("顾言", "攻", "x"), ("", "r", "s"), ("无此人名", None, None)], world="w", scene="s" * 151, emotion="e", plot="p" * 101, style="y", body="顾言" * 300), chapter("2"),
    ).withColumn("book_world", F.lit("other")).withColumn("malformed", F.col("file") == "3")
    got = sorted((r.file, r.issue_type, r.detail) for r in qa.issues(df).collect())
    assert [x[1:] for x in got if x[0] == "1"] == sorted([
        (qa.LONG_SCENE, "151"), (qa.LONG_PLOT, "101"), (qa.OTHER_WORLD, "other|w"), (qa.NO_NAME, ""), (qa.NO_ROLE, "无此人名"), (qa.NO_STATE, "无此人名"), (qa.NOT_IN_BODY, "无此人名"),
    ])
    assert sum(x[0] == "2" and x[1] == qa.NO_FIELD for x in got) == 6
    verdict = spark.createDataFrame([("1", "无此人名", True)], "file string, name string, present boolean")
    assert qa.issues(df, verdict).where(F.col("issue_type") == qa.NOT_IN_BODY).count() == 0
    assert qa.issues(df.withColumn("malformed", F.lit(True))).select("issue_type").distinct().first()[0] == qa.MALFORMED
    assert qa.stats(df, qa.issues(df)).first().chapters_with_issues == 2


def test_recheck_and_names(spark):
    df = frame(spark, chapter("1", body="他的父亲来了"))
    p = spark.createDataFrame([("1", "某父亲"), ("1", "顾言"), ("gone", "Tom")], "file string, character string")
    checked = qa.recheck(p, df)
    assert {r.character: r.confirmed for r in checked.collect()} == {"某父亲": False, "顾言": True, "Tom": True}
    assert {r.character for r in qa.final_names(checked).where("specific").collect()} == {"顾言", "Tom"}
    assert "【确认问题列表】" in reports.rechecked(checked) and "顾言 (1)" in reports.final(qa.final_names(checked))


def test_migrate_and_fill(spark):
    old = spark.createDataFrame([("1", "p", None), ("2", "p", "q")], "file string, plot_outline string, plot string")
    assert [r.plot for r in qa.migrate(old).orderBy("file").collect()] == ["p", "q"]
    df = frame(spark, chapter("1", scene="kept", emotion=""))
    made = spark.createDataFrame([("1", "new", "calm")], "file string, scene string, emotion string")
    r = qa.fill_empty(df, made).first()
    assert (r.scene, r.emotion) == ("kept", "calm")


def test_export(spark):
    books = spark.createDataFrame([("b", "W", ["odd"]), ("c", "V", [])], "book string, world string, flags array<string>")
    rows = frame(spark, chapter("1", [("甲", "攻", "x", "y", None, None)], scene="S"), chapter("2", book="c", flags=["f"]), chapter("3", book="nobook"))
    r = {x.book: x for x in export.training_records(books, rows).collect()}
    assert r["b"].messages[0].content == "[世界观] W\n[当前场景] S\n[人物状态]\n- 甲（攻）：x；说话风格：y" and set(r) == {"b", "c"}
    assert export.training_records(books, rows, skip_flagged=True).count() == 0
    assert tuple(export.export_stats(books, rows, True).first()) == (0, 0, 0, 2) and tuple(export.export_stats(books, rows).first()) == (2, 2, 2, 0)
    assert '"chapter_index":null' in export.record_json(export.training_records(books, rows, compat=True)).first().value
    assert export.flags(books, rows).count() == 2


def books_frame(spark, rows):
    df = spark.createDataFrame([(b, f"{i:03d}", t) for i, (b, t) in enumerate(rows)], "book string, path string, text string")
    return dedup.fingerprint(df)


def test_against_index_and_exact(spark):
    cached = books_frame(spark, [("A", "text of a " * 30), ("Z", "text of a " * 30), ("N", "near " + "long text here " * 50)]).withColumn("pos", F.col("path").cast("long"))
    new = books_frame(spark, [("B", "text of a " * 30), ("C", "new"), ("D", "new"), ("A", "text of a " * 30)])
    rest, dropped = dedup.against_index(new, cached)
    assert {(r.book, r.reason, r.duplicate_of) for r in dropped.collect()} == {("B", "exact_duplicate", "A"), ("A", "exact_duplicate", "Z")}
    unique, second = dedup.exact_among(rest)
    assert [r.book for r in unique.collect()] == ["C"] and [(r.book, r.duplicate_of) for r in second.collect()] == [("D", "C")]
    assert dedup.unseen(new, cached).count() == 3 and dedup.unseen(new, cached, force=True).count() == 4


def brute_greedy(near, count):
    """The pass as nested loops; a book's first record counts."""
    gone, out = set(), {}
    for i in range(len(count)):
        if i in gone:
            continue
        for j in range(i + 1, len(count)):
            if j not in gone and near(i, j):
                short, long = (i, j) if count[i] <= count[j] else (j, i)
                gone.add(short)
                out.setdefault(short, long)
    return sorted(out.items())


@pytest.mark.parametrize("same_salts", [True, False])
def test_greedy_equals_brute_force(spark, same_salts):
    from quillmill.functions.similarity import SAME_SALTS, distinct_salts

    rng = random.Random(6)
    base = "".join(rng.choice("甲乙丙丁戊己庚辛") for _ in range(900))
    rows = [(f"b{i}", base[: 900 - rng.randrange(0, 200, 3)] if i % 3 else "".join(rng.choice("子丑寅卯") for _ in range(300))) for i in range(24)]
    rows = [(b, t) for n, (b, t) in enumerate(rows) if t not in [x for _, x in rows[:n]]]
    df = spark.createDataFrame([(b, f"{i:03d}", t) for i, (b, t) in enumerate(rows)], "book string, path string, text string")
    df = dedup.fingerprint(df, salts=SAME_SALTS if same_salts else distinct_salts())
    info = [(r.book, r.char_count, r.fp) for r in df.orderBy("path").collect()]

    def near(i, j):
        (_, a, x), (_, b, y) = info[i], info[j]
        return min(a, b) / max(a, b) >= 0.85 and sum(p == q for p, q in zip(x, y, strict=True)) / 64 >= 0.8

    want = brute_greedy(near, [c for _, c, _ in info])
    kept, dropped = dedup.greedy_among(df, same_salts=same_salts)
    assert sorted((r.book, r.duplicate_of) for r in dropped.collect()) == sorted((info[a][0], info[b][0]) for a, b in want) and want
    assert {r.book for r in kept.collect()} == {b for b, _, _ in info} - {info[a][0] for a, _ in want}


def test_greedy_order():
    import numpy as np

    def run(pairs, count):
        return sorted(dedup.greedy(lambda i: np.array(sorted(j for a, j in pairs if a == i), int), np.array(count)))

    assert run([(0, 1)], [5, 5]) == [(0, 1)]
    assert run([(0, 1), (0, 2), (1, 2)], [5, 9, 7]) == [(0, 1), (2, 1)]
    for seed in range(200):
        rng = random.Random(seed)
        n = rng.randint(1, 9)
        pairs = {(i, j) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}
        count = [rng.randint(1, 4) for _ in range(n)]
        assert run(pairs, count) == brute_greedy(lambda i, j, p=pairs: (i, j) in p, count)


def test_greedy_by_length():
    for seed in range(300):
        rng = random.Random(seed)
        count = np.array([rng.randint(0, rng.choice([3, 30, 300])) for _ in range(rng.randint(0, 60))], "i8")

        def near(i, count=count):
            later = count[i + 1 :]
            return i + 1 + np.flatnonzero(np.minimum(later, count[i]) >= dedup.LEAST_RATIO * np.maximum(later, count[i]))

        assert sorted(dedup.greedy_by_length(count, dedup.LEAST_RATIO)) == sorted(dedup.greedy(near, count))


def test_a_common_paragraph_makes_no_pairs(spark):
    p = "".join(chr(0x5000 + i) for i in range(400))
    bodies = [p + "\n\n" + "".join(chr(0x6000 + (i * 130 + k) % 9000) for k in range(130)) for i in range(60)]
    c = spark.createDataFrame([("b", f"{i:03d}", t) for i, t in enumerate(bodies)], "book string, file string, body string")
    members = c.select("book", "file", F.lit("n").alias("norm"), F.length("body").alias("n"))
    sets = c.select("book", "file", shingle_hashes(F.col("body")).alias("s"))
    # The paragraph is 0.75 of each chapter, similar pairs are none.
    assert dedup._alike_in_group(members, sets, 0.8).count() == 0
    twice = sets.unionByName(sets.withColumn("file", F.concat("file", F.lit("x"))))
    both = members.unionByName(members.withColumn("file", F.concat("file", F.lit("x"))))
    assert {(r.file_a, r.file_b) for r in dedup._alike_in_group(both, twice, 0.8).collect()} == {(f"{i:03d}", f"{i:03d}x") for i in range(60)}


def test_chapter_duplicates(spark):
    p = "这一段的开头足够长，可以作为搜索的关键词使用，因为它超过了三十个字符。"
    long = "".join(chr(0x4E00 + i * 7 % 5000) for i in range(800))
    rows = [("b", "1", p + "\n\n" + long), ("b", "2", p + "\n\n" + long + "尾"), ("b", "3", "另一个开头，同样也要写得足够长才会被当作段落来看待。\n\n" + p + long), ("c", "4", p + "\n\n" + long), ("b", "5", None)]
    got = {(r.file, r.duplicate_of, r.reason[:4]) for r in dedup.chapter_duplicates(spark.createDataFrame(rows, "book string, file string, body string")).collect()}
    assert ("1", "2", "首段相同") in got and all(f != "4" for f, _, _ in got)


def brute_chapter_duplicates(rows, threshold=0.8):
    """The two stages as nested loops over the chapters of each book, in file order."""
    import re

    from quillmill.functions.similarity import shingle_set

    def form(t):
        return re.sub(r"""[，。！？、；：《》（）【】.,!?;:'"()\[\]{}]""", "", re.sub(r"\s+", "", t))

    def para(t):
        good = [p.strip() for p in re.split(r"\n\s*\n", t) if len(p.strip()) >= 20]
        return good[0] if good else t[:100]

    def similar(a, b):
        x, y = form(a), form(b)
        if not x or not y:
            return 0.0
        p, q = shingle_set(x), shingle_set(y)
        return len(p & q) / len(p | q)

    out = {}
    for book in {b for b, _, _ in rows}:
        c = sorted((f, t) for b, f, t in rows if b == book and t)
        seen, found = set(), []
        for i, (f, t) in enumerate(c):
            for g, u in c[i + 1 :]:
                if form(para(t)) == form(para(u)) and len(form(para(t))) >= 10:
                    seen.add((f, g))
                    if similar(t, u) >= threshold:
                        found.append((g, f) if len(t) >= len(u) else (f, g))
        for f, t in c:
            if len(para(t)) < 30:
                continue
            for g, u in c:
                pair = (min(f, g), max(f, g))
                if g != f and pair not in seen and para(t)[:30] in u:
                    seen.add(pair)
                    if similar(t, u) >= threshold:
                        found.append((g, f) if len(t) >= len(u) else (f, g))
        for gone, kept in found:
            out.setdefault((book, gone), kept)
    return {(b, f, k) for (b, f), k in out.items()}


@pytest.mark.parametrize("seed", range(3))
def test_chapter_duplicates_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    heads = ["这一段的开头足够长，可以作为搜索的关键词使用，因为它超过了三十个字符。", "另一个开头，同样写得足够长才会被当作段落来看待，这里也有三十多个字符。", "短开头", "！！！！" * 9]
    pool = ["".join(chr(0x4E00 + rng.randrange(4000)) for _ in range(300)) for _ in range(3)]
    rows = []
    for i in range(70):
        core = rng.choice(pool)
        cut = rng.choice([0, 0, 0, 3, 6, 30])
        core = core[: len(core) - cut] + rng.choice(["", "", "尾"])
        body = rng.choice(heads) + "\n\n" + core if rng.random() < 0.8 else core + "\n\n" + rng.choice(heads) + core[:50]
        rows.append((rng.choice("ab"), f"{i:03d}", rng.choice([body, body, body, "", "！。" * 30])))
    got = dedup.chapter_duplicates(spark.createDataFrame(rows, "book string, file string, body string"))
    assert {(r.book, r.file, r.duplicate_of) for r in got.collect()} == brute_chapter_duplicates(rows)


def test_sample(spark):
    df = spark.range(100).select(F.format_string("%03d", F.col("id")).alias("file"), F.lit("b").alias("book"))
    got = [(r.sample_no, r.file) for r in sample.sample(df, ["file"], 5, 42).orderBy("sample_no").collect()]
    assert got == [(n, f"{p:03d}") for n, p in enumerate(random.Random(42).sample(range(100), 5), 1)]
    assert sample.sample(df, ["file"], 500, 1).count() == 100
    s = spark.createDataFrame([(1, "overall_score", 3)], "sample_no int, key string, value int")
    assert sample.set_score(s, 1, "overall_score", 3).count() == 0 and sample.set_score(s, 1, "overall_score", 4).first().value == 4


def test_decode_and_paths(tmp_path):
    for name in ("utf-8", "gb18030"):
        assert files.decoded("第一章 你好，世界".encode(name)) == "第一章 你好，世界"
    assert files.decoded("x".encode("utf-16"), lambda b: ("utf-16", 0.9)) == "x" and files.decoded(b"abc", lambda b: ("utf-16", 0.5)) == "abc"
    assert files.patterns("# c\n\n a \n") == ["a"]
    assert files.confined(str(tmp_path), "a/b").endswith("a/b")
    with pytest.raises(ValueError, match="refusing"):
        files.confined(str(tmp_path), "../x")


def test_incremental_and_cli(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    raw = tmp_path / "raw"
    raw.mkdir()
    body = "这里是第一章的内容，有很多字。" * 10
    (raw / "甲-某.txt").write_bytes(f"标签：甜文\n第1章 起\n{body}\n第2章 承\n后续".encode("gb18030"))
    (raw / "乙.txt").write_text(f"标签：甜文\n第1章 起\n{body}\n第2章 承\n后续", encoding="utf-8")
    (raw / "x.md").write_text("no")
    out = str(tmp_path / "tables")
    got = incremental.run_once(spark, str(raw), out)
    assert {(r.book, r.status, r.duplicate_of) for r in got["index"].collect()} in ({("甲", "cleaned", None), ("乙", "duplicate", "甲")}, {("乙", "cleaned", None), ("甲", "duplicate", "乙")})
    assert sorted(r.title for r in got["chapters"].collect()) == ["第1章 起", "第2章 承"] and got["books"].first().tags == ["甜文"]
    assert incremental.run_once(spark, str(raw), out)["chapters"].count() == 0
    assert incremental.run_once(spark, str(raw), out, force=True)["dropped"].count() <= 1
    (raw / "丙.txt").write_text("01\n新书\n02\n乙", encoding="utf-8")
    q = incremental.stream(spark, str(raw), out, str(tmp_path / "check"))
    q.awaitTermination(120)
    last = incremental._latest(spark, out)
    assert {r.book for r in last.collect()} == {"甲", "乙", "丙"}

    folder = tmp_path / "cleaned" / "书"
    folder.mkdir(parents=True)
    (folder / "_book_meta.yaml").write_text(yaml.safe_dump({"book": "书", "world": "W", "flags": ["查"], "tags": ["a"]}, allow_unicode=True), encoding="utf-8")
    meta = {"plot_outline": "旧", "scene": 123, "characters": [{"name": "顾言", "role": "攻"}]}
    (folder / "0001.md").write_text("---\n" + yaml.safe_dump(meta, allow_unicode=True) + "---\n\n顾言来了\n", encoding="utf-8")
    (folder / "0002.md").write_text("nothing", encoding="utf-8")
    (folder / "0003.md").write_text("---\n: [\n---\nbody", encoding="utf-8")
    c = {r.chapter_no: r for r in files.chapter_files(spark, str(tmp_path / "cleaned")).collect()}
    assert c[1].plot == "旧" and c[1].scene == "123" and c[1].body == "顾言来了" and c[2].malformed and c[3].parse_error and c[1].book == "书"
    root = ["--root", str(tmp_path)]
    fresh = tmp_path / "fresh"
    (fresh / "raw").mkdir(parents=True)
    (fresh / "configs").mkdir()
    (fresh / "configs" / "ad_patterns.txt").write_text("# rules\n\n.*来看看.*\n", encoding="utf-8")
    (fresh / "raw" / "丁.txt").write_text("简介\n第1章 起\n正文一\n快来看看吧\n第2章 承\n正文二", encoding="utf-8")
    cli.main(["--root", str(fresh), "clean"], spark)
    assert (fresh / "cleaned/丁/0002.md").read_text(encoding="utf-8").endswith("---\n\n正文二\n")
    assert yaml.safe_load((fresh / "cleaned/丁/_book_meta.yaml").read_text(encoding="utf-8"))["synopsis"] == "简介"
    assert "来看看" not in (fresh / "cleaned/丁/0001.md").read_text(encoding="utf-8")
    assert spark.read.json(f"{fresh}/tables/corpus_index").select("book", "status").collect() == [("丁", "cleaned")] and (fresh / "logs/dedup").exists()
    cli.main(["--root", str(fresh), "export"], spark)
    assert '"file_name": "train.jsonl"' in (fresh / "export/dataset_info.json").read_text(encoding="utf-8")
    told = []
    cli.main(["--root", str(fresh), "draft", "--scope", "book"], spark, client=lambda s, u: '{"world": "江湖", "banned_terms": ["x"]}' if "书名：丁" in u and "简介" in u else told.append(u))
    about = yaml.safe_load((fresh / "cleaned/丁/_book_meta.yaml").read_text(encoding="utf-8"))
    assert about["world"] == "江湖" and about["banned_terms"] == ["x"] and about["synopsis"] == "简介" and "emotion: ''" in (fresh / "cleaned/丁/0001.md").read_text(encoding="utf-8")
    # A run that broke off before its index was whole is done again in the same place.
    shutil.rmtree(fresh / "tables" / "index")
    cli.main(["--root", str(fresh), "clean"], spark)
    assert spark.read.parquet(f"{fresh}/tables/chapters").count() == 2
    for verb in (["export"], ["flags"], ["validate"], ["recheck"], ["recheck", "--newest"], ["final"], ["final", "--newest"], ["score"], ["sample", "--seed", "3"], ["review"], ["dups"]):
        cli.main([*root, *verb], spark)
    assert "角色不在正文" not in (tmp_path / "reports/validation.txt").read_text(encoding="utf-8")
    assert "顾言" in (tmp_path / "review.html").read_text(encoding="utf-8")
    assert [(r.folder, r.world, r.flags) for r in files.book_files(spark, str(tmp_path / "cleaned")).collect()] == [("书", "W", ["查"])]
    assert files.book_files(spark, str(tmp_path / "raw")).count() == 0
    cli.main([*root, "draft"], spark, client=lambda s, u: '```json\n{"emotion": "calm", "style": "plain"}\n```')
    assert "emotion: calm" in (folder / "0001.md").read_text(encoding="utf-8")


def test_replies_keep_going(spark):
    def client(system, user):
        if user == "bad":
            raise RuntimeError("down")
        return "是"

    df = spark.createDataFrame([("s", "ok"), ("s", "bad")], "system string, user string")
    got = {r.user: (r.present, r.error) for r in model.verdicts(model.replies(df, client)).collect()}
    assert got == {"ok": (True, None), "bad": (None, "down")}


def test_index_file_and_reports(spark, tmp_path):
    (tmp_path / "i.jsonl").write_text('{"book":"A","status":"cleaned","hash":"1"}\n{"book":"B","status":"cleaned"}\n{"book":"A","status":"duplicate"}\n')
    got = {r.book: r.status for r in files.corpus_index(spark, str(tmp_path / "i.jsonl")).collect()}
    assert got == {"A": "duplicate", "B": "cleaned"}
    text = "x\n  [角色不在正文] 2\n    1. cleaned/书/0001.md: 甲\n    2. cleaned/书/0002.md: 乙\n  [无角色] 1\n    1. cleaned/书/0003.md: 丙\n"
    rows = files.report_problems(spark.createDataFrame([(text,)], "value string")).collect()
    assert [(r.file, r.character) for r in rows] == [("cleaned/书/0001.md", "甲"), ("cleaned/书/0002.md", "乙")]
    text = "【确认问题列表】\n  1. cleaned/书/0001.md: 甲\n"
    assert files.report_problems(spark.createDataFrame([(text,)], "value string"), True).first().character == "甲"
    (tmp_path / "s.json").write_text('{"1": {"overall_score": 4, "comment": "x"}, "2": {}}')
    assert tuple(sample.scored_count(files.review_scores(spark, str(tmp_path / "s.json"))).first()) == (1, 1)
    assert files.dataset_descriptor()["formatting"] == "sharegpt" and "train" in reports.descriptor(files.dataset_descriptor())


def test_logs_and_descriptions(spark, tmp_path):
    from quillmill.operators import segment

    dropped = spark.createDataFrame([("书, 一", "exact_duplicate", "二")], "book string, reason string, duplicate_of string")
    for _ in range(2):
        files.append_dedup_log(dropped, str(tmp_path / "log"))
    assert spark.read.csv(str(tmp_path / "log")).count() == 2
    removed = spark.createDataFrame([("书", "第1章", ["x" * 100 + "\ny"])], "b string, t string, r array<string>")
    lines = removed.select(F.explode(segment.repeat_log(F.col("b"), F.col("t"), F.col("r"))).alias("value"))
    files.append_lines(lines, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).first().value == "书 / 第1章: " + "x" * 80
    kind = "book string, source_file string, tags array<string>, synopsis string, flags array<string>"
    new = spark.createDataFrame([("A", "a.txt", ["t"], "s", []), ("B", "b.txt", [], "", [])], kind)
    assert [r.book for r in files.new_descriptions(new, new.where("book = 'A'")).collect()] == ["B"]
    index = spark.createDataFrame([("A", "cleaned", None, "a", 1, "h", ["0"], 0)], incremental.INDEX)
    files.write_index(index, str(tmp_path / "index"))
    files.write_index(index, str(tmp_path / "index"))
    assert files.corpus_index(spark, str(tmp_path / "index")).first().hash == "h"
    c = spark.createDataFrame([("b", "1"), ("b", "2")], "book string, file string")
    assert dedup.without(c, c.where("file = '2'")).first().file == "1"


def test_reports_list_every_row(spark):
    n = 5003
    file = F.format_string("cleaned/b/%05d.md", "id")
    found = spark.range(n).select(file.alias("file"), F.lit(qa.NOT_IN_BODY).alias("issue_type"), F.concat(F.lit("n"), "id").alias("detail"))
    text = reports.validation(spark.range(1), found.groupBy("issue_type").agg(F.count("*").alias("n")), found)
    again = files.report_problems(spark.createDataFrame([(text,)], "value string"))
    assert again.count() == n
    checked = spark.range(2 * n).select(file.alias("file"), F.concat(F.lit("n"), "id").alias("character"), (F.col("id") < n).alias("confirmed"))
    text = reports.rechecked(checked)
    assert text.partition("【误报列表】")[2].count("cleaned") == n
    assert files.report_problems(spark.createDataFrame([(text,)], "value string"), confirmed=True).count() == n
    text = reports.final(checked.withColumn("specific", F.col("confirmed")))
    assert text.partition("【可忽略的描述性角色】")[0].count("cleaned") == n == text.partition("【可忽略的描述性角色】")[2].count("cleaned")
    dups = spark.range(n).select(F.concat(F.lit("b"), "id").alias("book"), file.alias("file"), file.alias("duplicate_of"), F.lit("exact").alias("reason"))
    assert reports.duplicates(dups).count(": 1") == n == reports.duplicates(dups).count(" -> ")


def test_chapter_duplicates_write_little(spark):
    """The work tables are smaller than the chapters; a line that many chapters
    begin with and many others hold makes no pairs of texts."""
    rng = random.Random(0)
    line = "".join(chr(0x5000 + i) for i in range(40))

    def fresh(n):
        return "".join(chr(0x4E00 + rng.randrange(9000)) for _ in range(n))

    rows = [("b", f"{i:03d}", line + "\n\n" + fresh(900)) for i in range(120)]
    rows += [("b", f"{i:03d}", fresh(500) + "\n\n" + line + fresh(400)) for i in range(120, 240)]
    rows += [("b", "240", rows[7][2] + "尾"), ("b", "241", rows[150][2][:-1]), ("b", "242", rows[7][2])]
    c = spark.createDataFrame(rows, "book string, file string, body string")
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = {*shared.rglob("*.parquet")}
    got = {(r.file, r.duplicate_of) for r in dedup.chapter_duplicates(c).collect()}
    assert got == {(f, k) for _, f, k in brute_chapter_duplicates(rows)}
    size = sum(p.stat().st_size for p in {*shared.rglob("*.parquet")} - before if p.is_file())
    assert size < sum(len(b.encode()) for _, _, b in rows) / 2


def test_bloom_loses_nothing(spark):
    from quillmill.operators.filters import bloom, held

    keys = bloom(spark.range(9000).select(F.xxhash64("id").alias("h")), "h")
    h = np.array([r.h for r in spark.range(20000).select(F.xxhash64("id").alias("h")).collect()]).view("u8")
    at = held(keys.value, h)
    assert len(keys.value) > 1 << 13 and set(range(9000)) <= set(at.tolist()) and len(at) < 9050


def test_window_hashes():
    from quillmill.functions.similarity import codes_of, shingle_array, shingle_set, window_hashes

    for width in (1, 2, 7, 12, 30, 31):
        t = "abcab" * 9 + "\0甲𠀀"
        h = window_hashes(codes_of(t), width)
        runs = [t[i : i + width] for i in range(len(t) - width + 1)]
        assert len(h) == len(runs) and len(set(h.tolist())) == len(set(runs)) == len(set(zip(h.tolist(), runs, strict=True)))
    for t in ("", "ab", "abc" * 30, "甲乙丙" * 5 + "x"):
        assert len(shingle_array(codes_of(t))) == (len(shingle_set(t)) if t else 0)


def test_form_codes_equal_dedup_form(spark):
    from quillmill.functions.similarity import form_codes
    from quillmill.functions.text import dedup_form, is_blank

    t = "".join(chr(i) for i in range(1, 0x11000) if not 0xD800 <= i < 0xE000)
    r = spark.createDataFrame([(t,)], "t string").select(dedup_form("t").alias("f"), is_blank("t").alias("b"), is_blank(F.lit(" 。　\x1c")).alias("c"), is_blank(F.lit("。a")).alias("d")).first()
    assert [ord(x) for x in r.f] == form_codes(t).tolist() and (r.b, r.c, r.d) == (False, True, False)


def test_dup_per_book_writes_little(spark, tmp_path):
    from quillmill.plans import queries

    rng = random.Random(1)
    line = "".join(chr(0x5000 + i) for i in range(40))
    texts = [line + "\n" + "".join(chr(0x4E00 + rng.randrange(9000)) for _ in range(900)) for _ in range(150)]
    texts += [t + "尾" for t in texts[:3]]
    rows = [(i, t, "zh", "b") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = {*shared.rglob("*.parquet")}
    assert [tuple(r) for r in queries.dup_per_book(spark, str(tmp_path)).collect()] == [("b", 3)]
    size = sum(p.stat().st_size for p in {*shared.rglob("*.parquet")} - before if p.is_file())
    assert size < sum(len(t.encode()) for t in texts) / 2
