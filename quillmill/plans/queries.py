"""Queries over the driver's tables, each with its DuckDB SQL where SQL can express it.

The tables hold no novels, so books and chapters are derived from ``documents``: a document is
a book whose lines are its chapters, or a chapter of the book ``source``; annotations come from
its columns.  The SQL derives them in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import names, similarity, text
from quillmill.operators import dedup, export, qa, sample, segment
from quillmill.operators.tables import spread, written
from quillmill.sources.reports import files_per_name

RULES = (r".*License.*", r".*@.*", r".*\|.*")
CHARACTERS = "array<struct<name:string,role:string,state:string,speech:string,importance:string,function:string>>"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_docs`` for queries whose cost is Python."""
    return spread(_docs(spark, sf_dir))


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source")


def md5(c):
    return F.md5((F.col(c) if isinstance(c, str) else c).cast("binary"))


# --- text -----------------------------------------------------------------------------------


def normalize_docs(spark, sf_dir):
    t = text.normalise("text")
    return _docs(spark, sf_dir).select("doc_id", t.alias("t")).select("doc_id", md5("t").alias("text_md5"), F.length("t").cast("long").alias("n"))


NORMALISED = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'),
  '[\x{FEFF}\x{200B}\x{200C}\x{200D}]', '', 'g'), '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\n+|\n+\z', '', 'g')"""


def clean_docs(spark, sf_dir):
    t = text.clean("text", RULES)
    return _docs(spark, sf_dir).select("doc_id", t.alias("t")).select("doc_id", md5("t").alias("text_md5"), F.size(text.lines("t")).cast("long").alias("n_lines"))


def doc_fingerprint(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", md5("text").alias("hash"), F.length("text").cast("long").alias("char_count"), text.garbled("text").alias("garbled"))


def parse_names(spark, sf_dir):
    stem = F.when(F.col("doc_id") % 3 == 0, F.concat("source", F.lit("-"), "lang")).when(F.col("doc_id") % 3 == 1, F.concat("source", F.lit("（"), "lang", F.lit("）"))).otherwise(F.col("source"))
    t = text.file_title(stem)
    return _docs(spark, sf_dir).select("doc_id", t["title"].alias("title"), t["author"].alias("author"))


def extract_tags(spark, sf_dir):
    tagged = F.concat(F.lit("内容标签："), F.col("lang"), F.lit("、"), F.col("source"), F.lit("/x\nTags: "), F.col("source"), F.lit(", b\n"), F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(text.tags(tagged), "|").alias("tags"))


def html_escape(spark, sf_dir):
    t = text.escape_html(F.coalesce("html", F.lit("")))
    return _table(spark, sf_dir, "pages").select("page_id", md5(t).alias("html_md5"), F.length(t).cast("long").alias("n"))


def sentences(spark, sf_dir):
    s = text.sentences(F.regexp_replace("text", r"\.", "。"))
    return _docs(spark, sf_dir).select("doc_id", F.size(s).cast("long").alias("n"), md5(F.array_join(s, "|")).alias("s_md5"))


def paragraphs(spark, sf_dir):
    p = text.paragraphs(F.replace("text", F.lit("\n"), F.lit("\n\n")))
    first = text.first_paragraph(F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return _docs(spark, sf_dir).select("doc_id", F.size(p).cast("long").alias("n"), md5(first).alias("first_md5"))


def dedup_form(spark, sf_dir):
    t = text.dedup_form("text")
    return _docs(spark, sf_dir).select("doc_id", md5(t).alias("text_md5"), F.length(t).cast("long").alias("n"))


def without_dialogue(spark, sf_dir):
    t = text.without_dialogue(F.concat(F.lit('a "'), F.col("lang"), F.lit('" b「'), F.col("lang"), F.lit("」c『d』 "), F.col("text"), F.lit("　")))
    return _docs(spark, sf_dir).select("doc_id", t.alias("t")).select("doc_id", md5("t").alias("text_md5"), F.length("t").cast("long").alias("n"))


def split_each(spark, sf_dir):
    t = text.split_each(F.concat_ws("", F.col("lang"), F.lit("/"), F.col("source"), F.lit("、c ; ")))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(t, "|").alias("parts"))


def strip_fence(spark, sf_dir):
    t = text.strip_fence(F.concat(F.lit(" ```json\n"), F.col("lang"), F.lit("\n``` \n")))
    return _docs(spark, sf_dir).select("doc_id", t.alias("t"))


def truncations(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.preview("text").alias("preview"), md5(text.ellipsis("text")).alias("cut_md5"), md5(text.head("text", 3000)).alias("head_md5"))


def yes_no(spark, sf_dir):
    reply = F.element_at(F.array(*map(F.lit, ("YES", "no", "不是", "maybe", "否"))), (F.pmod("doc_id", F.lit(5)) + 1).cast("int"))
    return _docs(spark, sf_dir).select("doc_id", text.yes_no(reply).alias("answer"))


def book_of_path(spark, sf_dir):
    path = F.concat(F.lit("x/cleaned/"), "source", F.lit("/0001.md"))
    return _docs(spark, sf_dir).select("doc_id", text.book_of_path(path).alias("book"))


# --- chapters -------------------------------------------------------------------------------


def _novel(spark, sf_dir):
    """A document as a book: its lines are chapters, after a line of synopsis."""
    chapters = F.array_join(F.transform(text.lines("text"), lambda x, i: F.concat(F.lit(" 第"), (i + 1).cast("string"), F.lit("章 t"), (i + 1).cast("string"), F.lit("\n"), x)), "\n")
    return _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("文案\n"), chapters).alias("text"))


def split_chapters(spark, sf_dir):
    return segment.chapters(_novel(spark, sf_dir)).select("doc_id", F.col("chapter_no").cast("long"), "title", md5("body").alias("body_md5"))


def chapter_counts(spark, sf_dir):
    return segment.chapters(_novel(spark, sf_dir)).groupBy("doc_id").agg(F.count("*").alias("n"))


def split_flags(spark, sf_dir):
    books = _docs(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("01\n"), "text", F.lit("\n02\nx"))).otherwise(F.col("text")).alias("text"))
    cut = books.select("doc_id", segment.split_book(F.col("text")).alias("s"))
    return cut.select("doc_id", F.col("s.used_fallback").alias("used_fallback"), F.size(segment.split_flags(F.col("s"))).cast("long").alias("n_flags"), F.size("s.chapters").cast("long").alias("n_chapters"))


def repeated_windows(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", segment.may_repeat(F.col("text")).alias("repeats")).where("repeats").select("doc_id")


def intra_dedup(spark, sf_dir):
    out = segment.remove_repeats(_spread(spark, sf_dir).select("doc_id", F.col("text").alias("body")))
    return out.select("doc_id", md5("body").alias("body_md5"), F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", "|").alias("removed"))


def shingle_counts(spark, sf_dir):
    return _spread(spark, sf_dir).select("doc_id", F.size(similarity.shingle_hashes(F.col("text"))).cast("long").alias("n"))


# --- duplicates -----------------------------------------------------------------------------


def exact_keep_first(spark, sf_dir):
    docs = _docs(spark, sf_dir).select(F.col("doc_id").alias("path"), F.col("doc_id").cast("string").alias("book"), md5("text").alias("hash"))
    unique, dropped = dedup.exact_among(docs)
    more = dropped.groupBy("hash").agg(F.count("*").alias("more"))
    return unique.join(more, "hash", "left").select(F.col("path").alias("doc_id"), "hash", (1 + F.coalesce("more", F.lit(0))).alias("copies"))


def minhash_md5(spark, sf_dir):
    b = _table(spark, sf_dir, "benchmark").select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    return b.select("item_id", F.array_join(similarity.md5_minhash(F.col("text")), "|").alias("sig"))


def minhash_compat(spark, sf_dir):
    return _spread(spark, sf_dir).select("doc_id", F.get(similarity.minhash(F.col("text")), F.lit(0)).alias("slot"))


def minhash_distinct(spark, sf_dir):
    return _spread(spark, sf_dir).select("doc_id", F.array_join(similarity.minhash(F.col("text"), similarity.distinct_salts()), ",").alias("sig"))


def _books(spark, sf_dir):
    return _spread(spark, sf_dir).select(F.col("doc_id").cast("string").alias("book"), F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("path"), "text")


def new_vs_cached(spark, sf_dir):
    """Even documents are the index, odd ones are new."""
    books = written(dedup.fingerprint(_books(spark, sf_dir)).drop("text"))
    cached = books.where("CAST(book AS long) % 2 = 0").select("book", F.col("book").cast("long").alias("pos"), "hash", "fp", "char_count")
    _, dropped = dedup.against_index(books.where("CAST(book AS long) % 2 = 1"), cached)
    return dropped.select("book", "reason", "duplicate_of")


def new_vs_cached_exact(spark, sf_dir):
    """The part of ``new_vs_cached`` that equals a cached book: by signatures of the hash alone,
    no other text is near."""
    b = _docs(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").alias("book"), md5("text").alias("hash"), F.length("text").alias("char_count"))
    b = written(b.withColumn("fp", F.array_repeat("hash", similarity.SLOTS)))
    cached = b.where("doc_id % 2 = 0").select("book", F.col("doc_id").alias("pos"), "hash", "fp", "char_count")
    _, dropped = dedup.against_index(b.where("doc_id % 2 = 1"), cached)
    return dropped.select("doc_id", F.col("duplicate_of").cast("long").alias("duplicate_of"))


def greedy_dedup(spark, sf_dir):
    unique, _ = dedup.exact_among(written(dedup.fingerprint(_books(spark, sf_dir)).drop("text")))
    _, dropped = dedup.greedy_among(written(unique))
    return dropped.select("book", "reason", "duplicate_of")


def chapter_dups(spark, sf_dir):
    c = _spread(spark, sf_dir).select(F.col("source").alias("book"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("file"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("body"))
    return dedup.chapter_duplicates(c).select("book", "file", "duplicate_of", F.round("similarity", 6).alias("similarity"), "reason")


def dup_per_book(spark, sf_dir):
    return chapter_dups(spark, sf_dir).groupBy("book").agg(F.count("*").alias("n"))


# --- annotations ----------------------------------------------------------------------------


def _chapters(spark, sf_dir):
    """Documents as annotated chapters."""
    d, i = _docs(spark, sf_dir), F.col("doc_id")
    word = F.split("text", "[ \n]", -1)[0]

    def person(name, role, state):
        return F.struct(name.alias("name"), role.alias("role"), state.alias("state"), F.lit("s").alias("speech"), F.lit("main").alias("importance"), F.lit("").alias("function"))

    one = person(word, F.when(i % 3 == 0, "").otherwise("r"), F.when(i % 4 == 0, F.lit(None)).otherwise("x"))
    two = person(F.when(i % 6 == 0, F.lit("")).otherwise(F.concat(F.lit("Zz"), i.cast("string"))), F.lit("r"), F.lit("x"))
    people = F.when(i % 5 == 0, F.array().cast(CHARACTERS)).when(i % 2 == 0, F.array(one).cast(CHARACTERS)).otherwise(F.array(one, two).cast(CHARACTERS))
    return d.select(
        i.cast("string").alias("file"), F.col("source").alias("book"), F.col("text").alias("body"),
        F.when(i % 11 == 0, "").otherwise(F.col("lang")).alias("world"),
        F.substring("text", F.lit(1), (F.pmod(i, F.lit(200))).cast("int")).alias("scene"),
        F.when(i % 7 == 0, F.lit(None)).otherwise("calm").alias("emotion"),
        F.substring_index("text", ".", 1).alias("plot"), F.col("source").alias("style"),
        F.when(i % 5 == 0, "").otherwise("p").alias("pov"), people.alias("characters"),
        F.when(i % 13 == 0, F.array(F.lit("check"))).otherwise(F.array().cast("array<string>")).alias("flags"),
        F.lit("en").alias("book_world"), i.alias("chapter_no"), F.concat(F.lit("t"), i.cast("string")).alias("title"),
    )


CH = r"""
d AS (SELECT doc_id AS i, coalesce(text, '') AS text, lang, source FROM documents),
ch AS (
  SELECT i, i::VARCHAR AS file, source AS book, text AS body, CASE WHEN i % 11 = 0 THEN '' ELSE lang END AS world,
    substring(text, 1, (i % 200)::INT) AS scene, CASE WHEN i % 7 = 0 THEN NULL ELSE 'calm' END AS emotion,
    split_part(text, '.', 1) AS plot, source AS style, CASE WHEN i % 5 = 0 THEN '' ELSE 'p' END AS pov,
    CASE WHEN i % 5 = 0 THEN 0 WHEN i % 2 = 0 THEN 1 ELSE 2 END AS n_people,
    split_part(replace(text, chr(10), ' '), ' ', 1) AS name1, CASE WHEN i % 3 = 0 THEN '' ELSE 'r' END AS role1,
    CASE WHEN i % 4 = 0 THEN '' ELSE 'x' END AS state1, CASE WHEN i % 6 = 0 THEN '' ELSE 'Zz' || i END AS name2, i % 13 = 0 AS flagged
  FROM d
),
iss AS (
  SELECT file, '缺少字段' AS issue_type, 'world' AS detail FROM ch WHERE world = ''
  UNION ALL SELECT file, '缺少字段', 'scene' FROM ch WHERE scene = ''
  UNION ALL SELECT file, '缺少字段', 'emotion' FROM ch WHERE emotion IS NULL
  UNION ALL SELECT file, '缺少字段', 'plot' FROM ch WHERE plot = ''
  UNION ALL SELECT file, '缺少字段', 'style' FROM ch WHERE style = ''
  UNION ALL SELECT file, '缺少字段', 'characters' FROM ch WHERE n_people = 0
  UNION ALL SELECT file, 'world不一致', 'en|' || world FROM ch WHERE world <> 'en'
  UNION ALL SELECT file, '无角色', '' FROM ch WHERE n_people = 0
  UNION ALL SELECT file, 'scene过长', length(scene)::VARCHAR FROM ch WHERE length(scene) > 150
  UNION ALL SELECT file, 'plot过长', length(plot)::VARCHAR FROM ch WHERE length(plot) > 100
  UNION ALL SELECT file, '章节过短', length(body)::VARCHAR FROM ch WHERE length(body) < 500
  UNION ALL SELECT file, '角色缺少名字', '' FROM ch WHERE n_people >= 1 AND name1 = ''
  UNION ALL SELECT file, '角色缺少定位', name1 FROM ch WHERE n_people >= 1 AND name1 <> '' AND role1 = ''
  UNION ALL SELECT file, '角色缺少状态', name1 FROM ch WHERE n_people >= 1 AND name1 <> '' AND state1 = ''
  UNION ALL SELECT file, '角色缺少名字', '' FROM ch WHERE n_people = 2 AND name2 = ''
  UNION ALL SELECT file, '角色不在正文', name1 FROM ch WHERE n_people >= 1 AND length(name1) = 1
  UNION ALL SELECT file, '角色不在正文', name2 FROM ch WHERE n_people = 2 AND name2 <> ''
),
sc AS (
  SELECT file, ((world <> '')::INT + (scene <> '')::INT + (emotion IS NOT NULL)::INT + (plot <> '')::INT + (style <> '')::INT + (n_people > 0)::INT + (pov <> '')::INT) / 7.0::DOUBLE * 100 AS completeness,
    CASE WHEN length(scene) <= 50 AND length(plot) <= 50 THEN 100.0 WHEN length(scene) <= 100 AND length(plot) <= 100 THEN 80.0 ELSE 60.0 END::DOUBLE AS conciseness,
    CASE n_people WHEN 2 THEN 100.0 WHEN 1 THEN 60.0 ELSE 0.0 END::DOUBLE AS char_count_score,
    CASE WHEN n_people = 0 THEN 0.0 ELSE ((name1 <> '' AND state1 <> '')::INT + (n_people = 2 AND name2 <> '')::INT) * 100.0 / n_people END::DOUBLE AS char_info
  FROM ch
),
so AS (SELECT *, (completeness + conciseness + char_count_score + char_info) / 4 AS overall FROM sc)
"""


def qa_issues(spark, sf_dir):
    return qa.issues(_chapters(spark, sf_dir))


def issue_counts(spark, sf_dir):
    return qa.issue_counts(qa_issues(spark, sf_dir))


def qa_stats(spark, sf_dir):
    return qa.stats(_chapters(spark, sf_dir), qa_issues(spark, sf_dir))


def sample_issues(spark, sf_dir):
    return qa.sample_issues(_chapters(spark, sf_dir))


SAMPLE_ISSUES = f"""WITH {CH}
SELECT file, '缺少 ' || f AS detail FROM (
  SELECT file, unnest([CASE WHEN world = '' THEN 'world' END, CASE WHEN scene = '' THEN 'scene' END, CASE WHEN emotion IS NULL THEN 'emotion' END,
    CASE WHEN plot = '' THEN 'plot' END, CASE WHEN style = '' THEN 'style' END, CASE WHEN n_people = 0 THEN 'characters' END, CASE WHEN pov = '' THEN 'pov' END]) AS f FROM ch) WHERE f IS NOT NULL
UNION ALL SELECT file, 'scene 过长 (' || length(scene) || '字)' FROM ch WHERE length(scene) > 100
UNION ALL SELECT file, 'plot 过长 (' || length(plot) || '字)' FROM ch WHERE length(plot) > 100
UNION ALL SELECT file, '角色缺少名字' FROM ch WHERE n_people >= 1 AND name1 = ''
UNION ALL SELECT file, '角色缺少名字' FROM ch WHERE n_people = 2 AND name2 = ''
UNION ALL SELECT file, '角色 ' || name1 || ' 缺少定位' FROM ch WHERE n_people >= 1 AND role1 = ''
UNION ALL SELECT file, '角色 ' || name1 || ' 缺少状态' FROM ch WHERE n_people >= 1 AND state1 = ''
UNION ALL SELECT file, '正文过短 (' || length(body) || '字)' FROM ch WHERE length(body) < 500
"""


def _rounded(df):
    return df.select("file", *(F.round(c, 6).alias(c) for c in df.columns if c != "file"))


def scores(spark, sf_dir):
    return _rounded(qa.scores(_chapters(spark, sf_dir)))


def avg_score(spark, sf_dir):
    return qa.scores(_chapters(spark, sf_dir)).agg(F.round(F.avg("overall"), 6).alias("mean"))


def low_scores(spark, sf_dir):
    return _rounded(qa.low_scores(qa.scores(_chapters(spark, sf_dir)))).select("file", "overall")


def recheck(spark, sf_dir):
    c = _chapters(spark, sf_dir)
    absent = qa.issues(c).where(F.col("issue_type") == qa.NOT_IN_BODY).select("file", F.col("detail").alias("character"))
    return qa.recheck(absent, c)


def final_names(spark, sf_dir):
    return qa.final_names(recheck(spark, sf_dir))


def names_per_file(spark, sf_dir):
    named = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("file"), F.initcap("lang").alias("character"))
    named = named.withColumn("specific", names.is_person_name(F.col("character")))
    out = files_per_name(named)
    return out.select("character", "n", md5(F.array_join("files", ",")).alias("files_md5"))


NAMES = "('顾言'), ('老人'), ('Tom'), ('安·李'), ('路人甲'), ('神秘的部长（王者们）'), ('张三/李四'), ('白衣少年')"


def core_words(spark, sf_dir):
    n = spark.sql(f"SELECT col1 AS name FROM VALUES {NAMES}")
    return n.select("name", F.array_join(names.core_words(F.col("name")), "|").alias("core"), F.array_join(names.recheck_words(F.col("name")), "|").alias("again"), names.is_person_name(F.col("name")).alias("specific"))


def name_parts(spark, sf_dir):
    n = spark.sql(f"SELECT col1 AS name FROM VALUES {NAMES}")
    return n.select("name", F.array_join(names.name_parts("name"), "|").alias("wide"), F.array_join(names.recheck_parts("name"), "|").alias("narrow"))


def _described(spark, sf_dir):
    """Books by source; every fifth is flagged."""
    b = _docs(spark, sf_dir).select("source").distinct()
    five = F.regexp_extract("source", r"(\d+)", 1).try_cast("int") % 5 == 0
    return b.select(F.col("source").alias("book"), F.lit("W").alias("world"), F.when(five, F.array(F.lit("book flag"))).otherwise(F.array().cast("array<string>")).alias("flags"))


def flags_list(spark, sf_dir):
    return export.flags(_described(spark, sf_dir), _chapters(spark, sf_dir))


def export_records(spark, sf_dir):
    r = export.training_records(_described(spark, sf_dir), _chapters(spark, sf_dir), skip_flagged=True)
    return r.select("book", "chapter_index", "chapter_title", md5(F.col("messages")[0]["content"]).alias("user_md5"), md5(F.col("messages")[1]["content"]).alias("assistant_md5"))


def export_json(spark, sf_dir):
    return export.record_json(export.training_records(_described(spark, sf_dir), _chapters(spark, sf_dir), compat=True))


def export_stats(spark, sf_dir):
    return export.export_stats(_described(spark, sf_dir), _chapters(spark, sf_dir), skip_flagged=True)


def export_stats_all(spark, sf_dir):
    return export.export_stats(_described(spark, sf_dir), _chapters(spark, sf_dir))


BOOKS = "bk AS (SELECT DISTINCT source AS book, try_cast(regexp_extract(source, '(\\d+)', 1) AS INT) % 5 = 0 AS bf FROM documents)"


def migrate_meta(spark, sf_dir):
    i = F.col("doc_id")
    old = _docs(spark, sf_dir).select(
        i, F.when(i % 2 == 0, F.col("lang")).alias("plot_outline"), F.when(i % 3 == 0, F.col("source")).alias("plot"),
        F.when(i % 5 == 0, F.lit(None).cast("string")).otherwise("calm").alias("emotion"), F.lit("b").alias("book"), F.lit(1).alias("chapter_index"),
    )
    return qa.migrate(old).select("doc_id", "plot", "emotion", "style", "pov", "world", F.size("characters").cast("long").alias("n_characters"), "word_count")


def merge_style(spark, sf_dir):
    kind = "array<struct<role:string,instruction:string>>"

    def item(role, instruction):
        return F.struct(F.lit(role).alias("role"), instruction.alias("instruction"))

    base = F.array(item("a", F.col("lang")), item("b", F.lit("1"))).cast(kind)
    over = F.array(item("b", F.col("source")), item("c", F.lit("2"))).cast(kind)
    m = text.merge_style(base, over)
    return _docs(spark, sf_dir).select("doc_id", F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit("="), x["instruction"])), "|").alias("style"))


def fill_empty(spark, sf_dir):
    c = _chapters(spark, sf_dir)
    made = c.select("file", F.lit("drafted").alias("emotion"), F.lit("new").alias("scene"), F.lit("draft world").alias("world"))
    done = qa.fill_empty(c, made)
    return c.select("file", qa.needs_draft().alias("needs_draft")).join(done.select("file", "emotion", F.length("scene").cast("long").alias("n_scene"), "world"), "file")


def prompts(spark, sf_dir):
    d = _docs(spark, sf_dir)
    book = export.book_prompt(F.col("source"), F.array("lang", F.lit("x")), F.col("text"))
    return d.select("doc_id", md5(book).alias("book_md5"), md5(export.chapter_prompt(F.lit("t"), F.col("text"))).alias("chapter_md5"))


def sample_docs(spark, sf_dir):
    return sample.sample(_docs(spark, sf_dir).select("doc_id", F.col("source").alias("book")), ["doc_id"], 20, 42).select("sample_no", "doc_id", "book")


def samples_per_book(spark, sf_dir):
    return sample.per_book(sample_docs(spark, sf_dir))


def review_counts(spark, sf_dir):
    r = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("sample_no"), F.when(F.col("quality") == 1, F.lit(4)).alias("overall_score"))
    return sample.scored_count(r)


def first_unscored(spark, sf_dir):
    r = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("sample_no"), F.when(F.col("quality") == 1, F.lit(4)).alias("overall_score"))
    return sample.first_unscored(r).select("sample_no")


QUERIES = {
    f.__name__: f
    for f in (
        normalize_docs, clean_docs, doc_fingerprint, parse_names, extract_tags, html_escape, sentences, paragraphs, dedup_form, without_dialogue,
        split_each, strip_fence, truncations, yes_no, book_of_path, split_chapters, chapter_counts, split_flags, repeated_windows, intra_dedup,
        shingle_counts, exact_keep_first, minhash_md5, minhash_compat, minhash_distinct, new_vs_cached, new_vs_cached_exact, greedy_dedup,
        chapter_dups, dup_per_book, qa_issues, issue_counts, qa_stats, sample_issues, scores, avg_score, low_scores, recheck, final_names,
        names_per_file, core_words, name_parts, flags_list, export_records, export_json, export_stats, export_stats_all, migrate_meta,
        merge_style, fill_empty, prompts, sample_docs, samples_per_book, review_counts, first_unscored,
    )
}

D = "d AS (SELECT doc_id, coalesce(text, '') AS text, lang, source FROM documents)"
PARAS = r"list_filter(list_transform(string_split(text, chr(10)), lambda p: regexp_replace(p, '^[\s\x1c-\x1f\x{3000}\x{A0}\x85]+|[\s\x1c-\x1f\x{3000}\x{A0}\x85]+\z', '', 'g')), lambda p: length(p) >= 20)"

ORACLE_SQL = {
    "normalize_docs": f"WITH n AS (SELECT doc_id, {NORMALISED} AS t FROM documents) SELECT doc_id, md5(t) AS text_md5, length(t)::BIGINT AS n FROM n",
    "clean_docs": rf"""WITH n AS (SELECT doc_id, {NORMALISED} AS text FROM documents),
        k AS (SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT (contains(x, 'License') OR contains(x, '@') OR contains(x, '|'))), chr(10)) AS text FROM n),
        c AS (SELECT doc_id, {NORMALISED} AS t FROM k) SELECT doc_id, md5(t) AS text_md5, len(string_split(t, chr(10)))::BIGINT AS n_lines FROM c""",
    "doc_fingerprint": f"WITH {D} SELECT doc_id, md5(text) AS hash, length(text)::BIGINT AS char_count, contains(text, chr(65533)) AS garbled FROM d",
    "parse_names": "SELECT doc_id, source AS title, CASE WHEN doc_id % 3 = 2 THEN NULL ELSE lang END AS author FROM documents",
    "extract_tags": "SELECT doc_id, lang || '|' || source || '|x|' || source || '|b' AS tags FROM documents",
    "html_escape": """WITH e AS (SELECT page_id, replace(replace(replace(replace(replace(coalesce(html, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS t FROM pages)
        SELECT page_id, md5(t) AS html_md5, length(t)::BIGINT AS n FROM e""",
    "sentences": rf"""WITH {D}, s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(text, '.', '。'), '[。！？!?；;\n]'),
        lambda x: regexp_replace(x, '^[\s\x1c-\x1f\x{{3000}}\x{{A0}}\x85]+|[\s\x1c-\x1f\x{{3000}}\x{{A0}}\x85]+\z', '', 'g')), lambda x: length(x) >= 5) AS s FROM d)
        SELECT doc_id, len(s)::BIGINT AS n, md5(array_to_string(s, '|')) AS s_md5 FROM s""",
    "paragraphs": f"WITH {D}, p AS (SELECT doc_id, text, {PARAS} AS p FROM d) SELECT doc_id, len(p)::BIGINT AS n, md5(coalesce(p[1], substring(replace(text, chr(10), chr(10) || chr(10)), 1, 100))) AS first_md5 FROM p",
    "dedup_form": rf"""WITH {D}, t AS (SELECT doc_id, regexp_replace(text, '[\s\x1c-\x1f\x{{3000}}\x{{A0}}\x85\x{{2028}}\x{{2029}}，。！？、；：（）《》【】.,!?;:''"()\[\]{{}}]', '', 'g') AS t FROM d)
        SELECT doc_id, md5(t) AS text_md5, length(t)::BIGINT AS n FROM t""",
    "without_dialogue": rf"""WITH {D}, w AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace('a "' || lang || '" b「' || lang || '」c『d』 ' || text || '　', '"[^"]*"', '', 'g'), '「[^」]*」', '', 'g'), '『[^』]*』', '', 'g') AS w FROM d),
        t AS (SELECT doc_id, regexp_replace(w, '^[\s\x1c-\x1f\x{{3000}}\x{{A0}}\x85]+|[\s\x1c-\x1f\x{{3000}}\x{{A0}}\x85]+\z', '', 'g') AS t FROM w)
        SELECT doc_id, md5(t) AS text_md5, length(t) AS n FROM t""",
    "split_each": "SELECT doc_id, lang || '|' || source || '、c ;|' || lang || '/' || source || '|c ;|' || lang || '/' || source || '、c' AS parts FROM documents",
    "strip_fence": "SELECT doc_id, lang AS t FROM documents",
    "truncations": f"WITH {D} SELECT doc_id, replace(substring(text, 1, 80), chr(10), ' ') AS preview, md5(substring(text, 1, 300) || CASE WHEN length(text) > 300 THEN '...' ELSE '' END) AS cut_md5, md5(substring(text, 1, 3000)) AS head_md5 FROM d",
    "yes_no": "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 4 THEN false END AS answer FROM documents",
    "book_of_path": "SELECT doc_id, source AS book FROM documents",
    "split_chapters": f"""WITH {D}, l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS chapter_no, '第' || i || '章 t' || i AS title, md5(line) AS body_md5 FROM l WHERE line <> ''""",
    "chapter_counts": f"WITH {D}, l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) SELECT doc_id, count(*) AS n FROM l WHERE line <> '' GROUP BY doc_id",
    "repeated_windows": rf"""WITH {D}, l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^[\s\x1c-\x1f\x{{3000}}\x{{A0}}\x85]+|[\s\x1c-\x1f\x{{3000}}\x{{A0}}\x85]+\z', '', 'g')) AS l FROM d),
        w AS (SELECT doc_id, list_transform(range(1, len(l) - 2), lambda i: array_to_string(l[i:i + 3], '')) AS w FROM l WHERE len(l) > 4)
        SELECT doc_id FROM w WHERE len(list_distinct(w)) < len(w)""",
    "shingle_counts": f"WITH {D} SELECT doc_id, len(list_distinct(list_transform(range(0, greatest(length(text) - 12, 0) + 1, 3), lambda i: substring(text, i + 1, 12))))::BIGINT AS n FROM d",
    "exact_keep_first": f"WITH {D} SELECT min(doc_id) AS doc_id, md5(text) AS hash, count(*) AS copies FROM d GROUP BY md5(text)",
    "minhash_md5": """WITH s AS (SELECT item_id, unnest(list_distinct(list_transform(range(0, greatest(length(text) - 12, 0) + 1, 3), lambda i: substring(text, i + 1, 12)))) AS s FROM (SELECT item_id, coalesce(text, '') AS text FROM benchmark))
        SELECT item_id, min(md5('0:' || s)) || '|' || min(md5('1:' || s)) || '|' || min(md5('2:' || s)) || '|' || min(md5('3:' || s)) AS sig FROM s GROUP BY item_id""",
    "new_vs_cached_exact": f"""WITH {D}, h AS (SELECT doc_id, md5(text) AS hash FROM d), c AS (SELECT hash, min(doc_id) AS duplicate_of FROM h WHERE doc_id % 2 = 0 GROUP BY hash)
        SELECT doc_id, duplicate_of FROM h JOIN c USING (hash) WHERE doc_id % 2 = 1""",
    "qa_issues": f"WITH {CH} SELECT * FROM iss",
    "issue_counts": f"WITH {CH} SELECT issue_type, count(*) AS n FROM iss GROUP BY issue_type",
    "qa_stats": f"""WITH {CH} SELECT (SELECT count(*) FROM ch) AS total_chapters, (SELECT sum(n_people)::BIGINT FROM ch) AS total_characters,
        (SELECT count(*) FROM iss WHERE issue_type = '缺少字段') AS missing_fields, (SELECT count(*) FROM iss WHERE issue_type = '章节过短') AS short_chapters,
        (SELECT count(DISTINCT file) FROM iss) AS chapters_with_issues""",
    "sample_issues": SAMPLE_ISSUES,
    "scores": f"WITH {CH} SELECT file, round(completeness, 6) AS completeness, conciseness, char_count_score, round(char_info, 6) AS char_info, round(overall, 6) AS overall FROM so",
    "avg_score": f"WITH {CH} SELECT round(avg(overall), 6) AS mean FROM so",
    "low_scores": f"WITH {CH} SELECT file, round(overall, 6) AS overall FROM so WHERE overall < 70 ORDER BY file LIMIT 10",
    "recheck": f"WITH {CH} SELECT i.file, i.detail AS character, true AS confirmed FROM iss i WHERE i.issue_type = '角色不在正文'",
    "final_names": f"WITH {CH} SELECT file, detail AS character, regexp_full_match(detail, '[A-Za-z]+') AS specific FROM iss WHERE issue_type = '角色不在正文'",
    "names_per_file": "SELECT upper(lang[1]) || lower(lang[2:]) AS character, count(*) AS n, md5(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id::VARCHAR)) AS files_md5 FROM documents GROUP BY 1",
    "core_words": "SELECT * FROM (VALUES ('顾言', '', '', true), ('老人', '老人', '', false), ('Tom', 'o', '', true), ('安·李', '', '', true), ('路人甲', '甲|路人', '路人', false), ('神秘的部长（王者们）', '部长', '', false), ('张三/李四', '', '', false), ('白衣少年', '少年', '', false)) t(name, core, again, specific)",
    "flags_list": f"WITH {CH}, {BOOKS} SELECT 'book' AS level, book AS name, 'book flag' AS flag FROM bk WHERE bf UNION ALL SELECT 'chapter', file, 'check' FROM ch WHERE flagged",
    "export_records": f"""WITH {CH}, {BOOKS} SELECT ch.book, i::INT AS chapter_index, 't' || i AS chapter_title,
        md5(concat_ws(chr(10), '[世界观] ' || CASE WHEN world = '' THEN 'W' ELSE world END, CASE WHEN scene <> '' THEN '[当前场景] ' || scene END, '[情感基调] ' || emotion, CASE WHEN plot <> '' THEN '[剧情要点] ' || plot END,
          CASE WHEN style <> '' THEN '[写作风格] ' || style END,
          CASE WHEN n_people > 0 THEN '[人物状态]' || chr(10) || '- ' || name1 || CASE WHEN role1 = '' THEN '' ELSE '（r）' END || CASE WHEN state1 = '' THEN '' ELSE '：x' END || '；说话风格：s'
            || CASE WHEN n_people = 2 THEN chr(10) || '- ' || name2 || '（r）：x；说话风格：s' ELSE '' END END,
          CASE WHEN pov <> '' THEN '[视角] ' || pov END)) AS user_md5, md5(body) AS assistant_md5
        FROM ch JOIN bk ON ch.book = bk.book WHERE NOT flagged AND NOT bf""",
    "export_json": f"""WITH {CH}, {BOOKS} SELECT to_json({{'messages': [{{'role': 'user', 'content': concat_ws(chr(10), '[世界观] ' || CASE WHEN world = '' THEN 'W' ELSE world END, CASE WHEN scene <> '' THEN '[当前场景] ' || scene END, '[情感基调] ' || emotion, CASE WHEN plot <> '' THEN '[剧情要点] ' || plot END,
          CASE WHEN style <> '' THEN '[写作风格] ' || style END,
          CASE WHEN n_people > 0 THEN '[人物状态]' || chr(10) || '- ' || name1 || CASE WHEN role1 = '' THEN '' ELSE '（r）' END || CASE WHEN state1 = '' THEN '' ELSE '：x' END || '；说话风格：s'
            || CASE WHEN n_people = 2 THEN chr(10) || '- ' || name2 || '（r）：x；说话风格：s' ELSE '' END END,
          CASE WHEN pov <> '' THEN '[视角] ' || pov END)}}, {{'role': 'assistant', 'content': body}}],
        'book': ch.book, 'chapter_index': NULL, 'chapter_title': NULL}})::VARCHAR AS value FROM ch JOIN bk ON ch.book = bk.book""",
    "export_stats": f"""WITH {CH}, {BOOKS}, c AS (SELECT (scene = '' OR emotion IS NULL OR plot = '' OR n_people = 0) AS inc, (flagged OR bf) AS f FROM ch JOIN bk ON ch.book = bk.book)
        SELECT count(*) FILTER (WHERE NOT f) AS total, count(*) FILTER (WHERE NOT f AND inc) AS incomplete, 0::BIGINT AS flagged_included, count(*) FILTER (WHERE f) AS flagged_skipped FROM c""",
    "export_stats_all": f"""WITH {CH}, {BOOKS}, c AS (SELECT (scene = '' OR emotion IS NULL OR plot = '' OR n_people = 0) AS inc, (flagged OR bf) AS f FROM ch JOIN bk ON ch.book = bk.book)
        SELECT count(*) AS total, count(*) FILTER (WHERE inc) AS incomplete, count(*) FILTER (WHERE f) AS flagged_included, 0::BIGINT AS flagged_skipped FROM c""",
    "migrate_meta": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 2 = 0 THEN lang END AS plot, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'calm' END AS emotion, '' AS style, '' AS pov, '' AS world, 0::BIGINT AS n_characters, NULL::INT AS word_count FROM documents",
    "merge_style": "SELECT doc_id, 'a=' || lang || '|b=' || source || '|c=2' AS style FROM documents",
    "fill_empty": f"""WITH {CH} SELECT file, (scene = '' OR emotion IS NULL OR plot = '' OR style = '' OR n_people = 0) AS needs_draft, coalesce(emotion, 'drafted') AS emotion,
        (CASE WHEN scene = '' THEN 3 ELSE length(scene) END)::BIGINT AS n_scene, CASE WHEN world = '' THEN 'draft world' ELSE world END AS world FROM ch""",
    "prompts": f"""WITH {D} SELECT doc_id, md5('书名：' || source || chr(10) || '标签：' || lang || '、x' || chr(10) || '正文节选：' || chr(10) || substring(text, 1, 3000)) AS book_md5,
        md5('章节标题：t' || chr(10) || '正文：' || chr(10) || substring(text, 1, 4000)) AS chapter_md5 FROM d""",
    "review_counts": "SELECT count(*) FILTER (WHERE quality = 1) AS scored, count(*) FILTER (WHERE quality IS DISTINCT FROM 1) AS unscored FROM labels",
    "first_unscored": "SELECT min(doc_id) AS sample_no FROM labels WHERE quality IS DISTINCT FROM 1 HAVING min(doc_id) IS NOT NULL",
    "split_flags": f"""WITH {D}, c AS (SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN 0 WHEN trim(text, chr(10)) = '' THEN 1 ELSE 2 END AS n FROM d)
        SELECT doc_id, true AS used_fallback, (1 + (n <= 1)::INT)::BIGINT AS n_flags, n::BIGINT AS n_chapters FROM c""",
}

_FORM = r"""regexp_replace({}, '[\s\x1c-\x1f\x{{3000}}\x{{A0}}\x85\x{{2028}}\x{{2029}}，。！？、；：（）《》【】.,!?;:''"()\[\]{{}}]', '', 'g')"""
_SHINGLES = "list_distinct(list_transform(range(0, greatest(length({0}) - 12, 0) + 1, 3), lambda i: substring({0}, i + 1, 12)))"
CHAPTER_DUPS = f"""{D}, c0 AS (
    SELECT source AS book, lpad(doc_id::VARCHAR, 12, '0') AS file, replace(text, chr(10), chr(10) || chr(10)) AS body, {PARAS} AS p FROM d WHERE text <> ''),
  c1 AS (SELECT book, file, body, length(body) AS n, coalesce(p[1], substring(body, 1, 100)) AS para, {_FORM.format("body")} AS form FROM c0),
  c AS (SELECT *, {_FORM.format("para")} AS norm, substring(para, 1, 30) AS key, CASE WHEN form = '' THEN [] ELSE {_SHINGLES.format("form")} END AS s FROM c1),
  f AS (SELECT a.book, a.file AS fa, b.file AS fb, a.file AS prober, b.file AS other, 1 AS stage FROM c a JOIN c b ON a.book = b.book AND a.norm = b.norm AND a.file < b.file WHERE length(a.norm) >= 10),
  h AS (SELECT a.book, least(a.file, b.file) AS fa, greatest(a.file, b.file) AS fb, a.file AS prober, b.file AS other, 2 AS stage,
          row_number() OVER (PARTITION BY a.book, least(a.file, b.file), greatest(a.file, b.file) ORDER BY a.file) AS rn
        FROM c a JOIN c b ON a.book = b.book AND a.file <> b.file WHERE length(a.para) >= 30 AND contains(b.body, a.key)),
  u AS (SELECT * FROM f UNION ALL SELECT book, fa, fb, prober, other, stage FROM h WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM f WHERE f.book = h.book AND f.fa = h.fa AND f.fb = h.fb)),
  j AS (SELECT u.*, p.n >= o.n AS keep_prober, len(list_intersect(p.s, o.s)) / greatest(len(p.s) + len(o.s) - len(list_intersect(p.s, o.s)), 1)::DOUBLE AS sim
        FROM u JOIN c p ON p.book = u.book AND p.file = u.prober JOIN c o ON o.book = u.book AND o.file = u.other),
  k AS (SELECT book, CASE WHEN keep_prober THEN other ELSE prober END AS file, CASE WHEN keep_prober THEN prober ELSE other END AS duplicate_of, sim, stage,
          row_number() OVER (PARTITION BY book, CASE WHEN keep_prober THEN other ELSE prober END ORDER BY stage, prober, other) AS rn FROM j WHERE sim >= 0.8),
  r AS (SELECT book, file, duplicate_of, round(sim, 6) AS similarity, CASE stage WHEN 1 THEN '首段相同，全文相似' ELSE '首段命中，全文相似' END || printf('%.1f%%', sim * 100) AS reason FROM k WHERE rn = 1)"""
ORACLE_SQL["chapter_dups"] = f"WITH {CHAPTER_DUPS} SELECT * FROM r"
ORACLE_SQL["dup_per_book"] = f"WITH {CHAPTER_DUPS} SELECT book, count(*) AS n FROM r GROUP BY book"
