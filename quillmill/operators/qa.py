"""Checks and scores of chapter annotations.

A chapter is a row: file, book, body, world, scene, emotion, plot, style, pov, characters
(array of name, role, state, speech, importance, function), word_count, and optionally
malformed (no front matter) and parse_error.  Empty and null count as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.names import core_words, found_again, found_in_body, is_person_name, name_parts, recheck_parts, recheck_words
from quillmill.functions.text import missing, missing_list

TEXT_FIELDS = ("world", "scene", "emotion", "plot", "style", "pov")
REQUIRED = ("world", "scene", "emotion", "plot", "style", "characters")
SAMPLE_REQUIRED = (*REQUIRED, "pov")
EXPORT_REQUIRED = ("scene", "emotion", "plot", "characters")
DRAFT_FIELDS = ("scene", "emotion", "plot", "style", "characters")

#: Issue types (fixed values of reports).
MALFORMED, UNREADABLE, NO_FIELD, OTHER_WORLD = "格式错误", "解析错误", "缺少字段", "world不一致"
NO_NAME, NO_ROLE, NO_STATE, NOT_IN_BODY, NO_CHARACTERS = "角色缺少名字", "角色缺少定位", "角色缺少状态", "角色不在正文", "无角色"
LONG_SCENE, LONG_PLOT, SHORT_BODY = "scene过长", "plot过长", "章节过短"


def is_missing(field: str) -> Column:
    return missing_list(F.col(field)) if field == "characters" else missing(F.col(field))


def missing_fields(fields=REQUIRED) -> Column:
    """Names of the fields that a chapter lacks, in order."""
    return F.filter(F.array(*(F.when(is_missing(f), F.lit(f)) for f in fields)), lambda f: f.isNotNull())


def incomplete(fields=EXPORT_REQUIRED) -> Column:
    return F.size(missing_fields(fields)) > 0


def needs_draft() -> Column:
    return F.size(missing_fields(DRAFT_FIELDS)) > 0


def fill_empty(chapter: DataFrame, draft: DataFrame, key: str = "file") -> DataFrame:
    """``chapter`` with its missing fields from ``draft``; ``word_count`` only where null."""
    columns = [c for c in draft.columns if c != key]
    d = draft.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    out = chapter.join(d, key, "left")
    for c in columns:
        old, new = F.col(c), F.col(f"__{c}")
        keep = old.isNotNull() if c == "word_count" else ~(missing_list(old) if c == "characters" else missing(old))
        out = out.withColumn(c, F.when(keep, old).otherwise(F.coalesce(new, old)))
    return out.select(chapter.columns)


def migrate(chapter: DataFrame) -> DataFrame:
    """Old front matter: plot_outline becomes plot where there is no plot column value, absent
    fields are added empty, fields that moved elsewhere are dropped."""
    if "plot_outline" in chapter.columns:
        plot = F.coalesce("plot", "plot_outline") if "plot" in chapter.columns else F.col("plot_outline")
        chapter = chapter.withColumn("plot", plot).drop("plot_outline")
    for f in ("emotion", "style", "pov", "world"):
        chapter = chapter.withColumn(f, F.coalesce(f, F.lit("")) if f in chapter.columns else F.lit(""))
    if "characters" not in chapter.columns:
        chapter = chapter.withColumn("characters", F.array().cast("array<struct<name:string,role:string,state:string,speech:string,importance:string,function:string>>"))
    if "word_count" not in chapter.columns:
        chapter = chapter.withColumn("word_count", F.lit(None).cast("int"))
    return chapter.drop("book", "chapter_index", "chapter_title", "style_overrides", "flags", "source_file")


def with_matches(chapters: DataFrame) -> DataFrame:
    """(file, name, found) for each named character: how it is found in the body, or null.

    Name parts are made once per distinct name; bodies stay in the JVM.
    """
    named = chapters.select("file", "body", F.explode("characters").alias("c")).select("file", "body", F.col("c.name").alias("name")).where(~missing(F.col("name")))
    parts = named.select("name").distinct().withColumn("parts", name_parts("name"))
    joined = named.join(parts, "name")
    return joined.select("file", "name", found_in_body(F.col("parts"), core_words(F.col("name")), F.coalesce("body", F.lit(""))).alias("found"))


def issues(chapters: DataFrame, verify=None) -> DataFrame:
    """(file, issue_type, detail), one row per issue, several to a chapter.

    ``verify``: a table (file, name, present boolean) of a model's verdicts, which override
    names that the rules did not find.  Malformed chapters have that issue alone.
    """
    def flag(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(False)) if c in chapters.columns else F.lit(False)

    bad = flag("malformed")
    broken = F.col("parse_error").isNotNull() if "parse_error" in chapters.columns else F.lit(False)
    world = F.col("book_world") if "book_world" in chapters.columns else F.lit(None).cast("string")

    def issue(when: Column, kind: str, detail: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("issue_type"), detail.alias("detail")))

    size = F.coalesce(F.length("body"), F.lit(0))
    none = F.lit("")
    own = F.concat(
        F.transform(missing_fields(), lambda f: F.struct(F.lit(NO_FIELD).alias("issue_type"), f.alias("detail"))),
        F.array(
            issue(~missing(world) & ~world.eqNullSafe(F.col("world")), OTHER_WORLD, F.concat_ws("|", world, F.coalesce("world", none))),
            issue(missing_list(F.col("characters")), NO_CHARACTERS, none),
            issue(F.length("scene") > 150, LONG_SCENE, F.length("scene").cast("string")),
            issue(F.length("plot") > 100, LONG_PLOT, F.length("plot").cast("string")),
            issue(size < 500, SHORT_BODY, size.cast("string")),
        ),
        F.flatten(
            F.transform(
                F.coalesce("characters", F.array().cast(chapters.schema["characters"].dataType)),
                lambda c: F.when(missing(c["name"]), F.array(issue(F.lit(True), NO_NAME, none))).otherwise(
                    F.array(issue(missing(c["role"]), NO_ROLE, c["name"]), issue(missing(c["state"]), NO_STATE, c["name"]))
                ),
            )
        ),
    )
    one = F.when(bad, F.array(issue(F.lit(True), MALFORMED, none))).when(broken, F.array(issue(F.lit(True), UNREADABLE, none))).otherwise(own)
    rows = chapters.select("file", F.explode(F.filter(one, lambda x: x.isNotNull())).alias("i")).select("file", "i.*")
    absent = with_matches(chapters.where(~bad & ~broken)).where("found IS NULL")
    if verify is not None:
        absent = absent.join(verify.where("present"), ["file", "name"], "left_anti")
    return rows.unionByName(absent.select("file", F.lit(NOT_IN_BODY).alias("issue_type"), F.col("name").alias("detail")))


def issue_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("issue_type").agg(F.count("*").alias("n"))


def stats(chapters: DataFrame, found: DataFrame) -> DataFrame:
    """One row: total_chapters, missing_fields, total_characters, short_chapters,
    chapters_with_issues (malformed and unreadable chapters are in no count but the first)."""
    a = chapters.agg(F.count("*").alias("total_chapters"), F.coalesce(F.sum(F.greatest(F.coalesce(F.size("characters"), F.lit(0)), F.lit(0))), F.lit(0)).alias("total_characters"))
    b = found.agg(
        F.count_if(F.col("issue_type") == NO_FIELD).alias("missing_fields"),
        F.count_if(F.col("issue_type") == SHORT_BODY).alias("short_chapters"),
        F.count_distinct(F.when(~F.col("issue_type").isin(MALFORMED, UNREADABLE), F.col("file"))).alias("chapters_with_issues"),
    )
    # One row each.
    return a.join(b)


def sample_issues(chapters: DataFrame) -> DataFrame:
    """(file, detail) of the stricter check for samples."""
    size = F.coalesce(F.length("body"), F.lit(0))
    who = F.lit("角色 ")
    details = F.concat(
        F.transform(missing_fields(SAMPLE_REQUIRED), lambda f: F.concat(F.lit("缺少 "), f)),
        F.array(
            F.when(F.length("scene") > 100, F.concat(F.lit("scene 过长 ("), F.length("scene"), F.lit("字)"))),
            F.when(F.length("plot") > 100, F.concat(F.lit("plot 过长 ("), F.length("plot"), F.lit("字)"))),
        ),
        F.flatten(
            F.transform(
                F.coalesce("characters", F.array().cast(chapters.schema["characters"].dataType)),
                lambda c: F.array(
                    F.when(missing(c["name"]), F.lit(NO_NAME)),
                    F.when(missing(c["role"]), F.concat(who, F.coalesce(c["name"], F.lit("?")), F.lit(" 缺少定位"))),
                    F.when(missing(c["state"]), F.concat(who, F.coalesce(c["name"], F.lit("?")), F.lit(" 缺少状态"))),
                    F.when(missing(c["speech"]), F.concat(who, F.coalesce(c["name"], F.lit("?")), F.lit(" 缺少说话风格"))),
                ),
            )
        ),
        F.array(F.when(size < 500, F.concat(F.lit("正文过短 ("), size, F.lit("字)")))),
    )
    return chapters.select("file", F.explode(F.filter(details, lambda d: d.isNotNull())).alias("detail"))


def recheck(problems: DataFrame, chapters: DataFrame) -> DataFrame:
    """(file, character, confirmed): the second check of characters reported absent.  A chapter
    that is gone or has no body confirms the problem."""
    parts = problems.select("character").distinct().withColumn("parts", recheck_parts("character"))
    joined = problems.join(parts, "character", "left").join(chapters.select("file", "body"), "file", "left")
    found = ~missing(F.col("body")) & F.coalesce(found_again(F.col("parts"), recheck_words(F.col("character")), F.col("body")), F.lit(False))
    return joined.select("file", "character", (~found).alias("confirmed"))


def final_names(confirmed: DataFrame) -> DataFrame:
    """Confirmed problems with ``specific``: whether the character is a certain person."""
    return confirmed.where("confirmed").select("file", "character", is_person_name(F.col("character")).alias("specific"))


def scores(chapters: DataFrame) -> DataFrame:
    """file with completeness, conciseness, char_count_score, char_info and overall (0 to 100)."""
    n = F.greatest(F.coalesce(F.size("characters"), F.lit(0)), F.lit(0))
    scene, plot = (F.coalesce(F.length(c), F.lit(0)) for c in ("scene", "plot"))
    known = F.size(F.filter("characters", lambda c: ~missing(c["name"]) & ~missing(c["state"])))
    out = chapters.select(
        "file",
        ((len(SAMPLE_REQUIRED) - F.size(missing_fields(SAMPLE_REQUIRED))) / len(SAMPLE_REQUIRED) * 100).alias("completeness"),
        F.when((scene <= 50) & (plot <= 50), 100.0).when((scene <= 100) & (plot <= 100), 80.0).otherwise(60.0).alias("conciseness"),
        F.when(n >= 2, 100.0).when(n == 1, 60.0).otherwise(0.0).alias("char_count_score"),
        F.when(n > 0, known / n * 100).otherwise(0.0).alias("char_info"),
    )
    mean = (F.col("completeness") + F.col("conciseness") + F.col("char_count_score") + F.col("char_info")) / 4
    return out.withColumn("overall", mean)


def low_scores(scored: DataFrame, below: float = 70, n: int = 10) -> DataFrame:
    """The first ``n`` chapters by file that score below (not the lowest ones)."""
    return scored.where(F.col("overall") < below).orderBy("file").limit(n)
