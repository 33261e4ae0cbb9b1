"""Training records, flags and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import head, missing, missing_list
from quillmill.operators.qa import incomplete

#: Labels of the lines of a prompt (fixed values).
LABELS = (("scene", "[当前场景] "), ("emotion", "[情感基调] "), ("plot", "[剧情要点] "), ("style", "[写作风格] "))
WORLD, PEOPLE, POV = "[世界观] ", "[人物状态]", "[视角] "


def user_block(book_world: Column | None = None) -> Column:
    """The prompt of a chapter: one line per field that is not empty; the world falls back to
    the book's."""
    world = F.nullif(F.col("world"), F.lit(""))
    if book_world is not None:
        world = F.coalesce(world, F.nullif(book_world, F.lit("")))

    def line(label: str, c: Column) -> Column:
        return F.when(~missing(c), F.concat(F.lit(label), c))

    def person(c: Column) -> Column:
        def opt(before: str, field: str, after: str = "") -> Column:
            return F.when(missing(c[field]), "").otherwise(F.concat(F.lit(before), c[field], F.lit(after)))

        return F.concat(F.lit("- "), F.coalesce(c["name"], F.lit("")), opt("（", "role", "）"), opt("：", "state"), opt("；说话风格：", "speech"))

    people = F.when(~missing_list(F.col("characters")), F.concat(F.lit(PEOPLE + "\n"), F.array_join(F.transform("characters", person), "\n")))
    return F.concat_ws("\n", line(WORLD, world), *(line(label, F.col(f)) for f, label in LABELS), people, line(POV, F.col("pov")))


def flags(books: DataFrame, chapters: DataFrame) -> DataFrame:
    """(level, name, flag): flags of books (book), then of chapters (file)."""
    b = books.select(F.lit("book").alias("level"), F.col("book").alias("name"), F.explode("flags").alias("flag"))
    known = chapters.join(books.select("book"), "book", "left_semi")
    return b.unionByName(known.select(F.lit("chapter").alias("level"), F.col("file").alias("name"), F.explode("flags").alias("flag")))


def candidates(books: DataFrame, chapters: DataFrame) -> DataFrame:
    """Chapters of books that have a description, with book_world, flagged and incomplete."""
    b = books.select("book", F.col("world").alias("book_world"), (~missing_list(F.col("flags"))).alias("__flagged"))
    return (
        chapters.drop("book_world").join(b, "book")
        .withColumn("flagged", F.col("__flagged") | ~missing_list(F.col("flags")))
        .withColumn("incomplete", incomplete()).drop("__flagged")
    )


def training_records(books: DataFrame, chapters: DataFrame, skip_flagged: bool = False, compat: bool = False) -> DataFrame:
    """One record per chapter: messages (user, assistant), book, chapter_index, chapter_title.

    ``compat``: the last two are null, as in exports of migrated chapters.
    """
    rows = candidates(books, chapters)
    if skip_flagged:
        rows = rows.where(~F.col("flagged"))
    said = F.array(
        F.struct(F.lit("user").alias("role"), user_block(F.col("book_world")).alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.coalesce("body", F.lit("")).alias("content")),
    )
    number = F.lit(None).cast("int") if compat else F.col("chapter_no").cast("int")
    title = F.lit(None).cast("string") if compat or "title" not in chapters.columns else F.col("title")
    return rows.select(said.alias("messages"), "book", number.alias("chapter_index"), title.alias("chapter_title"))


def record_json(record: DataFrame) -> DataFrame:
    """One JSON text per record; nulls are written."""
    return record.select(F.to_json(F.struct(*record.columns), {"ignoreNullFields": "false"}).alias("value"))


def export_stats(books: DataFrame, chapters: DataFrame, skip_flagged: bool = False) -> DataFrame:
    """One row: total, incomplete, flagged_included, flagged_skipped."""
    rows = candidates(books, chapters)
    kept = ~F.col("flagged") if skip_flagged else F.lit(True)
    return rows.agg(
        F.count_if(kept).alias("total"),
        F.count_if(kept & F.col("incomplete")).alias("incomplete"),
        F.count_if(kept & F.col("flagged")).alias("flagged_included"),
        F.count_if(~kept & F.col("flagged")).alias("flagged_skipped"),
    )


def book_prompt(title: Column, tags: Column, sample: Column) -> Column:
    """What a model is asked about a book: title, tags and the first 3000 characters."""
    listed = F.when(missing_list(tags), "（无）").otherwise(F.array_join(tags, "、"))
    return F.concat(F.lit("书名："), title, F.lit("\n标签："), listed, F.lit("\n正文节选：\n"), head(sample, 3000))


def chapter_prompt(title: Column, body: Column) -> Column:
    return F.concat(F.lit("章节标题："), title, F.lit("\n正文：\n"), head(body, 4000))
