"""Commands over a folder of texts and tables: ``python -m quillmill.plans.cli VERB ...``.

clean      raw/*.txt into tables of books, chapters, dropped books and an index, and into
           cleaned/BOOK/NNNN.md for annotation
draft      annotations of chapters that lack some, by a chat model
export     training records; flags, validate, recheck, score, sample, dups, review: reports
"""

from __future__ import annotations

import argparse
import pathlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions.text import missing, strip_fence
from quillmill.operators import dedup, export, qa, sample
from quillmill.sources import files, model, reports
from quillmill.streaming import incremental


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quillmill")
    p.add_argument("--root", default=".", help="folder below which everything is read and written")
    verbs = p.add_subparsers(dest="verb", required=True)

    def verb(name: str, **options) -> argparse.ArgumentParser:
        v = verbs.add_parser(name)
        for flag, kw in options.items():
            v.add_argument("--" + flag.replace("_", "-"), **kw)
        return v

    url = {"llm_base_url": {"default": "http://localhost:11434/v1"}, "api_key": {"default": None}}
    yes = {"action": "store_true"}
    verb("clean", force=yes)
    verb("draft", scope={"choices": ("book", "chapters", "all"), "default": "all"}, book={}, llm_model={"default": "qwen3:8b"}, **url)
    verb("export", out={"default": "export/train.jsonl"}, skip_flagged=yes)
    verb("flags")
    verb("validate", use_ai=yes, llm_model={"default": "qwen2.5:3b"}, **url)
    verb("recheck", report={}, newest=yes)
    verb("final", report={}, newest=yes)
    verb("score", reviews={})
    verb("sample", sample_size={"type": int, "default": 20}, seed={"type": int}, book={})
    verb("dups", threshold={"type": float, "default": 0.8}, delete=yes)
    verb("review", sample_size={"type": int, "default": 20}, seed={"type": int, "default": 42}, output={"default": "review.html"}, book={})
    return p


def _chapters(spark: SparkSession, root: str) -> DataFrame:
    return files.chapter_files(spark, f"{root}/cleaned")


def _books(spark: SparkSession, root: str) -> DataFrame:
    return files.book_files(spark, f"{root}/cleaned").withColumn("book", F.col("folder"))


def _save(root: str, name: str, text: str | Iterable[str]) -> None:
    """Write a text, or lines as they come."""
    path = pathlib.Path(files.confined(root, name))
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", encoding="utf-8") as out:
        if isinstance(text, str):
            out.write(text)
        else:
            out.writelines(("\n" if i else "") + line for i, line in enumerate(text))
    print(path)


#: What the models are told; both are defaults.
DRAFT_SYSTEM = "你为小说章节写标注。世界观：{world}。只用一个 JSON 对象回答，字段为 scene、emotion、plot、style、characters（name、role、state、speech、importance、function）、pov、word_count。"
BOOK_SYSTEM = "你为一本小说写世界观。只用一个 JSON 对象回答，字段为 world、style_template（role、instruction 的列表）、banned_terms（词的列表）。"
VERIFY_SYSTEM = "判断句子里是否有人物符合角色描述。只回答 YES 或 NO。"


def drafted(spark: SparkSession, root: str, client: model.Client, book: str | None = None) -> DataFrame:
    """Chapters that lacked fields, filled from the model's replies."""
    c = _chapters(spark, root).where(~F.col("malformed"))
    c = c.where(F.col("book") == book) if book else c
    world = _books(spark, root).select("book", F.col("world").alias("book_world"))
    todo = c.where(qa.needs_draft()).join(world, "book", "left")
    known = F.coalesce(F.nullif("book_world", F.lit("")), F.lit("未知"))
    asked = todo.select("file", F.replace(F.lit(DRAFT_SYSTEM), F.lit("{world}"), known).alias("system"), export.chapter_prompt(F.format_string("%04d", "chapter_no"), F.col("body")).alias("user"))
    made = model.draft_fields(model.replies(asked, client).where("error IS NULL"))
    made = made.join(todo.select("file", "book_world"), "file").withColumn("world", F.coalesce(F.nullif("book_world", F.lit("")), "world")).drop("book_world")
    return qa.fill_empty(todo.drop("book_world"), made)


BOOK_FIELDS = "struct<world:string,style_template:array<struct<role:string,instruction:string>>,banned_terms:array<string>>"


def drafted_books(spark: SparkSession, root: str, client: model.Client, book: str | None = None) -> DataFrame:
    """(book, world, style_template, banned_terms) of books without a world, from the model's
    replies to their title, tags and synopsis, or first chapter where there is none; books with
    neither, and failed replies, are left out."""
    b = _books(spark, root).where(missing(F.col("world")))
    b = b.where(F.col("book") == book) if book else b
    first = _chapters(spark, root).groupBy("book").agg(F.min_by("body", "file").alias("first"))
    sample = F.coalesce(F.nullif("synopsis", F.lit("")), F.nullif("first", F.lit("")))
    asked = b.join(first, "book", "left").withColumn("sample", sample).where("sample IS NOT NULL")
    asked = asked.select("book", F.lit(BOOK_SYSTEM).alias("system"), export.book_prompt(F.col("book"), F.col("tags"), F.col("sample")).alias("user"))
    made = model.replies(asked, client).where("error IS NULL")
    return made.select("book", F.from_json(strip_fence("reply"), BOOK_FIELDS).alias("d")).where("d IS NOT NULL").select("book", "d.*")


def verified(found: DataFrame, chapters: DataFrame, client: model.Client) -> DataFrame:
    """(file, name, present): a model's verdict on characters that the rules did not find, where
    the body has sentences with persons at all."""
    from quillmill.functions.names import person_sentences

    absent = found.where(F.col("issue_type") == qa.NOT_IN_BODY).select("file", F.col("detail").alias("name"))
    rows = absent.join(chapters.select("file", F.array_join(person_sentences(F.col("body")), " ").alias("s")), "file").where("s != ''")
    asked = rows.select("file", "name", F.lit(VERIFY_SYSTEM).alias("system"), F.concat(F.lit("角色描述："), "name", F.lit("\n句子：\n"), F.substring("s", 1, 1000)).alias("user"))
    return model.verdicts(model.replies(asked, client)).select("file", "name", "present")


def main(argv: list[str] | None = None, spark: SparkSession | None = None, client: model.Client | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("quillmill").getOrCreate()
    root = str(pathlib.Path(a.root).resolve())
    if a.verb == "clean":
        rules = {"ads": files.pattern_file(f"{root}/configs/ad_patterns.txt"), "tag_rules": files.pattern_file(f"{root}/configs/tag_line_patterns.txt")}
        result = incremental.run_once(spark, f"{root}/raw", f"{root}/tables", a.force, detect=files.detector(), **rules)
        files.append_dedup_log(result["dropped"], f"{root}/logs/dedup")
        files.write_index(result["index"], f"{root}/tables/corpus_index")
        files.write_tree(result["books"], result["chapters"], f"{root}/cleaned")
        rows = result["books"].join(result["chapters"].groupBy("book").count(), "book", "left")
        print({"kept": rows.count(), "dropped": result["dropped"].count(), "chapters": result["chapters"].count()})
        return
    chapters = _chapters(spark, root)
    if a.verb == "draft":
        ask = client or model.http_client(a.llm_base_url, a.llm_model, a.api_key, **model.DRAFT)
        if a.scope in ("book", "all"):
            for row in drafted_books(spark, root, ask, a.book).toLocalIterator():
                about = row.asDict(recursive=True)
                files.write_description(files.confined(root, f"cleaned/{row.book}/_book_meta.yaml"), {"world": about["world"] or "", "style_template": about["style_template"] or [], "banned_terms": about["banned_terms"] or []})
        if a.scope == "book":
            return
        for row in drafted(spark, root, ask, a.book).toLocalIterator():
            pathlib.Path(row.file.removeprefix("file:")).write_text(files.render_chapter(row.asDict(recursive=True)), encoding="utf-8")
    elif a.verb == "export":
        records = export.record_json(export.training_records(_books(spark, root), chapters, a.skip_flagged, compat=True))
        files.write_records(records, files.confined(root, a.out))
        out = pathlib.PurePosixPath(a.out)
        _save(root, str(out.parent / "dataset_info.json"), reports.descriptor(files.dataset_descriptor(out.name), out.stem))
        print(export.export_stats(_books(spark, root), chapters, a.skip_flagged).first().asDict())
    elif a.verb == "flags":
        for r in export.flags(_books(spark, root), chapters).orderBy("level", "name").toLocalIterator():
            print(f"[{r.level}] {r.name}: {r.flag}")
    elif a.verb in ("validate", "recheck", "final"):
        with_world = chapters.join(_books(spark, root).select("book", F.col("world").alias("book_world")), "book", "left")
        found = qa.issues(with_world)
        if a.verb == "validate":
            if a.use_ai:
                ask = client or model.http_client(a.llm_base_url, a.llm_model, a.api_key, **model.VERIFY)
                found = qa.issues(with_world, verified(found, chapters, ask))
            _save(root, "reports/validation.txt", reports.validation_lines(qa.stats(chapters, found), qa.issue_counts(found), found))
            return
        absent = found.where(F.col("issue_type") == qa.NOT_IN_BODY).select("file", F.col("detail").alias("character"))
        if a.newest:
            kind = "recheck" if a.verb == "final" else "validation"
            found_file = files.newest(spark.read.format("binaryFile").option("pathGlobFilter", f"{kind}*.txt").load(f"{root}/reports")).select("path").first()
            a.report = found_file.path.removeprefix("file:") if found_file else None
        if a.report:
            absent = files.report_problems(spark.read.text(files.confined(root, a.report), wholetext=True), confirmed=a.verb == "final")
        checked = qa.recheck(absent, chapters) if a.verb == "recheck" or not a.report else absent.withColumn("confirmed", F.lit(True))
        text = reports.rechecked_lines(checked) if a.verb == "recheck" else reports.final_lines(qa.final_names(checked))
        _save(root, f"reports/{a.verb}.txt", text)
    elif a.verb == "score":
        scored = qa.scores(chapters)
        print(scored.agg(F.avg("overall").alias("mean")).first().mean)
        qa.low_scores(scored).show(truncate=False)
        if a.reviews:
            print(sample.scored_count(files.review_scores(spark, files.confined(root, a.reviews))).first().asDict())
    elif a.verb in ("sample", "review"):
        chosen = chapters.where(F.col("book") == a.book) if a.book else chapters
        drawn = sample.sample(chosen, ["book", "file"], a.sample_size, a.seed)
        text = reports.sampled(drawn, qa.sample_issues(drawn)) if a.verb == "sample" else reports.review_page(drawn)
        _save(root, "sample_check/sample.txt" if a.verb == "sample" else a.output, text)
    elif a.verb == "dups":
        rows = dedup.chapter_duplicates(chapters.select("book", "file", "body"), a.threshold)
        _save(root, "reports/duplicates.txt", reports.duplicates_lines(rows))
        for r in rows.orderBy("book", "file").limit(10).collect():
            print(f"{r.file} -> {r.duplicate_of} ({r.reason})")
        if a.delete:
            for r in rows.select("file").toLocalIterator():
                pathlib.Path(files.confined(root, r.file.removeprefix("file:"))).unlink()


if __name__ == "__main__":
    main()
