"""Raw texts, chapter files, book descriptions, indexes and reports, in and out."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tried in this order (fixed values).
ENCODINGS = ("utf-8", "gb18030", "big5", "utf-16")
LEAST_CONFIDENCE = 0.7

CHARACTER = "struct<name:string,role:string,state:string,speech:string,importance:string,function:string>"
CHAPTER = (
    f"struct<world:string,scene:string,emotion:string,plot:string,style:string,characters:array<{CHARACTER}>,pov:string,"
    "word_count:int,flags:array<string>,body:string,malformed:boolean,parse_error:string>"
)
BOOK = (
    "struct<book:string,source_file:string,tags:array<string>,synopsis:string,world:string,"
    "style_template:array<struct<role:string,instruction:string>>,banned_terms:array<string>,flags:array<string>>"
)


def raw_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, stem, content) of the ``*.txt`` files right in ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    return files.select("path", F.regexp_extract("path", r"([^/\\]+)\.txt\z", 1).alias("stem"), "content")


def decoded(data: bytes, detect: Callable[[bytes], tuple[str | None, float]] | None = None) -> str:
    """Text of bytes: a detector's guess if it is sure enough, else the first encoding that
    fits, else UTF-8 without what does not."""
    guess, sure = detect(data) if detect else (None, 0.0)
    for name in ([guess] if guess and sure >= LEAST_CONFIDENCE else []) + list(ENCODINGS):
        try:
            return data.decode(name)
        except (UnicodeDecodeError, LookupError):
            continue
    return data.decode("utf-8", "ignore")


def decode_column(content: Column, detect=None) -> Column:
    """UTF-8 in the JVM; the others by an Arrow UDF."""

    @F.pandas_udf("string")
    def other(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for contents in batches:
            yield contents.map(lambda b: None if b is None else decoded(bytes(b), detect))

    return other(content) if detect else F.coalesce(F.try_validate_utf8(F.decode(F.when(F.is_valid_utf8(content.cast("string")), content), "UTF-8")), other(content))


def detector() -> Callable[[bytes], tuple[str | None, float]] | None:
    """(encoding, confidence) by an installed detection library; None where there is none."""
    import importlib.util

    if not importlib.util.find_spec("chardet"):
        return None

    def detect(data: bytes) -> tuple[str | None, float]:
        import chardet

        found = chardet.detect(data)
        return found["encoding"], found["confidence"] or 0.0

    return detect


def pattern_file(path: str) -> list[str] | None:
    """The rules in a local file; None where there is no such file."""
    if not os.path.exists(path):
        return None
    with open(path, encoding="utf-8") as f:
        return patterns(f.read())


def patterns(lines: str) -> list[str]:
    """Rules of a configuration text: one per line, without blank lines and comments."""
    return [s for s in map(str.strip, lines.splitlines()) if s and not s.startswith("#")]


def _yaml(text: str):
    import yaml

    return yaml.safe_load(text)


def _texts(value) -> list[str]:
    return [str(x) for x in value] if isinstance(value, list) else []


def _text(value) -> str | None:
    return None if value is None else value if isinstance(value, str) else str(value)


def parse_chapter(raw: str, strict: bool = False) -> dict:
    """Fields and body of a chapter file: front matter between the first two ``---``.

    Strict: the body loses line breaks at its ends, and a file without front matter is an
    error.  Tolerant: the body is stripped, and such a file is malformed.  Front matter that
    can't be read is a parse_error and counts as empty; fields of other types become text.
    """
    parts = raw.split("---", 2)
    if len(parts) < 3:
        if strict:
            raise ValueError("no front matter")
        return {"malformed": True, "body": ""}
    try:
        meta, error = _yaml(parts[1]), None
        if meta is not None and not isinstance(meta, dict):
            meta, error = None, "front matter is no mapping"
    except ImportError:
        raise
    except Exception as e:  # yaml's errors have no common base with ValueError
        meta, error = None, str(e).splitlines()[0]
    meta = meta or {}
    plot = meta.get("plot") if "plot" in meta else meta.get("plot_outline")
    people = [{k: _text(c.get(k)) for k in ("name", "role", "state", "speech", "importance", "function")} for c in meta.get("characters") or [] if isinstance(c, dict)]
    count = meta.get("word_count")
    return {
        **{k: _text(meta.get(k)) for k in ("world", "scene", "emotion", "style", "pov")},
        "plot": _text(plot),
        "characters": people,
        "word_count": count if isinstance(count, int) else None,
        "flags": _texts(meta.get("flags")),
        "body": parts[2].strip("\n") if strict else parts[2].strip(),
        "malformed": False,
        "parse_error": error,
    }


def render_chapter(row: dict) -> str:
    """A chapter file; the fields are written in a fixed order, body last."""
    import yaml

    front = {k: row.get(k) or "" for k in ("world", "scene", "emotion", "plot", "style")}
    front["characters"] = [{k: v for k, v in dict(c).items() if v is not None} for c in row.get("characters") or []]
    front |= {"pov": row.get("pov") or "", "word_count": row.get("word_count")}
    if row.get("flags"):
        front["flags"] = list(row["flags"])
    return "---\n" + yaml.safe_dump(front, allow_unicode=True, sort_keys=False) + "---\n\n" + (row.get("body") or "") + "\n"


def write_tree(books: DataFrame, chapters: DataFrame, folder: str) -> None:
    """``book/_book_meta.yaml`` and ``book/NNNN.md`` for people to annotate, on a local or
    mounted folder that the executors share.  Chapters are written by the tasks that hold them.  A
    description that exists stays; flags of a chapter are written into its front matter."""
    import yaml

    for b in books.toLocalIterator():
        path = confined(folder, f"{b.book}/_book_meta.yaml")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        if not os.path.exists(path):
            about = {"book": b.book, "source_file": b.source_file, "tags": list(b.tags or []), "synopsis": b.synopsis or "", "world": "", "style_template": [], "banned_terms": [], "flags": list(b.flags or [])}
            with open(path, "w", encoding="utf-8") as f:
                f.write(yaml.safe_dump(about, allow_unicode=True, sort_keys=False))

    def write(rows) -> None:
        for c in rows:
            path = confined(folder, f"{c.book}/{c.chapter_no:04d}.md")
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w", encoding="utf-8") as f:
                f.write(render_chapter({"body": c.body, "flags": c.flags}))

    chapters.select("book", "chapter_no", "body", "flags").foreachPartition(write)


def chapter_files(spark: SparkSession, folder: str, strict: bool = False) -> DataFrame:
    """One row per ``book/NNNN.md``: file, book, chapter_no and the fields of ``CHAPTER``."""

    @F.pandas_udf(CHAPTER)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split(":")[0] for x in ("world", "scene", "emotion", "plot", "style", "characters", "pov", "word_count", "flags", "body", "malformed", "parse_error")]
        for contents in batches:
            rows = [parse_chapter(bytes(b).decode("utf-8"), strict) for b in contents]
            yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names).astype({"word_count": "Int32"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").load(folder)
    found = files.select(
        F.col("path").alias("file"),
        F.regexp_extract("path", r"([^/\\]+)[/\\][^/\\]+\z", 1).alias("book"),
        F.regexp_extract("path", r"(\d{4})\.md\z", 1).try_cast("int").alias("chapter_no"),
        parse("content").alias("c"),
    )
    return found.select("file", "book", "chapter_no", "c.*")


def book_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ``book/_book_meta.yaml``; folders without one are absent.

    Spark's readers pass over names that begin with an underscore, so the driver lists the paths
    and tasks read the files from the local or mounted folder.
    """

    @F.pandas_udf(BOOK)
    def parse(paths: pd.Series) -> pd.DataFrame:
        rows = []
        for p in paths:
            with open(p.removeprefix("file:"), encoding="utf-8") as f:
                m = _yaml(f.read()) or {}
            styles = [{"role": _text(s.get("role")), "instruction": _text(s.get("instruction"))} if isinstance(s, dict) else {"role": None, "instruction": _text(s)} for s in m.get("style_template") or []]
            rows.append({**{k: _text(m.get(k)) for k in ("book", "source_file", "synopsis", "world")}, **{k: _texts(m.get(k)) for k in ("tags", "banned_terms", "flags")}, "style_template": styles})
        return pd.DataFrame(rows, columns=["book", "source_file", "tags", "synopsis", "world", "style_template", "banned_terms", "flags"])

    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*/_book_meta.yaml")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    files = spark.createDataFrame([(s.getPath().toString(),) for s in found], "path string")
    return files.select(F.regexp_extract("path", r"([^/\\]+)[/\\][^/\\]+\z", 1).alias("folder"), parse("path").alias("b")).select("folder", "b.*")


def corpus_index(spark: SparkSession, path: str) -> DataFrame:
    """The index, one row per book: of several lines the last counts, at the place of the first."""
    schema = "book string, status string, duplicate_of string, source_file string, char_count long, hash string, fp array<string>"
    lines = spark.read.text(path).withColumn("__at", F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id()))
    rows = lines.withColumn("r", F.from_json("value", schema)).where("r.book IS NOT NULL")
    return rows.groupBy("r.book").agg(F.max_by("r", "__at").alias("r"), F.min("__at").alias("pos")).select("r.*", "pos")


def write_index(index: DataFrame, path: str) -> None:
    """The index as JSON lines, in place of what was there."""
    index.drop("pos").write.mode("overwrite").json(path)


def new_descriptions(books: DataFrame, known: DataFrame) -> DataFrame:
    """Descriptions for books that have none yet; what people filled in is never replaced."""
    return books.join(known.select("book"), "book", "left_anti").select(
        "book", "source_file", "tags", "synopsis", F.lit("").alias("world"),
        F.array().cast("array<struct<role:string,instruction:string>>").alias("style_template"),
        F.array().cast("array<string>").alias("banned_terms"), "flags",
    )


def append_dedup_log(dropped: DataFrame, path: str) -> None:
    dropped.select("book", "reason", "duplicate_of").write.mode("append").option("quoteAll", "true").csv(path)


def append_lines(lines: DataFrame, path: str) -> None:
    """A log of one string column."""
    lines.write.mode("append").text(path)


def write_records(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").text(path)


def dataset_descriptor(file_name: str = "train.jsonl") -> dict:
    """What a trainer needs to read the records (fixed values of its format)."""
    return {
        "file_name": file_name,
        "formatting": "sharegpt",
        "columns": {"messages": "messages"},
        "tags": {"role_tag": "role", "content_tag": "content", "user_tag": "user", "assistant_tag": "assistant"},
    }


def confined(root: str, path: str) -> str:
    """The absolute path of an output; outside of ``root`` it is refused."""
    root, full = os.path.realpath(root), os.path.realpath(os.path.join(root, path))
    if full != root and not full.startswith(root + os.sep):
        raise ValueError(f"refusing to write outside {root}: {full}")
    return full


def review_scores(spark: SparkSession, path: str) -> DataFrame:
    """Scores that a reviewer exported: a JSON object by sample number."""
    kind = "map<string,struct<scene_score:int,plot_score:int,character_score:int,emotion_score:int,style_score:int,overall_score:int,comment:string>>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("m"))
    return whole.select(F.explode("m").alias("sample_no", "s")).select(F.col("sample_no").cast("int").alias("sample_no"), "s.*")


def report_problems(reports: DataFrame, confirmed: bool = False) -> DataFrame:
    """(file, character) rows of a report's text (column ``value``): of the section of
    characters that are not in the body or, with ``confirmed``, of the confirmed problems.

    Within one row: the text is cut at the section's title and at the next one.
    """
    title, end = ("【确认问题列表】", r"(?=\z)") if confirmed else (r"\[角色不在正文\]", r"(?=\n  \[[^\n]*\]|\z)")
    section = F.regexp_extract("value", rf"(?s){title}[^\n]*\n(.*?){end}", 1)
    line = r"(cleaned[\\/].+?\.md):\s+(.+)$"
    rows = reports.select(F.explode(F.split(section, "\n")).alias("line"))
    rows = rows.where(F.col("line").rlike(r"^  .*\. cleaned")) if confirmed else rows
    return rows.where(F.trim("line").rlike(line)).select(F.regexp_extract(F.trim("line"), line, 1).alias("file"), F.trim(F.regexp_extract(F.trim("line"), line, 2)).alias("character"))


def write_description(path: str, fields: dict) -> None:
    """``fields`` put into the book description at ``path``; what else it holds stays."""
    import yaml

    with open(path, encoding="utf-8") as f:
        about = yaml.safe_load(f) or {}
    with open(path, "w", encoding="utf-8") as f:
        f.write(yaml.safe_dump(about | fields, allow_unicode=True, sort_keys=False))


def newest(files: DataFrame) -> DataFrame:
    """The file that was changed last, of a ``binaryFile`` listing."""
    return files.orderBy(F.desc("modificationTime"), "path").limit(1)
