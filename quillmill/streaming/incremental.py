"""Adding books to a corpus: one batch function, by hand or for a stream of new files.

The state is the index table.  A stream hands each micro-batch of files to the batch function,
which reads the index, writes books and chapters of the next version and then its index.  A
version counts once its index is whole: a run that breaks off before is done again in its place,
and a repeated batch finds its books known and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions.text import AD_PATTERNS, TAG_PATTERNS, clean, file_title, garbled, strip_lf, tags
from quillmill.operators.dedup import dedup_books, fingerprint, unseen
from quillmill.operators.segment import REPEATED_BLOCKS, remove_repeats, split_book, split_flags
from quillmill.operators.tables import written
from quillmill.sources.files import decode_column, raw_texts

INDEX = "book string, status string, duplicate_of string, source_file string, char_count long, hash string, fp array<string>, pos long"
#: Flag of texts with replacement characters.
GARBLED = "解码后含替换字符，疑似编码识别错误"


def empty_index(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INDEX)


def read_books(files: DataFrame, ads=None, tag_rules=None, detect=None) -> DataFrame:
    """(book, author, path, text, tags, flags, hash, fp, char_count) of (path, stem, content).
    Rules that are None are the built-in ones."""
    ads, tag_rules = AD_PATTERNS if ads is None else ads, TAG_PATTERNS if tag_rules is None else tag_rules
    rows = files.withColumn("raw", decode_column(F.col("content"), detect)).withColumn("t", file_title("stem"))
    lf = F.regexp_replace("raw", r"\r\n?", "\n")
    rows = rows.select(
        F.col("t.title").alias("book"), F.col("t.author").alias("author"), "path", clean("raw", ads).alias("text"),
        tags(lf, tag_rules).alias("tags"), F.when(garbled("raw"), F.array(F.lit(GARBLED))).otherwise(F.array().cast("array<string>")).alias("flags"),
    )
    return fingerprint(rows)


def clean_batch(files: DataFrame, index: DataFrame, force: bool = False, **reading) -> dict[str, DataFrame]:
    """New books into descriptions, chapters, dropped books and the next index.

    Known files are left out before their content is read.  Under ``force`` they are cleaned
    again, and a book is no duplicate of itself.
    """
    named = files.withColumn("book", file_title("stem")["title"])
    todo = unseen(named, index, force).select("path", "stem", "content")
    new = written(read_books(todo, **reading))
    cached = index.where("status = 'cleaned'").select("book", "pos", "hash", "fp", "char_count")
    kept, dropped = dedup_books(new, cached)
    kept, dropped = written(kept), written(dropped)
    cut = written(kept.select("book", "author", "path", "tags", "flags", split_book(F.col("text")).alias("s")))
    books = cut.select("book", F.col("path").alias("source_file"), "tags", strip_lf("s.synopsis").alias("synopsis"), F.concat("flags", split_flags(F.col("s"))).alias("flags"))
    rows = cut.select("book", F.col("path").alias("source_file"), F.posexplode("s.chapters").alias("p", "c"))
    rows = rows.select("book", "source_file", (F.col("p") + 1).alias("chapter_no"), F.col("c.title").alias("title"), F.col("c.body").alias("body"))
    none = F.array().cast("array<string>")
    chapters = remove_repeats(rows).withColumn("flags", F.when(F.size("removed") > 0, F.array(F.lit(REPEATED_BLOCKS))).otherwise(none))
    last = index.agg(F.coalesce(F.max("pos"), F.lit(-1)).alias("p"))
    # Positions only order the index; gaps are fine.
    at = last.select("p")
    ok = kept.select("book", F.lit("cleaned").alias("status"), F.lit(None).cast("string").alias("duplicate_of"), F.col("path").alias("source_file"), F.col("char_count").cast("long").alias("char_count"), "hash", "fp")
    bad = dropped.select("book", F.lit("duplicate").alias("status"), "duplicate_of", F.col("path").alias("source_file"), F.lit(None).cast("long").alias("char_count"), F.lit(None).cast("string").alias("hash"), F.lit(None).cast("array<string>").alias("fp"))
    added = ok.unionByName(bad).withColumn("k", F.monotonically_increasing_id()).join(at).withColumn("pos", F.col("p") + 1 + F.col("k")).drop("p", "k")
    next_index = index.join(added.select("book").distinct(), "book", "left_anti").select(added.columns).unionByName(added)
    return {"books": books, "chapters": chapters, "dropped": dropped, "index": next_index}


def counts(files: DataFrame, result: dict[str, DataFrame]) -> dict[str, int]:
    """What a run reports: files seen, books kept and dropped, chapters written."""
    kept, dropped = result["books"].count(), result["dropped"].count()
    return {"seen": files.count(), "kept": kept, "dropped": dropped, "chapters": result["chapters"].count()}


def run_once(spark: SparkSession, folder: str, out: str, force: bool = False, files: DataFrame | None = None, **reading) -> dict[str, DataFrame]:
    """Clean ``folder`` into tables below ``out``, a version a run (``v=N``); the index comes last,
    so a run that breaks off is done again in the same place.  ``reading``: options of ``read_books``."""
    index = _latest(spark, out)
    result = clean_batch(files if files is not None else raw_texts(spark, folder), index, force, **reading)
    result = {k: written(v) for k, v in result.items()}
    version = 1 + max(_versions(spark, out), default=-1)
    for name in ("books", "chapters", "dropped", "index"):
        result[name].write.mode("overwrite").parquet(f"{out}/{name}/v={version:06d}")
    return result


def _versions(spark: SparkSession, out: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/index")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = (s.getPath() for s in fs.listStatus(path))
    return [int(p.getName()[2:]) for p in done if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def _latest(spark: SparkSession, out: str) -> DataFrame:
    versions = _versions(spark, out)
    return spark.read.schema(INDEX).parquet(f"{out}/index/v={max(versions):06d}") if versions else empty_index(spark)


def stream(spark: SparkSession, folder: str, out: str, checkpoint: str):
    """A query that cleans the files that are in ``folder`` now and ends; start it again for
    files that come later."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.txt").load(folder)
    named = files.select("path", F.regexp_extract("path", r"([^/\\]+)\.txt\z", 1).alias("stem"), "content")

    def batch(rows: DataFrame, _: int) -> None:
        run_once(rows.sparkSession, folder, out, files=rows)

    return named.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
