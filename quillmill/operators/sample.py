"""Samples for review, equal for equal seeds."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def positions(total: int, size: int, seed: int | None) -> list[int]:
    """Positions without replacement, in the order drawn; no seed, or 0, draws anew each time."""
    return (random.Random(seed) if seed else random.Random()).sample(range(total), min(size, total))


def sample(df: DataFrame, order: list[str], size: int = 20, seed: int | None = 42) -> DataFrame:
    """``df`` rows at drawn positions of the order, with ``sample_no`` from 1.

    Rows are numbered without moving them to one task: sorted by range, counted per partition,
    and each partition adds the rows before it.  Only counts and the drawn positions (``size``
    of them) reach the driver.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    placed = placed.withColumn("__row", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("long"), 33))
    from quillmill.operators.tables import written

    placed = written(placed)
    counts = {r["__part"]: r["n"] for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    drawn = positions(sum(counts.values()), size, seed)
    starts, at = {}, 0
    for part in sorted(counts):
        starts[part] = at
        at += counts[part]
    wanted = []
    for number, p in enumerate(drawn, 1):
        part = max((x for x in starts if starts[x] <= p and p < starts[x] + counts[x]))
        wanted.append((part, p - starts[part], number))
    picks = spark.createDataFrame(wanted, "__part int, __row long, sample_no int")
    return placed.join(F.broadcast(picks), ["__part", "__row"]).drop("__part", "__row")


def per_book(sampled: DataFrame, book: str = "book") -> DataFrame:
    return sampled.groupBy(book).agg(F.count("*").alias("n"))


def scored_count(reviews: DataFrame) -> DataFrame:
    """One row: scored and unscored samples; one is scored if it has an overall score."""
    done = F.col("overall_score").isNotNull()
    return reviews.agg(F.count_if(done).alias("scored"), F.count_if(~done).alias("unscored"))


def first_unscored(reviews: DataFrame) -> DataFrame:
    return reviews.where("overall_score IS NULL").orderBy("sample_no").limit(1)


def set_score(scores: DataFrame, sample_no: int, key: str, value: int) -> DataFrame:
    """Scores (sample_no, key, value) after a click: the same value again takes it away."""
    hit = (F.col("sample_no") == sample_no) & (F.col("key") == key)
    same = scores.where(hit & (F.col("value") == value)).limit(1).count() > 0
    rest = scores.where(~hit)
    new = scores.sparkSession.createDataFrame([(sample_no, key, value)], scores.schema)
    return rest if same else rest.unionByName(new)
