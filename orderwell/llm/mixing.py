"""Mixing sources to target weights, in DataFrame functions only.

Words are counted per document and added up per source (map-side first, so a source
with a third of all rows costs one row per task).  Targets are filled like vessels:
every source gets its weight's share of the whole, a source stops at a multiple of
its size, and what it leaves is shared again by weight.  A document is then written
floor(rate) times, and once more if its hash-seeded draw is below the fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderwell.llm.keys import send_if_small
from orderwell.sources.tables import stage

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
#: Sources are ranked in so many key ranges side by side.
RANK_RANGES = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on key and seed alone: 52 bits of SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)


def _ranked(sizes: DataFrame) -> DataFrame:
    """Adds ``place``, the position of the source by code point, null last, from 0.

    Sources are sorted within key ranges; only the rows per range are added up in
    one place, so any number of sources is ranked without gathering them.
    """
    null_last = F.col("source").isNull()
    ranged = stage(
        sizes.repartitionByRange(RANK_RANGES, null_last, F.col("source")).withColumn(
            "part", F.spark_partition_id()
        ),
        "ranged-sources",
    )
    parts = ranged.groupBy("part").agg(F.count("*").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy(null_last, "source")
    return ranged.join(F.broadcast(parts), "part").select(
        "source", "source_size", (F.col("before") + F.row_number().over(within) - 1).alias("place")
    )


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row per source.

    Weights repeat over the sources in order of code point, null last.  All targets
    together are the sum of all sizes.  A source whose share is above
    ``max_repeats`` times its size stops there and the rest is shared by weight
    until none is above.  Without any words every target is 0.
    """
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
    )
    sources = stage(_ranked(sizes).withColumn("weight", weight.cast("long")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * max_repeats
    full = F.lit(False)
    while True:
        open_weight, filled = sources.agg(
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)),
        ).first()
        per_weight = float(total - filled) / open_weight if open_weight else 0.0
        share = F.lit(per_weight) * F.col("weight")
        above = full | (share > most)
        if not sources.filter(above & ~full).isEmpty():
            sources = stage(sources.withColumn("full", above), "sources")
            full = F.col("full")
            continue
        target = F.when(full, most.cast("double")).otherwise(share)
        return sources.select("source", "source_size", target.cast("double").alias("target"))


def _with_copies(sized: DataFrame, rates: DataFrame, id_col: str, max_repeats: int, seed: str) -> DataFrame:
    """Adds the source's rate columns and ``_copies`` to rows that carry ``_source``."""
    rate = F.least(F.col("_target") / F.col("_source_size"), F.lit(float(max_repeats)))
    rate = F.when(F.col("_source_size") > 0, rate).otherwise(F.lit(0.0))
    extra = (draw(F.col(id_col), seed) < rate - F.floor(rate)).cast("long")
    return sized.join(
        send_if_small(rates), F.col("_source").eqNullSafe(F.col("_of")), "inner"
    ).withColumn("_copies", (F.floor(rate) + extra).cast("long"))


def _rates(sized: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    sizes = sized.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    found = targets(stage(sizes, "source-sizes"), weights, max_repeats)
    return stage(found.toDF("_of", "_source_size", "_target"), "rates")


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, copies.

    A null text has size 0; null sources are one source, placed last.  Rows with the
    same doc_id draw alike, so repeated rows are repeated alike.  An empty table
    gives no rows.  A source without words has target 0 and is not taken.
    """
    sized = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("_source"),
            word_count(F.col(text_col)).alias("_size"),
        ),
        "sizes",
    )
    planned = _with_copies(sized, _rates(sized, weights, max_repeats), "doc_id", max_repeats, seed)
    return planned.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
        F.col("_copies").alias("copies"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``plan`` takes it.

    Only rates meet the documents; their texts stay where they are read.  Sources
    beyond the bound of ``send_if_small`` are joined by shuffle.
    """
    columns = docs.columns
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"))
    sized = sized.select(
        "doc",
        F.col(f"doc.`{id_col}`").alias("_id"),
        F.col(f"doc.`{source_col}`").cast("string").alias("_source"),
    )
    counted = docs.select(
        F.col(source_col).cast("string").alias("_source"), word_count(F.col(text_col)).alias("_size")
    )
    taken = _with_copies(sized, _rates(counted, weights, max_repeats), "_id", max_repeats, seed)
    repeated = F.explode(F.array_repeat(F.col("doc"), F.col("_copies").cast("int")))
    return taken.filter("_copies > 0").select(repeated.alias("doc")).select("doc.*")
