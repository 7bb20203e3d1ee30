"""Exact duplicates by two passes over a Bloom filter.

The first pass counts, in a counting filter whose counters stop at two, how often
each filter bit was hit.  A text can only be repeated if all its bits were hit
twice, so in the second pass every other row goes straight through and only the
possibly repeated rows are shuffled and settled by SHA-256.

The filter is cut into segments of fixed size; all bits of a text lie in one
segment.  The number of segments grows with the rows, so false alarms stay near
0.3 % and a segment stays small at any scale.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwell.sources.tables import stage

SEGMENT_BITS = 1 << 16
BITS_PER_ROW = 16
PROBES = 4
#: A filter of at most so many bytes is sent to every executor; a larger one is joined.
BROADCAST_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Null as empty, A-Z lower-cased, nothing else changed."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fingerprint(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _segment(sha: Column, segments: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), sha), F.lit(segments)).cast("int")


def _bit(sha: Column, probe: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(sha), 16 * probe).bitwiseAND(SEGMENT_BITS - 1).cast("int")


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and segment: the bits hit, and whether more than once."""
    for batch in batches:
        segment = batch.column("segment").to_numpy().astype(np.int64)
        bits = np.stack([batch.column(f"bit{i}").to_numpy() for i in range(PROBES)], axis=1)
        owned = np.sort(segment[:, None] * SEGMENT_BITS + bits, axis=1)
        first = np.ones(owned.shape, dtype=bool)  # two probes on one bit are one hit
        first[:, 1:] = owned[:, 1:] != owned[:, :-1]
        hit, times = np.unique(owned[first], return_counts=True)
        segments, starts = np.unique(hit // SEGMENT_BITS, return_index=True)
        ends = np.append(starts[1:], len(hit))
        offsets = (hit % SEGMENT_BITS).astype("<u2")
        again = times > 1
        spans = list(zip(starts.tolist(), ends.tolist()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(segments.astype(np.int32)),
                pa.array([offsets[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([again[a:b].tobytes() for a, b in spans], pa.binary()),
            ],
            names=["segment", "bits", "twice"],
        )


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    """One segment as a bitmap of the bits that were hit at least twice."""
    once, twice = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
    for bits, again in zip(frame["bits"], frame["twice"]):
        at = np.frombuffer(bits, "<u2")
        twice[at] |= once[at] | np.frombuffer(again, bool)
        once[at] = True
    packed = np.packbits(twice, bitorder="little").tobytes()
    return pd.DataFrame({"segment": frame["segment"].iloc[:1], "repeated": [packed]})


_MASKS = [1 << i for i in range(8)]


class RepeatFilter:
    """The counting filter over a stored table of fingerprints (column ``sha``)."""

    def __init__(self, keys: DataFrame):
        self.segments = max(1, -(-keys.count() * BITS_PER_ROW // SEGMENT_BITS))
        probes = [_bit(F.col("sha"), i).alias(f"bit{i}") for i in range(PROBES)]
        self.bitmaps = stage(
            keys.select(_segment(F.col("sha"), self.segments).alias("segment"), *probes)
            .mapInArrow(_hits, "segment int, bits binary, twice binary")
            .groupBy("segment")
            .applyInPandas(_merge, "segment int, repeated binary"),
            "bloom",
        )

    def probe(self, rows: DataFrame, sha: str, flag: str) -> DataFrame:
        """``rows`` with a boolean column: false only if the fingerprint is unique.

        A filter within its bound is sent to the executors and the rows stay where
        they are; a larger one is joined by segment.
        """
        bitmaps = self.bitmaps.select(
            F.col("segment").alias("_bloom_segment"), F.col("repeated").alias("_bloom_bits")
        )
        if self.segments * SEGMENT_BITS // 8 <= BROADCAST_BYTES:
            bitmaps = F.broadcast(bitmaps)
        joined = rows.join(
            bitmaps, _segment(rows[sha], self.segments) == bitmaps["_bloom_segment"], "left"
        )

        def is_set(bit: Column) -> Column:
            one_byte = F.substring("_bloom_bits", F.shiftright(bit, 3) + 1, F.lit(1))
            value = F.conv(F.hex(one_byte), 16, 10).cast("int")
            return value.bitwiseAND(F.element_at(F.array(*map(F.lit, _MASKS)), F.pmod(bit, F.lit(8)) + 1)) != 0

        all_set = F.lit(True)
        for i in range(PROBES):
            all_set = all_set & is_set(_bit(rows[sha], i))
        return joined.withColumn(flag, F.coalesce(all_set, F.lit(True))).drop(
            "_bloom_segment", "_bloom_bits"
        )


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z; null counts as empty.  The
    row with the largest doc_id stays, a null id being smaller than any other.  Of
    repeated rows (equal text and doc_id) exactly one stays; each counts in
    ``group_size``.
    """
    keys = stage(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            fingerprint(F.col(text_col)).alias("sha"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "fingerprints",
    )
    probed = RepeatFilter(keys).probe(keys, "sha", "maybe")
    single = probed.filter(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    maybe = probed.filter("maybe")
    groups = stage(
        maybe.groupBy("sha").agg(
            F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("group_size")
        ),
        "groups",
    )
    settled = maybe.join(groups, "sha").select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return single.unionByName(settled)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``decide`` keeps.

    Rows whose text is certainly unique are passed on unmoved; of the others only
    fingerprints are shuffled to find each group's last doc_id, then the rows that
    carry it are reduced to one per text.
    """
    columns = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        F.col(id_col).cast("long").alias("id"),
        fingerprint(F.col(text_col)).alias("sha"),
    )
    keys = stage(rows.select("id", "sha"), "fingerprints")
    repeats = RepeatFilter(keys)
    last = stage(
        repeats.probe(keys, "sha", "maybe")
        .filter("maybe")
        .groupBy("sha")
        .agg(F.max("id").alias("last_id"), F.count("*").alias("copies")),
        "groups",
    )
    probed = repeats.probe(rows, "sha", "maybe")
    maybe = probed.filter("maybe")
    held = maybe.join(last, "sha").filter(F.col("id").eqNullSafe(F.col("last_id")))
    once = held.filter("copies = 1").select("doc")
    several = held.filter("copies > 1").groupBy("sha").agg(F.any_value("doc").alias("doc")).select("doc")
    single = probed.filter(~F.col("maybe")).select("doc")
    return single.unionByName(once).unionByName(several).select("doc.*")
