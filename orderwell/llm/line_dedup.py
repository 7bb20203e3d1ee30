"""Lines that many documents share, kept in one of them.  Reversible.

The index holds, for every long line, which documents it occurs in (postings, only
ever added to: a batch that inserts and a batch that deletes cancel out), the exact
reference count and last document of each line, and one cuckoo filter per shard of
the lines that reach the threshold.  A filter takes deletions, so lines that fall
below the threshold leave it again.  Texts are probed against the filters where they
are read; only lines that a filter knows are shuffled and settled by the exact table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.exact_dedup import LOWER, UPPER
from orderwell.llm.text import mix
from orderwell.sources.tables import stage, table_exists

MIN_CHARS, MIN_DOCS, SHARDS = 40, 5, 64
SPACE = " \t\n\x0b\x0c\r"
SLOTS, MAX_KICKS = 4, 200
#: Filters of at most so many bytes are sent to every executor; without them every
#: long line is settled by the exact table.
BROADCAST_BYTES = 64 << 20
POSTING = "shard int, key_a long, key_b long, doc_id long, present boolean"
COUNT = "shard int, key_a long, key_b long, n_docs long, last_doc long"
FILTER = "shard int, tables array<binary>"


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; when it is full a table of twice
    the size is added, so no insertion is ever lost."""

    def __init__(self, tables: list[bytes] | None = None, expected: int = 1):
        if tables:
            self.tables = [np.frombuffer(t, "<u2").reshape(-1, SLOTS).copy() for t in tables]
        else:
            buckets = 1 << max(2, (max(1, expected) * 5 // (4 * SLOTS)).bit_length())
            self.tables = [np.zeros((buckets, SLOTS), "<u2")]

    def _places(self, table: np.ndarray, hashes: np.ndarray):
        mask = np.uint64(len(table) - 1)
        prints = (hashes >> np.uint64(48)).astype(np.uint64)
        prints[prints == 0] = 1
        first = hashes & mask
        return prints.astype(np.uint16), first.astype(np.int64), (first ^ (mix(prints) & mask)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        known = np.zeros(len(hashes), dtype=bool)
        for table in self.tables:
            prints, first, second = self._places(table, hashes)
            for at in (first, second):
                known |= (table[at] == prints[:, None]).any(axis=1)
        return known

    def insert(self, hashes: np.ndarray) -> None:
        for h in hashes:
            if not self._put(self.tables[-1], h):
                self.tables.append(np.zeros((2 * len(self.tables[-1]), SLOTS), "<u2"))
                self._put(self.tables[-1], h)

    def _put(self, table: np.ndarray, h: np.uint64) -> bool:
        prints, first, second = self._places(table, np.array([h], np.uint64))
        mask, value = np.uint64(len(table) - 1), prints[0]
        for at in (first[0], second[0]):
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = value
                return True
        at, path = first[0], []
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            path.append((at, slot, table[at, slot]))
            value, table[at, slot] = table[at, slot], value
            moved = mix(np.array([value], np.uint64))[0] & mask
            at = int(np.uint64(at) ^ moved)
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = value
                return True
        for at, slot, value in reversed(path):
            table[at, slot] = value
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Takes out one fingerprint for each hash, which must have been inserted."""
        for h in hashes:
            for table in reversed(self.tables):
                prints, first, second = self._places(table, np.array([h], np.uint64))
                spots = [(a, s) for a in (first[0], second[0]) for s in np.flatnonzero(table[a] == prints[0])]
                if spots:
                    table[spots[0]] = 0
                    break

    def as_bytes(self) -> list[bytes]:
        return [t.tobytes() for t in self.tables]


def _hash(key_a: np.ndarray, key_b: np.ndarray) -> np.ndarray:
    return mix(key_a.astype(np.int64).view(np.uint64) ^ mix(key_b.astype(np.int64).view(np.uint64)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _pair(key: Column) -> Column:
    """128 bits of a key, as two longs."""
    return F.struct(F.xxhash64(key).alias("key_a"), F.xxhash64(F.lit(1), key).alias("key_b"))


def _long_keys(text: Column, min_chars: int) -> Column:
    """The distinct keys of a text's long lines, hashed."""
    # Lower-casing the whole text moves no line end; trimming then is line by line.
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    keys = F.transform(F.split(lower, "\n"), lambda line: F.btrim(line, F.lit(SPACE)))
    long = F.filter(keys, lambda key: F.char_length(key) >= min_chars)
    return F.transform(F.array_distinct(long), _pair)


def _held_lines(docs: DataFrame, min_chars: int, shards: int) -> DataFrame:
    exploded = docs.select("doc_id", F.explode(_long_keys(F.col("text"), min_chars)).alias("key"))
    return exploded.select("doc_id", "key.*").withColumn(
        "shard", F.pmod(F.col("key_a"), F.lit(shards)).cast("int")
    )


def _update_filter(key: tuple, changes: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    rose = changes[changes["rose"]]
    fell = changes[~changes["rose"]]
    held = CuckooFilter(list(old["tables"].iloc[0]) if len(old) else None, expected=len(rose))
    held.delete(_hash(fell["key_a"].to_numpy(), fell["key_b"].to_numpy()))
    held.insert(_hash(rose["key_a"].to_numpy(), rose["key_b"].to_numpy()))
    return pd.DataFrame({"shard": [key[0]], "tables": [held.as_bytes()]})


class LineIndex:
    """Long lines of the documents inserted so far, below ``path``.

    ``insert`` and ``delete`` write a new version beside the last one, so a run that
    dies leaves the last version right, and every version can still be read.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        min_chars: int = MIN_CHARS,
        min_docs: int = MIN_DOCS,
        shards: int = SHARDS,
    ):
        self.spark, self.path = spark, path
        self.min_chars, self.min_docs, self.shards = min_chars, min_docs, shards
        self.version = 0
        while table_exists(spark, f"{path}/filters/version={self.version + 1}"):
            self.version += 1

    def _read(self, table: str, schema: str, version: int | None = None) -> DataFrame:
        version = self.version if version is None else version
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}/version={version}")

    def counts(self) -> DataFrame:
        """Exact reference counts: key_a, key_b, n_docs, last_doc (largest doc_id)."""
        return self._read("counts", COUNT)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Adds documents.  Rows with the same doc_id, null included, are one
        document; adding a line of a document again changes nothing."""
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        held = _held_lines(rows, self.min_chars, self.shards).withColumn("present", F.lit(True))
        self._apply(held)

    def delete(self, doc_ids: DataFrame, id_col: str = "doc_id") -> None:
        """Takes documents out again, whatever batch brought them."""
        gone = doc_ids.select(F.col(id_col).cast("long").alias("gone")).distinct()
        held = self._postings().join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi")
        self._apply(held.withColumn("present", F.lit(False)))

    def _postings(self) -> DataFrame:
        """Line and document of every reference that holds now."""
        if not self.version:
            return self.spark.createDataFrame([], POSTING).drop("present")
        if self.version == 1:
            rows = self._read("postings", POSTING, 1)
            return rows.drop("present")
        batches = [
            self._read("postings", POSTING, v).withColumn("batch", F.lit(v))
            for v in range(1, self.version + 1)
        ]
        every = batches[0]
        for batch in batches[1:]:
            every = every.unionByName(batch)
        last = every.groupBy("shard", "key_a", "key_b", "doc_id").agg(
            F.max_by("present", "batch").alias("present")
        )
        return last.filter("present").drop("present")

    def _apply(self, changes: DataFrame) -> None:
        old, version = self.counts(), self.version + 1
        columns = ["shard", "key_a", "key_b", "doc_id", "present"]
        changes.select(*columns).distinct().write.mode("overwrite").parquet(
            f"{self.path}/postings/version={version}"
        )
        self.version = version
        postings = self._postings()
        if version > 1:
            touched = self._read("postings", POSTING).select("key_a", "key_b").distinct()
            postings = postings.join(touched, ["key_a", "key_b"], "left_semi")
            untouched = old.join(touched, ["key_a", "key_b"], "left_anti")
        fresh = postings.groupBy("shard", "key_a", "key_b").agg(
            F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")
        )
        counts = fresh.unionByName(untouched) if version > 1 else fresh
        counts.write.mode("overwrite").parquet(f"{self.path}/counts/version={version}")
        self._update_filters(old, version)

    def _update_filters(self, old: DataFrame, version: int) -> None:
        often = F.col("n_docs") >= self.min_docs
        key = ["shard", "key_a", "key_b"]
        was = old.filter(often).select(*key)
        now = self.counts().filter(often).select(*key)
        rose = now.join(was, key, "left_anti").withColumn("rose", F.lit(True))
        changes = rose
        if version > 1:
            changes = rose.unionByName(was.join(now, key, "left_anti").withColumn("rose", F.lit(False)))
        filters = self._read("filters", FILTER, version - 1)
        (
            changes.groupBy("shard")
            .cogroup(filters.groupBy("shard"))
            .applyInPandas(_update_filter, FILTER)
            .write.mode("overwrite")
            .parquet(f"{self.path}/filters/version={version}")
        )

    def _probe(self, lines: DataFrame) -> DataFrame:
        """The lines whose shard's filter knows them; all lines if the filters are
        too large to send round."""
        filters = self._read("filters", FILTER)
        size = filters.agg(
            F.sum(F.aggregate("tables", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t)))
        ).first()[0]
        if (size or 0) > BROADCAST_BYTES:
            return lines
        held = {r.shard: [bytes(t) for t in r.tables] for r in filters.collect()}
        shared = self.spark.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = {s: CuckooFilter(t) for s, t in shared.value.items()}
            for batch in batches:
                shard = batch.column("shard").to_numpy()
                hashes = _hash(batch.column("key_a").to_numpy(), batch.column("key_b").to_numpy())
                hit = np.zeros(len(shard), dtype=bool)
                for s in np.unique(shard).tolist():
                    own = np.flatnonzero(shard == s)
                    if s in known:
                        hit[own] = known[s].contains(hashes[own])
                yield batch.filter(pa.array(hit))

        return lines.mapInArrow(run, lines.schema)

    def rewrite(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_text.

        A line of ``min_chars`` code points or more (trimmed) that ``min_docs``
        indexed documents hold goes, except in the largest doc_id that holds it; a
        null id is smaller than any.  Null counts as empty text, which is one empty
        line.  Repeated rows are treated alike.
        """
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        lines = _held_lines(rows, self.min_chars, self.shards).select("doc_id", "shard", "key_a", "key_b")
        often = self.counts().filter(F.col("n_docs") >= self.min_docs).select("key_a", "key_b", "last_doc")
        drops = stage(
            stage(self._probe(lines), "probed")
            .join(stage(often, "often"), ["key_a", "key_b"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
            .groupBy(F.col("doc_id").alias("drop_id"))
            .agg(F.collect_set(F.struct("key_a", "key_b")).alias("drops")),
            "drops",
        )
        # Texts are always shuffled by document: how much is moved grows with the input.
        joined = rows.join(drops.hint("merge"), F.col("doc_id").eqNullSafe(F.col("drop_id")), "left")
        every = _lines(F.col("text"))

        def stays(line: Column) -> Column:
            key = _key(line)
            return (F.char_length(key) < self.min_chars) | ~F.array_contains("drops", _pair(key))

        kept = F.when(F.col("drops").isNull(), every).otherwise(F.filter(every, stays))
        return joined.select(
            "doc_id",
            F.size(every).cast("long").alias("n_lines"),
            (F.size(every) - F.size(kept)).cast("long").alias("n_dropped"),
            F.array_join(kept, "\n").alias("kept_text"),
        )
