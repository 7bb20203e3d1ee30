"""Tables on shared storage: parquet directories, written so that a lost
executor or a repeated run leaves them right."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderwell.operators.merge import applied, row_changes
from orderwell.schema import SILVER_PARTITIONS


def _scratch_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/orderwell/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory name in a folder that the whole cluster shares: the
    session's ``spark.checkpoint.dir``, or its warehouse where that is unset."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Removes what this application staged; call it when done with the results."""
    _remove(spark, _scratch_root(spark))


#: What a writing task reads, of a file or a shuffle.  Order rows take some twenty times
#: as much in a sort as in compressed columns, so larger tasks spill all they sort.
TASK_BYTES = 16 << 20
#: Shuffle partitions that Spark joins to tasks of that size: enough for 16 GB a shuffle.
SHUFFLE_PIECES = 1000
#: What is written is not read from its shuffles again, which else stay on disk until the
#: driver's memory happens to be collected: with a large driver, all of them.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def small_tasks(spark: SparkSession, files: int = 1, shuffles: int = 1) -> Iterator[None]:
    """Bounded tasks for what is planned and run inside, however large the input: their
    number grows with it, not what each sorts.  Smaller settings of the session hold.
    Where rows take less room than usual, ``files`` and ``shuffles`` say how many times.
    The shuffles of what is run inside are removed as soon as it is done."""
    most = {
        "spark.sql.files.maxPartitionBytes": TASK_BYTES // files,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES // shuffles,
    }
    pieces = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {name: spark.conf.get(name) for name in [*most, DROP_SHUFFLES]} | {pieces: spark.conf.get(pieces, None)}
    spark.conf.set(DROP_SHUFFLES, "true")
    for name, size in most.items():
        spark.conf.set(name, at_most(spark, before[name], size))
    least = before[pieces] or spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(pieces, str(max(int(least), SHUFFLE_PIECES * shuffles)))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def at_most(spark: SparkSession, setting: str | None, size: int) -> str:
    """A setting of so many bytes, or the one there is where that is smaller."""
    given = size if setting is None else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)
    return f"{min(size, given)}b"


#: What tables are compressed with that are to stay: less to write than the default.
CODEC = "zstd"
#: How many times as many rows a byte of them holds.
PACKED = 2


def _packed(df: DataFrame) -> DataFrameWriter:
    return df.write.option("compression", CODEC)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a frame with several consumers: each then reads only the columns it
    needs, and losing an executor does not rerun what came before.
    """
    path = scratch_path(df.sparkSession, name)
    with small_tasks(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_STAGED: dict[tuple[str, str], tuple[str, StructType]] = {}


def stage_once(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """``stage`` for a table that many questions share: built by the first to
    ask within an application, read by the others.

    ``name`` must tell the inputs apart.  A table is remembered only after it was
    written in full.
    """
    key = (spark.sparkContext.applicationId, name)
    path, schema = _STAGED.get(key, (None, None))
    if path is None or not table_exists(spark, path):
        df = build()
        path, schema = scratch_path(spark, "shared"), df.schema
        with small_tasks(spark):
            df.write.partitionBy(*partition_by).parquet(path)
        _STAGED[key] = (path, schema)
    return spark.read.schema(schema).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("_ int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replaces the table at ``path``.

    Partitioned tables are rebalanced first: files of sensible size whatever the
    number of tasks, and a hot partition is split over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    write_as_dealt(df, path, partition_by)


def write_as_dealt(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """The same without rebalancing."""
    with small_tasks(df.sparkSession, files=PACKED):
        _packed(df).mode("overwrite").partitionBy(*partition_by).parquet(path)


def merge_table(
    source: DataFrame,
    path: str,
    keys: Sequence[str] = ("order_id",),
    partition_by: Sequence[str] = SILVER_PARTITIONS,
    newer_by: str | None = None,
) -> None:
    """Upserts ``source`` into the partitioned table at ``path``.

    Only partitions that gain a row or lose one are rewritten: those of the
    source rows, and those where an earlier version of such a row lies (an order
    whose date changed moves).  A partition that ends up empty is removed.
    Running the same merge again leaves the same table.
    """
    if not table_exists(source.sparkSession, path):
        write_table(source, path, list(partition_by))
        return
    changes = stage(find_changes(source, path, keys, partition_by, newer_by), "changes")
    apply_changes(changes, path, keys, partition_by)


def find_changes(
    source: DataFrame,
    path: str,
    keys: Sequence[str] = ("order_id",),
    partition_by: Sequence[str] = SILVER_PARTITIONS,
    newer_by: str | None = None,
    within: list[Row] | None = None,
) -> DataFrame:
    """``row_changes`` of merging ``source`` into the table at ``path``, which need not be
    there yet.  Only partitions that hold one of the keys are read beyond their keys, and
    of the others no more than the keys; none at all of those outside ``within``, if it
    is known where the keys can be (see ``places_of``)."""
    spark, keys, partition_by = source.sparkSession, list(keys), list(partition_by)
    if not table_exists(spark, path) or within == []:
        # Known to be empty when planned, so that nothing is shuffled to meet no rows.
        return row_changes(source.limit(0), source, keys, newer_by)
    target = spark.read.schema(source.schema).parquet(path)
    if within is not None:
        target = in_partitions(target, within, partition_by)
    incoming = source.select(*keys)
    holding = target.select(*keys, *partition_by).join(incoming, keys, "left_semi")
    places = _partitions(holding, partition_by)
    old = in_partitions(target, places, partition_by) if places else target.limit(0)
    return row_changes(old.join(incoming, keys, "left_semi"), source, keys, newer_by)


def widened(
    ranges: DataFrame, rows: DataFrame, key: str, partition_by: Sequence[str] = SILVER_PARTITIONS
) -> DataFrame:
    """``low`` and ``high`` key per partition once ``rows`` have been put in.  Rows that
    left leave their range as it was: it only has to cover the keys there are."""
    new = rows.select(*partition_by, F.col(key).alias("low"), F.col(key).alias("high"))
    both = ranges.select(*partition_by, "low", "high").unionByName(new)
    return both.groupBy(*partition_by).agg(F.min("low").alias("low"), F.max("high").alias("high"))


def places_of(
    rows: DataFrame, ranges: DataFrame, key: str, partition_by: Sequence[str] = SILVER_PARTITIONS
) -> list[Row]:
    """Partitions whose range holds one of the rows' keys, from one pass over the keys.
    ``ranges`` has as many rows as the table has partitions."""
    known, found = ranges.select(*partition_by, "low", "high").collect(), []
    for first in range(0, len(known), 200):
        part = known[first : first + 200]
        tests = [F.coalesce(F.bool_or(F.col(key).between(r.low, r.high)), F.lit(False)) for r in part]
        hits = rows.agg(*[test.alias(f"p{i}") for i, test in enumerate(tests)]).first()
        found += [r for r, hit in zip(part, hits) if hit]
    return found


def apply_changes(
    changes: DataFrame,
    path: str,
    keys: Sequence[str] = ("order_id",),
    partition_by: Sequence[str] = SILVER_PARTITIONS,
) -> None:
    """Brings the table at ``path`` to where stored ``row_changes`` lead.

    Only partitions that gain or lose a row are rewritten, and emptied ones removed.
    Doing it again, after a failure half way too, leaves the same table.
    """
    spark, keys, partition_by = changes.sparkSession, list(keys), list(partition_by)
    done = applied(changes)
    rows = done.filter(F.col("after").isNotNull()).select("after.*")
    if not table_exists(spark, path):
        write_table(rows, path, partition_by)
        return
    target = spark.read.schema(rows.schema).parquet(path)
    gaining = _partitions(rows, partition_by)
    images = done.filter(F.col("before").isNotNull()).select("before.*")
    losing = without(_partitions(images, partition_by), gaining, partition_by)
    if not gaining and not losing:
        return
    moved = done.select(*keys)
    stay = in_partitions(target, [*gaining, *losing], partition_by).join(moved, keys, "left_anti")
    emptied = losing
    if losing:
        rest = in_partitions(target, losing, partition_by).select(*keys, *partition_by)
        emptied = without(losing, _partitions(rest.join(moved, keys, "left_anti"), partition_by), partition_by)
    overwrite_partitions(stay.unionByName(rows), path, partition_by)
    remove_partitions(spark, path, partition_by, emptied)


def without(rows: list[Row], others: list[Row], columns: Sequence[str]) -> list[Row]:
    """``rows`` that do not share their values of ``columns`` with one of ``others``."""
    gone = {_values(row, columns) for row in others}
    return [row for row in rows if _values(row, columns) not in gone]


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], places: list[Row]
) -> None:
    """Writes ``df`` in place of the partitions at ``places``; those that ``df`` has no
    rows for are removed.  ``df`` may read the table itself."""
    partition_by = list(partition_by)
    df = stage(df, "replaced")
    overwrite_partitions(df, path, partition_by)
    remove_partitions(df.sparkSession, path, partition_by, without(places, _partitions(df, partition_by), partition_by))


def remove_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], places: list[Row]) -> None:
    for row in places:
        _remove_directory(spark, path, row, list(partition_by))


def _partitions(df: DataFrame, partition_by: list[str]) -> list[Row]:
    # As many rows as the table has partitions: directory names, not data.
    return df.select(*partition_by).distinct().collect()


def _values(row: Row, partition_by: Sequence[str]) -> tuple:
    return tuple(row[c] for c in partition_by)


def in_partitions(df: DataFrame, rows: list[Row], partition_by: list[str]) -> DataFrame:
    """``df`` limited to the given partitions, pruned at planning time.

    One membership test per leading value keeps the predicate short.
    """
    *lead, last = partition_by
    grouped: dict[tuple, list] = {}
    for row in rows:
        grouped.setdefault(_values(row, lead), []).append(row[last])

    def is_value(name: str, value) -> Column:
        return F.col(name).isNull() if value is None else F.col(name) == value

    def is_one_of(name: str, values: list) -> Column:
        known = [v for v in values if v is not None]
        test = F.col(name).isin(known)
        return test | F.col(name).isNull() if len(known) < len(values) else test

    tests = [
        reduce(
            lambda a, b: a & b,
            [*(is_value(n, v) for n, v in zip(lead, values)), is_one_of(last, lasts)],
        )
        for values, lasts in grouped.items()
    ]
    return df.filter(reduce(lambda a, b: a | b, tests))


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replaces just the partitions that ``df`` holds; the swap happens when the
    job commits, after every task has read what it needs."""
    dealt = df.hint("rebalance", *partition_by)
    with small_tasks(df.sparkSession, files=PACKED):
        (
            _packed(dealt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(path)
        )


def _remove_directory(
    spark: SparkSession, path: str, row: Row, partition_by: list[str]
) -> None:
    parts = [
        f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else quote(str(row[c]))}"
        for c in partition_by
    ]
    _remove(spark, "/".join([path.rstrip("/"), *parts]))


def _remove(spark: SparkSession, path: str) -> None:
    directory = spark._jvm.org.apache.hadoop.fs.Path(path)
    directory.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(
        directory, True
    )
