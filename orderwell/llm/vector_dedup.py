"""Near-duplicate embeddings by a pruned neighbour graph.

Equal vectors are one class.  Classes are dealt to overlapping shards, the nearest
few of a set of centres each; a shard that is too large is cut again by centres of
its own.  Within a shard every class gets the neighbours that robust pruning leaves
it, and the adjacency lists of a class's shards are united over all shards.

The nearest of its shards is a class's home.  A class is searched for in the homes
its shards are, then in those of whatever is found in range: the shards of such a
class and the homes of its neighbours, round by round, until no new one appears.  A
visit compares a class with all members of one home in double precision, so every
link met is found, and a link sends both its ends to each other's home.  A stated
set of queries is compared with all rows; if too many of their links are missing,
every class visits twice as many of the homes nearest to it, at last all of them.

Each pair of classes is compared in one home only, and visits are rows of a class
and a home: a group's pairs become no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderwell.llm.components import connected
from orderwell.sources.tables import stage

COSINE = 0.9
#: Classes per shard aimed at, shards a class goes to, and centres made at a time.
SHARD_ROWS, OVERLAP, MAX_CENTRES = 1500, 4, 1024
#: Vectors that centres are fitted on, about, on the driver in all and in one task.
SAMPLE_ROWS = 20_000
DEGREE, CANDIDATES, SLACK = 24, 48, 1.2
QUERIES = 256
#: Classes compared with all others, and the part of their links to be found.
AUDIT_ROWS, AUDIT_RECALL = 512, 0.99
#: Large shards whose centres the driver fits; rows of a shard that one task deals.
FEW_SHARDS, PART_ROWS = 64, 4096


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in double precision; null for a vector that links with nothing."""
    for batch in batches:
        units = []
        for value in batch.column("vector"):
            unit = None
            if value.is_valid and len(value.values) and not value.values.null_count:
                v = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all() and v.any():
                    v = v / np.abs(v).max()  # no overflow in the sum of squares
                    unit = v / np.sqrt((v * v).sum())
            units.append(unit)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(units, pa.list_(pa.float64()))], names=["vec_id", "unit"]
        )


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column whose lists are equally long, as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def centres_of(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    rng = np.random.default_rng(11)
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.sqrt((sums * sums).sum(axis=1))
        held = norms > 0
        centres[held] = sums[held] / norms[held, None]
    return centres


def _nearest(units: np.ndarray, centres: np.ndarray, near: int) -> np.ndarray:
    return np.argsort(-(units @ centres.T), axis=1, kind="stable")[:, :near]


def _dealt(table: pa.Table | pa.RecordBatch, index: np.ndarray, shards: list[str], ranks: np.ndarray):
    taken = table.take(pa.array(index))
    return type(table).from_arrays(
        [pa.array(shards, pa.string()), pa.array(ranks, pa.int64()), *(taken.column(c) for c in ("class", "copies", "unit"))],
        names=["shard", "rank", "class", "copies", "unit"],
    )


def _assign(centres, overlap: int):
    """Rows of MEMBER dealt to the nearest of the broadcast centres of their shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("shard").to_pylist(), dtype=object)
            ranks = batch.column("rank").to_numpy()
            index, shards, places = [np.zeros(0, np.int64)], [], [np.zeros(0, np.int64)]
            for shard in set(names.tolist()):
                own = np.flatnonzero(names == shard)
                best = _nearest(_matrix(batch.column("unit").take(pa.array(own))), centres.value[shard], overlap)
                near = best.shape[1]
                index.append(np.repeat(own, near))
                places.append((ranks[own][:, None] * near + np.arange(near)).ravel())
                shards += [f"{shard}.{b}" for b in best.ravel().tolist()]
            yield _dealt(batch, np.concatenate(index), shards, np.concatenate(places))

    return run


def _cut(overlap: int):
    """A part of one shard's rows dealt to the nearest of that shard's centres."""

    def run(own: pa.Table, centres: pa.Table) -> pa.Table:
        units = _matrix(own.column("unit"))
        held = centres.column("centres")[0].values.to_numpy().reshape(-1, units.shape[1])
        best = _nearest(units, held, overlap)
        near = best.shape[1]
        shard = own.column("shard")[0].as_py()
        ranks = (own.column("rank").to_numpy()[:, None] * near + np.arange(near)).ravel()
        return _dealt(
            own, np.repeat(np.arange(len(units)), near), [f"{shard}.{b}" for b in best.ravel().tolist()], ranks
        )

    return run


def _fit(table: pa.Table) -> pa.Table:
    table = table.sort_by("class")
    centres = centres_of(_matrix(table.column("unit")), table.column("wanted")[0].as_py())
    return pa.table(
        {"shard": table.column("shard")[:1], "centres": pa.array([centres.ravel()], pa.list_(pa.float64()))}
    )


MEMBER = "shard string, rank long, class long, copies long, unit array<double>"


def _recut(members: DataFrame, large: DataFrame, shard_rows: int, overlap: int) -> DataFrame:
    """The members of the shards in ``large``, dealt to centres of those shards.

    A few large shards are fitted on the driver, from ``SAMPLE_ROWS`` vectors in all;
    many are fitted by tasks, each from as many of one shard, and their centres are
    joined, so neither grows with the number of shards.
    """
    spark = members.sparkSession
    own = members.join(large, "shard")
    drawn = F.pmod(F.xxhash64("class"), F.lit(1 << 30))
    wanted = F.greatest(F.lit(8), F.ceil(F.col("held") * overlap / shard_rows))
    few = large.limit(FEW_SHARDS + 1).toPandas()
    if len(few) <= FEW_SHARDS:
        samples = (
            own.filter(drawn < int(min(1.0, SAMPLE_ROWS / max(1, few["held"].sum())) * (1 << 30)))
            .select("shard", "class", "unit")
            .toPandas()
            .sort_values(["shard", "class"])
        )
        count = {s: max(8, -(-overlap * n // shard_rows)) for s, n in zip(few["shard"], few["held"].tolist())}
        shrink = min(1.0, MAX_CENTRES / sum(count.values()))
        centres = {
            shard: centres_of(np.stack(rows["unit"]), max(8, int(count[shard] * shrink)))
            for shard, rows in samples.groupby("shard")
        }
        fitted = own.filter(F.col("shard").isin(list(centres))).select(*members.columns)
        dealt = fitted.mapInArrow(_assign(spark.sparkContext.broadcast(centres), overlap), MEMBER)
        unfit = own.filter(~F.col("shard").isin(list(centres)))
    else:
        rate = F.least(F.lit(1.0), F.lit(SAMPLE_ROWS) / F.col("held"))
        centres = stage(
            own.filter(drawn < rate * (1 << 30))
            .select("shard", "class", "unit", F.least(wanted, F.lit(MAX_CENTRES)).cast("int").alias("wanted"))
            .groupBy("shard")
            .applyInArrow(_fit, "shard string, centres array<double>"),
            "centres",
        )
        parts = F.ceil(F.col("held") / PART_ROWS).cast("int")
        part = F.pmod(F.xxhash64("class"), parts).cast("int")
        spread = centres.join(large, "shard").select(
            "shard", "centres", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
        )
        dealt = (
            own.join(centres.select("shard"), "shard", "left_semi")
            .select(*members.columns, part.alias("part"))
            .groupBy("shard", "part")
            .cogroup(spread.groupBy("shard", "part"))
            .applyInArrow(_cut(overlap), MEMBER)
        )
        unfit = own.join(centres.select("shard"), "shard", "left_anti")
    return dealt.unionByName(_at_random(unfit, shard_rows))


def _at_random(own: DataFrame, shard_rows: int) -> DataFrame:
    """Members of large shards dealt by hash; the name tells how many parts there are."""
    parts = F.ceil(F.col("held") / shard_rows).cast("int")
    place = F.pmod(F.xxhash64("class"), parts).cast("int")
    name = F.concat("shard", F.lit("."), place.cast("string"), F.lit("/"), parts.cast("string"))
    return own.select(name.alias("shard"), "rank", "class", "copies", "unit")


def shards(classes: DataFrame, shard_rows: int = SHARD_ROWS, overlap: int = OVERLAP) -> DataFrame:
    """Classes (class, copies, unit) dealt to overlapping shards of bounded size.

    Every shard above twice ``shard_rows`` is cut by centres of its own, level by
    level, until none is; a shard that centres do not at least halve is dealt at
    random.  A class goes to ``overlap`` shards at the first level, to two of each at
    the second and to one after it, so copies are bounded too.  ``rank`` is 0 in the
    nearest shard, a class's home.  Centres are fitted on samples (``SAMPLE_ROWS``);
    every class is dealt.  Vectors of different length never share a shard.
    """
    members = classes.select(
        F.concat(F.lit("d"), F.size("unit")).alias("shard"), F.lit(0).cast("long").alias("rank"), "class", "copies", "unit"
    )
    done, level, before = [], 0, None
    while True:
        members = stage(members, "members")
        sizes = members.groupBy("shard").agg(F.count("*").alias("held"))
        large = stage(
            sizes.filter((F.col("held") > 2 * shard_rows) & ~F.col("shard").contains("/")), "large-shards"
        )
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*done, members])
        done.append(members.join(large, "shard", "left_anti"))
        near = overlap if not level else 2 if level == 1 else 1
        if before is None:
            members = _recut(members, large, shard_rows, near)
        else:
            parent = F.regexp_replace("shard", r"\.[^.]*$", "")
            grown = large.withColumn("parent", parent).join(
                before.select(F.col("shard").alias("parent"), F.col("held").alias("parent_held")), "parent"
            )
            stuck = stage(grown.filter("2 * held > parent_held").select("shard", "held"), "stuck-shards")
            rest = stage(large.join(stuck, "shard", "left_anti"), "large-shards")
            at_random = _at_random(members.join(stuck, "shard"), shard_rows)
            if rest.isEmpty():  # centres have halved none of them
                members = at_random
            else:
                members = at_random.unionByName(_recut(members, rest, shard_rows, near))
        before, level = large, level + 1


def _top(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest values of each row, largest first."""
    k = min(k, sims.shape[1])
    part = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    order = np.argsort(-np.take_along_axis(sims, part, axis=1), axis=1, kind="stable")
    return np.take_along_axis(part, order, axis=1)


def pruned_neighbours(units: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Up to ``degree`` neighbours of each vector, -1 where there are fewer.

    Candidates are the nearest vectors and a few fixed random ones.  Taken nearest
    first, a candidate stays unless a neighbour taken before is nearer to it, by the
    slack factor, than the vector itself (robust pruning).
    """
    n = len(units)
    chosen = np.full((n, degree), -1, dtype=np.int64)
    if n < 2:
        return chosen
    rng = np.random.default_rng(23)
    for first in range(0, n, QUERIES):
        own = np.arange(first, min(n, first + QUERIES))
        sims = units[own] @ units.T
        sims[np.arange(len(own)), own] = -np.inf
        near = _top(sims, min(CANDIDATES, n - 1))
        far = rng.integers(0, n, (len(own), 8))
        ids = np.concatenate([near, far], axis=1)
        reach = np.take_along_axis(sims, ids, axis=1)
        order = np.argsort(-reach, axis=1, kind="stable")
        ids, reach = np.take_along_axis(ids, order, axis=1), np.take_along_axis(reach, order, axis=1)
        vectors = units[ids]
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("pcd,ped->pce", vectors, vectors), 0))
        away = np.sqrt(np.maximum(2 - 2 * reach, 0))
        alive = np.isfinite(reach)
        alive[:, 1:] &= ids[:, 1:] != ids[:, :-1]
        taken = np.zeros(len(own), dtype=np.int64)
        for c in range(ids.shape[1]):
            take = alive[:, c] & (taken < degree)
            rows = np.flatnonzero(take)
            chosen[own[rows], taken[rows]] = ids[rows, c]
            taken[rows] += 1
            hidden = SLACK * between[:, c, :] <= away
            hidden[:, : c + 1] = False
            alive &= ~(hidden & take[:, None])
    return chosen


class Graph:
    """Vectors with their adjacency, walked by blocks of queries: shows that a pruned
    graph is navigable.  The query itself searches by visits."""

    def __init__(self, units: np.ndarray, sources: np.ndarray, targets: np.ndarray):
        self.units, n = units, len(units)
        # Both directions, a node's own choices first; wide nodes are cut at a width.
        both = np.concatenate([sources, targets]), np.concatenate([targets, sources])
        kind = np.repeat([0, 1], len(sources))
        _, first = np.unique(both[0] * n + both[1], return_index=True)
        order = first[np.lexsort((kind[first], both[0][first]))]
        node, other = both[0][order], both[1][order]
        place = np.arange(len(node)) - np.searchsorted(node, node)
        width = int(min(4 * DEGREE, place.max(initial=0) + 1))
        self.near = np.full((n, width), -1, dtype=np.int64)
        fits = place < width
        self.near[node[fits], place[fits]] = other[fits]
        mean = units.mean(axis=0)
        self.medoid = int((units @ mean).argmax())

    def greedy(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes that a walk from the medoid meets, per query."""
        q, n = len(queries), len(self.units)
        targets = self.units[queries]
        ids = np.full((q, beam), -1, dtype=np.int64)
        sims = np.full((q, beam), -np.inf)
        ids[:, 0] = self.medoid
        sims[:, 0] = targets @ self.units[self.medoid]
        opened = np.zeros((q, beam), dtype=bool)
        met = np.zeros((q, n + 1), dtype=bool)  # the last column stands for "no node"
        met[:, -1] = True
        met[:, self.medoid] = True
        rows = np.arange(q)
        while True:
            waiting = np.where(opened | (ids < 0), -np.inf, sims)
            best = waiting.argmax(axis=1)
            active = rows[np.isfinite(waiting[rows, best])]
            if not len(active):
                return ids, sims
            opened[active, best[active]] = True
            around = self.near[ids[active, best[active]]]
            fresh = ~met[active[:, None], around]
            met[active[:, None], around] = True
            at, column = np.nonzero(fresh)
            new = around[at, column]
            found = np.full(around.shape, -np.inf)
            found[at, column] = np.einsum("ij,ij->i", targets[active[at]], self.units[new])
            all_ids = np.concatenate([ids[active], np.where(fresh, around, -1)], axis=1)
            all_sims = np.concatenate([sims[active], found], axis=1)
            all_open = np.concatenate([opened[active], np.zeros(around.shape, bool)], axis=1)
            keep = _top(all_sims, beam)
            ids[active] = np.take_along_axis(all_ids, keep, axis=1)
            sims[active] = np.take_along_axis(all_sims, keep, axis=1)
            opened[active] = np.take_along_axis(all_open, keep, axis=1)


def _build(cosine: float):
    """The neighbours of each class that can lead on: if x is in range of a query and
    its neighbour too, the two are within twice the range of each other."""
    reach = np.cos(min(2 * np.arccos(np.clip(cosine, -1, 1)), np.pi)) - 1e-9

    def run(table: pa.Table) -> pa.Table:
        units = _matrix(table.column("unit"))
        classes = table.column("class").to_numpy()
        near = pruned_neighbours(units)
        row, column = np.nonzero(near >= 0)
        other = near[row, column]
        close = np.concatenate(
            [
                np.einsum("ij,ij->i", units[row[at : at + 20_000]], units[other[at : at + 20_000]]) >= reach
                for at in range(0, len(row), 20_000)
            ]
            or [np.zeros(0, bool)]
        )
        return pa.table({"class": pa.array(classes[row[close]]), "other": pa.array(classes[other[close]])})

    return run


def _places(classes: DataFrame, members: DataFrame, cosine: float) -> DataFrame:
    """Per class its home, the shards it starts from and those it leads on to."""
    dealt = stage(
        members.groupBy("class")
        .agg(F.min_by("shard", "rank").alias("home"), F.collect_set("shard").alias("own"))
        .select("class", "home", "own"),
        "dealt",
    )
    edges = stage(members.groupBy("shard").applyInArrow(_build(cosine), "class long, other long"), "adjacency")
    both = edges.unionByName(edges.select(F.col("other").alias("class"), F.col("class").alias("other")))
    around = (
        both.join(dealt.select(F.col("class").alias("other"), F.col("home").alias("shard")), "other")
        .groupBy("class")
        .agg(F.collect_set("shard").alias("around"))
    )
    # Every part of a shard that was dealt at random: "base.i/parts".
    name = lambda s: F.regexp_replace(s, r"\d+/\d+$", "")
    count = lambda s: F.regexp_extract(s, r"/(\d+)$", 1)
    parts = lambda s: F.transform(
        F.sequence(F.lit(0), count(s).cast("int") - 1), lambda i: F.concat(name(s), i.cast("string"), F.lit("/"), count(s))
    )
    starts = F.array_distinct(
        F.flatten(F.transform("own", lambda s: F.when(s.contains("/"), parts(s)).otherwise(F.array(s))))
    )
    return stage(
        classes.select("class", "copies", "unit")
        .join(dealt, "class")
        .join(around, "class", "left")
        .select("class", "copies", "unit", "home", starts.alias("starts"), "around")
        .withColumn("routes", F.array_union("starts", F.coalesce("around", F.array().cast("array<string>"))))
        .drop("around"),
        "places",
    )


VISIT = "class long, links long, root long, next array<string>"


def _visit(cosine: float):
    """Part of the queries that visit one home, compared with all its members.

    One row per query, with its links here, the smallest class of its component here
    and the shards to visit next that it has not; and one per member that was linked
    with, which is sent to the homes of those that found it.
    """

    def run(home: pa.Table, queries: pa.Table) -> pa.Table:
        if not home.num_rows or not queries.num_rows:
            return pa.table({"class": [], "links": [], "root": [], "next": []}, _arrow_visit())
        units, asked = _matrix(home.column("unit")), _matrix(queries.column("unit"))
        classes, asking = home.column("class").to_numpy(), queries.column("class").to_numpy()
        copies = home.column("copies").to_numpy()
        n = len(asking)
        linked = np.zeros((n, len(classes)), dtype=bool)
        for at in range(0, n, QUERIES):
            linked[at : at + QUERIES] = asked[at : at + QUERIES] @ units.T >= cosine
        linked &= asking[:, None] != classes[None, :]
        links = np.array([copies[row].sum() for row in linked], dtype=np.int64)
        low_q, low_x = _lowest_linked(linked, asking, classes)

        routes = [frozenset(r) for r in home.column("routes").to_pylist()]
        starts = [set(s) for s in home.column("starts").to_pylist()]
        known = [set(k) for k in queries.column("known").to_pylist()]
        homes = np.array(queries.column("home").to_pylist(), dtype=object)
        kinds = {r: i for i, r in enumerate(dict.fromkeys(routes))}  # many members share their routes
        kind, sets = np.array([kinds[r] for r in routes]), list(kinds)
        onward = [
            sorted(frozenset().union(*(sets[k] for k in np.unique(kind[row]))) - seen) if row.any() else []
            for row, seen in zip(linked, known)
        ]
        met = np.flatnonzero(linked.any(axis=0))
        back = [sorted(set(homes[linked[:, x]].tolist()) - starts[x]) for x in met]
        return pa.table(
            {
                "class": np.concatenate([asking, classes[met]]),
                "links": np.concatenate([links, np.zeros(len(met), np.int64)]),
                "root": np.concatenate([low_q, low_x[met]]),
                "next": pa.array(onward + back, pa.list_(pa.string())),
            },
            _arrow_visit(),
        )

    return run


def _arrow_visit() -> pa.Schema:
    return pa.schema(
        [("class", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("next", pa.list_(pa.string()))]
    )


def _lowest_linked(linked: np.ndarray, asking: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest class in the component of each query and of each member."""
    low_q, low_x = asking.copy(), classes.copy()
    row, column = linked.any(axis=1).nonzero()[0], linked.any(axis=0).nonzero()[0]
    within = linked[np.ix_(row, column)]
    q, x, far = low_q[row], low_x[column], np.iinfo(np.int64).max
    while len(row):
        before = q.copy(), x.copy()
        for at in range(0, len(row), QUERIES):
            here = within[at : at + QUERIES]
            q[at : at + QUERIES] = np.minimum(q[at : at + QUERIES], np.where(here, x, far).min(axis=1))
            x = np.minimum(x, np.where(here, q[at : at + QUERIES, None], far).min(axis=0))
        if (before[0] == q).all() and (before[1] == x).all():
            break
    low_q[row], low_x[column] = q, x
    return low_q, low_x


def _round(places: DataFrame, fresh: DataFrame, seen: DataFrame, cosine: float) -> DataFrame:
    """The visits ``fresh`` (class, shard), a home's visitors in parts of about
    ``PART_ROWS`` with a copy of its members each."""
    held = stage(
        fresh.groupBy("shard").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts")), "visited"
    )
    known = seen.groupBy("class").agg(F.collect_set("shard").alias("known"))
    askers = stage(
        fresh.select("class").distinct().join(known, "class").join(places.select("class", "unit", "home"), "class"),
        "askers",
    )
    queries = fresh.join(held, "shard").join(askers, "class").select(
        "shard", F.pmod(F.xxhash64("class"), "parts").cast("int").alias("part"), "class", "unit", "home", "known"
    )
    homes = places.join(held, places["home"] == held["shard"]).select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        "class", "copies", "unit", "starts", "routes",
    )
    return stage(
        homes.groupBy("shard", "part").cogroup(queries.groupBy("shard", "part")).applyInArrow(_visit(cosine), VISIT),
        "found",
    )


def _search(places: DataFrame, cosine: float) -> DataFrame:
    """Rows (class, links, root) of all visits."""
    seen = stage(places.select("class", F.explode("starts").alias("shard")), "visits")
    truth = stage(_audit(places, cosine), "audit")
    homes = stage(places.groupBy("home").agg(F.count("*").alias("held")), "homes").count()
    fresh, found, reach = seen, [], OVERLAP
    while True:
        while not fresh.isEmpty():
            found.append(_round(places, fresh, seen, cosine))
            fresh = stage(
                found[-1].select("class", F.explode("next").alias("shard")).distinct()
                .join(seen, ["class", "shard"], "left_anti"),
                "visits",
            )
            seen = seen.unionByName(fresh)
        answers = reduce(DataFrame.unionByName, found).drop("next") if found else None
        if answers is None or reach >= homes:
            return answers
        links = answers.groupBy("class").agg(F.sum("links").alias("links"))
        both = truth.join(links, "class").agg(F.sum("links").alias("got"), F.sum("true").alias("true")).first()
        if (both.got or 0) >= AUDIT_RECALL * (both.true or 0):
            return answers
        reach = min(2 * reach, homes)
        fresh = stage(_nearest_homes(places, reach).join(seen, ["class", "shard"], "left_anti"), "visits")
        seen = seen.unionByName(fresh)


def _audit(places: DataFrame, cosine: float) -> DataFrame:
    """The true count of links of the ``AUDIT_ROWS`` classes whose hash is smallest,
    each compared with all classes."""
    chosen = places.select("class", "unit").orderBy(F.xxhash64("class"), "class").limit(AUDIT_ROWS).toPandas()
    asked = {
        size: (own["class"].to_numpy(), np.stack(own["unit"])) for size, own in chosen.groupby(chosen["unit"].map(len))
    }
    shared = places.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("unit").offsets.to_numpy())
            for size, (ids, asked) in shared.value.items():
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                true = np.zeros(len(ids), np.int64)
                if own.num_rows:
                    linked = (asked @ _matrix(own.column("unit")).T >= cosine) & (
                        ids[:, None] != own.column("class").to_numpy()
                    )
                    true = (linked * own.column("copies").to_numpy()).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(true)], names=["class", "true"])

    counted = places.select("class", "copies", "unit").mapInArrow(run, "class long, true long")
    return counted.groupBy("class").agg(F.sum("true").alias("true"))


def _nearest_homes(places: DataFrame, reach: int) -> DataFrame:
    """Visits of every class to the ``reach`` homes whose mean is nearest to it.  The
    means go out about ``MAX_CENTRES`` at a time; homes of other lengths are not visited."""
    dims = F.posexplode("unit").alias("at", "value")
    means = stage(
        places.select("home", dims).groupBy("home", "at").agg(F.avg("value").alias("value"))
        .groupBy("home").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("m"))
        .select("home", F.col("m.value").alias("mean")),
        "means",
    )
    near, pieces = [], -(-means.count() // MAX_CENTRES)
    for piece in range(pieces):
        some = means.filter(F.pmod(F.xxhash64("home"), F.lit(pieces)) == piece).toPandas()
        sizes = some["mean"].map(len)
        held = {k: (own["home"].tolist(), np.stack(own["mean"])) for k, own in some.groupby(sizes)}
        shared = places.sparkSession.sparkContext.broadcast(held)
        ranked = _rank_homes(shared, reach)
        near.append(places.select("class", "unit").mapInArrow(ranked, "class long, shard string, cosine double"))
    order = Window.partitionBy("class").orderBy(F.desc("cosine"), "shard")
    ranked = reduce(DataFrame.unionByName, near).withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= reach).select("class", "shard")


def _rank_homes(shared, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("unit").offsets.to_numpy())
            for size, (names, means) in shared.value.items():
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                for at in range(0, own.num_rows, QUERIES):
                    some = own.slice(at, QUERIES)
                    sims = _matrix(some.column("unit")) @ means.T
                    best = _top(sims, reach)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(some.column("class").to_numpy(), best.shape[1])),
                            pa.array([names[b] for b in best.ravel()], pa.string()),
                            pa.array(np.take_along_axis(sims, best, axis=1).ravel()),
                        ],
                        names=["class", "shard", "cosine"],
                    )

    return run


def near_copies(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    shard_rows: int = SHARD_ROWS,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest vec_id reachable by links and ``kept`` marks that row.  A vector that
    is null, empty, zero, or holds null or non-finite components links with nothing,
    and vectors of different length do not link.  Every row is a vector of its own:
    repeated rows link with each other.  A null vec_id is no candidate for
    ``component_id``; a component without any id has null, and its rows are kept.
    """
    rows = stage(
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
        .mapInArrow(_units, "vec_id long, unit array<double>")
        .withColumns({"key_a": F.xxhash64("unit"), "key_b": F.xxhash64(F.lit(1), "unit")}),
        "units",
    )
    same = ["key_a", "key_b"]
    valid = rows.filter("unit is not null")
    classes = stage(
        valid.groupBy(*same)
        .agg(F.min("vec_id").alias("label"), F.count("*").alias("copies"), F.any_value("unit").alias("unit"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    places = _places(classes, shards(classes, shard_rows, overlap), cosine)
    found = _search(places, cosine)
    if found is None:
        found = classes.select("class", F.lit(0).cast("long").alias("links"), F.col("class").alias("root"))
    roots = connected(found, "class", "root").withColumnRenamed("node", "class")
    links = stage(found.groupBy("class").agg(F.sum("links").alias("links")), "links")
    placed = stage(
        classes.drop("unit").join(links, "class").join(roots, "class", "left")
        .withColumn("root", F.coalesce("root", "class")),
        "placed",
    )
    lowest = stage(placed.groupBy("root").agg(F.min("label").alias("component_id")), "lowest")
    answers = stage(
        placed.join(lowest, "root").select(
            *same, (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
        ),
        "answers",
    )
    linked = valid.join(answers, same).select("vec_id", "n_links", "component_id")
    alone = rows.filter("unit is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
