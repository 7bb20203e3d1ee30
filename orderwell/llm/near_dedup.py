"""Near-duplicate documents: one-permutation MinHash, bands, stars, exact check.

Every shingle is hashed once.  The top bits of the hash choose one of 256 bins, and
a bin keeps its smallest hash; an empty bin borrows from a bin that is not, chosen
by a fixed sequence of pseudo-random probes that is the same for all documents
(optimal densification), so two documents agree in any bin with a probability equal
to their similarity.  Bands are as many bins wide as two documents at the threshold
miss every band with a probability under one in a million: seven and 36 bands at 0.85,
five and 51 at 0.80 (``Threshold``).

Documents with the same set of shingles are one class, and only classes are
compared.  Within a bucket each class is paired with the smallest class alone (a
star), which bounds pairs by rows.  Where a bucket then still holds several
components, members outside the largest one become centres in turn, a growing number
each round, and meet the members of other components only, until no pair that shares
a bucket is open.  Members and centres meet in blocks of bounded size that carry the
whole sets of all but long documents, so links are confirmed there, and a block tells
of no more than what joins its components; pairs with a long document become rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderwell.llm.components import connected
from orderwell.llm.keys import only_ids, send_if_small
from orderwell.llm.text import as_arrays, blocks, mix, shingle_sets
from orderwell.sources.tables import stage

BINS, MISSED = 256, 1e-6
PERCENT = 85
STAR_ROWS = 50
#: Further centres of a bucket in the first round after the star, and how many times
#: as many in each round after it; members of a bucket that one task compares with them.
FIRST_CENTRES, MORE_CENTRES = 512, 8
PART_ROWS = 1000
#: Centres that one task compares with a part's members at a time.
BLOCK_CENTRES = 512
#: Shingles of a set that is carried whole: as many as take the room of a sketch.
WHOLE_SET = 256
#: Different shingles of a block looked at together.
BLOCK_SHINGLES = 4096
#: One byte for each of 2048 bin minima foretells a similarity; pairs that agree in
#: fewer than a pair at the threshold by so many standard deviations are compared no
#: further.
SKETCH_BINS, SKETCH_DEVIATIONS = 2048, 8.45


@dataclass(frozen=True)
class Threshold:
    """A link's least similarity in percent, and what finding all links takes."""

    percent: int = PERCENT

    def __post_init__(self):
        if not 0 < self.percent <= 100:
            raise ValueError(f"a similarity of {self.percent} percent")

    @property
    def band_bins(self) -> int:
        """The widest band that misses few enough pairs; one bin where none does."""
        missed = lambda width: (1 - (self.percent / 100) ** width) ** (BINS // width)
        return max((w for w in range(1, 17) if missed(w) < MISSED), default=1)

    @property
    def bands(self) -> int:
        return BINS // self.band_bins

    @property
    def sketch_agree(self) -> int:
        """Bins of two sketches that agree at least; bytes agree by chance as well."""
        p = self.percent / 100 + (1 - self.percent / 100) / 256
        return int(np.ceil(SKETCH_BINS * p - SKETCH_DEVIATIONS * np.sqrt(SKETCH_BINS * p * (1 - p))))


DEFAULT = Threshold()
BANDS, BAND_BINS, SKETCH_AGREE = DEFAULT.bands, DEFAULT.band_bins, DEFAULT.sketch_agree

SKETCH = "n_shingles long, set_a long, set_b long, bands array<long>"


def _densify(bins: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Each empty bin asks bins in a hashed order of its own, twice as many each
    time, until one is filled; the order depends on nothing but the bin."""
    empty, asked, step = np.flatnonzero(~filled), 0, 1
    while len(empty):
        order = (empty.astype(np.uint64)[:, None] << np.uint64(32)) + np.arange(asked, asked + step, dtype=np.uint64)
        donors = (mix(order) & np.uint64(len(bins) - 1)).astype(np.int64)
        hit = filled[donors]
        found = hit.any(axis=1)
        bins[empty[found]] = bins[donors[found, hit[found].argmax(axis=1)]]
        empty, asked, step = empty[~found], asked + step, min(2 * step, 512)
    return bins


def signature(shingles: np.ndarray, n_bins: int = BINS) -> np.ndarray:
    """Bin minima of a sorted, non-empty set of hashes, empty bins filled."""
    where = (shingles >> np.uint64(65 - n_bins.bit_length())).astype(np.int64)
    first = np.flatnonzero(np.diff(where, prepend=-1))
    bins, filled = np.zeros(n_bins, np.uint64), np.zeros(n_bins, bool)
    bins[where[first]] = shingles[first]
    filled[where[first]] = True
    return _densify(bins, filled)


@cache
def _band_seeds(bands: int, width: int) -> np.ndarray:
    return np.random.default_rng(5).integers(1, 2**63, (bands, width), dtype=np.uint64) | np.uint64(1)


def band_keys(signatures: np.ndarray, limit: Threshold = DEFAULT) -> np.ndarray:
    """A bucket key per band for each row of bin minima; the band number is part of a key."""
    shape, seeds = (limit.bands, limit.band_bins), _band_seeds(limit.bands, limit.band_bins)
    used = signatures[:, : shape[0] * shape[1]].reshape(-1, *shape)
    keys = (mix(used) * seeds).sum(axis=2, dtype=np.uint64)
    return mix(keys + np.arange(shape[0], dtype=np.uint64)).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch], limit: Threshold) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        sets = shingle_sets(*as_arrays(batch.column("text")))
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        marks = np.zeros((2, len(sets)), dtype=np.uint64)
        own = [c for c in batch.schema.names if c != "text"]
        signed = [signature(s) for s in sets if len(s)]
        keys = band_keys(np.array(signed), limit).ravel() if signed else np.zeros(0, np.int64)
        for i, s in enumerate(sets):
            marks[0, i] = s.sum(dtype=np.uint64)
            marks[1, i] = mix(s + np.uint64(1)).sum(dtype=np.uint64)
        ends = np.concatenate([[0], np.cumsum(limit.bands * (sizes > 0))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in own),
                pa.array(sizes),
                pa.array(marks[0].view(np.int64)),
                pa.array(marks[1].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(keys)),
            ],
            names=[*own, "n_shingles", "set_a", "set_b", "bands"],
        )


def _compare(batches: Iterator[pa.RecordBatch], limit: Threshold) -> Iterator[pa.RecordBatch]:
    """Rows sorted by star: the centre's texts, then those it is compared with."""
    star, centres = None, []
    for batch in blocks(batches, "text"):
        sets = shingle_sets(*as_arrays(batch.column("text")))
        hubs, parts, ids, member = (batch.column(c).to_pylist() for c in ("hub", "part", "label", "member"))
        found = []
        for hub, part, label, is_member, shingles in zip(hubs, parts, ids, member, sets):
            if (hub, part) != star:
                star, centres = (hub, part), []
            if not is_member:
                centres.append(shingles)
                continue
            for centre in centres:
                if _similar(centre, shingles, limit.percent):
                    found.append((hub, label))
                    break
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b):
        return False
    if len(a) < len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(pairs: DataFrame, docs: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs (hub, label) whose full shingle sets are similar enough.

    A centre's partners are dealt out in parts of about ``STAR_ROWS``, each with a
    copy of the centre's text, so a centre with a third of all rows is spread over
    the cluster and a task holds one centre at a time.
    """
    ends = stage(
        pairs.select(F.col("hub").alias("doc_id"))
        .distinct()
        .unionByName(pairs.select(F.col("label").alias("doc_id")).distinct())
        .distinct(),
        "pair-ends",
    )
    texts = only_ids(docs, ends)
    sizes = stage(
        pairs.groupBy("hub").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("parts")), "stars"
    )
    members = (
        pairs.join(sizes, "hub")
        .select(
            "hub",
            F.pmod(F.xxhash64("label"), "parts").cast("int").alias("part"),
            "label",
            F.lit(True).alias("member"),
        )
        .join(texts.withColumnRenamed("doc_id", "label"), "label")
    )
    centres = sizes.join(texts.withColumnRenamed("doc_id", "hub"), "hub").select(
        F.col("hub").alias("label"),
        "hub",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(False).alias("member"),
        "text",
    )
    return (
        members.unionByName(centres)
        .repartition("hub", "part")
        .sortWithinPartitions("hub", "part", "member")
        .mapInArrow(partial(_compare, limit=limit), "a long, b long")
    )


def _pairs(rows: DataFrame, limit: Threshold) -> DataFrame:
    """Two classes of a row, once each; sizes that rule a link out need no reading."""
    small, large = F.least("n", "hub_n"), F.greatest("n", "hub_n")
    return (
        rows.filter((F.col("label") != F.col("hub")) & (small * 100 >= large * limit.percent))
        .select(F.least("hub", "label").alias("hub"), F.greatest("hub", "label").alias("label"))
        .distinct()
    )


def _next_round(
    slots: DataFrame, roots: DataFrame, docs: DataFrame, centres_each: int, limit: Threshold
) -> tuple[DataFrame, DataFrame] | None:
    """What buckets that hold several components tell of (see ``_met``), and the slots
    of those buckets without the centres used up; None if there are none.

    Centres are the first members outside a bucket's largest component: once each of
    them has met every member of another component, no pair of the bucket is open.
    """
    placed = stage(
        slots.join(roots.withColumnRenamed("node", "label"), "label", "left").select(
            "key", "label", "n", F.coalesce("root", "label").alias("root")
        ),
        "slots-placed",
    )
    apart = stage(
        placed.groupBy("key", "root")
        .agg(F.count("*").alias("held"))
        .groupBy("key")
        .agg(F.max(F.struct("held", "root")).alias("top"), F.sum("held").alias("held"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(
            "key",
            F.col("top.root").alias("main"),
            F.ceil(F.col("held") / PART_ROWS).cast("int").alias("parts"),
            F.ceil(F.least(F.col("held") - F.col("top.held"), F.lit(centres_each)) / BLOCK_CENTRES)
            .cast("int")
            .alias("blocks"),
        ),
        "buckets-apart",
    )
    held = stage(placed.join(apart, "key"), "slots-apart")
    if held.isEmpty():
        return None
    first = F.row_number().over(Window.partitionBy("key").orderBy("label"))
    centres = stage(
        held.filter("root <> main")
        .withColumn("place", first)
        .filter(F.col("place") <= centres_each)
        .select("key", "label", F.floor((F.col("place") - 1) / BLOCK_CENTRES).cast("int").alias("block")),
        "centres",
    )
    left = held.select("key", "label", "n").join(centres, ["key", "label"], "left_anti")
    return _met(held, centres, docs, limit), stage(left, "slots-left")


def _met(held: DataFrame, centres: DataFrame, docs: DataFrame, limit: Threshold) -> DataFrame:
    """What comes of centres meeting the members of other components: ``hub`` and
    ``label``, joined by confirmed links where ``sure``, else a pair to be confirmed.

    A bucket's members are dealt out in parts of about ``PART_ROWS``, its centres in
    blocks of ``BLOCK_CENTRES``, and a task compares one part with one block.
    """
    ends = stage(held.select(F.col("label").alias("doc_id")).distinct(), "members")
    sketches = stage(
        only_ids(docs, ends)
        .mapInArrow(partial(_small_sketch, limit=limit), "label long, whole binary, sketch binary, homes binary")
        .filter("whole is not null or sketch is not null"),
        "small-sketches",
    )
    parts = F.sequence(F.lit(0), F.col("parts") - 1)
    blocks_ = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.pmod(F.xxhash64("label"), "parts").cast("int")
    place = lambda part, block, centre: F.struct(part.alias("part"), block.alias("block"), F.lit(centre).alias("centre"))
    as_member = F.transform(blocks_, lambda b: place(F.col("own"), b, False))
    as_centre = F.transform(parts, lambda p: place(p, F.col("centre_block"), True))
    # A member is in a bucket per band at most: they meet its sketch as one row.
    members = (
        held.join(centres.withColumnRenamed("block", "centre_block"), ["key", "label"], "left")
        .withColumn("slot", F.struct("key", "parts", "blocks", "centre_block"))
        .groupBy("label")
        .agg(F.any_value("n").alias("n"), F.any_value("root").alias("root"), F.collect_list("slot").alias("slots"))
    )
    return (
        members.join(sketches, "label")
        .select("label", "n", "root", "whole", "sketch", "homes", F.inline("slots"))
        .withColumn("own", own)
        .withColumn(
            "at", F.explode(F.when(F.col("centre_block").isNull(), as_member).otherwise(F.concat(as_member, as_centre)))
        )
        .select("key", "at.part", "at.block", "at.centre", "label", "n", "root", "whole", "sketch", "homes")
        .repartition("key", "part", "block")
        .sortWithinPartitions("key", "part", "block", F.desc("centre"), "label")
        .mapInArrow(partial(_meetings, limit=limit), "hub long, label long, sure boolean")
        .distinct()
    )


def _small_sketch(batches: Iterator[pa.RecordBatch], limit: Threshold) -> Iterator[pa.RecordBatch]:
    """Per document its whole set, unless that is long; for long ones, and those that
    may be linked with one, a byte for each bin of a finer signature and bucket keys."""
    for batch in blocks(batches, "text"):
        sets = shingle_sets(*as_arrays(batch.column("text")))
        may_meet_long = [100 * len(s) >= limit.percent * (WHOLE_SET + 1) for s in sets]
        whole = [s.tobytes() if 0 < len(s) <= WHOLE_SET else None for s in sets]
        small = [
            signature(s, SKETCH_BINS).astype(np.uint8).tobytes() if may else None for s, may in zip(sets, may_meet_long)
        ]
        homes = [band_keys(signature(s)[None], limit).tobytes() if may else None for s, may in zip(sets, may_meet_long)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.binary()) for x in (whole, small, homes))],
            names=["label", "whole", "sketch", "homes"],
        )


class _Side:
    """Rows of one side of a block: numbers as arrays, sets and sketches as lists."""

    def __init__(self):
        self.label, self.n, self.root = (np.zeros(0, np.int64) for _ in range(3))
        self.whole, self.sketch, self.homes = [], [], []

    def add(self, columns: dict, a: int, b: int) -> None:
        for name in ("label", "n", "root"):
            setattr(self, name, np.concatenate([getattr(self, name), columns[name][a:b]]))
        for name in ("whole", "sketch", "homes"):
            getattr(self, name).extend(columns[name][a:b])

    def having(self, name: str) -> np.ndarray:
        return np.array([i for i, x in enumerate(getattr(self, name)) if x is not None], np.int64)


def _meetings(batches: Iterator[pa.RecordBatch], limit: Threshold) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, part and block, centres first: each run of members meets the
    centres of its block."""
    current, centres = None, None
    for batch in batches:
        columns = {
            c: batch.column(c).to_numpy(zero_copy_only=False)
            for c in ("key", "part", "block", "centre", "label", "n", "root")
        }
        columns |= {c: batch.column(c).to_pylist() for c in ("whole", "sketch", "homes")}
        places = np.stack([columns[c] for c in ("key", "part", "block")])
        bounds = [0, *(np.flatnonzero((np.diff(places) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        found = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b:
                continue
            here = tuple(places[:, a].tolist())
            if here != current:
                current, centres = here, _Side()
            last = a + int(columns["centre"][a:b].astype(bool).sum())
            centres.add(columns, a, last)
            members = _Side()
            members.add(columns, last, b)
            if len(members.label) and len(centres.label):
                found.append(_joined(members, centres, limit))
                found.append(_foretold(members, centres, limit, here[0]))
        pairs = np.unique(np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1), axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pairs[0]), pa.array(pairs[1]), pa.array(pairs[2].astype(bool))], names=["hub", "label", "sure"]
        )


def _joined(members: _Side, centres: _Side, limit: Threshold) -> np.ndarray:
    """Roots that links between whole sets join, each with the smallest one joined to
    it in this block: no more rows than the block has components."""
    m, c = members.having("whole"), centres.having("whole")
    if not len(m) or not len(c):
        return np.zeros((3, 0), np.int64)
    both = _common(*([np.frombuffer(side.whole[i], np.uint64) for i in at] for side, at in ((members, m), (centres, c))))
    n = members.n[m][:, None] + centres.n[c][None, :]
    root_m, root_c = members.root[m], centres.root[c]
    linked = (100 * both >= limit.percent * (n - both)) & (root_m[:, None] != root_c[None, :])
    roots, at = np.unique(np.concatenate([root_m, root_c]), return_inverse=True)
    lowest, far = np.arange(len(roots)), len(roots)
    while True:  # the smallest root that can be reached, a link further each time
        before = lowest.copy()
        np.minimum.at(lowest, at[: len(m)], np.where(linked, lowest[at[len(m) :]][None, :], far).min(axis=1))
        np.minimum.at(lowest, at[len(m) :], np.where(linked, lowest[at[: len(m)]][:, None], far).min(axis=0))
        if (lowest == before).all():
            break
    moved = np.flatnonzero(lowest != np.arange(len(roots)))
    return np.stack([roots[lowest[moved]], roots[moved], np.ones(len(moved), np.int64)])


def _common(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of the one list shares with each of the other, as
    products of incidence matrices over the elements that occur on both sides."""
    flat = [np.concatenate(sets) for sets in (one, other)]
    owner = [np.repeat(np.arange(len(sets)), [len(s) for s in sets]) for sets in (one, other)]
    shared = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    both = np.zeros((len(one), len(other)), np.float32)
    if not len(shared):
        return both.astype(np.int64)
    at = [np.minimum(np.searchsorted(shared, f), len(shared) - 1) for f in flat]
    kept = [shared[a] == f for a, f in zip(at, flat)]
    at, owner = [a[k] for a, k in zip(at, kept)], [o[k] for o, k in zip(owner, kept)]
    for first in range(0, len(shared), BLOCK_SHINGLES):
        sides = []
        for places, own, n in zip(at, owner, both.shape):
            here = (places >= first) & (places < first + BLOCK_SHINGLES)
            side = np.zeros((n, min(BLOCK_SHINGLES, len(shared) - first)), np.float32)
            side[own[here], places[here] - first] = 1
            sides.append(side)
        both += sides[0] @ sides[1].T
    return both.astype(np.int64)


def _foretold(members: _Side, centres: _Side, limit: Threshold, key: int) -> np.ndarray:
    """Pairs with a long document whose sketches agree, to be confirmed on full sets.
    A pair that shares several buckets is told of in the first of them only."""
    found = [np.zeros((3, 0), np.int64)]
    at = centres.having("sketch")
    if not len(at):
        return found[0]
    hubs, hub_n, hub_root = centres.label[at], centres.n[at], centres.root[at]
    hub_sketches = np.frombuffer(b"".join(centres.sketch[i] for i in at), np.uint8).reshape(-1, SKETCH_BINS)
    hub_homes = np.frombuffer(b"".join(centres.homes[i] for i in at), np.int64).reshape(-1, limit.bands)
    hub_long = np.array([centres.whole[i] is None for i in at])
    for i in members.having("sketch").tolist():
        n, homes = members.n[i], np.frombuffer(members.homes[i], np.int64)
        may = (hub_root != members.root[i]) & (100 * np.minimum(hub_n, n) >= limit.percent * np.maximum(hub_n, n))
        may = np.flatnonzero(may & (hub_long | (members.whole[i] is None)))
        agree = (hub_sketches[may] == np.frombuffer(members.sketch[i], np.uint8)).sum(axis=1)
        may = may[agree >= limit.sketch_agree]
        if len(may):
            may = may[homes[(hub_homes[may] == homes).argmax(axis=1)] == key]
            ends = np.minimum(hubs[may], members.label[i]), np.maximum(hubs[may], members.label[i])
            found.append(np.stack([*ends, np.zeros(len(may), np.int64)]))
    return np.concatenate(found, axis=1)


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links of similarity
    ``percent`` in a hundred or more between distinct five-word shingles; ``kept`` marks that document.
    A text that is null or has no word has no shingles and is linked with nothing.
    Rows with the same doc_id are one document for linking, and repeated rows share
    their answer.  A row without a doc_id takes the component of documents with
    the same shingles; where there are none its component is null and it is kept.
    """
    return _decided(docs, id_col, text_col, percent, [])


#: Tells rows with the same doc_id, or with none, apart by their text.
TEXT_KEY = ["text_a", "text_b"]


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def _decided(docs: DataFrame, id_col: str, text_col: str, percent: int, keys: list[str]) -> DataFrame:
    """The rows of ``components``, with the key of their text if its names are given."""
    limit = Threshold(percent)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = docs.select("*", *[c.alias(n) for n, c in zip(keys, _text_key(F.col("text")))])
    schema = ", ".join([f"{c} long" for c in ("doc_id", *keys)] + [SKETCH])
    sketches = stage(keyed.mapInArrow(partial(_sketch, limit=limit), schema), "sketches")
    same = ["set_a", "set_b", "n_shingles"]
    classes = stage(
        sketches.filter("n_shingles > 0")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("label"), F.any_value("bands").alias("bands")),
        "classes",
    )
    slots = classes.filter("label is not null").select(
        "label", F.col("n_shingles").alias("n"), F.explode("bands").alias("key")
    )
    shared = stage(
        slots.groupBy("key")
        .agg(F.min(F.struct("label", "n")).alias("c"), F.max("label").alias("hi"))
        .filter("c.label < hi")
        .select("key", F.col("c.label").alias("hub"), F.col("c.n").alias("hub_n")),
        "shared-buckets",
    )
    open_slots = stage(slots.join(shared, "key"), "slots")
    tested = stage(_pairs(open_slots, limit), "pairs")
    links = [stage(_confirm(tested, docs, limit), "confirmed")]
    roots = connected(links[0])
    centres_each = FIRST_CENTRES
    while found := _next_round(open_slots.select("key", "label", "n"), roots, docs, centres_each, limit):
        met, open_slots = found
        met = stage(met, "met")
        centres_each *= MORE_CENTRES
        sure = stage(met.filter("sure").select(F.col("hub").alias("a"), F.col("label").alias("b")), "confirmed")
        pairs = stage(
            met.filter("not sure").select("hub", "label").join(tested, ["hub", "label"], "left_anti"), "pairs"
        )
        fresh = [sure]
        if not pairs.isEmpty():
            tested = tested.unionByName(pairs)
            fresh.append(stage(_confirm(pairs, docs, limit), "confirmed"))
        fresh = [found for found in fresh if not found.isEmpty()]
        if fresh:
            links += fresh
            roots = connected(reduce(DataFrame.unionByName, links))
    answers = stage(
        classes.select(*same, "label")
        .join(roots.withColumnRenamed("node", "label"), "label", "left")
        .select(*same, F.coalesce("root", "label").alias("component")),
        "answers",
    )
    alone = sketches.filter("n_shingles = 0").select(
        "doc_id", *keys, "n_shingles", F.col("doc_id").alias("component_id")
    )
    linked = (
        sketches.filter("n_shingles > 0")
        .join(answers, same)
        .select("doc_id", *keys, "n_shingles", F.col("component").alias("component_id"))
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``components`` keeps.

    Rows are told apart by doc_id and text: one without a doc_id goes if a document has
    its shingles, and of a doc_id's several texts only those go that are not kept.
    """
    found = _decided(docs, id_col, text_col, percent, TEXT_KEY)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone_id"), *TEXT_KEY).distinct()
    gone = send_if_small(stage(gone.withColumnsRenamed({c: f"_gone_{c}" for c in TEXT_KEY}), "near-copies"))
    same = docs[id_col].cast("long").eqNullSafe(gone["_gone_id"])
    for name, key in zip(TEXT_KEY, _text_key(docs[text_col])):
        same &= key == gone[f"_gone_{name}"]
    return docs.join(gone, same, "left_anti")
