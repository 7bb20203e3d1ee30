"""A trie of the beginnings that conversations share, by vertical bitmaps.

Conversations are packed into shards of consecutive ids; texts stay behind, a turn
travels as 16 bytes of hash and the length of its text.  A shard indexes each
(position, turn) to the set of its conversations that have it, a bitmap held as one
integer, and walks depth first: the members of a node, intersected with the posting
of the lowest one's next turn, are a child; popcounts are sizes, and those that end
at a node are its end list.

What a node is in all shards together is settled between two walks.  The first tells
Spark of every node of a shard; nodes known in several shards get their smallest
member, and whether any conversation goes on below, and hand both back.  A node is
*owned* by the shard of its smallest member, and all other figures are then sums:
children and leaves count where they are owned, and a node saves its text once for
every member but the owner.  A node with a third of all conversations is a row per
shard, never a group of conversations.

Bounds: a shard takes whole conversations until it has ``SHARD_TURNS`` turns, so one
task holds at most that many and one conversation, 24 bytes a turn.  The digest of an
end list is sequential by its nature: one task reads it in order, in pieces.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.llm.text import mix
from orderwell.sources.tables import stage

#: Turns (and conversations) after which a shard is closed.
SHARD_TURNS = 8192
#: Ids of an end list in one row at most.
ENDS_ROW = 512
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


class Lending(NamedTuple):
    """Beginnings passed on inside groups of consecutive ids: conversation ``c`` takes
    the first h turns of ``c - c % group`` in place of its own first h, where h is the
    unsigned CRC-32 of the decimal id modulo ``most``."""

    group: int = 5
    most: int = 9

    def taken(self, conv: int) -> int:
        return zlib.crc32(str(conv).encode()) % self.most


SHARDS = "shard long, convs array<long>, lens array<long>, keys binary, sizes array<long>"
LOCAL = "shard long, node0 long, node1 long, owner long, depth long, goes_on boolean"
FOUND = (
    "shard long, node0 long, node1 long, shared boolean, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends array<string>"
)
NODE = ["node0", "node1"]


def _turns(
    conversations: DataFrame, group: int, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.md5(told)).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
    ).filter("conv is not null").withColumn("block", F.expr(f"conv div {group}"))


class Told(NamedTuple):
    """One conversation: its id, the 16 bytes of each turn, the lengths of the texts."""

    conv: int
    keys: bytes
    sizes: np.ndarray

    def part(self, first: int | None, last: int | None) -> tuple[bytes, np.ndarray]:
        at = slice(None if first is None else first * 16, None if last is None else last * 16)
        return self.keys[at], self.sizes[first:last]


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[Told]:
    """Conversations out of rows sorted by conversation and turn."""

    def runs() -> Iterator[Told]:
        for batch in batches:
            if not batch.num_rows:
                continue
            convs = batch.column("conv").to_numpy()
            sizes = batch.column("size").to_numpy()
            keys = b"".join(batch.column("key").to_pylist())
            edges = [0, *(np.flatnonzero(convs[1:] != convs[:-1]) + 1).tolist(), len(convs)]
            for a, b in zip(edges, edges[1:]):
                yield Told(int(convs[a]), keys[a * 16 : b * 16], sizes[a:b])

    for conv, parts in groupby(runs(), key=lambda run: run.conv):
        parts = list(parts)
        yield Told(conv, b"".join(p.keys for p in parts), np.concatenate([p.sizes for p in parts]))


def _lent(block: list[Told], lending: Lending) -> list[Told]:
    """The conversations of one block with the beginnings they take."""
    lender = _div(block[0].conv, lending.group) * lending.group
    lender = next((t for t in block if t.conv == lender), Told(0, b"", np.zeros(0, np.int64)))
    found = []
    for own in block:
        h = lending.taken(own.conv)
        (head, head_sizes), (tail, tail_sizes) = lender.part(None, h), own.part(h, None)
        found.append(Told(own.conv, head + tail, np.concatenate([head_sizes, tail_sizes])))
    return found


def _div(conv: int, group: int) -> int:
    """Rounded towards zero, as SQL divides."""
    return -(-conv // group) if conv < 0 else conv // group


def _packed(
    batches: Iterator[pa.RecordBatch], lending: Lending | None, shard_turns: int
) -> Iterator[pa.RecordBatch]:
    group = lending.group if lending else 1

    def row(held: list[Told]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([held[0].conv], pa.int64()),
                pa.array([[t.conv for t in held]], pa.list_(pa.int64())),
                pa.array([[len(t.sizes) for t in held]], pa.list_(pa.int64())),
                pa.array([b"".join(t.keys for t in held)], pa.binary()),
                pa.array([np.concatenate([t.sizes for t in held])], pa.list_(pa.int64())),
            ],
            names=["shard", "convs", "lens", "keys", "sizes"],
        )

    held, load = [], 0
    for _, block in groupby(_told(batches), key=lambda t: _div(t.conv, group)):
        block = list(block)
        block = _lent(block, lending) if lending else block
        held += block
        load += sum(len(t.sizes) + 1 for t in block)
        if load >= shard_turns:
            yield row(held)
            held, load = [], 0
    if held:
        yield row(held)


class Walk:
    """The nodes of one shard in depth-first order, a node before those below it.

    Arrays over nodes: ``low`` (place of the smallest member), ``depth``, ``count``,
    ``parent`` (-1 for the root); ``ends`` maps a node to the places of the
    conversations that end there.
    """

    def __init__(self, convs: list[int], lens: np.ndarray, keys: bytes):
        self.convs = np.asarray(convs, np.int64)
        self.lens = lens.tolist()
        self.first = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
        self.halves = np.frombuffer(keys, np.uint64).reshape(-1, 2)
        self.place = np.arange(len(self.halves)) - np.repeat(self.first[:-1], lens)
        self._index()
        self._walk()

    def _index(self) -> None:
        """``posting``: for each turn the number of its bitmap, -1 for a turn that no
        other conversation has at its position."""
        n = len(self.halves)
        order = np.lexsort((self.halves[:, 1], self.halves[:, 0], self.place))
        same = np.ones(n, bool)
        same[0:1] = False
        a, b = order[1:], order[:-1]
        same[1:] = (self.place[a] == self.place[b]) & (self.halves[a] == self.halves[b]).all(axis=1)
        run = np.cumsum(~same) - 1
        several = np.bincount(run, minlength=1)[run] > 1 if n else np.zeros(0, bool)
        posting = np.full(n, -1, np.int64)
        posting[order[several]] = run[several]
        self.posting = posting.tolist()
        member = np.repeat(np.arange(len(self.lens)), self.lens)
        self.bitmaps: dict[int, int] = {}
        for turn in np.flatnonzero(posting >= 0).tolist():
            number = self.posting[turn]
            self.bitmaps[number] = self.bitmaps.get(number, 0) | 1 << int(member[turn])
        self.ended: dict[int, int] = {}
        for i, length in enumerate(self.lens):
            self.ended[length] = self.ended.get(length, 0) | 1 << i

    def _walk(self) -> None:
        low, depth, count, parent = [], [], [], []
        self.ends: dict[int, list[int]] = {}
        first = self.first.tolist()
        todo = [((1 << len(self.lens)) - 1, 0, -1)]
        while todo:
            members, d, above = todo.pop()
            me, lowest, size = len(low), (members & -members).bit_length() - 1, members.bit_count()
            if size == 1:  # a lone conversation: all that is left of it at once
                rest = self.lens[lowest] - d + 1
                low += [lowest] * rest
                count += [1] * rest
                depth += range(d, d + rest)
                parent += [above, *range(me, me + rest - 1)]
                self.ends[me + rest - 1] = [lowest]
                continue
            low.append(lowest)
            depth.append(d)
            count.append(size)
            parent.append(above)
            over = members & self.ended.get(d, 0)
            if over:
                self.ends[me] = _places(over)
                members &= ~over
            while members:
                lowest = (members & -members).bit_length() - 1
                number = self.posting[first[lowest] + d]
                child = members & self.bitmaps[number] if number >= 0 else 1 << lowest
                members &= ~child
                todo.append((child, d + 1, me))
        self.low, self.depth, self.count, self.parent = (np.array(x, np.int64) for x in (low, depth, count, parent))
        self.owner = self.convs[self.low] if len(self.low) else np.zeros(0, np.int64)

    def last_turn(self, values: np.ndarray) -> np.ndarray:
        """A value per turn as a value per node: that of its last turn, 0 for the root."""
        values = np.concatenate([values, np.zeros(1, values.dtype)])
        return values[np.where(self.depth > 0, self.first[self.low] + self.depth - 1, -1)]

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that stand for the turns from the root to each node."""
        sums = []
        for half, salt in ((0, 0x9E3779B97F4A7C15), (1, 0xC2B2AE3D27D4EB4F)):
            step = mix(self.halves[:, half] ^ mix((self.place.astype(np.uint64) + np.uint64(1)) * np.uint64(salt)))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(step, dtype=np.uint64)])
            sums.append(self.last_turn(total[1:] - np.repeat(total[self.first[:-1]], self.lens)).view(np.int64))
        return sums[0], sums[1]

    def children(self, counted: np.ndarray) -> np.ndarray:
        """Per node the number of its children that are ``counted``."""
        below = self.parent >= 0
        return np.bincount(self.parent[below], counted[below], len(self.parent)).astype(np.int64)

    def below(self, values: np.ndarray) -> np.ndarray:
        """Per node the sum of ``values`` over its subtree."""
        sums, parent = values.tolist(), self.parent.tolist()
        for i in range(len(sums) - 1, 0, -1):
            sums[parent[i]] += sums[i]
        return np.array(sums, np.int64)


def _places(members: int) -> list[int]:
    raw = members.to_bytes((members.bit_length() + 7) // 8, "little")
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")).tolist()


def _walks(batch: pa.RecordBatch) -> Iterator[tuple[int, Walk, np.ndarray]]:
    for i in range(batch.num_rows):
        shard, convs, lens, keys, sizes = (batch.column(c)[i] for c in ("shard", "convs", "lens", "keys", "sizes"))
        lens = lens.values.to_numpy(zero_copy_only=False)
        yield shard.as_py(), Walk(convs.as_py(), lens, keys.as_py()), sizes.values.to_numpy(zero_copy_only=False)


def _first_walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, walk, _ in _walks(batch):
            n = len(walk.low)
            goes_on = walk.children(np.ones(n, bool)) > 0
            columns = [np.full(n, shard), *walk.names(), walk.owner, walk.depth, goes_on]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["shard", *NODE, "owner", "depth", "goes_on"]
            )


def _second_walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in FOUND.split(", ")]
    for batch in batches:
        for i, (shard, walk, sizes) in enumerate(_walks(batch)):
            n = len(walk.low)
            smallest, goes_on = walk.owner.copy(), walk.children(np.ones(n, bool)) > 0
            shared = np.zeros(n, bool)
            at = {node: k for k, node in enumerate(zip(walk.owner.tolist(), walk.depth.tolist()))}
            for told in batch.column("told")[i].as_py() or ():
                k = at[told["owner"], told["depth"]]
                smallest[k], goes_on[k], shared[k] = told["smallest"], told["any_goes_on"], True
            owned = smallest == walk.owner
            above = [None if p < 0 else int(smallest[p]) for p in walk.parent.tolist()]
            digests, ends = [EMPTY_SHA256] * n, [None] * n
            for k, places in walk.ends.items():
                listed = [str(c) for c in walk.convs[places].tolist()]
                if shared[k]:
                    digests[k] = None
                    ends[k] = [",".join(listed[j : j + ENDS_ROW]) for j in range(0, len(listed), ENDS_ROW)]
                else:
                    digests[k] = hashlib.sha256(",".join(listed).encode()).hexdigest()
            columns = [
                np.full(n, shard), *walk.names(), shared, smallest, walk.depth, pa.array(above, pa.int64()),
                walk.count, walk.children(owned), walk.below((owned & ~goes_on).astype(np.int64)),
                walk.below((walk.count - owned) * walk.last_turn(sizes)),
                pa.array(digests, pa.string()), pa.array(ends, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node out of the pieces of its end list, which come in order."""

    def pieces() -> Iterator[tuple[tuple[int, int], str]]:
        for batch in batches:
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                yield tuple(node), ids

    for node, own in groupby(pieces(), key=lambda piece: piece[0]):
        digest, glue = hashlib.sha256(), b""
        for _, ids in own:
            digest.update(glue + ids.encode())
            glue = b","
        yield pa.RecordBatch.from_pydict(
            {"node0": [node[0]], "node1": [node[1]], "ends_sha256": [digest.hexdigest()]}
        )


def shards(
    conversations: DataFrame,
    lending: Lending | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """Conversations packed by ranges of ids, a row per shard, stored."""
    rows = _turns(conversations, lending.group if lending else 1, conv_col, turn_col, role_col, text_col)
    dealt = rows.repartitionByRange("block").sortWithinPartitions("block", "conv", F.asc_nulls_first("turn"), "key")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(batches, lending, shard_turns)

    return stage(dealt.mapInArrow(pack, SHARDS), "trie-shards")


def trie(
    conversations: DataFrame,
    lending: Lending | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """One row per distinct beginning of a conversation, its first ``depth`` turns (role
    and text), from none at all (depth 0, the root) to whole conversations.

    ``conv_id`` is the smallest id of the conversations that begin so and names the node
    together with ``depth``; ``parent_conv_id`` that of the node one turn shorter (null
    for the root); ``n_convs`` counts them, ``n_children`` the different next turns,
    ``n_leaves`` the nodes without children at or below it.  ``saved_tokens`` adds up,
    at and below the node, the UTF-8 bytes of its last text times the conversations but
    one.  ``ends_sha256`` digests the ids of those that end there.

    Turns are ordered by turn, null first; turns of one number by a hash of role and
    text.  Null role or text counts as empty; repeated rows are turns of their own.
    Rows without an id belong to no conversation and are left out.  An empty table
    gives no rows, not even a root.  Other columns are not read.
    """
    packed = shards(conversations, lending, conv_col, turn_col, role_col, text_col, shard_turns)
    local = stage(packed.mapInArrow(_first_walk, LOCAL), "trie-local")
    shared = stage(
        local.groupBy(*NODE)
        .agg(
            F.min("owner").alias("smallest"),
            F.bool_or("goes_on").alias("any_goes_on"),
            F.count("*").alias("shards"),
        )
        .filter("shards > 1")
        .drop("shards"),
        "trie-shared",
    )
    told = F.collect_list(F.struct("owner", "depth", "smallest", "any_goes_on")).alias("told")
    answers = local.drop("goes_on").join(shared, NODE).groupBy("shard").agg(told)
    found = stage(packed.join(answers, "shard", "left").mapInArrow(_second_walk, FOUND), "trie-found")

    pieces = found.filter("shared")
    summed = pieces.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    listed = (
        pieces.filter("ends is not null")
        .select(*NODE, "shard", F.posexplode("ends").alias("part", "ids"))
        .repartition(*NODE)
        .sortWithinPartitions(*NODE, "shard", "part")
        .select(*NODE, "ids")
        .mapInArrow(_digests, "node0 long, node1 long, ends_sha256 string")
    )
    merged = summed.join(listed, NODE, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))
    )
    wanted = [c for c in merged.columns if c not in NODE]
    return found.filter("not shared").select(*wanted).unionByName(merged.select(*wanted))
