"""Token ids of documents in compact binary segments.

A segment is one row of a Parquet table: the ids of consecutive documents in one
array, and their boundaries in Elias-Fano form (low bits packed, high bits in unary,
with sampled positions for ``select``), which takes about two bits and the logarithm
of the mean length per document and no table of 64-bit offsets.  Segments hold a
bounded number of ids; a longer document continues in the next ones.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderwell.llm.text import BLOCK_BYTES, blocks, exact_hashes
from orderwell.sources.tables import scratch_path, stage

SEGMENT_IDS = 1 << 19
#: Words whose ids a worker remembers at most, and words encoded in one string.
CACHE_WORDS, JOINED_WORDS = 800_000, 50
#: Words handed to the tokenizer at a time, which bounds what it holds besides.
BATCH_WORDS = 5_000
#: Shards per shuffle partition, and shards at most.
SHARDS_EACH, MAX_SHARDS = 4, 1 << 16
SELECT_STEP = 64
END_ID = 2


class EliasFano:
    """A non-decreasing sequence in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        #: The place of every ``SELECT_STEP``-th one, stored with the rest.
        self.samples = samples
        self._samples = np.frombuffer(samples, "<u4")

    @classmethod
    def encode(cls, values: Sequence[int]) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        high[ones] = 1
        return cls(
            n,
            low_bits,
            np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            ones[::SELECT_STEP].astype("<u4").tobytes(),
        )

    def select(self, i: int) -> int:
        """The i-th value: the place of the i-th one, then the low bits beside it."""
        at = int(self._samples[i // SELECT_STEP])
        rest = i % SELECT_STEP
        byte, bit = divmod(at, 8)
        word = self.high[byte] >> bit << bit
        while rest >= word.bit_count():
            rest -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(rest):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return ((one - i) << self.low_bits) | self._low_value(i)

    def _low_value(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        held = int.from_bytes(self.low[first // 8 : -(-last // 8)], "little")
        return (held >> (first % 8)) & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """Every value, as ``select`` gives them one by one."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        upper = (ones[: self.n] - np.arange(self.n)) << self.low_bits
        if not self.low_bits:
            return upper
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
        bits = bits[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.int64)
        return upper | (bits << np.arange(self.low_bits)).sum(axis=1)


class WordEncoder:
    """Ids of whole texts by a tokenizers file.

    Where the tokenizer drops ASCII white space and never joins across it, each
    distinct word is encoded once and its ids are repeated; that is tried out on the
    tokenizer itself, and any other file encodes text by text.
    """

    _TRIAL = ["a b", "don't  stop\n'll", "x́ ́y 12 3", "\t<|x|> a b\r\nÉ! İx", "  "]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # A task has a core of its own; threads would only hold memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._forget()
        self.by_word = all(
            self._encode([t])[0] == [i for w in self._encode([w.decode() for w in t.encode().split()]) for i in w]
            for t in self._TRIAL
        )

    def _forget(self) -> None:
        #: Two hashes of every remembered word, sorted by the first, and its place.
        self._known = np.zeros((2, 0), np.uint64)
        self._places = np.zeros(0, np.int32)
        self._flat, self._ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has: words are encoded some at a
        time, and an id belongs to the word that its place in the string is in."""
        groups = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        ids, counts = [], []
        for group, found in zip(
            groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
        ):
            own = np.array(found.ids, dtype=np.uint32)
            at = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(own))[::2]
            ends = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)) + 1)
            ids.append(own)
            counts.append(np.bincount(np.searchsorted(ends, at, side="right"), minlength=len(group)))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and how many each text has; null is empty."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            ids = [np.array(i, np.uint32) for i in self._encode(texts.to_pylist())]
            return _joined(ids), np.array([len(i) for i in ids], dtype=np.int64)
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        if len(texts) != 1 or lengths[0] <= BLOCK_BYTES:
            return self._encode_block(texts)
        found = [self._encode_block(pa.array([piece])) for piece in _cut(texts[0].as_py())]
        return _joined([ids for ids, _ in found]), np.array([sum(int(n.sum()) for _, n in found)])

    def _encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.ascii_split_whitespace(texts)
        per_text = np.diff(words.offsets.to_numpy())
        coded = words.flatten().dictionary_encode()
        place = self._remember(coded.dictionary)
        used = place[coded.indices.to_numpy()] if len(place) else np.zeros(0, np.int64)
        starts = self._ends[used]
        sizes = self._ends[used + 1] - starts
        ends = np.cumsum(sizes)
        taken = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return self._flat[taken], np.diff(bounds)

    def _remember(self, words: pa.Array) -> np.ndarray:
        """The places of distinct words, which are encoded if they are new."""
        if len(self._places) > CACHE_WORDS:
            self._forget()
        hashes = np.stack(exact_hashes(words))
        at = np.searchsorted(self._known[0], hashes[0])
        place = np.zeros(len(words), dtype=np.int64)
        inside = np.flatnonzero(at < len(self._places))
        inside = inside[(self._known[:, at[inside]] == hashes[:, inside]).all(axis=0)]
        place[inside] = self._places[at[inside]]
        new = np.ones(len(words), dtype=bool)
        new[inside] = False
        new = np.flatnonzero(new)
        if len(new):
            missing = words.take(pa.array(new)).to_pylist()
            place[new] = len(self._ends) - 1 + np.arange(len(new))
            parts = [self._encode_words(missing[i : i + BATCH_WORDS]) for i in range(0, len(missing), BATCH_WORDS)]
            self._flat = np.concatenate([self._flat, *(p[0] for p in parts)])
            ends = np.cumsum(np.concatenate([p[1] for p in parts])) + self._ends[-1]
            self._ends = np.concatenate([self._ends, ends])
            order = new[np.argsort(hashes[0, new], kind="stable")]
            self._known = np.insert(self._known, at[order], hashes[:, order], axis=1)
            self._places = np.insert(self._places, at[order], place[order])
        return place


def _cut(text: str) -> Iterator[str]:
    """A long text in pieces of about ``BLOCK_BYTES`` characters that end before white
    space, so that no word is cut; one long word is a piece."""
    start = 0
    while start < len(text):
        gap = _SPACE.search(text, min(len(text), start + BLOCK_BYTES))
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


_SPACE = re.compile(r"[ \t-\r]")

_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One per worker, so the words it remembers serve its next tasks too."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.uint32)


def _encode_rows(tokenizer_path: str, end_id: int, width: int, bounds: np.ndarray):
    """Documents as rows of at most ``SEGMENT_IDS`` ids: shard, doc_id, row, piece, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in blocks(batches, "text"):
            ids, counts = encoder.encode(batch.column("text"))
            doc_ids = batch.column("doc_id")
            shards = np.searchsorted(bounds, doc_ids.fill_null(0).to_numpy(), side="right") + 1
            shards[doc_ids.is_null().to_numpy(zero_copy_only=False)] = 0
            ends = np.cumsum(counts)
            doc, piece, held = [], [], []
            for i, (first, last) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
                own = np.append(ids[first:last], end_id).astype(f"<u{width}")
                for k, at in enumerate(range(0, len(own), SEGMENT_IDS)):
                    doc.append(i)
                    piece.append(k)
                    held.append(own[at : at + SEGMENT_IDS].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards[doc].astype(np.int32)),
                    doc_ids.take(pa.array(doc, pa.int32())),
                    batch.column("row").take(pa.array(doc, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(held, pa.binary()),
                ],
                names=["shard", "doc_id", "row", "piece", "ids"],
            )

    return run


SEGMENT = (
    "shard int, first_doc long, continues boolean, base long, doc_ids array<long>, "
    "low_bits int, low binary, high binary, samples binary, width int, n_ids long, ids binary"
)


class _SegmentWriter:
    """Rows of a shard in order, gathered into segments."""

    def __init__(self, shard: int, width: int):
        self.shard, self.width = shard, width
        self.docs, self.base = 0, 0
        self._start(False)

    def _start(self, continues: bool) -> None:
        self.first_doc, self.continues = self.docs - continues, continues
        self.ids, self.lengths, self.held = [], [], []
        self.total = 0

    def add(self, doc_id: int | None, piece: int, ids: bytes) -> None:
        if piece and not self.held:
            self.continues, self.first_doc = True, self.docs - 1
        if piece and self.held:
            self.lengths[-1] += len(ids) // self.width
        else:
            self.held.append(doc_id)
            self.lengths.append(len(ids) // self.width)
            self.docs += not piece
        self.ids.append(ids)
        self.total += len(ids) // self.width

    def segment(self) -> dict:
        bounds = EliasFano.encode(np.cumsum(self.lengths))
        row = dict(
            shard=self.shard, first_doc=self.first_doc, continues=self.continues, base=self.base,
            doc_ids=self.held, low_bits=bounds.low_bits, low=bounds.low, high=bounds.high,
            samples=bounds.samples, width=self.width, n_ids=self.total, ids=b"".join(self.ids),
        )
        self.base += self.total
        self._start(False)
        return row


def _build(width: int):
    schema = pa.schema(
        [
            ("shard", pa.int32()), ("first_doc", pa.int64()), ("continues", pa.bool_()),
            ("base", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("low_bits", pa.int32()),
            ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary()), ("width", pa.int32()),
            ("n_ids", pa.int64()), ("ids", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            numbers = [batch.column(c).to_pylist() for c in ("shard", "doc_id", "piece")]
            for shard, doc_id, piece, ids in zip(*numbers, batch.column("ids")):
                if writer is None or writer.shard != shard:
                    if writer is not None and writer.total:
                        yield pa.RecordBatch.from_pylist([writer.segment()], schema=schema)
                    writer = _SegmentWriter(shard, width)
                writer.add(doc_id, piece, ids.as_py())
                if writer.total >= SEGMENT_IDS:
                    yield pa.RecordBatch.from_pylist([writer.segment()], schema=schema)
        if writer is not None and writer.total:
            yield pa.RecordBatch.from_pylist([writer.segment()], schema=schema)

    return run


def _shard_bounds(rows: DataFrame) -> np.ndarray:
    """Ids that begin a shard, ascending: quantiles, so shards hold about as many
    documents each.  Reads ids only; the driver gets one number per shard."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(MAX_SHARDS, SHARDS_EACH * partitions)
    shares = [i / n for i in range(1, n)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 4 * n)).first()[0]
    return np.unique(np.array(found or [], dtype=np.int64))


def write(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Writes the ids of all documents below ``path``, in ascending order of doc_id.

    ``path/segments`` holds the segments, ``path/shards`` the ids before each shard.
    Null counts as empty text; every document ends with ``end_id``.  A null doc_id
    comes first; repeated rows are written again, in the order they were read.  An
    empty table writes empty tables.
    """
    spark = docs.sparkSession
    width = 2 if WordEncoder(tokenizer_path).tokenizer.get_vocab_size() <= 1 << 16 else 4
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    encode = _encode_rows(tokenizer_path, end_id, width, _shard_bounds(rows))
    (
        rows.mapInArrow(encode, "shard int, doc_id long, row long, piece int, ids binary")
        .repartition("shard")
        .sortWithinPartitions("shard", "doc_id", "row", "piece")
        .mapInArrow(_build(width), SEGMENT)
        .write.mode("overwrite")
        .parquet(f"{path}/segments")
    )
    sizes = (
        spark.read.schema(SEGMENT).parquet(f"{path}/segments").groupBy("shard").agg(F.sum("n_ids").alias("held"))
    )
    # One row per shard, so as many as the write had tasks.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("shard_start")).write.mode(
        "overwrite"
    ).parquet(f"{path}/shards")


def _bounds(row: dict) -> EliasFano:
    return EliasFano(len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["samples"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document of each segment: where its ids begin, how many, their CRC-32."""
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            bounds = _bounds(row)
            ends = np.array([bounds.select(i) for i in range(bounds.n)], np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"], f"<u{row['width']}")
            crcs = [
                zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())
            ]
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * n, pa.int32()),
                    pa.array(row["first_doc"] + np.arange(n)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["base"]),
                    pa.array(ends - starts),
                    pa.array(crcs, pa.int64()),
                    # Only the first and the last document can go on elsewhere.
                    pa.array([i == 0 and row["continues"] or i == n - 1 for i in range(n)]),
                ],
                names=["shard", "doc", "doc_id", "start", "n_tokens", "ids_crc32", "edge"],
            )


def _shift(crc: int, zeros: int) -> int:
    """The CRC register after so many zero bytes, by squaring the one-bit step."""
    step = [0xEDB88320] + [1 << i for i in range(31)]
    times = zeros * 8

    def apply(matrix: list[int], value: int) -> int:
        return reduce(lambda a, i: a ^ matrix[i], (i for i in range(32) if value >> i & 1), 0)

    while times:
        if times & 1:
            crc = apply(step, crc)
        step = [apply(step, column) for column in step]
        times >>= 1
    return crc


def joined_crc(crcs: Sequence[int], n_bytes: Sequence[int]) -> int:
    """CRC-32 of a concatenation from the CRC-32 and length of each part."""
    whole = 0
    for crc, n in zip(crcs, n_bytes):
        whole = _shift(whole, n) ^ crc
    return whole


def _join_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = [
            joined_crc([p["ids_crc32"] for p in parts], [4 * p["n_tokens"] for p in parts])
            for parts in batch.column("parts").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("shard", "doc_id", "start", "n_tokens")), pa.array(crcs, pa.int64())],
            names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"],
        )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per written document: doc_id, start, n_tokens, ids_crc32.

    Every segment is read by itself, so files may be split anyhow; only the parts of
    documents at the edges of segments are brought together.
    """
    schema = "shard int, doc long, doc_id long, start long, n_tokens long, ids_crc32 long, edge boolean"
    segments = spark.read.schema(SEGMENT).parquet(f"{path}/segments")
    pieces = stage(segments.mapInArrow(_pieces, schema), "pieces")  # a few numbers per document
    whole = pieces.filter(~F.col("edge")).select("shard", "doc_id", "start", "n_tokens", "ids_crc32")
    edges = (
        pieces.filter("edge")
        .groupBy("shard", "doc")
        .agg(
            F.any_value("doc_id").alias("doc_id"),
            F.min("start").alias("start"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sort_array(F.collect_list(F.struct("start", "n_tokens", "ids_crc32"))).alias("parts"),
        )
        .select("shard", "doc_id", "start", "n_tokens", "parts")
        .mapInArrow(_join_edges, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    )
    shards = spark.read.schema("shard int, shard_start long").parquet(f"{path}/shards")
    return (
        whole.unionByName(edges)
        .join(F.broadcast(shards), "shard")
        .select("doc_id", (F.col("shard_start") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part and ids of every stored run of ids; a document longer than a
    segment has several runs, in the order of ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                bounds = _bounds(row)
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype(np.int64)
                ends = [bounds.select(i) for i in range(bounds.n)]
                offsets = pa.array([0, *ends], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["base"]] * len(ends), pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(ids)),
                    ],
                    names=["doc_id", "part", "ids"],
                )

    return spark.read.schema(SEGMENT).parquet(f"{path}/segments").mapInArrow(
        run, "doc_id long, part long, ids array<long>"
    )


def index(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the documents to the shared folder and reads their index back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer_path, id_col=id_col, text_col=text_col)
    return read_index(docs.sparkSession, path)
