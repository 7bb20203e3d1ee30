"""Scores of texts under a hidden Markov language model.

Words are counted over all training documents.  The most frequent ones are symbols
of their own; every other word is the symbol RARE, under which it has its smoothed
share of all rare words, known or not, so each text has a proper probability.  The
model's start, transition and emission tables are trained by Baum-Welch: each pass
runs forward and backward over all training texts, expected counts are added up
across partitions, and the driver only normalises tables of fixed size.  The score is
the exact likelihood of the whole sequence by the scaled forward recursion.

Word tables stay distributed.  Symbols of all texts are computed once and stored as
two bytes a word; rare words meet their counts in a shuffled join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwell.llm.text import as_arrays, blocks, word_hashes
from orderwell.sources.tables import stage

#: Words that are symbols of their own; ids of symbols fit two bytes.
FREQUENT = 65_000
STATES, PASSES = 8, 4
SMOOTHING = 0.1
#: Occurrences by which a word's share of the states is drawn to the overall share.
SHRINKAGE = 2.0
#: Tokens run through the recursions at a time, and text lengths that go together.
BLOCK_TOKENS, LENGTH_CLASSES = 400_000, (256, 1024, 4096)
END_HASH = np.uint64(0x1F3D5B79A2C4E6F8)
PARTS, PART_GROUP = 32, 128

SYMBOLS = (
    "row long, doc_id long, held_out boolean, n_tokens long, symbols binary, "
    "rare array<long>, rare_times array<int>"
)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold nothing is learnt from; a null id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of a task, added up within bounds before anything is shuffled."""
    words, times, held = [], [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        unique, place = np.unique(np.concatenate(words), return_inverse=True)
        return unique, np.bincount(place, weights=np.concatenate(times)).astype(np.int64)

    def rows(unique: np.ndarray, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(unique), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(unique[part].view(np.int64)), pa.array(total[part])], names=["word", "times"]
            )

    for batch in blocks(batches, "text"):
        hashes, _ = word_hashes(*as_arrays(batch.column("text")))
        unique, n = np.unique(hashes, return_counts=True)
        words += [unique, np.array([END_HASH])]
        times += [n, np.array([batch.num_rows])]
        held += len(unique) + 1
        if held > 2_000_000:
            unique, n = added()
            if len(unique) > 1_000_000:
                yield from rows(unique, n)
                unique, n = unique[:0], n[:0]
            words, times, held = [unique], [n], len(unique)
    if held:
        yield from rows(*added())


@dataclass
class Lexicon:
    """Counts of the training words: totals, the stored table, the frequent ones."""

    tokens: int
    distinct: int
    ends: int
    table: DataFrame
    frequent: np.ndarray
    frequent_times: np.ndarray

    @property
    def rare_tokens(self) -> int:
        return self.tokens - self.ends - int(self.frequent_times.sum())

    @property
    def rare_mass(self) -> float:
        """What the smoothed counts of rare words and of one unknown word add up to."""
        rare_words = self.distinct - len(self.frequent) - (self.ends > 0)
        return self.rare_tokens + SMOOTHING * (rare_words + 1)

    @property
    def denominator(self) -> float:
        return self.tokens + SMOOTHING * (self.distinct + 1)

    def symbol_counts(self) -> np.ndarray:
        """Smoothed counts of every symbol: frequent words, RARE, END."""
        return np.concatenate(
            [self.frequent_times + SMOOTHING, [self.rare_mass, self.ends + SMOOTHING]]
        ).astype(np.float64)


def count_words(training: DataFrame, frequent: int = FREQUENT) -> Lexicon:
    """Counts words of all rows of ``training`` (column text), one end for each."""
    table = stage(
        training.select("text")
        .mapInArrow(_count_words, "word long, times long")
        .groupBy("word")
        .agg(F.sum("times").alias("times")),
        "words",
    )
    end = int(END_HASH.astype(np.int64))
    totals = table.agg(
        F.sum("times").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == end, F.col("times"))).alias("e")
    ).first()
    top = table.filter(F.col("word") != end).orderBy(F.desc("times"), "word").limit(frequent).toPandas()
    words = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    return Lexicon(
        totals.n or 0, totals.v, totals.e or 0, table, words[order], top["times"].to_numpy(np.int64)[order]
    )


def _to_symbols(frequent: np.ndarray):
    rare_symbol, end_symbol = len(frequent), len(frequent) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            hashes, counts = word_hashes(*as_arrays(batch.column("text")))
            symbols, known = np.full(len(hashes), rare_symbol, "<u2"), np.zeros(len(hashes), bool)
            for a in range(0, len(hashes) if len(frequent) else 0, BLOCK_TOKENS):
                part = hashes[a : a + BLOCK_TOKENS]
                place = np.minimum(np.searchsorted(frequent, part), len(frequent) - 1)
                known[a : a + BLOCK_TOKENS] = here = frequent[place] == part
                symbols[a : a + BLOCK_TOKENS][here] = place[here]
            ends = np.cumsum(counts)
            symbols = np.insert(symbols, ends, end_symbol)
            bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).tolist()
            rare = np.flatnonzero(~known)
            cuts = np.searchsorted(rare, np.concatenate([[0], ends]))
            listed, sizes, many = [], [0], []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                unique, n = np.unique(hashes[rare[a:b]], return_counts=True)
                listed.append(unique)
                many.append(n)
                sizes.append(sizes[-1] + len(unique))
            offsets = pa.array(sizes, pa.int32())
            flat = np.concatenate(listed) if listed else np.zeros(0, np.uint64)
            times = np.concatenate(many) if many else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(counts + 1),
                    pa.array([symbols[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "symbols", "rare", "rare_times"],
            )

    return run


@dataclass
class Markov:
    """Start, transition and emission probabilities; a state's emissions are a row
    per symbol so that a text's symbols pick rows."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


def first_model(counts: np.ndarray, states: int = STATES) -> Markov:
    """Every state near the overall symbol shares, told apart by fixed noise, and
    inclined to stay: a text then falls to the state that suits it best."""
    rng = np.random.default_rng(3)
    emits = (counts / counts.sum())[:, None] * np.exp(rng.normal(0, 0.5, (len(counts), states)))
    moves = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * 0.9
    return Markov(
        np.full(states, 1 / states), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0)
    )


class Ragged:
    """Sequences laid out step by step: all first symbols, all second ones, ..., the
    longest sequence first, so the sequences still running are always a prefix."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        steps = int(lengths[0])
        self.running = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.at = np.concatenate([[0], np.cumsum(self.running)])
        flat = np.concatenate([sequences[i] for i in self.order]).astype(np.int64)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.symbols = np.empty(len(flat), dtype=np.int64)
        self.symbols[self.at[step] + np.repeat(np.arange(len(lengths)), lengths)] = flat


def forward(
    model: Markov, ragged: Ragged, kind=np.float64, before: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled state probabilities and scales of every step, and the emissions read.
    ``before`` has those of the step before the first, where there is one."""
    emitted = model.emits.astype(kind)[ragged.symbols]
    states = np.empty_like(emitted)
    scales = np.empty(len(emitted), dtype=kind)
    moves = model.moves.astype(kind)
    now = (model.start.astype(kind) if before is None else before @ moves) * emitted[: ragged.running[0]]
    at = ragged.at.tolist()
    for t, n in enumerate(ragged.running.tolist()):
        here = slice(at[t], at[t + 1])
        if t:
            now = now[:n] @ moves
            now *= emitted[here]
        scale = now.sum(axis=1)
        now /= scale[:, None]
        states[here] = now
        scales[here] = scale
    return states, scales, emitted


def pieces_of(sequence: np.ndarray) -> list[np.ndarray]:
    """A sequence in runs of ``BLOCK_TOKENS``, so that a long one takes bounded memory."""
    return [sequence[a : a + BLOCK_TOKENS] for a in range(0, len(sequence), BLOCK_TOKENS)]


def total(table: np.ndarray, sequence: np.ndarray) -> float:
    """The sum of a table's values for the symbols of a sequence."""
    return float(sum(table[piece].sum() for piece in pieces_of(sequence)))


def log10_likelihoods(model: Markov, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each (non-empty) sequence; long ones go piece by piece
    with the states that the piece before ended in."""
    result = np.empty(len(sequences))
    long = [i for i, s in enumerate(sequences) if len(s) > BLOCK_TOKENS]
    for i in long:
        before, result[i] = None, 0.0
        for piece in pieces_of(sequences[i]):
            states, scales, _ = forward(model, Ragged([piece]), before=before)
            before = states[-1:].copy()
            result[i] += np.log10(scales).sum()
    short = [i for i in range(len(sequences)) if i not in set(long)] if long else list(range(len(sequences)))
    if not short:
        return result
    ragged = Ragged([sequences[i] for i in short])
    _, scales, _ = forward(model, ragged)
    sums = np.zeros(len(short))
    logs = np.log10(scales)
    at = ragged.at.tolist()
    for t, n in enumerate(ragged.running.tolist()):
        sums[:n] += logs[at[t] : at[t + 1]]
    result[np.array(short)[ragged.order]] = sums
    return result


def expected_counts(model: Markov, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of the sequences (Baum-Welch).

    A long sequence keeps the states at the ends of its pieces from a first run
    forward, and runs forward again inside each piece on its way back.
    """
    short = [s for s in sequences if len(s) <= BLOCK_TOKENS]
    parts = [_expected(model, Ragged(short))[0]] if short else []
    for sequence in (s for s in sequences if len(s) > BLOCK_TOKENS):
        cut, befores = pieces_of(sequence), [None]
        for piece in cut[:-1]:
            states, _, _ = forward(model, Ragged([piece]), np.float32, befores[-1])
            befores.append(states[-1:].copy())
        ahead = None
        for piece, before in zip(cut[::-1], befores[::-1]):
            found, ahead = _expected(model, Ragged([piece]), before, ahead)
            parts.append(found)
    return tuple(sum(values) for values in zip(*parts))


def _expected(
    model: Markov, ragged: Ragged, before: np.ndarray | None = None, beyond: np.ndarray | None = None
) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """The counts, and what the first step is worth to the one before it; ``beyond`` is
    what the step after the last is worth, where there is one."""
    states, scales, emitted = forward(model, ragged, np.float32, before)
    moves = model.moves.astype(np.float32)
    back, at, running = moves.T.copy(), ragged.at.tolist(), ragged.running.tolist()
    passed = np.zeros((len(moves), len(moves)))
    after = np.ones((running[-1], len(moves)), np.float32)
    if beyond is not None:
        passed += states[-1:].T @ beyond
        after = beyond @ back
    emitted /= scales[:, None]
    for t in range(len(running) - 1, -1, -1):
        here = slice(at[t], at[t + 1])
        if t < len(running) - 1:
            n = running[t + 1]
            ahead = emitted[at[t + 1] : at[t + 2]] * after
            passed += states[at[t] : at[t] + n].T @ ahead
            after = np.ones((running[t], len(moves)), np.float32)
            after[:n] = ahead @ back
        states[here] *= after  # forward times backward: the step is done with
    first = states[: running[0]].sum(axis=0, dtype=np.float64)
    starts = first if before is None else np.zeros(len(moves))
    emissions = np.stack(
        [np.bincount(ragged.symbols, states[:, k], len(model.emits)) for k in range(len(moves))], axis=1
    )
    return (starts, passed * model.moves, emissions), emitted[: at[1]] * after


def _length_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], list[tuple]]]:
    """Sequences of like length together, about ``BLOCK_TOKENS`` at a time, with the
    other columns of their rows."""
    held = [([], []) for _ in range(len(LENGTH_CLASSES) + 1)]
    sizes = [0] * len(held)
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in batch.schema.names if c != "symbols"]
        for symbols, *rest in zip(batch.column("symbols"), *columns):
            sequence = np.frombuffer(symbols.as_buffer(), "<u2")
            k = int(np.searchsorted(LENGTH_CLASSES, len(sequence)))
            held[k][0].append(sequence)
            held[k][1].append(tuple(rest))
            sizes[k] += len(sequence)
            if sizes[k] >= BLOCK_TOKENS:
                yield held[k]
                held[k], sizes[k] = ([], []), 0
    yield from (h for h in held if h[0])


def _gather(model_of):
    """The expected counts of a task as rows of parts of the tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, total = model_of.value, None
        for sequences, _ in _length_blocks(batches):
            found = expected_counts(model, sequences)
            total = found if total is None else tuple(a + b for a, b in zip(total, found))
        if total is None:
            return
        starts, moves, emissions = total
        parts = [np.concatenate([starts, moves.ravel()]), *np.array_split(emissions, PARTS)]
        group = TaskContext.get().partitionId() // PART_GROUP
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(parts)), pa.int32()),
                pa.array([group] * len(parts), pa.int32()),
                pa.array([p.astype("<f4" if i else "<f8").tobytes() for i, p in enumerate(parts)], pa.binary()),
            ],
            names=["part", "part_group", "counts"],
        )

    return run


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    kind = "<f4" if frame["part"].iloc[0] else "<f8"
    total = sum(np.frombuffer(c, kind).astype(np.float64) for c in frame["counts"])
    return frame.iloc[:1].assign(counts=[total.astype(kind).tobytes()])


def _emissions(expected: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Emission table from expected counts.  Which states a symbol belongs to is
    drawn to the overall occupancy the more the rarer it is, and how often it comes
    is its smoothed count, so every state can emit every symbol."""
    occupancy = expected.sum(axis=0) / max(expected.sum(), 1e-300)
    seen = expected.sum(axis=1, keepdims=True)
    belongs = (expected + SHRINKAGE * occupancy) / (seen + SHRINKAGE)
    emitted = counts[:, None] * np.maximum(belongs, 1e-12)
    return emitted / emitted.sum(axis=0)


def train(sequences: DataFrame, counts: np.ndarray, states: int = STATES, passes: int = PASSES) -> Markov:
    """Baum-Welch over all rows of a stored table of symbol sequences.

    Partial counts are added in two steps, so no task adds more than a fixed number
    of tables; the driver gets one table of fixed size a pass.  Without sequences
    the first model is returned.
    """
    spark = sequences.sparkSession
    model = first_model(counts, states)
    schema = "part int, part_group int, counts binary"
    for _ in range(passes):
        sent = spark.sparkContext.broadcast(model)
        gathered = (
            sequences.select("symbols")
            .mapInArrow(_gather(sent), schema)
            .groupBy("part", "part_group")
            .applyInPandas(_add, schema)
            .groupBy("part")
            .applyInPandas(_add, schema)
            .orderBy("part")
            .toPandas()
        )
        sent.destroy()
        if not len(gathered):
            return model
        head = np.frombuffer(gathered["counts"].iloc[0], "<f8")
        starts, moves = head[:states] + 0.01, head[states:].reshape(states, states) + 0.01
        emissions = np.concatenate(
            [np.frombuffer(c, "<f4").reshape(-1, states) for c in gathered["counts"].iloc[1:]]
        ).astype(np.float64)
        model = Markov(
            starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), _emissions(emissions, counts)
        )
    return model


def _score(model_of, log_shares: np.ndarray, known: np.ndarray):
    """Likelihood of the symbols, and base score and known words among all but rare
    ones; rare words count nothing here."""
    shares = np.append(log_shares, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of.value
        for sequences, rows in _length_blocks(batches):
            likelihoods = log10_likelihoods(model, sequences)
            base = [total(shares, s) for s in sequences]
            seen = [int(total(known, s)) for s in sequences]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.bool_()),
                    pa.array(columns[3], pa.int64()),
                    pa.array(seen, pa.int64()),
                    pa.array(base),
                    pa.array(likelihoods),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "model"],
            )

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    A null text is empty and has its end token only.  ``base_score`` is the smoothed
    unigram log10 probability and ``score`` that of the hidden Markov model.
    Repeated rows count and are scored each.  An empty table gives no rows;
    without any training document all words are unknown.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        held_out(id_col).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    lexicon = count_words(rows.filter(~F.col("held_out")), frequent)
    symbols = stage(rows.mapInArrow(_to_symbols(lexicon.frequent), SYMBOLS), "symbols")
    counts = lexicon.symbol_counts()
    model = train(symbols.filter(~F.col("held_out")), counts)

    log_shares = np.log10(counts / lexicon.denominator)
    log_shares[-2] = 0.0  # rare words are looked up one by one
    known = np.ones(len(counts), dtype=bool)
    known[-2], known[-1] = False, lexicon.ends > 0
    scored = symbols.select("row", "doc_id", "held_out", "n_tokens", "symbols").mapInArrow(
        _score(docs.sparkSession.sparkContext.broadcast(model), log_shares, known),
        "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double",
    )
    times = F.coalesce("times", F.lit(0)) + SMOOTHING
    rare = (
        symbols.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("r"))
        .select("row", F.col("r.rare").alias("word"), F.col("r.rare_times").alias("here"))
        .join(lexicon.table, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("times") > 0, F.col("here")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("here") * F.log10(times / lexicon.denominator)).alias("rare_base"),
            F.sum(F.col("here") * F.log10(times / lexicon.rare_mass)).alias("rare_model"),
        )
    )
    none = F.lit(0)
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", none)).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", none)).alias("base_score"),
        (F.col("model") + F.coalesce("rare_model", none)).alias("score"),
    )
