"""Hidden Markov model scoring of keyed event sequences.

P(O | π, A, B) for every key, by the forward or the backward recursion,
written as an ordered product of N×N matrices:

    P(O) = π · D(o_1) · (A·D(o_2)) · … · (A·D(o_T)) · 1,   D(o) = diag(B[:, o])

The events move once: they are range-partitioned on (key, order) and sorted,
and the recursion runs over each sorted partition as it streams past, in
numpy, all sequences of an Arrow batch in step.  A sequence that lies in one
partition is finished there.  Only the first and the last of a partition may
go on in another one: the last leaves its vector, the first, whose start is
not known, the product of its matrices (N rows instead of one).  These pieces,
at most two a partition, are joined in order per key.  So a key with a third
of all events is spread over many tasks, and a task holds one batch.

Forward reads ascending and ends with the sum; backward reads descending with
A transposed, starts from ones and ends with π.  Both give the same likelihood.

Emissions are a table of (symbol, one probability per state): given as such a
DataFrame, or made from the rows of B and the list of its symbols.  It is joined
to the events: broadcast after they have moved up to ``BROADCAST_BYTES``,
else by an ordinary join before.

A null symbol, or one that is not among ``symbols``, is an observation that no
state emits: its position stays in the sequence (``obs`` is null), and the
likelihood of the sequence is 0 (log -inf).  Every vector is scaled by its largest
entry after each event, so a state counts as impossible once it is 1e-308 times less likely than another.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package, shuffle_partitions
from .encode import apply_label_index, label_counts
from .relational import row_numbers, written

BROADCAST_BYTES = 64 << 20  # emission tables up to this size are sent to every executor
STEP_BYTES = 16 << 20       # emissions of the events of one step of work


def _symbol_table(spark: SparkSession, symbols: Sequence, kind: T.DataType, symbol: str) -> DataFrame:
    """(symbol, label_index) in the order given."""
    if len(set(symbols)) < len(symbols):
        raise ValueError("a symbol is given twice")
    given = pa.table({symbol: pa.array(list(symbols)) if symbols else pa.array([], pa.string()),
                      "label_index": pa.array(range(len(symbols)), pa.float64())})
    return spark.createDataFrame(given).withColumn(symbol, F.col(symbol).cast(kind))


def positions(df: DataFrame, key: str, order: Sequence[str], symbol: str,
              symbols: Sequence | None = None, partitions: int | None = None) -> DataFrame:
    """(key, pos, obs): dense 1-based positions per key in ``order``, obs = symbol index.

    Symbols are indexed by falling frequency (ties by value) unless given; ``obs`` is null
    for a null symbol and for one that is not given.
    """
    base = df.select(key, *order, F.col(symbol).alias("_symbol"))
    if symbols is None:
        mapping = label_counts(base, "_symbol")
    else:
        mapping = _symbol_table(df.sparkSession, symbols, base.schema["_symbol"].dataType, "_symbol")
    coded = apply_label_index(base, mapping, "_symbol", "_obs").select(key, *order, F.col("_obs").cast("int").alias("obs"))
    numbered = row_numbers(coded, [key], list(order), out="pos", partitions=partitions)
    return numbered.select(key, "pos", "obs")


def emission_table(df: DataFrame, symbol: str, B, symbols: Sequence | None = None) -> DataFrame:
    """(_symbol, _emit): probabilities of a symbol by state, from N rows of B over ``symbols``.

    Without ``symbols`` the columns of B belong to the symbols of ``df`` by falling frequency (ties by value).
    """
    spark, kind = df.sparkSession, df.schema[symbol].dataType
    by_symbol = np.ascontiguousarray(np.asarray(B, dtype=float).T)
    n = by_symbol.shape[1]
    offsets = pa.array(np.arange(0, by_symbol.size + 1, n, dtype=np.int32))
    columns = spark.createDataFrame(pa.table({
        "_index": pa.array(np.arange(len(by_symbol), dtype=float)),
        "_emit": pa.ListArray.from_arrays(offsets, pa.array(by_symbol.ravel()))}))
    if symbols is None:
        mapping = label_counts(df.select(F.col(symbol).alias("_symbol")), "_symbol")
    else:
        if len(symbols) != len(by_symbol):
            raise ValueError("B needs one column for each symbol")
        mapping = _symbol_table(spark, symbols, kind, "_symbol")
    return mapping.join(columns, F.col("label_index") == F.col("_index")).select("_symbol", "_emit")


class _Fold:
    """The recursion over one sorted partition; yields (key, pid, n_obs, kind, m, s).

    ``kind``: 2 a finished sequence (s: its log-likelihood), 1 a vector whose start is known, 0 the
    product of a piece that may have begun in an earlier partition (row-major); s: the log scale of each row.
    """

    def __init__(self, start: np.ndarray, step: np.ndarray, end: np.ndarray, pid: int):
        self.start, self.step, self.end, self.pid = start, step, end, pid
        self.n = len(start)
        self.open = None  # (key array of one, state rows, log scales by row, n_obs, kind)

    def _advance(self, rows: np.ndarray, scale: np.ndarray, emit: np.ndarray):
        rows = rows * emit
        top = rows.max(axis=1)
        safe = np.where(top > 0, top, 1.0)
        with np.errstate(divide="ignore"):
            return rows / safe[:, None], scale + np.log(top)

    def _single(self, state: np.ndarray, scale: np.ndarray, emits: np.ndarray, fresh: bool):
        """One sequence: its row, or its N rows, over all its events."""
        for t, emit in enumerate(emits):
            state = state if fresh and t == 0 else state @ self.step
            state, scale = self._advance(state, scale, emit[None, :])
        return state, scale

    def _together(self, emits: np.ndarray, begins: np.ndarray, lengths: np.ndarray):
        """Sequences that begin and are known here, in step: state rows and log scales."""
        by_length = np.argsort(-lengths, kind="stable")
        first, size = begins[by_length], lengths[by_length]
        state, scale = self._advance(np.repeat(self.start[None, :], len(first), axis=0), np.zeros(len(first)), emits[first])
        active = len(first)
        for t in range(1, int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(-size[:active], -t, side="left"))
            state[:active], scale[:active] = self._advance(state[:active] @ self.step, scale[:active], emits[first[:active] + t])
        back = np.argsort(by_length, kind="stable")
        return state[back], scale[back]

    def _finished(self, state: np.ndarray, scale: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return (np.log(state @ self.end) + scale)[:, None]

    def _batch(self, keys: pa.Array, n_obs, kind, m, s) -> dict:
        size = len(keys)
        return {"key": keys, "n_obs": pa.array(n_obs, pa.int64()), "kind": pa.array(kind, pa.int32()),
                "pid": pa.array(np.full(size, self.pid), pa.int32()),
                "m": pa.array(m, pa.list_(pa.float64())), "s": pa.array(s, pa.list_(pa.float64()))}

    def close(self) -> Iterator[dict]:
        """The open sequence, as a piece: it may go on in the next partition."""
        if self.open is None:
            return
        key, state, scale, n_obs, kind = self.open
        yield self._batch(key, [n_obs], [kind], [state.ravel()], [scale])
        self.open = None

    def _end_open(self) -> Iterator[dict]:
        """Another key follows: a known sequence is finished, a product remains a piece."""
        if self.open is not None and self.open[4] == 1:
            key, state, scale, n_obs, _ = self.open
            yield self._batch(key, [n_obs], [2], [None], list(self._finished(state, scale)))
            self.open = None
        yield from self.close()

    def feed(self, keys: pa.Array, emits: np.ndarray, first: bool) -> Iterator[dict]:
        runs = pc.run_end_encode(keys)
        ends = runs.run_ends.to_numpy().astype(np.int64)
        begins = np.concatenate([[0], ends[:-1]])
        done = 0  # runs that are dealt with
        if first:  # it may have begun in the partition before
            state, scale = self._single(np.eye(self.n), np.zeros(self.n), emits[:ends[0]], True)
            self.open, done = (runs.values.slice(0, 1), state, scale, int(ends[0]), 0), 1
        elif self.open[0].equals(runs.values.slice(0, 1)):
            key, state, scale, n_obs, kind = self.open
            state, scale = self._single(state, scale, emits[:ends[0]], False)
            self.open, done = (key, state, scale, n_obs + int(ends[0]), kind), 1
        if done == len(ends):
            return
        yield from self._end_open()
        state, scale = self._together(emits, begins[done:], (ends - begins)[done:])
        size, last = len(ends) - done - 1, len(ends) - 1
        if size:
            yield self._batch(runs.values.slice(done, size), (ends - begins)[done:last], np.full(size, 2), [None] * size,
                              list(self._finished(state[:-1], scale[:-1])))
        self.open = (runs.values.slice(last, 1), state[-1:], scale[-1:], int(ends[last] - begins[last]), 1)


def _folder(start, step, end, chunk):
    """The function for ``mapInArrow``: columns key, pid, emit (null: no state emits the symbol)."""
    start, step, end = (np.asarray(x, dtype=float) for x in (start, step, end))
    n = len(start)
    names = ["key", "pid", "n_obs", "kind", "m", "s"]

    def fold(batches):
        work = None
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                first = work is None
                if first:
                    work = _Fold(start, step, end, part.column("pid")[0].as_py())
                emit = part.column("emit")
                known = emit.is_valid().to_numpy(zero_copy_only=False)
                emits = np.zeros((part.num_rows, n))
                emits[known] = np.asarray(emit.drop_null().flatten()).reshape(-1, n)
                for out in work.feed(part.column("key"), emits, first):
                    yield pa.RecordBatch.from_pydict({c: out[c] for c in names})
        if work is not None:
            for out in work.close():
                yield pa.RecordBatch.from_pydict({c: out[c] for c in names})

    return fold


def _joined(start, step, end):
    """The function that joins the pieces of a key in the order of their partitions."""
    start, step, end = (np.asarray(x, dtype=float) for x in (start, step, end))
    n = len(start)

    def join(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by("pid")
        state, scale = None, 0.0
        with np.errstate(divide="ignore"):
            for kind, m, s in zip(*(pieces.column(c).to_pylist() for c in ("kind", "m", "s"))):
                if kind == 1:
                    state, scale = np.asarray(m), s[0]
                    continue
                weight = np.log(start if state is None else state @ step) + np.asarray(s)
                top = weight.max()
                if top == -np.inf:
                    state, scale = np.zeros(n), top
                else:
                    state, scale = np.exp(weight - top) @ np.asarray(m).reshape(n, n), scale + top
            value = float(np.log(state @ end)) + scale
        return pa.table({"key": pieces.column("key").slice(0, 1), "n_obs": pa.array([pc.sum(pieces.column("n_obs")).as_py()], pa.int64()),
                         "log_likelihood": pa.array([value], pa.float64())})

    return join


def hmm_score(df: DataFrame, key: str, order: Sequence[str], symbol: str, pi, A, B,
              symbols: Sequence | None = None, method: str = "forward", chunk: int | None = None,
              partitions: int | None = None) -> DataFrame:
    """log P(O | π, A, B) per key: columns ``key, n_obs, log_likelihood``.

    ``B``: N rows over ``symbols`` (default: the symbols of ``df`` by falling frequency, ties by
    value), or a DataFrame of (symbol, array of N probabilities) with one row per symbol.
    ``order`` must be unique within a key (e.g. time then event id), so that the order of events is
    deterministic.  Null keys are one sequence.  ``chunk``: events of one step of work (default: by STEP_BYTES).
    """
    if method not in ("forward", "backward"):
        raise ValueError("method is 'forward' or 'backward'")
    pi, A = np.asarray(pi, dtype=float), np.asarray(A, dtype=float)
    down, kind = method == "backward", df.schema[key].dataType
    model = (np.ones(len(pi)), A.T.copy(), pi) if down else (pi, A, np.ones(len(pi)))
    events = _sorted_events(df, key, order, symbol, B, symbols, len(pi), down, partitions)
    ship_package(df.sparkSession)
    # at most two rows a partition besides one row a key; written, since finished sequences and pieces part here
    out = written(events.mapInArrow(_folder(*model, chunk or max(1, STEP_BYTES // (8 * len(pi)))), T.StructType([
        T.StructField("key", kind), T.StructField("pid", T.IntegerType()), T.StructField("n_obs", T.LongType()),
        T.StructField("kind", T.IntegerType()), T.StructField("m", T.ArrayType(T.DoubleType())),
        T.StructField("s", T.ArrayType(T.DoubleType()))])), "hmm-pieces")
    whole = out.where(F.col("kind") == 2).select("key", "n_obs", F.col("s")[0].alias("log_likelihood"))
    pieces = out.where(F.col("kind") < 2).groupBy("key").applyInArrow(_joined(*model), whole.schema)
    return whole.unionByName(pieces).withColumnRenamed("key", key)


def _sorted_events(df: DataFrame, key: str, order: Sequence[str], symbol: str, B, symbols: Sequence | None,
                   n: int, down: bool, partitions: int | None) -> DataFrame:
    """key, pid, emit by range of (key, order), sorted within partitions; the events are exchanged once."""
    if isinstance(B, DataFrame):
        table = B.select(F.col(B.columns[0]).alias("_symbol"), F.col(B.columns[1]).cast("array<double>").alias("_emit"))
        n_symbols = table.count()
    else:
        table, n_symbols = emission_table(df, symbol, B, symbols), len(B[0])
    names = ["_key", *(f"_o{i}" for i in range(len(order)))]
    sort = [F.col(c).desc() if down else F.col(c).asc() for c in names]
    n_parts = partitions or shuffle_partitions(df.sparkSession)
    events = df.select(F.col(key).alias("_key"), F.col(symbol).alias("_s"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    known = F.col("_s") == F.col("_symbol")
    if n_symbols * (8 * n + 64) <= BROADCAST_BYTES:
        events = events.repartitionByRange(n_parts, *sort).join(F.broadcast(table), known, "left")
    else:
        events = events.join(table, known, "left").repartitionByRange(n_parts, *sort)
    # sorted after the join, which gives no promise about the order within partitions
    return events.sortWithinPartitions(*sort).select(
        F.col("_key").alias("key"), F.spark_partition_id().alias("pid"), F.col("_emit").alias("emit"))
