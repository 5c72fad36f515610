"""Helpers shared by the training-data operators: scratch tables, words, hashes, components.

Intermediate tables are written as Parquet below ``spark.checkpoint.dir`` (shared by
all executors), so a lost executor costs a re-read and never a wrong result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, ship_package, shuffle_partitions, shuffles_dropped

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to lower case, all other characters as they are."""
    return F.translate(c, UPPER, LOWER)


class Scratch:
    """Intermediate tables of one operator call, deleted at the end except those kept.

    ``save`` writes a DataFrame and reads it back (cuts lineage); ``save(..., keep=True)``
    is for the table that the returned result reads.  The shuffle files of a write are of no use once the table stands, and go
    with it.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.tag, self.paths = ship_package(spark), tag, []

    def __enter__(self) -> "Scratch":
        return self

    def save(self, df: DataFrame, keep: bool = False) -> DataFrame:
        path = scratch_path(self.spark, self.tag)
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        if not keep:
            self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        self.paths = []

    def __exit__(self, *exc) -> None:
        self.drop()


def text_blocks(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int = 4 << 20,
                ) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches that hold about ``max_bytes`` of ``text`` (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        lengths = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """The texts as UTF-8 bytes, null as empty."""
    col = batch.column(batch.schema.get_field_index(text))
    return [t or b"" for t in col.cast(pa.large_binary()).to_pylist()]


def add_column(df: DataFrame, name: str, kind: T.DataType, fill: Callable[[pa.RecordBatch], pa.Array],
               text: str, keep: list[str] | None = None, max_bytes: int = 4 << 20,
               reads: tuple[str, ...] = ()) -> DataFrame:
    """``df`` (its ``keep`` columns, default all) with the column ``name`` that ``fill`` computes block by block.

    ``fill`` sees ``keep``, ``text`` and ``reads``.  A column of ``df`` that already has that name is replaced.
    """
    ship_package(df.sparkSession)
    keep = [c for c in (df.columns if keep is None else keep) if c != name]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, text, max_bytes):
            yield pa.RecordBatch.from_arrays(
                [*(block.column(block.schema.get_field_index(c)) for c in keep), fill(block)], [*keep, name])

    return df.select(*dict.fromkeys([*keep, text, *reads])).mapInArrow(run, schema)


class WordHash(dict):
    """64-bit hash of a word (bytes), remembered; forgets all beyond ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (multiply, shift, xor)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9FB21C651E98DF25)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes; fewer words: the whole sequence as one; none: none."""
    n = len(h)
    if n == 0:
        return h
    k_here = min(k, n)
    out = np.full(n - k_here + 1, np.uint64(k_here))
    for j in range(k_here):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[j:n - k_here + 1 + j])
    return out


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def summed_vectors(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
                   length: int, chunk: int = 16384, kind: str = "f8") -> np.ndarray:
    """Sum over all partitions of one fixed-length vector each; the sum (``length`` doubles) is returned.

    Tasks emit their vector in chunks (as ``kind``, a numpy type), chunks are
    summed by key, and only the sum, whose length is a parameter of the caller,
    reaches the driver.
    """
    return _merged_vectors(df, partial, length, chunk, kind, "f8", np.add)


def joined_bits(df: DataFrame, column: str, per_value: int = 256, most: int = 1 << 28) -> np.ndarray:
    """Bytes with a set bit for each value of the long ``column`` modulo their number, a power of two.

    A filter of about ``per_value`` bits a value, and of ``most`` bits (32 MB) at most: beyond
    that it lets more values pass by chance, which the join behind it removes.
    """
    df = df.select(column)
    bits = min(most, max(1 << 16, 1 << (per_value * df.count()).bit_length()))

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(bits // 8, np.uint8)
        for b in batches:
            at = b.column(0).to_numpy(zero_copy_only=False) % bits
            np.bitwise_or.at(out, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
        return out

    return _merged_vectors(df, partial, bits // 8, 16384, "u1", "u1", np.bitwise_or)


def has_bit(filled: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values % (len(filled) * 8)
    return (filled[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _merged_vectors(df, partial, length: int, chunk: int, kind: str, total_kind: str, merge) -> np.ndarray:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = np.asarray(partial(batches)).astype(kind)
        parts = [(i, v[s:s + chunk]) for i, s in enumerate(range(0, length, chunk))]
        for i, p in parts:
            if p.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([p.tobytes()], pa.binary())], ["i", "v"])

    def add(key, table):
        total = None
        for raw in table.column("v").to_pylist():
            v = np.frombuffer(raw, kind).astype(total_kind)
            total = v if total is None else merge(total, v)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})

    ship_package(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        rows = df.mapInArrow(emit, "i int, v binary").groupBy("i").applyInArrow(add, "i int, v binary").collect()
    out = np.zeros(length, total_kind)
    for r in rows:
        v = np.frombuffer(r["v"], total_kind)
        out[r["i"] * chunk:r["i"] * chunk + len(v)] = v
    return out


def connected_components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Every round gives each node its smallest neighbour as parent, follows the
    parents to their roots by pointer doubling, and contracts the edges to
    roots; all steps are partial minima, equi-joins and distincts on the shuffle.
    """
    with Scratch(edges.sparkSession, scratch.tag) as own:  # of all rounds only the last labels stay
        e = own.save(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
        labels = own.save(e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
                          .select("node", F.col("node").alias("component")))
        for _ in range(max_rounds):
            if e.isEmpty():
                return scratch.save(labels)
            both = e.union(e.select("b", "a"))
            p = own.save(both.groupBy("a").agg(F.min("b").alias("m"))
                         .select(F.col("a").alias("u"), F.least("a", "m").alias("p")))
            while True:
                up = p.select(F.col("u").alias("_u"), F.col("p").alias("_p"))
                q = own.save(p.join(up, F.col("p") == F.col("_u"), "left")
                             .select("u", F.coalesce("_p", "p").alias("p"),
                                     (F.col("_p") != F.col("p")).alias("moved")))
                p = q.select("u", "p")
                if q.where("moved").isEmpty():
                    break
            pa_, pb_ = (p.select(F.col("u").alias(f"_{x}"), F.col("p").alias(f"p{x}")) for x in "ab")
            e = own.save(e.join(pa_, F.col("a") == F.col("_a")).join(pb_, F.col("b") == F.col("_b"))
                         .where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                         .distinct())
            labels = own.save(labels.join(p, F.col("component") == F.col("u"), "left")
                              .select("node", F.coalesce("p", "component").alias("component")))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def partitions_for(spark: SparkSession) -> int:
    return shuffle_partitions(spark)
