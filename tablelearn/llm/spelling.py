"""Spelling variants: words one edit apart, found by probing generated edits against Bloom filters.

Words are counted where documents are read (per block, then by key).  For each word length a blocked Bloom
filter is built (a block is one 64-bit word with five bits a key): blocks are numbered by the word's hash, each
run of blocks is one row that a task fills from the words dealt to it, and nothing but filter bytes, ``most`` in
number at most, reaches the driver.  Where all filters together are larger, the vocabulary is
probed in several passes, each with the part of the filters that ``most`` bytes hold.  A word then generates its
neighbourhood: every deletion, and every replacement by a later character (the earlier one of two words of
equal length finds the later one, and the longer one finds the shorter one, so insertions need no
probes).  Hashes are sums over positions, so the hash of an edit follows from that of the word by numpy arithmetic.
Only edits that the filters let through become strings and are joined with the vocabulary, which removes false positives.

A word's form is its near word of largest count (ties: smallest in code-point order), if that has ``ratio`` times
its own count at least; forms are followed to the last one by doubling joins.

Defined results: a null or empty text has no words; a null id counts as the empty string where ids matter
(``drop_every``); repeated rows count again; words and texts may be of any length; an empty table gives an empty
result; columns beside id and text are not read, names of any kind are possible.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix64, text_blocks, texts_of

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
BITS = 24  # of a filter for each word
LONG = 64  # words of this length and more share one filter, of eight times the bits
CHUNK = 1 << 13  # blocks that one row of the filter table holds (64 KB)
MOST = 32 << 20  # bytes of filters sent at once
PROBES = 1 << 19  # edits hashed at once

_SALT = np.uint64(0x51A7F0C3D2B4968E)
_VOCABULARY = "word string, n long"


# ---- words

def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: str = LETTERS, min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, drop_every: int | None = None) -> DataFrame:
    """(word, n) of the runs of ``letters``, with A-Z lower-cased, of ``min_length`` characters and ``min_count`` places or more.

    ``drop_every``: a run whose checksum with the document's id is a multiple loses one character first (a planted slip).
    """
    runs = re.compile(f"[{letters}]{{{min_length},}}")  # greedy from the left, so every match is a maximal run

    def count(batches):
        for block in text_blocks(batches, "t", 4 << 20):
            words: Counter = Counter()
            for k, raw in zip(block.column(0).to_pylist(), texts_of(block, "t")):
                found = runs.findall(raw.lower().decode())  # lower() of bytes changes A-Z only
                if drop_every is None:
                    words.update(found)
                    continue
                start = zlib.crc32(b"" if k is None else k.encode())
                start = zlib.crc32(b":", start)
                for run in found:
                    h = zlib.crc32(run.encode(), start)
                    if h % drop_every:
                        words[run] += 1
                    elif len(run) > min_length:
                        words[run[:h % len(run)] + run[h % len(run) + 1:]] += 1
            if words:
                yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInArrow(count, _VOCABULARY)
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- hashes: a sum over positions, mixed

def _factors(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _SALT) | np.uint64(1)


def matrix(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length."""
    return np.array(words, f"<U{length}").view(np.uint32).reshape(len(words), length).astype(np.uint64)


def position_sums(m: np.ndarray) -> np.ndarray:
    return (m * _factors(m.shape[1])).sum(1, dtype=np.uint64)


def finished(sums: np.ndarray, length: int) -> np.ndarray:
    return mix64(sums ^ mix64(np.array([length], np.uint64)))


def shard_of(length: int) -> int:
    return min(length, LONG)


def block_and_mask(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of a hash (its upper half) and the five bits in it (from its lower half)."""
    block = ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    mask, one, low = np.zeros(len(h), np.uint64), np.uint64(1), np.uint64(63)
    for i in range(5):
        mask |= one << (h >> np.uint64(6 * i) & low)
    return block, mask


def blocks_of(n: int, shard: int) -> int:
    """64-bit words of a filter of n keys (2^16 bits at least, so that the many edits of a long word rarely pass by chance)."""
    return max(1024, n * BITS * (8 if shard == LONG else 1) // 64)


def by_length(words: list[str]):
    """(length, their places, their matrix) for bounded groups of words of equal length."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        step = max(1, (1 << 20) // int(length))
        for s in range(0, len(at), step):
            part = at[s:s + step]
            yield int(length), part, matrix([words[i] for i in part], int(length))


def filters(words: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(shard, chunk, bits): runs of ``CHUNK`` blocks of each shard's filter."""
    def hashed(batches):
        for batch in batches:
            for length, part, m in by_length(batch.column(0).to_pylist()):
                h = finished(position_sums(m), length)
                shard = shard_of(length)
                block, _ = block_and_mask(h, sizes[shard])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), shard, np.int32)), pa.array((block // CHUNK).astype(np.int32)), pa.array(h.view(np.int64))],
                    ["shard", "chunk", "h"])

    def fill(key, table):
        shard, chunk = (k.as_py() for k in key)
        block, mask = block_and_mask(table.column("h").to_numpy().view(np.uint64), sizes[shard])
        bits = np.zeros(min(CHUNK, sizes[shard] - chunk * CHUNK), np.uint64)
        np.bitwise_or.at(bits, block - chunk * CHUNK, mask)
        return pa.table({"shard": pa.array([shard], pa.int32()), "chunk": pa.array([chunk], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    return (words.select("word").mapInArrow(hashed, "shard int, chunk int, h long")
            .groupBy("shard", "chunk").applyInArrow(fill, "shard int, chunk int, bits binary"))


# ---- neighbourhoods

def deletions(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, position sum) of the words with one character left out; of equal neighbours only the first."""
    r = _factors(m.shape[1])
    before = np.cumsum(m * r, 1, dtype=np.uint64) - m * r
    moved = np.zeros_like(m)
    moved[:, 1:] = m[:, 1:] * r[:-1]
    after = moved.sum(1, dtype=np.uint64)[:, None] - np.cumsum(moved, 1, dtype=np.uint64)
    distinct = np.ones(m.shape, bool)
    distinct[:, 1:] = m[:, 1:] != m[:, :-1]
    row, at = np.nonzero(distinct)
    return row, at, (before + after)[row, at]


def let_through(sums: np.ndarray, length: int, sizes: dict[int, int], loaded: dict[int, tuple[int, np.ndarray]]) -> np.ndarray:
    """Places of ``sums`` that the loaded part of the filter of ``length`` lets through."""
    shard = shard_of(length)
    if shard not in loaded:
        return np.empty(0, np.int64)
    first, bits = loaded[shard]
    block, mask = block_and_mask(finished(sums, length), sizes[shard])
    block -= first
    here = np.flatnonzero((block >= 0) & (block < len(bits)))
    return here[bits[block[here]] & mask[here] == mask[here]]


def neighbourhood(m: np.ndarray, alphabet: np.ndarray, sizes: dict[int, int], loaded: dict[int, tuple[int, np.ndarray]]):
    """(row, edit) of all edits of the words in ``m`` that the filters let through, edits as strings."""
    n, length = m.shape
    if length > 1:
        row, at, sums = deletions(m)
        hit = let_through(sums, length - 1, sizes, loaded)
        for s in range(0, len(hit), max(1, PROBES // length)):
            r, a = row[hit[s:s + max(1, PROBES // length)]], at[hit[s:s + max(1, PROBES // length)]]
            cols = np.arange(length - 1)
            yield r, m[r[:, None], cols + (cols >= a[:, None])]
    if shard_of(length) not in loaded:
        return
    factors, total = _factors(length), position_sums(m)
    row, at = (x.ravel() for x in np.indices(m.shape))
    code = m.ravel()
    for s in range(0, len(row), max(1, PROBES // max(1, len(alphabet)))):
        cut = slice(s, s + max(1, PROBES // max(1, len(alphabet))))
        place, char = np.nonzero(alphabet > code[cut, None])
        r, a, new = row[cut][place], at[cut][place], alphabet[char]
        hit = let_through(total[r] + (new - code[cut][place]) * factors[a], length, sizes, loaded)
        for t in range(0, len(hit), max(1, PROBES // length)):
            h = hit[t:t + max(1, PROBES // length)]
            changed = m[r[h]]
            changed[np.arange(len(h)), a[h]] = new[h]
            yield r[h], changed


def strings(m: np.ndarray) -> list[str]:
    return np.ascontiguousarray(m.astype(np.uint32)).view(f"<U{m.shape[1]}").ravel().tolist()


def passes(sizes: dict[int, int], most: int) -> list[list[tuple[int, int, int]]]:
    """Runs of chunks (shard, first chunk, chunks) for each pass, ``most`` bytes in a pass."""
    room, out = max(1, most // (8 * CHUNK)), [[]]
    left = room
    for shard, blocks in sorted(sizes.items()):
        first, chunks = 0, -(-blocks // CHUNK)
        while first < chunks:
            if not left:
                out.append([])
                left = room
            n = min(left, chunks - first)
            out[-1].append((shard, first, n))
            first, left = first + n, left - n
    return out


def near_words(words: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """(word, n, near, near_n) for all ordered pairs of words in ``words`` (word, n) that are one edit apart."""
    spark = words.sparkSession
    counted = words.groupBy(F.least(F.char_length("word"), F.lit(LONG)).alias("s")).count().collect()  # LONG rows at most
    sizes = {r["s"]: blocks_of(r["count"], r["s"]) for r in counted}
    letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct()
    codes = np.array(sorted(ord(r["c"]) for r in letters.collect()), np.uint64)  # of the alphabet of the runs
    table = scratch.save(filters(words, sizes))
    found = None
    for part in passes(sizes, most):
        loaded = {}
        for shard, first, n in part:
            bits = np.zeros(min(n * CHUNK, sizes[shard] - first * CHUNK), np.uint64)
            rows = table.where((F.col("shard") == shard) & (F.col("chunk") >= first) & (F.col("chunk") < first + n))
            for row in rows.collect():  # n chunks; all of a pass are ``most`` bytes
                at = (row["chunk"] - first) * CHUNK
                v = np.frombuffer(row["bits"], np.uint64)
                bits[at:at + len(v)] = v
            loaded[shard] = (first * CHUNK, bits)
        sent = spark.sparkContext.broadcast(loaded)

        def probe(batches, sent=sent):
            for batch in batches:
                names, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                for _, part, m in by_length(names):
                    for row, edits in neighbourhood(m, codes, sizes, sent.value):
                        if len(row):
                            at = part[row]
                            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in at]), pa.array(counts[at]), pa.array(strings(edits))],
                                                             ["word", "n", "near"])

        one = scratch.save(words.select("word", "n").mapInArrow(probe, "word string, n long, near string"))
        found = one if found is None else found.union(one)
        sent.destroy()
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = scratch.save(found.join(exact, "near").select("word", "n", "near", "near_n"))
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


def followed(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) from (word, form), following forms to the last one; paths are doubled, so a few rounds do."""
    root = scratch.save(forms.select("word", F.col("form").alias("root")))
    while True:
        up = root.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = scratch.save(root.join(up, F.col("root") == F.col("_w"), "left")
                            .select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")))
        root = step.select("word", "root")
        if step.where("moved").isEmpty():
            return root


def spelling_forms(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: str = LETTERS, min_length: int = MIN_LENGTH,
                   min_count: int = MIN_COUNT, ratio: int = RATIO, drop_every: int | None = None, most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary; see the module's text."""
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its word")
    with Scratch(docs.sparkSession, "spelling") as own:
        words = own.save(vocabulary(docs, key, text, letters, min_length, min_count, drop_every))
        best = near_words(words, own, most).groupBy("word").agg(
            F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("top"))
        judged = words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(-F.col("top.m") >= ratio * F.col("n"), F.col("top")).alias("top"))
        judged = own.save(judged.select("word", F.col("top.near").alias("form"), "n", "n_near", (-F.col("top.m")).alias("form_n")))
        roots = followed(judged.where("form is not null"), own)
        return own.save(judged.join(roots, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), keep=True)
