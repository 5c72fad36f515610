"""Byte-level BPE encoding and decoding over padded numpy matrices.

A text is cut by the vocabulary's pattern; the distinct pieces of a block that the vocabulary
doesn't hold whole become rows of byte ids, bucketed by length and padded.  In each
round every row of a matrix merges its leftmost pair of minimum rank: ranks of neighbours come from a hashed
table of all pairs whose bytes together are an entry, finished rows leave (compaction of rows), and the others move
up by one column (compaction of columns), so the matrix narrows by one every round.  A piece beyond the
largest bucket is one row whose equal minimum pairs merge in one round, from the left up to the first merge that makes a
pair of lower rank, which is what merging them one by one gives.  Ids of pieces are
kept across blocks up to a limit and then forgotten; texts never leave their rows.

Decoding gathers the entries' bytes by id.

Defined results: a null or empty text has no ids; a null list of ids decodes to null, a null id
inside it to no bytes, and an id that the vocabulary doesn't have is an error; names of special tokens
are plain text; repeated rows and null ids are done row by row; texts may be of any length; an empty table
gives an empty result; other columns are kept, one that has the output's name is replaced.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_column, mix64, ship_package, texts_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
NO_RANK = np.int32(2**31 - 1)
BUCKETS = (4, 8, 12, 16, 24, 32, 48, 64)  # longer pieces are rows of their own
_BUCKET = [next(w for w in BUCKETS if n <= w) for n in range(BUCKETS[-1] + 1)] + [0]
CELLS = 1 << 20  # of a matrix
KEPT_PIECES = 400_000

# Letters and numbers of newer Unicode versions, which the reference library of the format
# takes for neither (tested over all code points).
NEWER = (
    "՘ ֋-֌ ࢏ ౜ ೜ ₏ ₝-₟ ꟎-꟏ ꟒ ꟔ ꟝ ꟢ ꟱ "
    "꭬-꭭ \U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee "
    "\U00011b0a \U00011db0-\U00011ddb \U00011de0-\U00011de9 \U00011df1 \U0001246f \U00012475-\U0001247f "
    "\U00012550-\U00012686 \U00016ea0-\U00016eb8 \U00016ebb-\U00016ed3 \U00016ff2-\U00016ff3 \U00016ff4-\U00016ff6 "
    "\U000187f8-\U000187ff \U00018cd6-\U00018cda \U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 "
    "\U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 "
    "\U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 "
    "\U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff \U0002b73a-\U0002b73f \U0002b81e "
    "\U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f")
_NEWER = regex.compile("[" + NEWER.replace(" ", "") + "]")
_NEWER_BYTE = min(c.encode()[0] for c in NEWER if c not in " -")  # texts of smaller bytes have none of them


def pieces_of(raw: bytes, pattern: regex.Pattern) -> list[str]:
    """The matches of the pattern, with characters of NEWER counted as neither letters nor numbers."""
    text = raw.decode()
    if not raw or np.frombuffer(raw, np.uint8).max() < _NEWER_BYTE or not _NEWER.search(text):
        return pattern.findall(text)
    return [text[m.start():m.end()] for m in pattern.finditer(_NEWER.sub("\ufffd", text))]


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices start[0], start[0] + 1, … (count[0] of them), start[1], …"""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


class PairTable:
    """Open addressing from a pair of ids to the rank of their bytes together."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, (4 * len(rank)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.empty = np.uint64(2**64 - 1)
        self.keys, self.ranks = np.full(1 << bits, self.empty), np.full(1 << bits, NO_RANK)
        key = self._key(left, right)
        slot = mix64(key) >> self.shift
        while len(key):  # of the pairs that want a free slot one gets it, the others go on to the next
            free = self.keys[slot] == self.empty
            self.keys[slot[free]] = key[free]
            placed = self.keys[slot] == key
            self.ranks[slot[placed]] = rank[placed]
            key, rank, slot = key[~placed], rank[~placed], (slot[~placed] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint32).astype(np.uint64) << np.uint64(32) | right.astype(np.uint32).astype(np.uint64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs (NO_RANK: not a pair); any shape."""
        key = self._key(left, right).ravel()
        slot = mix64(key) >> self.shift
        found = self.keys[slot]
        out = np.where(found == key, self.ranks[slot], NO_RANK)
        left_over = np.flatnonzero((found != key) & (found != self.empty))
        slot = slot[left_over]
        while len(left_over):
            slot = (slot + np.uint64(1)) & self.mask
            found, want = self.keys[slot], key[left_over]
            hit = found == want
            out[left_over[hit]] = self.ranks[slot[hit]]
            go = ~hit & (found != self.empty)
            left_over, slot = left_over[go], slot[go]
        return out.reshape(left.shape)


class BytePairs:
    """A byte-level vocabulary: ids of pieces and bytes of ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        if any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        joined = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                  if t[:i] in ranks and t[i:] in ranks]
        self.pairs = PairTable(*np.array(joined or np.empty((0, 3)), np.int64).astype(np.int32).T)
        self.lengths = np.full(max(ranks.values()) + 1, -1, np.int64)
        for t, r in ranks.items():
            self.lengths[r] = len(t)
        self.starts = np.zeros(len(self.lengths), np.int64)
        by_id = sorted(ranks.items(), key=lambda x: x[1])
        self.starts[[r for _, r in by_id]] = np.cumsum([0, *(len(t) for t, _ in by_id)])[:-1]
        self.bytes = np.frombuffer(b"".join(t for t, _ in by_id), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.piece_start, self.piece_count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.piece_ids = np.empty(0, np.int32)

    def merge_rows(self, m: np.ndarray) -> np.ndarray:
        """Rows of ids, padded with -1, after all their merges (padded again)."""
        out, rows = np.full(m.shape, -1, np.int32), np.arange(len(m))
        rank = self.pairs.look(m[:, :-1], m[:, 1:])
        while len(m):
            if m.shape[1] == 1:
                out[rows, 0] = m[:, 0]
                break
            j = rank.argmin(1)
            best = rank[np.arange(len(m)), j]
            done = best == NO_RANK
            if done.any():
                out[rows[done], :m.shape[1]] = m[done]
                m, rank, rows, j, best = (x[~done] for x in (m, rank, rows, j, best))
            at, cols = np.arange(len(m)), np.arange(m.shape[1] - 1)
            m = np.take_along_axis(m, cols + (cols > j[:, None]), 1)
            m[at, j] = best
            cols = cols[:-1]
            rank = np.take_along_axis(rank, cols + (cols > j[:, None]), 1)
            for here in (j - 1, j):  # the pairs on both sides of the merged one
                i = np.flatnonzero((here >= 0) & (here < rank.shape[1]))
                rank[i, here[i]] = self.pairs.look(m[i, here[i]], m[i, here[i] + 1])
        return out

    def merge_long(self, t: np.ndarray) -> np.ndarray:
        """One row of any length: its equal minimum pairs merge together as far as the order allows."""
        rank = self.pairs.look(t[:-1], t[1:])
        while len(rank) and (low := rank.min()) != NO_RANK:
            at = np.flatnonzero(rank == low)
            first = np.r_[True, np.diff(at) > 1]  # of neighbours that overlap, every second one from the left
            run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            before = np.r_[np.int32(-1), t][at]  # the ids beside each merge when its turn comes
            before[1:][np.diff(at) == 2] = low
            after = np.r_[t, np.int32(-1)][at + 2]
            merged = np.full(len(at), low, np.int32)
            lower = np.minimum(self.pairs.look(before, merged), self.pairs.look(merged, after)) < low
            if lower.any():
                at = at[:lower.argmax() + 1]
            t[at] = low
            stay = np.ones(len(t), bool)
            stay[at + 1] = False
            t = t[stay]
            at = at - np.arange(len(at))
            rank = rank[stay[:-1]] if stay[-1] else rank[stay[:-1]][:len(t) - 1]
            for here in (at - 1, at):
                here = here[(here >= 0) & (here < len(t) - 1)]
                rank[here] = self.pairs.look(t[here], t[here + 1])
        return t

    def _learn(self, new: list[str]) -> None:
        order, counts, flat = [], [], []  # pieces by the way they take

        def add(pieces: list[str], count: np.ndarray, ids: np.ndarray) -> None:
            order.extend(pieces)
            counts.append(count)
            flat.append(ids)

        raw = [p.encode() for p in new]
        whole = [*map(self.ranks.get, raw)]
        held = [i for i, r in enumerate(whole) if r is not None]
        add([new[i] for i in held], np.ones(len(held), np.int64), np.array([whole[i] for i in held], np.int32))
        waiting: dict[int, list[int]] = {}
        for i, r in enumerate(whole):
            if r is None:
                waiting.setdefault(_BUCKET[min(len(raw[i]), len(_BUCKET) - 1)], []).append(i)
        for i in waiting.pop(0, []):
            ids = self.merge_long(self.byte_ids[np.frombuffer(raw[i], np.uint8)])
            add([new[i]], np.array([len(ids)]), ids)
        for width, members in waiting.items():
            for s in range(0, len(members), CELLS // width):
                part = members[s:s + CELLS // width]
                count = np.array([len(raw[i]) for i in part])
                m = np.full((len(part), width), -1, np.int32)
                m[np.arange(width) < count[:, None]] = self.byte_ids[np.frombuffer(b"".join([raw[i] for i in part]), np.uint8)]
                m = self.merge_rows(m)
                add([new[i] for i in part], (m >= 0).sum(1), m[m >= 0])
        count, first = np.concatenate(counts), len(self.known)
        self.known.update(zip(order, range(first, first + len(order))))
        self.piece_start = np.r_[self.piece_start, len(self.piece_ids) + np.cumsum(count) - count]
        self.piece_count = np.r_[self.piece_count, count]
        self.piece_ids = np.concatenate([self.piece_ids, *flat])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each."""
        if len(self.known) > KEPT_PIECES:
            self._forget()
        pieces, ends = [], []
        for t in texts:
            pieces += pieces_of(t, self.pattern)
            ends.append(len(pieces))
        if new := [*set(pieces).difference(self.known)]:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        count = self.piece_count[at]
        total = np.r_[0, np.cumsum(count)][np.array([0, *ends])]
        return self.piece_ids[ragged(self.piece_start[at], count)], np.diff(total)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids in one array, and the number of bytes of each id (-1: an id of no bytes)."""
        if len(ids) and (ids.max() >= len(self.lengths) or ids.min() < -1 or (self.lengths[ids[ids >= 0]] < 0).any()):
            raise ValueError("an id is not in the vocabulary")
        count = np.where(ids >= 0, self.lengths[ids], 0)
        return self.bytes[ragged(np.where(ids >= 0, self.starts[ids], 0), count)], count


@lru_cache(maxsize=2)
def vocabulary(path: str = RANKS) -> BytePairs:
    with open(path, "rb") as f:
        return BytePairs({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def encode(docs: DataFrame, text: str = "text", out: str = "ids", keep: list[str] | None = None,
           ranks: str = RANKS) -> DataFrame:
    """``docs`` (its ``keep`` columns, default all) with the ids of ``text`` as the array column ``out``."""
    def fill(block: pa.RecordBatch) -> pa.Array:
        ids, count = vocabulary(ranks).encode(texts_of(block, text))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), pa.array(ids))

    return add_column(docs, out, T.ArrayType(T.IntegerType()), fill, text, keep, 2 << 20)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", keep: list[str] | None = None,
           ranks: str = RANKS, most: int = 1 << 20) -> DataFrame:
    """``df`` (its ``keep`` columns, default all) with the bytes of the id lists as the binary column ``out``."""
    ship_package(df.sparkSession)
    keep = [c for c in (df.columns if keep is None else keep) if c != out]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.BinaryType())])

    def bytes_of(lists: pa.ListArray) -> pa.Array:
        offsets = np.asarray(lists.offsets).astype(np.int64)
        values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        raw, count = vocabulary(ranks).decode(values.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64))
        ends = np.r_[0, np.cumsum(count)][offsets - offsets[0]]
        valid = None if lists.null_count == 0 else pa.py_buffer(np.packbits(lists.is_valid().to_numpy(zero_copy_only=False), bitorder="little"))
        return pa.Array.from_buffers(pa.binary(), len(lists), [valid, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            column = column.cast(pa.list_(pa.int32()))
            sizes = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                base = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, base + most, "right")))
                part = batch.slice(start, stop - start)
                made = bytes_of(column.slice(start, stop - start))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), made], [*keep, out])
                start = stop

    return df.select(*dict.fromkeys([*keep, ids])).mapInArrow(run, schema)
