"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Every document becomes token ids and one closing id.  Whole windows of
``capacity`` ids are cut off first; what is left of each document is cut into pieces of
at most ``piece`` ids, and a batch of pieces is divided into k windows: each piece
starts as a partition with one filled part, the two partitions of the largest
imbalance merge with opposing order (largest part of one with the smallest part of the
other), until one is left with near-equal parts.  k starts at the least possible count and
rises whenever a part exceeds the capacity.  Batches are formed where documents are
read, so nothing is shuffled; a batch holds ``batch`` pieces at most, and a window never
crosses batches.

A window's length on the device is ``capacity``, except where it holds a power of two of
ids, which needs no padding.

Defined results: null and empty texts hold the closing id alone; repeated rows and
null ids are packed row by row; an empty table gives no pieces; window numbers are the
Spark partition number times 2^32 plus a counter, the same whenever the same files are
read with the same settings; columns beside id and text are not read.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_blocks, texts_of

CAPACITY = 2048
PIECE = 256
BATCH = 8192
END = 1
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Both libraries hold the same vocabulary and agree on these characters (tested);
# any other text, and one with the name of a special token, takes the slower library.
_PLAIN = re.compile("[\\n\\t -~¡-¬®-ſ]*")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _ranks(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> list[int]:
    """Ids of the text by the tokenizer file; ``ranks`` is the same vocabulary for the faster library, if there is one."""
    if ranks and "<|" not in text and _PLAIN.fullmatch(text) and _longest_word(text) < 2000:
        return _ranks(ranks).encode_ordinary(text)
    return _tokenizer(tokenizer).encode(text, add_special_tokens=False).ids


def _longest_word(text: str) -> int:
    return max(map(len, text.split()), default=0)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` divided into k parts of near-equal sums (largest differencing method)."""
    heap = []  # (negative imbalance, number, filled parts as (sum, items), largest first; others are empty)
    for i, s in enumerate(sizes):
        heap.append((-s, i, [(s, [i])]))
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        _, _, x = heapq.heappop(heap)
        _, _, y = heapq.heappop(heap)
        over = max(0, len(x) + len(y) - k)  # parts of both that must share
        # y's smallest empty parts meet x's largest, and x's empty parts meet y's largest
        merged = x[:len(x) - over] + y[:len(y) - over]
        for j in range(over):
            a, b = x[len(x) - over + j], y[len(y) - 1 - j]
            merged.append((a[0] + b[0], a[1] + b[1]))
        merged.sort(key=lambda part: -part[0])
        least = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (least - merged[0][0], number, merged))
        number += 1
    parts = [items for _, items in heap[0][2]] if heap else []
    return parts + [[] for _ in range(k - len(parts))]


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Indices of ``sizes`` by window: near-equal sums, none beyond the capacity, as few windows as that allows."""
    if not sizes:
        return []
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = differencing(sizes, k)
        worst = max(sum(sizes[i] for i in p) for p in parts)
        if worst <= capacity:
            return [p for p in parts if p]
        k += 1


def pieces_of(total: int, capacity: int, piece: int) -> tuple[list[int], list[int]]:
    """Lengths of the whole windows of a document, and of the pieces of what is left."""
    rest = total % capacity
    return [capacity] * (total // capacity), [piece] * (rest // piece) + [rest % piece] * (rest % piece > 0)


_COLUMNS = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
            ("sequence_id", pa.int64()), ("offset", pa.int64())]


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, piece: int = PIECE,
         batch: int = BATCH, with_ids: bool = True, tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked, the ids."""
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    ids_type = ", ids array<int>" if with_ids else ""
    schema = (f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              f"`offset` long{ids_type}")
    names = [key, *(n for n, _ in _COLUMNS)] + ["ids"] * with_ids

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        count, waiting, arrow_key = 0, [], None

        def emit(rows: list[tuple]):
            keys = pa.array([r[0] for r in rows], arrow_key)
            cols = [pa.array([r[j + 1] for r in rows], t) for j, (_, t) in enumerate(_COLUMNS)]
            if with_ids:
                ends = np.cumsum([0, *(len(r[7]) for r in rows)], dtype=np.int32)
                ids = np.concatenate([r[7] for r in rows]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)))
            return pa.RecordBatch.from_arrays([keys, *cols], names)

        def flush():
            nonlocal count
            rows = []
            for part in windows([len(w[2]) for w in waiting], capacity):
                at = 0
                for i in sorted(part):
                    k, start, ids, total = waiting[i]
                    rows.append((k, start, len(ids), zlib.crc32(ids.tobytes()), total, first + count, at, ids))
                    at += len(ids)
                count += 1
            waiting.clear()
            return rows

        for block in text_blocks(batches, text, 2 << 20):
            arrow_key = block.column(0).type
            rows = []
            for k, raw in zip(block.column(0).to_pylist(), texts_of(block, text)):
                ids = np.array([*token_ids(raw.decode(), tokenizer, ranks), END], "<u4")
                whole, rest = pieces_of(len(ids), capacity, piece)
                at = 0
                for n in whole:
                    part = ids[at:at + n]
                    rows.append((k, at, n, zlib.crc32(part.tobytes()), len(ids), first + count, 0, part))
                    at, count = at + n, count + 1
                for n in rest:
                    waiting.append((k, at, ids[at:at + n], len(ids)))
                    at += n
                if len(waiting) >= batch:
                    rows += flush()
            if rows:
                yield emit(rows)
        if waiting:
            yield emit(flush())

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)
