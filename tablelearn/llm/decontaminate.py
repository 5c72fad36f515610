"""Benchmark decontamination by suffix arrays over training shards.

A shard is a block of whole documents inside one Spark partition.  Its words
become benchmark word numbers (0: not in any item); the suffixes that can hold a
whole window are sorted by their next words, and every test suffix is found by
binary search in each shard.  Consecutive hits of one item form the verbatim
matches, of which the longest is reported with its place.  No shuffle is needed:
a document is judged where it is read, so hot sources and copies do not matter.

Defined results: a null or empty text has no words and is clean; an item without
words never matches; an item of fewer than ``window`` words is one window; items
that share an id count once, a null id reads as the empty string; repeated
documents are judged row by row; an empty benchmark leaves all documents clean;
input columns stay as they are, except one named like the result (replaced).
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_column, texts_of

WINDOW = 13
MAX_BENCHMARK_BYTES = 16 << 20  # a benchmark beyond this is searched in several parts, one after the other

# words are runs of other bytes than these ranges, after A-Z became a-z
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b
    for b in range(256))

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.IntegerType())),
    T.StructField("longest", T.IntegerType()), T.StructField("longest_item", T.StringType()),
    T.StructField("longest_at", T.IntegerType()),
])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Windows:
    """The windows of one part of the benchmark, as big-endian word numbers."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.number: dict[bytes, int] = {}
        self.texts: dict[tuple[int, ...], list[str]] = defaultdict(list)
        for item, words in items:
            if words:
                seq = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words)
                self.texts[seq].append(item)
        self.texts = {s: sorted(set(i)) for s, i in self.texts.items()}
        self.width = 2 if len(self.number) < 65000 else 4
        places: dict[int, dict[bytes, list]] = defaultdict(lambda: defaultdict(list))
        for t, seq in enumerate(self.texts):
            raw = np.array(seq, f">u{self.width}").tobytes()
            size = min(window, len(seq))
            for j in range(len(seq) - size + 1):
                places[size][raw[j * self.width:(j + size) * self.width]].append((t, j))
        self.items = list(self.texts.values())
        # for each size: sorted distinct windows, and where in which text each occurs
        self.by_size = {}
        for size, found in places.items():
            keys = sorted(found)
            self.by_size[size] = (np.array(keys, f"S{size * self.width}"), [found[k] for k in keys])


def shard_hits(x: np.ndarray, win: Windows) -> list[tuple[int, int, int, list]]:
    """(start, size, window number, its places) of every window occurrence in the word numbers ``x``."""
    n, out = len(x), []
    zeros = np.append(np.flatnonzero(x == 0), n)
    ahead = zeros[np.searchsorted(zeros, np.arange(n))] - np.arange(n)  # known words from here on
    for size, (keys, places) in win.by_size.items():
        at = np.flatnonzero(ahead >= size)
        if not len(at):
            continue
        words = x[at[:, None] + np.arange(size)].astype(f">u{win.width}")
        suffix = np.ascontiguousarray(words).view(f"S{size * win.width}").ravel()
        order = np.argsort(suffix, kind="stable")
        ranked = suffix[order]  # the shard's suffix array, to the depth of a window
        lo, hi = np.searchsorted(ranked, keys, "left"), np.searchsorted(ranked, keys, "right")
        for k in np.flatnonzero(hi > lo):
            for p in at[order[lo[k]:hi[k]]]:
                out.append((int(p), size, places[k]))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", out: str = "contamination", window: int = WINDOW,
                  keep: list[str] | None = None, max_benchmark_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """``docs`` with a struct ``out``: words, hit words, item ids, hit spans, longest verbatim match.

    ``spans`` lists start and end of the hit word runs, flat.  The benchmark is
    measured first; each part that is sent to the tasks has a bounded size, and
    a large benchmark is searched part by part along the same rows.
    """
    total = benchmark.select(F.sum(F.coalesce(F.octet_length(item_text), F.lit(0)) + 64).alias("b")).first()["b"] or 0
    parts = max(1, math.ceil(total / max_benchmark_bytes))
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    df = docs
    for part in range(parts):
        rows = (benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(item_text).alias("t"))
                .where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).where("t is not null").collect())
        win = Windows([(r["i"], words_of(r["t"].encode())) for r in rows], window)
        last = part == parts - 1
        df = add_column(df, out, RESULT, _judge(win, text, out, part > 0), text,
                        keep + [text] * (not last and text not in keep), reads=(out,) * (part > 0))
    return df


def _judge(win: Windows, text: str, out: str, again: bool):
    number = win.number

    def fill(block: pa.RecordBatch) -> pa.Array:
        docs = [words_of(t) for t in texts_of(block, text)]
        ends = np.cumsum([len(w) + 1 for w in docs])
        x = np.zeros(ends[-1], np.uint32)
        for d, w in enumerate(docs):
            get = number.get
            x[ends[d] - len(w) - 1:ends[d] - 1] = [get(v, 0) for v in w]
        found: dict[int, list] = defaultdict(list)
        for hit in shard_hits(x, win):
            found[int(np.searchsorted(ends, hit[0], "right"))].append(hit)
        before = block.column(block.schema.get_field_index(out)).to_pylist() if again else [None] * len(docs)
        result = []
        for d, (w, old) in enumerate(zip(docs, before)):
            spans = np.array((old or {}).get("spans") or [], np.int64).reshape(-1, 2)
            items = set((old or {}).get("items") or [])
            best = ((old or {}).get("longest") or 0, (old or {}).get("longest_item"), (old or {}).get("longest_at"))
            if d in found:
                first = int(ends[d]) - len(w) - 1
                starts = np.array([h[0] - first for h in found[d]])
                spans = merged(np.vstack([spans, np.stack([starts, starts + [h[1] for h in found[d]]], 1)]))
                lines = defaultdict(list)
                for p, size, places in found[d]:
                    for t, j in places:
                        items.update(win.items[t])
                        lines[t, p - first - j].append((p - first, p - first + size))
                for (t, _), runs in lines.items():  # one text along one diagonal: runs of overlapping windows
                    for s, e in merged(np.array(runs)):
                        if e - s > best[0] or e - s == best[0] and (s, win.items[t][0]) < (best[2], best[1]):
                            best = (int(e - s), win.items[t][0], int(s))
            result.append({"n_words": len(w), "n_hit": int((spans[:, 1] - spans[:, 0]).sum()), "items": sorted(items),
                           "spans": spans.ravel().tolist(), "longest": best[0], "longest_item": best[1],
                           "longest_at": best[2]})
        return pa.array(result, _ARROW)

    return fill


_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                    ("spans", pa.list_(pa.int32())), ("longest", pa.int32()), ("longest_item", pa.string()),
                    ("longest_at", pa.int32())])


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of [start, end) spans as sorted disjoint spans (touching ones join)."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], np.append(reach[at[1:] - 1], reach[-1])], 1)


def digest(df: DataFrame, out: str = "contamination") -> list:
    """The contract's columns from the result struct."""
    items = F.col(f"{out}.items")
    hit, words = F.col(f"{out}.n_hit"), F.col(f"{out}.n_words")
    return [words.alias("n_words"), hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", F.array_sort(items)).cast("binary"), 256).alias("items_sha256"),
            contaminated(out).alias("contaminated")]


def contaminated(out: str = "contamination"):
    """At least a twentieth of the words are hit."""
    hit, words = F.col(f"{out}.n_hit"), F.col(f"{out}.n_words")
    return (hit > 0) & (20 * hit >= words)


