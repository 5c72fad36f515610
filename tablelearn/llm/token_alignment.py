"""Alignment of two tokenizers' tokens by products of incidence matrices.

Both tokenizers cut the same bytes (a space and the text).  Over a slice of documents, laid end to end, two incidence
matrices in compressed rows say which bytes each token covers.  The row product A·Bᵀ (Gustavson: each entry of a
row of A fetches a row of Bᵀ, equal columns add up) gives the overlap links and the number of
shared bytes.  Where a link follows one with neither token in common, both
tokenizers end at the same byte: there a group of tokens ends.  The product of the token-group incidences,
tokens of one id and group added first, gives the links of ids that share a group, with their number.

Counts over the corpus: each document's id pairs are stored once per block of documents; blocks pre-aggregate the
pairs (a pair is one row of a block, however frequent it is), counts are summed by pair, joined back to the
blocks' pairs, and a block's documents meet the counts of their pairs in one group of bounded size.

Defined results: a null or empty text, and one whose tokens' bytes differ from a space and the text (a tokenizer that
changes the text), has no tokens, zeros, and the empty string as digest; repeated rows and null ids are
documents of their own; names of special tokens are plain text; texts may be of any length; an empty table gives an
empty result; columns beside id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, ship_package, text_blocks, texts_of

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
A_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the same vocabulary for the faster library
B_FILE = public_tokenizers.path("piece_bpe_32k.model")
SLICE = 1 << 20  # bytes of text whose matrices are held at once
BLOCK = 8 << 20  # bytes of text whose id pairs are aggregated at once
PRODUCTS = 1 << 21  # entries that one run of rows of a product may have
ID_BITS = 20  # of an id within a pair
CROWDED = 64  # products of a group beyond which tokens of one id are added first

# Characters on which both libraries of tokenizer A agree (as for packing), in words of moderate length.
_PLAIN = re.compile("[\\n\\t -~¡-¬®-ſ]*")


# ---- compressed rows

@dataclass
class Rows:
    """A sparse matrix in compressed rows."""
    start: np.ndarray  # of each row in the other two, and the end of the last
    column: np.ndarray
    value: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.start) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.start))

    def transposed(self) -> Rows:
        order = self.column.argsort(kind="stable")
        start = np.r_[0, np.cumsum(np.bincount(self.column, minlength=self.width))]
        return Rows(start, self.row_of()[order], self.value[order], self.height)

    def part(self, first: int, last: int) -> Rows:
        s, e = self.start[first], self.start[last]
        return Rows(self.start[first:last + 1] - s, self.column[s:e], self.value[s:e], self.width)


def added(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values."""
    if not len(key):
        return key, value
    if (key[1:] < key[:-1]).any():
        order = key.argsort(kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(value, first)


def product(x: Rows, y: Rows, most: int = PRODUCTS):
    """Runs of rows of x·y as (row, column, value); each row of x adds up the rows of y that its entries name."""
    fetched = y.start[x.column + 1] - y.start[x.column]
    upto = np.r_[0, np.cumsum(fetched)][x.start]
    first = 0
    while first < x.height:
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + most, "right")) - 1)
        p, n = x.part(first, last), fetched[x.start[first]:x.start[last]]
        ends = np.cumsum(n)
        at = np.repeat(y.start[p.column] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        key = np.repeat(p.row_of(), n) * y.width + y.column[at]
        key, value = added(key, np.repeat(p.value, n) * y.value[at])
        yield first + key // y.width, key % y.width, value
        first = last


def covers(lengths: np.ndarray) -> Rows:
    """Token-byte incidence of tokens laid end to end."""
    start = np.r_[0, np.cumsum(lengths)]
    return Rows(start, np.arange(start[-1]), np.ones(start[-1], np.int64), int(start[-1]))


def overlap_links(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, shared bytes), by both."""
    parts = [*product(covers(a_lengths), covers(b_lengths).transposed())]
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 3


def groups_of(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Group of each token of A and of B, and the number of groups, from the overlap links."""
    ends = (np.diff(a) > 0) & (np.diff(b) > 0)
    group = np.r_[0, np.cumsum(ends)][:len(a)]
    of_a, of_b = np.empty(n_a, np.int64), np.empty(n_b, np.int64)
    of_a[a], of_b[b] = group, group
    return of_a, of_b, int(group[-1]) + 1 if len(group) else 0


def by_group(ids: np.ndarray, group: np.ndarray, n: int, crowded: np.ndarray) -> Rows:
    """Group-id incidence with counts: one entry a token, or one an id where the group is crowded."""
    many = crowded[group]
    key, value = added(group[many] << 32 | ids[many], np.ones(int(many.sum()), np.int64))
    row, column = np.r_[group[~many], key >> 32], np.r_[ids[~many], key & 0xFFFFFFFF]
    value = np.r_[np.ones(len(row) - len(key), np.int64), value]
    order = row.argsort(kind="stable")
    return Rows(np.r_[0, np.cumsum(np.bincount(row, minlength=n))], column[order], value[order], 1 << 32)


def shared_links(a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, n: int,
                 doc_of_group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, id pair, links) for the ids that share a group: the product of the incidences of A's ids and B's ids with groups."""
    crowded = np.bincount(a_group, minlength=n) * np.bincount(b_group, minlength=n) > CROWDED
    x, y = by_group(a_ids, a_group, n, crowded), by_group(b_ids, b_group, n, crowded)
    keys, links = [], []
    tokens = Rows(np.arange(len(x.column) + 1), x.row_of(), x.value, n)  # A's entries by group, a row each
    for row, b_id, value in product(tokens, y):
        key, value = added(doc_of_group[tokens.column[row]] << 2 * ID_BITS | x.column[row] << ID_BITS | b_id, value)
        keys.append(key)
        links.append(value)
    if not keys:
        return (np.empty(0, np.int64),) * 3
    key, links = added(np.concatenate(keys), np.concatenate(links))
    return key >> 2 * ID_BITS, key & (1 << 2 * ID_BITS) - 1, links


# ---- the two tokenizers

class Tokens:
    """Ids of a text by one tokenizer, and the bytes of every id."""

    def __init__(self, bytes_of: list[bytes], encode, first: bytes, last: bytes):
        self.bytes_of, self.encode = bytes_of, encode
        self.length = np.array([len(b) for b in bytes_of], np.int64)
        # an id in a listing of groups with what follows it: another token of the group, or its end
        self.written = [str(i).encode() + end for i in range(len(bytes_of)) for end in (first, last)]

    def covers(self, ids: list[int], raw: bytes) -> bool:
        return b"".join(map(self.bytes_of.__getitem__, ids)) == raw


def _byte_characters() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def tokenizer_a(path: str = A_FILE, ranks: str | None = A_RANKS) -> Tokens:
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    fast = None
    if ranks:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    with open(path, encoding="utf-8") as f:
        entries = json.load(f)
    alphabet, bytes_of = _byte_characters(), [b""] * slow.get_vocab_size()
    for entry, i in entries["model"]["vocab"].items():
        bytes_of[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()

    def encode(texts: list[str]) -> list[list[int]]:
        out = []
        for t in texts:
            t = " " + t
            plain = fast and _PLAIN.fullmatch(t) and max(map(len, t.split()), default=0) < 2000
            out.append(fast.encode_ordinary(t) if plain else slow.encode(t, add_special_tokens=False).ids)
        return out

    return Tokens(bytes_of, encode, b",", b"|")


@lru_cache(maxsize=2)
def tokenizer_b(path: str = B_FILE) -> Tokens:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    byte = re.compile("<0x([0-9A-F]{2})>")
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    bytes_of = [bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
    return Tokens(bytes_of, lambda texts: model.encode(texts, num_threads=1), b",", b";")


# ---- slices of documents

@dataclass
class Aligned:
    """Figures of a slice's documents, and the id pairs of each."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    listing: list
    doc: np.ndarray
    pair: np.ndarray
    links: np.ndarray
    tokens: tuple | None  # of A and B: ids and groups; the overlap links


def aligned(texts: list[bytes], a: Tokens, b: Tokens, with_tokens: bool = False) -> Aligned:
    n = len(texts)
    n_a, n_b, n_groups = (np.zeros(n, np.int64) for _ in range(3))
    listing = [b""] * n
    filled = [i for i, t in enumerate(texts) if t]
    strings = [texts[i].decode() for i in filled]
    a_lists, b_lists, used = [], [], []
    for i, x, y in zip(filled, a.encode(strings), b.encode(strings)):
        raw = b" " + texts[i]
        if a.covers(x, raw) and b.covers(y, raw):
            used.append(i)
            a_lists.append(x)
            b_lists.append(y)
    used = np.array(used, np.int64)
    n_a[used], n_b[used] = [len(x) for x in a_lists], [len(y) for y in b_lists]
    a_ids, b_ids = (np.array([i for x in lists for i in x], np.int64) for lists in (a_lists, b_lists))
    left, right, shared = overlap_links(a.length[a_ids], b.length[b_ids])
    a_group, b_group, groups = groups_of(left, right, len(a_ids), len(b_ids))
    a_doc = np.repeat(used, n_a[used])
    doc_of_group = np.zeros(groups, np.int64)
    doc_of_group[a_group] = a_doc
    n_groups += np.bincount(doc_of_group, minlength=n)
    # the listing: A's tokens of a group, then B's; a token's place is its own number and the tokens of the other side before it
    a_ends, b_ends = np.diff(np.r_[a_group, groups]) > 0, np.diff(np.r_[b_group, groups]) > 0
    a_upto, b_upto = np.cumsum(np.bincount(a_group, minlength=groups)), np.cumsum(np.bincount(b_group, minlength=groups))
    text = np.empty(len(a_ids) + len(b_ids), object)
    text[np.arange(len(a_ids)) + np.r_[0, b_upto][a_group]] = [*map(a.written.__getitem__, (2 * a_ids + a_ends).tolist())]
    text[np.arange(len(b_ids)) + a_upto[b_group]] = [*map(b.written.__getitem__, (2 * b_ids + b_ends).tolist())]
    end = 0
    for i in used:
        start, end = end, end + int(n_a[i] + n_b[i])
        listing[i] = b"".join(text[start:end])[:-1]
    doc, pair, links = shared_links(a_ids, b_ids, a_group, b_group, groups, doc_of_group)
    tokens = (a_ids, b_ids, a_group, b_group, left, right, shared) if with_tokens else None
    return Aligned(n_a, n_b, n_groups, listing, doc, pair, links, tokens)


def token_links(docs: DataFrame, key: str = "doc_id", text: str = "text", a_file: str = A_FILE, a_ranks: str | None = A_RANKS,
                b_file: str = B_FILE) -> DataFrame:
    """One row per document: ids and groups of its tokens by both tokenizers, and its overlap links (tokens numbered from 0, shared bytes)."""
    ship_package(docs.sparkSession)
    names = ["a_ids", "b_ids", "a_group", "b_group", "link_a", "link_b", "link_bytes"]
    schema = T.StructType([docs.schema[key], *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in names)])

    def run(batches):
        for block in text_blocks(batches, text, SLICE):
            got = aligned(texts_of(block, text), tokenizer_a(a_file, a_ranks), tokenizer_b(b_file), True)
            a_ids, b_ids, a_group, b_group, left, right, shared = got.tokens
            a_end, b_end, g_end = (np.r_[0, np.cumsum(x)] for x in (got.n_a, got.n_b, got.n_groups))
            l_end = np.searchsorted(left, a_end)
            cols = []
            for v, end, base in ((a_ids, a_end, None), (b_ids, b_end, None), (a_group, a_end, g_end), (b_group, b_end, g_end),
                                 (left, l_end, a_end), (right, l_end, b_end), (shared, l_end, None)):
                v = v if base is None else v - np.repeat(base[:-1], np.diff(end))
                cols.append(pa.ListArray.from_arrays(pa.array(end.astype(np.int32)), pa.array(v.astype(np.int32))))
            yield pa.RecordBatch.from_arrays([block.column(block.schema.get_field_index(key)), *cols], [key, *names])

    return docs.select(*dict.fromkeys([key, text])).mapInArrow(run, schema)


# ---- corpus counts

_FIGURES = [("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long"), ("groups_sha256", "string")]


def _lists(values: np.ndarray, ends: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, kind))


def document_pairs(docs: DataFrame, key: str, text: str, a_file: str, a_ranks: str | None, b_file: str) -> DataFrame:
    """A row per document: ``k``, its figures, its id pairs with their links, its block; a block's first row has the block's pairs and their documents."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("k", docs.schema[key].dataType), T.StructField("block", T.LongType()),
                           *(T.StructField(c, T.LongType() if t == "long" else T.StringType()) for c, t in _FIGURES),
                           T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("links", T.ArrayType(T.IntegerType())),
                           T.StructField("block_pairs", T.ArrayType(T.LongType())), T.StructField("block_docs", T.ArrayType(T.IntegerType()))])

    def run(batches):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def emit():
            pairs, counts = np.unique(np.concatenate([g.pair for _, g in held]), return_counts=True)
            for i, (keys, g) in enumerate(held):
                n = len(keys)
                ends = np.searchsorted(g.doc, np.arange(n + 1))
                upto = np.r_[0, np.cumsum(g.links)][ends]
                own = (pairs, counts) if i == 0 else (pairs[:0], counts[:0])
                first = np.r_[0, np.full(n, len(own[0]))]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.full(n, number)), pa.array(g.n_a), pa.array(g.n_b), pa.array(g.n_groups), pa.array(np.diff(upto)),
                     pa.array(g.listing, pa.string()), _lists(g.pair, ends, pa.int64()), _lists(g.links, ends, pa.int32()),
                     _lists(own[0], first, pa.int64()), _lists(own[1], first, pa.int32())], schema.names)

        for part in text_blocks(batches, "t", SLICE):
            texts = texts_of(part, "t")
            got = aligned(texts, tokenizer_a(a_file, a_ranks), tokenizer_b(b_file))
            got.listing = [hashlib.sha256(x).hexdigest() if x else "" for x in got.listing]  # only the digests are held
            held.append((part.column(0), got))
            size += sum(map(len, texts))
            if size >= BLOCK:
                yield from emit()
                number, held, size = number + 1, [], 0
        if held:
            yield from emit()

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, a, docs, best): documents that hold the id pair linked, and whether no pair of the same id of A has more."""
    rows = blocks.where(F.size("block_pairs") > 0).select(F.explode(F.arrays_zip("block_pairs", "block_docs")).alias("x"))
    counts = rows.groupBy(F.col("x.block_pairs").alias("pair")).agg(F.sum("x.block_docs").alias("docs"))
    counts = counts.withColumn("a", F.shiftright("pair", ID_BITS).cast("int"))
    top = counts.groupBy(F.col("a").alias("_a")).agg(F.max("docs").alias("_top"))
    return counts.join(top, F.col("a") == F.col("_a")).select("pair", "a", "docs", (F.col("docs") == F.col("_top")).alias("best"))


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", a_file: str = A_FILE, a_ranks: str | None = A_RANKS,
          b_file: str = B_FILE) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every document."""
    with Scratch(docs.sparkSession, "align") as own:
        rows = own.save(document_pairs(docs, key, text, a_file, a_ranks, b_file))
        counts = own.save(pair_counts(rows))
        asked = rows.where(F.size("block_pairs") > 0).select(F.col("block").alias("of_block"), F.explode("block_pairs").alias("pair"))
        known = asked.join(counts.select("pair", (F.col("docs") * 2 + F.col("best").cast("long")).alias("v")), "pair")
        kept = [c for c, _ in _FIGURES]
        schema = T.StructType([T.StructField("k", rows.schema["k"].dataType), *(rows.schema[c] for c in kept),
                               T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

        def judge(documents: pa.Table, found: pa.Table) -> pa.Table:
            pair, value = found.column("pair").to_numpy(), found.column("v").to_numpy()
            order = pair.argsort()
            pair, value = pair[order], value[order]
            out = []
            for batch in documents.to_batches():
                lists, links = batch.column(batch.schema.get_field_index("pairs")), batch.column(batch.schema.get_field_index("links"))
                n = lists.value_lengths().to_numpy(zero_copy_only=False)
                v = value[np.searchsorted(pair, lists.flatten().to_numpy())] if len(pair) else value
                m = links.flatten().to_numpy().astype(np.int64)
                ends = np.r_[0, np.cumsum(n)]
                sums = [np.diff(np.r_[0, np.cumsum(x)][ends]) for x in (m * (v & 1), m * (v >> 1))]
                columns = [batch.column(batch.schema.get_field_index(c)) for c in ["k", *kept]]
                out.append(pa.RecordBatch.from_arrays([*columns, *map(pa.array, sums)], schema.names))
            return pa.Table.from_batches(out, documents.select(["k", *kept]).schema.append(pa.field("n_best", pa.int64())).append(pa.field("count_sum", pa.int64())))

        judged = (rows.select("k", "block", *kept, "pairs", "links").groupBy("block")
                  .cogroup(known.groupBy("of_block")).applyInArrow(judge, schema))
        order = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return own.save(judged.select(F.col("k").alias(key), *order), keep=True)
