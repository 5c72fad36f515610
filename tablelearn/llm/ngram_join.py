"""Size-aware Jaccard self-join on word shingles, and its connected groups.

Equal shingle sets are one node, named by a 128-bit digest, so copies cost
one partial minimum and are never paired.  Small sets (size up to a boundary)
enumerate their subsets of the sizes that a partner can share; in each list of a
subset all are compared with the smallest set there, which is complete: if two
sets share a subset that makes them similar, both are as similar to the smallest one.
Large sets put their rarest shingles (a prefix that two similar sets must
share) into inverted lists.  The lists are scanned twice: first every set against
one pivot of its list and size class, which joins groups of near copies without
pairing them; then only pairs whose sets are still in different groups and
whose places in the prefixes and outlines (parities of the shingles in hash cells, whose odd
differences bound the symmetric difference from below) allow the similarity.  Candidates are verified on the whole sets.  The boundary is chosen from the sizes of all sets by comparing
the number of subsets with the expected length of the scanned lists.

The order of shingles is by how often their hash cell (of ``CELLS``) occurs in
all documents, then by hash; any order gives the same links.

Defined results: null, empty or blank text has an empty set, links with nothing and is
its own group; fewer than ``k`` words are one shingle; repeated rows come back row
by row; a null id never is a group's name unless all ids of the group are null; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHash, connected_components, has_bit, joined_bits, shingle_hashes, signed, summed_vectors, text_blocks, texts_of

CELLS = 1 << 20  # cells of the frequency table that is sent to the tasks (4 MB)
SKETCH = 16  # longs of the outline of a set (parities of its shingles in 64 cells a long), by which pairs are excluded before their sets are fetched
SMALL = 40  # sizes above this are never small


def shingle_set(text: bytes, k: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of the text, A-Z in lower case."""
    return np.unique(shingle_hashes(hashes.of(text.lower().split()), k))


def node_of(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def missing(n: int, num: int, den: int) -> int:
    """How many of n elements may be absent from a partner: similarity num/den or more."""
    return n - -(-num * n // den)


def subsets(n: int, num: int, den: int) -> int:
    return sum(math.comb(n, d) for d in range(missing(n, num, den) + 1))


def boundary(sizes: np.ndarray, num: int, den: int) -> int:
    """Largest set size whose sets enumerate subsets, by expected cost; ``sizes``: sets of each size below SMALL.

    A subset costs one list entry; a prefix shingle costs an entry and the comparison
    (VERIFY entries) with the sets of fitting size that it meets in its cell.
    """
    verify, best, best_cost, running = 20, 0, 0.0, 0.0
    for n in range(1, SMALL):
        low, high = -(-num * n // den), min(SMALL - 1, n * den // num)
        partners = sizes[low:high + 1].sum() * (missing(n, num, den) + 1) / CELLS
        running += sizes[n] * (subsets(n, num, den) - (missing(n, num, den) + 1) * (1 + verify * partners))
        if sizes[n] and running <= best_cost or not sizes[n] and best == n - 1:
            best, best_cost = n, running
    # sets whose only partners are equal sets need no list at all
    return max(best, max(n for n in range(SMALL) if missing(n, num, den) == 0))


def subset_keys(s: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """(size, sum of hashes) of every subset of s that a similar set may share."""
    out = [(len(s), 0)]
    values = [int(v) for v in s]

    def drop(start: int, left: int, size: int, total: int) -> None:
        for i in range(start, len(values)):
            out.append((size - 1, total + values[i]))
            if left > 1:
                drop(i + 1, left - 1, size - 1, total + values[i])

    if (m := missing(len(s), num, den)) > 0:
        drop(0, m, len(s), 0)
    whole = sum(values)
    return [(size, (whole - gone) % (1 << 64)) for size, gone in out]


def ngram_components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(key, n_shingles, component_id, text_hash) for every row of ``docs``; links need num/den or more.

    ``text_hash`` is xxhash64 of the text, to find the row again where ids repeat.
    """
    spark = docs.sparkSession
    with Scratch(spark, "ngram-join") as own:
        docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("th"))

        def cells(batches):
            total, hashes = np.zeros(CELLS + SMALL), WordHash()
            for block in text_blocks(batches, "text"):
                sets = [shingle_set(t, k, hashes) for t in texts_of(block, "text")]
                if sets:
                    total[:CELLS] += np.bincount((np.concatenate(sets) >> np.uint64(44)).astype(np.int64), minlength=CELLS)
                    total[CELLS:] += np.bincount([min(len(s), SMALL - 1) for s in sets], minlength=SMALL)
            return total

        total = summed_vectors(docs, cells, CELLS + SMALL, kind="i4")
        sizes = total[CELLS:]
        sizes[SMALL - 1] = 0
        small = boundary(sizes, num, den)
        listed = -(-num * (small + 1) // den)  # sets from this size on can have a large partner
        often = spark.sparkContext.broadcast(np.minimum(total[:CELLS], 2**32 - 1).astype(np.uint32))

        def sign(batches):
            hashes = WordHash()
            for block in text_blocks(batches, "text"):
                nodes, ns, prefixes, keys, sketches = [], [], [], [], []
                for t in texts_of(block, "text"):
                    s = shingle_set(t, k, hashes)
                    n = len(s)
                    ns.append(n)
                    nodes.append(node_of(s) if n else None)
                    prefix = None
                    if n >= listed:
                        rank = np.lexsort((s, often.value[(s >> np.uint64(44)).astype(np.int64)]))
                        prefix = signed(s[rank[:missing(n, num, den) + 1]])
                    prefixes.append(prefix)
                    odd = np.bincount((s % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
                    sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                    keys.append([{"c": c, "s": v - (1 << 64) if v >> 63 else v} for c, v in subset_keys(s, num, den)]
                                if 0 < n <= small else None)
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), block.column(2), pa.array(ns, pa.int64()), pa.array(nodes, pa.binary()),
                     pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())),
                     pa.array(keys, pa.list_(pa.struct([("c", pa.int32()), ("s", pa.int64())])))],
                    ["id", "th", "n", "node", "prefix", "sketch", "subsets"])

        kind = docs.schema["id"].dataType.simpleString()
        signed_docs = own.save(docs.mapInArrow(
            sign, f"id {kind}, th long, n long, node binary, prefix array<long>, sketch array<long>, subsets array<struct<c:int,s:long>>"))
        rows = signed_docs.select("id", "th", "n", "node")
        reps = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("rep"))
        reps = own.save(reps)
        # one row per node; lists are unfolded from it where they are needed
        nodes = own.save(signed_docs.where("prefix is not null or subsets is not null").select("node", "n", "prefix", "sketch", "subsets")
                         .dropDuplicates(["node"]))
        every = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "token")).select(
            "token", "node", (F.shiftleft("n", 24) + F.col("pos")).alias("place"))
        subs = nodes.select("node", "n", F.explode("subsets").alias("x")).select("node", "n", "x.c", "x.s")

        shared = every.groupBy("token").agg(F.count("*").alias("_c")).where("_c > 1").select("token")
        lists = own.save(every.join(shared, "token").select(
            "token", "node", F.shiftright("place", 24).alias("n"), F.col("place").bitwiseAND((1 << 24) - 1).alias("pos")))
        band = F.floor(F.log(F.col("n").cast("double")) / math.log(den / num) * 0.999)
        classed = lists.withColumn("band", band)
        pivots = classed.groupBy("token", "band").agg(F.min("node").alias("pivot"), F.count("*").alias("_c")).where("_c > 1")
        heavy = (classed.join(pivots, ["token", "band"]).where("node <> pivot")
                 .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())
        least = subs.groupBy("c", "s").agg(F.min(F.struct("n", "node")).alias("m"), F.count("*").alias("_c")).where("_c > 1")
        light = (subs.join(least, ["c", "s"]).where("node <> m.node")
                 .where((F.lit(den) * F.col("c")) >= F.lit(num) * (F.col("n") + F.col("m.n") - F.col("c")))
                 .select(F.least("node", "m.node").alias("a"), F.greatest("node", "m.node").alias("b")).distinct())
        tried = own.save(heavy.unionByName(light).distinct())
        sx, sy = (nodes.select(F.col("node").alias(f"k{z}"), F.col("n").alias(f"n{z}"), F.col("sketch").alias(f"s{z}")) for z in "xy")
        likely = tried.join(sx, F.col("a") == F.col("kx")).join(sy, F.col("b") == F.col("ky")).where(
            _possible(F.col("sx"), F.col("sy"), F.col("nx"), F.col("ny"), num, den)).select("a", "b")
        links = own.save(_verified(docs, own.save(likely), reps, own, k, num, den))
        groups = connected_components(links, own)

        # what the pivots did not join: pairs of different groups whose prefix places allow the similarity
        g = groups.select(F.col("node").alias("_g"), "component")
        placed = lists.join(g, F.col("node") == F.col("_g"), "left").select(
            "token", "node", "n", "pos", F.coalesce("component", "node").alias("grp"))
        lists_of = placed.groupBy("token").agg(
            F.min("grp").alias("lo"), F.max("grp").alias("hi"), F.min("n").alias("n_lo"), F.max("n").alias("n_hi"),
            F.min("pos").alias("first_pos"), F.count("*").alias("_c"))
        # a list of two needs sets of like size; no partner stands before the first place of a list
        mixed = lists_of.where("lo <> hi").where((F.col("_c") > 2) | (F.lit(den) * F.col("n_lo") >= F.lit(num) * F.col("n_hi"))).select(
            "token", "first_pos")
        left = F.col("n") - F.col("pos")
        placed = placed.join(mixed, "token").where(
            F.lit(den) * left >= F.lit(num) * (left + F.col("pos") + F.col("first_pos"))).drop("first_pos")
        outlines = nodes.select(F.col("node").alias("_k"), "sketch")
        placed = own.save(placed.join(outlines, F.col("node") == F.col("_k")).drop("_k"))
        x, y = (placed.select("token", *(F.col(c).alias(f"{c}_{z}") for c in ("node", "n", "pos", "grp", "sketch"))) for z in "xy")
        share = F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
        rest = (x.join(y, (x["token"] == y["token"]) & (F.col("node_x") < F.col("node_y")) & (F.col("grp_x") != F.col("grp_y"))
                       & (F.lit(den) * F.least("n_x", "n_y") >= F.lit(num) * F.greatest("n_x", "n_y"))
                       & (F.lit(den) * share >= F.lit(num) * (share + F.col("pos_x") + F.col("pos_y")))
                       & _possible(F.col("sketch_x"), F.col("sketch_y"), F.col("n_x"), F.col("n_y"), num, den))
                .select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()
                .join(tried, ["a", "b"], "left_anti"))
        rest = own.save(rest)
        if not rest.isEmpty():
            more = own.save(_verified(docs, rest, reps, own, k, num, den))
            if not more.isEmpty():
                links = own.save(links.unionByName(more))
                groups = connected_components(links, own)

        grouped = reps.join(groups.select(F.col("node").alias("_g"), "component"), F.col("node") == F.col("_g"), "left").select(
            "node", "rep", F.coalesce("component", "node").alias("component"))
        names = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
        named = own.save(grouped.join(names, "component").select(F.col("node").alias("_n"), "component_id",
                                                                 (F.col("component_id").isNotNull()).alias("_known")))
        out = (rows.join(named, F.col("node") == F.col("_n"), "left")
               .select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                       F.when(F.col("_known"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"), F.col("th").alias("text_hash")))
        return own.save(out, keep=True)


def _possible(x, y, n_x, n_y, num: int, den: int):
    """Whether the sketches allow the similarity: a cell whose parities differ holds an element of one set only."""
    apart = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(1, SKETCH)), F.bit_count(x[0].bitwiseXOR(y[0])))
    both = n_x + n_y
    # at most (both - apart) / 2 elements are shared
    return F.lit(den) * (both - apart) >= F.lit(num) * (both + apart)


def _verified(docs: DataFrame, pairs: DataFrame, reps: DataFrame, own: Scratch, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets have the similarity."""
    nodes = own.save(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    asked = nodes.join(reps, "node").select(F.xxhash64("rep").alias("h"))
    wanted = docs.sparkSession.sparkContext.broadcast(joined_bits(asked, "h"))

    def sets(batches):
        hashes = WordHash()
        for batch in batches:  # most documents are not asked for, and need not be shuffled
            some = has_bit(wanted.value, batch.column(1).to_numpy(zero_copy_only=False))
            for block in text_blocks([batch.filter(pa.array(some))], "text"):
                found = [shingle_set(t, k, hashes) for t in texts_of(block, "text")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(s) for s in found], pa.binary()),
                     pa.array([signed(s) for s in found], pa.list_(pa.int64()))], ["node", "s"])

    texts = docs.select("text", F.xxhash64("id").alias("h"))
    # other documents pass the filter too, so the sets are reduced to the asked nodes
    table = own.save(texts.mapInArrow(sets, "node binary, s array<long>").join(nodes, "node", "left_semi")
                     .dropDuplicates(["node"]))
    x, y = (table.select(F.col("node").alias(f"n{z}"), F.col("s").alias(f"s{z}")) for z in "xy")
    both = pairs.join(x, F.col("a") == F.col("nx")).join(y, F.col("b") == F.col("ny"))
    inter = F.size(F.array_intersect("sx", "sy"))
    return (both.select("a", "b", inter.alias("i"), (F.size("sx") + F.size("sy")).alias("t"))
            .where(F.lit(den) * F.col("i") >= F.lit(num) * (F.col("t") - F.col("i"))).select("a", "b"))
