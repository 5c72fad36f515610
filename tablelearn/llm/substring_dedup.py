"""Repeated passages by MinHash banding of paragraphs.

Paragraphs follow the content, not the layout, since a copied passage may start in
the middle of a line: a word position is an anchor where the hash of its next five
words is the least of ``window`` neighbours, and a paragraph is the ``length`` words from an
anchor on.  Any verbatim passage of ``window + length - 1`` words (51) holds a whole
paragraph, the same one in every copy.  Bands of min-hashes over the five-word shingles of a
paragraph are tuned for the recall asked at the similarity; paragraphs that collide in a
band are compared with the least content there by exact Jaccard similarity of
their shingle sets; then, in bands whose contents are still in several groups, the contents of different
groups are compared wherever they share one of their rarest shingles.  Similar contents form components; the first
occurrence of a component in the order of (id, text hash, start) stays, and those in all other
documents go (what repeats inside one document is left to line dedup).

Equal paragraphs are one content: they are counted by partial aggregation and joined
to their component at the end, so a group of copies is never paired.

Defined results: null, empty and short texts (under ``length`` words) have no
paragraphs; a null id comes first; repeated rows (same id and text) are one document, so
its own paragraphs do not count twice; words are compared with A-Z in lower case; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHash, connected_components, has_bit, joined_bits, mix64, shingle_hashes, signed, summed_vectors, text_blocks, texts_of

SHINGLE = 5
LENGTH = 20
WINDOW = 32
CELLS = 1 << 20  # cells of the frequency table that orders the shingles (4 MB); any order gives the same links
SIMILARITY = 0.8
RECALL = 0.99


def tuned_bands(similarity: float, recall: float, most: int = 16) -> tuple[int, int]:
    """(bands, rows) with the fewest min-hashes that reach the recall at the similarity; more rows break ties.

    A band has two rows at least: paragraphs often share one frequent shingle, and would
    collide in bands of a single row without being similar.
    """
    fits = [(b * r, -r, b, r) for r in range(2, most + 1) for b in range(1, most + 1)
            if 1 - (1 - similarity**r) ** b >= recall]
    return min(fits)[2:]


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:len(out) - step], out[step:])
        have += step
    return out


def anchors(h: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Positions in ``h`` (runs of ``counts`` values, one per text) that are the least of ``window`` neighbours of their text.

    A text of fewer values has its least one.  In a run of equal anchors every ``window``-th position is kept.
    """
    n = len(h)
    if n == 0:
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    rel = np.arange(n) - starts[doc]
    chosen = np.zeros(n, bool)
    if n >= window:
        least = _sliding(h, window, np.minimum)
        least = np.where((rel + window <= counts[doc])[:len(least)], least, 0)
        # the largest of the least values of all windows that hold a position
        around = _sliding(np.concatenate([np.zeros(window - 1, h.dtype), least, np.zeros(window - 1, h.dtype)]), window, np.maximum)
        chosen = (h == around) & (around > 0)
    few = np.flatnonzero((counts > 0) & (counts < window))
    if len(few):
        lows = np.zeros(len(counts), h.dtype)
        lows[few] = [h[starts[d]:starts[d] + counts[d]].min() for d in few]
        chosen |= (counts[doc] < window) & (h == lows[doc])
    at = np.flatnonzero(chosen)
    same = np.append(False, (h[at[1:]] == h[at[:-1]]) & (np.diff(at) < window) & (doc[at[1:]] == doc[at[:-1]]))
    if same.any():
        run = np.flatnonzero(~same)
        first = at[run[np.searchsorted(run, np.arange(len(at)), "right") - 1]]
        step = (at - first) // window
        at = at[~same | np.append(False, step[1:] != step[:-1])]
    return at


def paragraphs(texts: list[bytes], hashes: WordHash, length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, shingle hashes) of every paragraph of some texts."""
    words = [t.lower().split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    h = hashes.of(list(chain.from_iterable(words)))
    fits = np.maximum(lengths - length + 1, 0)  # starts whose paragraph fits
    none = np.zeros(0, np.int64)
    if not fits.any():
        return none, none, np.zeros((0, length - SHINGLE + 1), np.uint64)
    s = shingle_hashes(h, SHINGLE)  # also across texts, where no paragraph looks
    doc = np.repeat(np.arange(len(texts)), fits)
    rel = np.arange(len(doc)) - (np.cumsum(fits) - fits)[doc]
    place = (np.cumsum(lengths) - lengths)[doc] + rel
    at = anchors(s[place], fits, window)
    return doc[at], rel[at], s[place[at][:, None] + np.arange(length - SHINGLE + 1)]


def content_hash(s: np.ndarray) -> np.ndarray:
    out = np.zeros(len(s), np.uint64)
    for j in range(s.shape[1]):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + s[:, j])
    return out


def band_keys(s: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band (columns) of every paragraph."""
    keys = np.zeros((len(s), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(s), np.uint64(b + 1))
        for r in range(rows):
            salt = mix64(np.array([b * rows + r + 1], np.uint64))[0]
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + mix64(s ^ salt).min(1))
        keys[:, b] = key
    return keys


def _doc(place: str):
    return F.struct(F.col(f"{place}.id").alias("id"), F.col(f"{place}.th").alias("th"))


def _similar(pairs: DataFrame, sets: DataFrame, num: int) -> DataFrame:
    """The pairs (a, b) of contents whose shingle sets have a similarity of num / 1000 or more."""
    x, y = (sets.select(F.col("content").alias(f"c{z}"), F.col("s").alias(f"s{z}")) for z in "xy")
    inter = F.size(F.array_intersect("sx", "sy"))
    return (pairs.join(x, F.col("a") == F.col("cx")).join(y, F.col("b") == F.col("cy"))
            .where(1000 * inter >= num * (F.size("sx") + F.size("sy") - inter)).select("a", "b"))


def _unjoined(lists: DataFrame, sets: DataFrame, groups: DataFrame, near: DataFrame, own: Scratch, num: int) -> DataFrame:
    """Pairs (a, b) that can be similar, of contents in different groups that stand in bands with several groups.

    Similar sets share one of the rarest shingles of each (so many that the similarity needs one of
    them), in any order of the shingles; so the long list that a frequent phrase makes of a band is
    split without losing a pair.
    """
    with Scratch(sets.sparkSession, "substring-unjoined") as step:  # only the pairs stay
        return own.save(_prefix_pairs(lists, sets, groups, near, step, num))


def _prefix_pairs(lists: DataFrame, sets: DataFrame, groups: DataFrame, near: DataFrame, own: Scratch, num: int) -> DataFrame:
    """The pairs of ``_unjoined``, not yet written."""
    g = groups.select(F.col("node").alias("_g"), "component")
    grouped = own.save(lists.join(g, F.col("content") == F.col("_g"), "left").select(
        "band", "content", F.coalesce("component", "content").alias("grp")))
    mixed = grouped.groupBy("band").agg(F.min("grp").alias("_lo"), F.max("grp").alias("_hi")).where("_lo <> _hi").select("band")
    members = grouped.join(mixed, "band").select("content", "grp").distinct()
    held = own.save(sets.join(members, "content"))

    def cells(batches):
        total = np.zeros(CELLS)
        for b in batches:
            s = b.column(0).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(s.view(np.uint64) >> np.uint64(44), minlength=CELLS)
        return total

    counts = summed_vectors(held.select("s"), cells, CELLS, kind="i4")
    often = held.sparkSession.sparkContext.broadcast(np.minimum(counts, 2**32 - 1).astype(np.uint32))

    def prefixes(batches):
        for b in batches:
            out = []
            for s in b.column(2).to_pylist():
                s = np.array(s, np.int64)
                rank = np.lexsort((s, often.value[s.view(np.uint64) >> np.uint64(44)]))
                out.append(s[rank[:len(s) - -(-num * len(s) // 1000) + 1]])
            sizes = np.array([len(x) for x in b.column(2).to_pylist()], np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes), pa.array(out, pa.list_(pa.int64()))],
                                             ["content", "grp", "n", "prefix"])

    placed = own.save(held.select("content", "grp", "s").mapInArrow(prefixes, "content long, grp long, n int, prefix array<long>")
                      .select("content", "grp", "n", F.posexplode("prefix").alias("pos", "token")))
    split = placed.groupBy("token").agg(F.min("grp").alias("_lo"), F.max("grp").alias("_hi")).where("_lo <> _hi").select("token")
    placed = own.save(placed.join(split, "token"))
    x, y = (placed.select("token", *(F.col(c).alias(f"{c}_{z}") for c in ("content", "grp", "n", "pos"))) for z in "xy")
    share = F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))  # no token of theirs is shared before this one
    pairs = (x.join(y, (x["token"] == y["token"]) & (F.col("content_x") < F.col("content_y")) & (F.col("grp_x") != F.col("grp_y")))
             .where(1000 * F.least("n_x", "n_y") >= num * F.greatest("n_x", "n_y"))
             .where((F.lit(1000) * share >= num * (F.col("n_x") + F.col("n_y") - share)))
             .select(F.col("content_x").alias("a"), F.col("content_y").alias("b")).distinct())
    tried = near.select(F.least("content", "pivot").alias("a"), F.greatest("content", "pivot").alias("b"))
    return pairs.join(tried, ["a", "b"], "left_anti")


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, window: int = WINDOW,
                      similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(key, start, n_words, component, kept_id, kept_start) of every paragraph that goes; places count words from 0."""
    bands, rows = tuned_bands(similarity, recall)
    num = round(similarity * 1000)
    kind = docs.schema[key].dataType.simpleString()
    docs = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    docs = docs.withColumn("doc", F.xxhash64("id", "th"))

    def cut(batches):
        hashes = WordHash()
        for block in text_blocks(batches, "text", 2 << 20):
            doc, start, s = paragraphs(texts_of(block, "text"), hashes, length, window)
            if len(doc):
                yield block, doc, start, s

    def emit_bands(batches):
        for _, _, _, s in cut(batches):
            keys, content = band_keys(s, bands, rows), content_hash(s)
            pair = np.unique(np.stack([keys.ravel(), np.repeat(content, bands)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.ascontiguousarray(pair[:, j]))) for j in (0, 1)], ["band", "content"])

    def in_several(batches):
        return (b.filter(pa.array(has_bit(several.value, b.column(0).to_numpy(zero_copy_only=False)))) for b in batches)

    def emit_contents(batches):
        for block, doc, _, s in cut(batches):
            pair = np.unique(np.stack([signed(content_hash(s)), block.column(3).to_numpy(zero_copy_only=False)[doc]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pair[:, j])) for j in (0, 1)], ["content", "doc"])

    def emit_places(batches):
        for block, doc, start, s in cut(batches):
            content = signed(content_hash(s))
            some = has_bit(repeated.value, content)
            row = pa.array(doc[some])
            yield pa.RecordBatch.from_arrays(
                [block.column(0).take(row), block.column(1).take(row), pa.array(start[some].astype(np.int32)), pa.array(content[some])],
                ["id", "th", "start", "content"])

    def emit_sets(batches):
        own_docs = (b.filter(pa.array(has_bit(held.value, b.column(3).to_numpy(zero_copy_only=False)))) for b in batches)
        for _, _, _, s in cut(own_docs):
            content, first = np.unique(content_hash(s), return_index=True)
            some = has_bit(wanted.value, signed(content))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(content[some])), pa.array([signed(np.unique(s[i])) for i in first[some]], pa.list_(pa.int64()))],
                ["content", "s"])

    with Scratch(docs.sparkSession, "substring-dedup") as own:
        # the least content of a band by partial minima; bands of one content, which are most, are not shuffled again
        broadcast = docs.sparkSession.sparkContext.broadcast
        with Scratch(docs.sparkSession, "substring-bands") as first:  # the largest table, deleted before the others are made
            banded = first.save(docs.select("text").mapInArrow(emit_bands, "band long, content long"))
            pivots = first.save(banded.groupBy("band").agg(F.min("content").alias("pivot"), F.max("content").alias("_last"))
                                .where("pivot <> _last").select("band", "pivot"))
            several = broadcast(joined_bits(pivots, "band"))
            lists = own.save(banded.mapInArrow(in_several, "band long, content long").distinct().join(pivots, "band"))
        near = own.save(lists.where("content <> pivot").select("content", "pivot").distinct())
        asked = own.save(near.select("content").union(near.select("pivot")).distinct())

        contents = docs.mapInArrow(emit_contents, "content long, doc long")
        counted = contents.groupBy("content").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        counted = own.save(counted.join(asked.withColumnRenamed("content", "_asked"), F.col("content") == F.col("_asked"), "left")
                           .where("first <> last or _asked is not null").select("content", "first", "_asked"))

        # only documents that hold an asked content are cut again, and only asked contents leave the task
        held = broadcast(joined_bits(counted.where("_asked is not null"), "first"))
        wanted = broadcast(joined_bits(asked, "content"))
        sets = own.save(docs.mapInArrow(emit_sets, "content long, s array<long>").join(asked, "content", "left_semi")
                        .dropDuplicates(["content"]))
        links = own.save(_similar(near.select(F.col("content").alias("a"), F.col("pivot").alias("b")), sets, num))
        groups = connected_components(links, own)
        # what the pivots did not join: contents of bands with several groups, by their rarest shingles
        rest = _unjoined(lists, sets, groups, near, own, num)
        more = own.save(_similar(rest, sets, num))
        if not more.isEmpty():
            groups = connected_components(own.save(links.union(more)), own)

        labelled = own.save(counted.join(groups, F.col("content") == F.col("node"), "left").select(
            F.col("content").alias("_c"), F.coalesce("component", "content").alias("component")))
        repeated = broadcast(joined_bits(labelled, "_c", 32))
        places = docs.mapInArrow(emit_places, f"id {kind}, th long, start int, content long")
        places = own.save(places.join(labelled, F.col("content") == F.col("_c")).select("component", "id", "th", "start").distinct())
        place, doc = F.struct("id", "th", "start"), F.struct("id", "th")
        kept = places.groupBy("component").agg(F.min(place).alias("kept"), F.max(doc).alias("last")).where(
            _doc("kept") != F.col("last")).select("component", "kept")
        out = places.join(kept, "component").where(doc != _doc("kept"))
        return own.save(out.select(F.col("id").alias(key), "start", F.lit(length).alias("n_words"), "component",
                                   F.col("kept.id").alias("kept_id"), F.col("kept.start").alias("kept_start")), keep=True)
