"""Nearest rows: what the driver holds, and values that equal the plain ones."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.operators import directory, pairwise
from tablelearn.session import scratch_dir


def test_no_row_sized_side_is_broadcast(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 4)))]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    nb = pairwise.nearest(df, df, "id", "id", "v", "v", 4, 3, exclude_self=True, metric="cosine", block=32, fan=4)
    plan = nb._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [_qr" not in plan and "BroadcastHashJoin [_tr" not in plan and "SortMergeJoin [_qr" in plan


@pytest.mark.parametrize("metric, kw", [("euclidean", {}), ("minkowski", {"p": 3.0}), ("cosine", {}), ("tanimoto", {}),
                                        ("std_euclidean", {"scales": (1.0, 0.0, 0.5, 2.0, 1.0)})])
@pytest.mark.parametrize("kind", ["spread", "ties", "far"])
def test_best_rows_equal_those_of_plain_sums(metric, kw, kind):
    rng = np.random.default_rng(5)
    q, t = rng.normal(size=(20, 5)), rng.normal(size=(300, 5))
    if kind == "ties":
        q, t = np.round(q) + [1, 0, 0, 0, .5], np.round(t) + [1, 0, 0, 0, .25]
    if kind == "far":
        q, t = q + 1e6, t + 1e6
    space, qa, ta = directory.Space(metric, 5, **kw), (q * q).sum(1), (t * t).sum(1)
    for ours, plain in zip(space.best(q, t, qa, ta, 6), space.best_plain(q, t, qa, ta, 6)):
        assert np.array_equal(ours, plain)


@pytest.mark.parametrize("metric, kw", [("euclidean", {}), ("manhattan", {}), ("chebyshev", {}), ("minkowski", {"p": 1.5}), ("minkowski", {"p": 3.0}),
                                        ("minkowski", {"p": 5.0}), ("cosine", {}), ("tanimoto", {}), ("std_euclidean", {"scales": (1.0, 0.0, 0.5, 2.0) * 4})])
@pytest.mark.parametrize("kind", ["spread", "ties", "far", "small", "copies"])
def test_tiles_return_what_plain_sums_return(monkeypatch, metric, kw, kind):
    monkeypatch.setattr(directory, "STRIP", 128)
    monkeypatch.setattr(directory, "PRODUCTS", 16)
    rng = np.random.default_rng(6)
    q, t = rng.normal(size=(50, 16)), rng.normal(size=(900, 16))
    if kind == "ties":
        q, t = np.round(q) + 0.5 * np.eye(16)[0], np.round(t) + 0.5 * np.eye(16)[0]
    if kind == "far":
        q, t = q + 1e6, t + 1e6
    if kind == "small" and metric not in directory.SIMILARITIES:
        q, t = q * 1e-150, t * 1e-150
    if kind == "copies":
        t[:] = t[0]
    space, qa, ta = directory.Space(metric, 16, **kw), (q * q).sum(1), (t * t).sum(1)
    rank, block = rng.permutation(900), np.sort(rng.integers(0, 9, 900))
    by_rank = np.argsort(rank)
    rows, at, scores = space.best_plain(q, t[by_rank], qa, ta[by_rank], 6)
    home = np.sort(space.scores(q, t[:100], qa, ta[:100]), 1)[:, 5]
    for bounds in (home, np.full(50, np.nan)):
        r, c, s = space.tile(q, t, qa, ta, bounds, np.ones((50, 9), bool), block, rank, 6)
        order = np.lexsort((rank[c], s, r))
        assert np.array_equal(r[order], rows) and np.array_equal(c[order], by_rank[at]) and np.array_equal(s[order], scores)


def test_vectors_are_not_sent_to_blocks_one_by_one(spark, monkeypatch):
    """Vectors that nothing rules out meet in tiles; only the home blocks are met query by query."""
    calls, met = [], directory._met
    monkeypatch.setattr(directory, "_met", lambda *a: calls.append(1) or met(*a))
    monkeypatch.setattr(directory, "PART", 64)
    monkeypatch.setattr(directory, "SLAB", 64)
    rng = np.random.default_rng(7)
    v = rng.normal(size=(400, 8))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, v array<double>")
    got = {(r["id"], r["rank"]): r["other"] for r in pairwise.nearest(df, df.withColumnRenamed("id", "other"), "id", "other", "v", "v", 8, 3, block=16, fan=4).collect()}
    d = ((v[:, None] - v) ** 2).sum(2)
    assert len(calls) == 1 and all([got[i, 1], got[i, 2], got[i, 3]] == np.argsort(d[i])[:3].tolist() for i in range(400))


def test_groups_are_numbered_up_to_a_size():
    assert directory._numbered([3, 3, 3, 20, 1, 1], 6) == [(0, 1), (0, 1), (1, 1), (2, 4), (6, 1), (6, 1)]
    assert directory._numbered([], 6) == []


@pytest.mark.parametrize("slices", [1, 3])
def test_sets_leave_only_what_the_result_reads(spark, monkeypatch, slices):
    monkeypatch.setattr(pairwise, "SLICES", slices)
    monkeypatch.setattr(pairwise, "SLICE_ROWS", 10)
    before = set(os.listdir(scratch_dir(spark).removeprefix("file:")))
    rng = np.random.default_rng(4)
    rows = [(i, [int(x) for x in rng.integers(0, 60, rng.integers(0, 6))]) for i in range(150)] + [(200, None), (201, [3, 3, None])]
    df = spark.createDataFrame(rows, "id long, s array<int>")
    out = pairwise.nearest_sets(df, df.withColumnRenamed("id", "other"), "id", "other", "s", "s", 3, exclude_self=True)
    left = {x.split("-")[1] for x in set(os.listdir(scratch_dir(spark).removeprefix("file:"))) - before if x.startswith("set-")}
    assert left == {"train", "query", "found"}
    got = {(r["id"], r["rank"]): (r["distance"], r["other"]) for r in out.collect()}
    sets = [(i, set(s)) for i, s in rows if s is not None]
    for i, a in sets:
        want = sorted((1.0 - len(a & b) / len(a | b) if a | b else 0.0, j) for j, b in sets if j != i)[:3]
        assert [got[i, 1], got[i, 2], got[i, 3]] == want


def test_ids_that_come_twice_leave_k_neighbours(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [0.1, 1.0]), (3, [0.2, 1.0]), (4, [0.3, 1.0]), (5, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    nb = pairwise.nearest(df, df.withColumnRenamed("id", "other"), "id", "other", "v", "v", 2, 2, exclude_self=True)
    got = [(r["id"], r["other"]) for r in nb.where("id in (2, 5)").orderBy("id", "rank").select("id", "other").collect()]
    assert got == [(2, 1), (2, 1), (5, 1), (5, 1)]


def _hamming_plain(qs, ts, k):
    out = {}
    for qi, a in qs:
        near = sorted((sum(x != y for x, y in zip(a, b)), ti) for ti, b in ts if a is not None and b is not None and len(a) == len(b))
        out[qi] = [(i + 1, ti, float(d)) for i, (d, ti) in enumerate(near[:k])]
    return {q: n for q, n in out.items() if n}


@pytest.mark.parametrize("patterns", [16, 1])
def test_hamming_equals_all_pairs(spark, monkeypatch, patterns):
    monkeypatch.setattr(directory, "PATTERNS", patterns)
    rng = np.random.default_rng(8)
    word = lambda first, n, most: first + "".join(str(x) for x in rng.integers(0, most, n))
    qs = [(i, word("Käufer#", 4, 10)) for i in range(60)] + [(60 + i, word("ab", 5, 3)) for i in range(20)] + [(90, ""), (91, None), (92, "q" * 70), (93, "😀0000")]
    ts = [(i, word("Lieferer#"[:7], 4, 6)) for i in range(80)] + [(100 + i, word("xb", 5, 3)) for i in range(4)]
    ts += [(200, ""), (201, None), (202, "q" * 69 + "r"), (203, "😀0100"), (204, ts[0][1]), (205, "a1000")]
    q, t = spark.createDataFrame(qs, "q int, s string"), spark.createDataFrame(ts, "t int, s string")
    got = {}
    for r in pairwise.nearest(q, t, "q", "t", "s", "s", None, 5, metric="hamming").orderBy("q", "rank").collect():
        got.setdefault(r["q"], []).append((r["rank"], r["t"], r["distance"]))
    assert got == _hamming_plain(qs, ts, 5)


def test_hamming_lookup_answers_numbered_names_alone(spark, monkeypatch):
    q = spark.range(300).selectExpr("cast(id as int) q", "concat('Customer#', lpad(id, 6, '0')) s")
    t = spark.range(100).selectExpr("cast(id as int) t", "concat('Supplier#', lpad(id, 6, '0')) s")
    monkeypatch.setattr(pairwise, "search", None)  # comparing blocks of pairs would fail
    got = pairwise.nearest(q, t, "q", "t", "s", "s", None, 5, metric="hamming")
    first = {r["q"]: r["t"] for r in got.where(F.col("rank") == 1).collect()}
    assert first == {i: i % 100 for i in range(300)}
