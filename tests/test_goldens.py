"""Learners against plain numpy / Python versions on small hand-written tables."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.functions import distance as D
from tablelearn.operators import bayes, cluster, directory, encode, linear, mixture, pairwise, sequence, tree

PI, A = (0.6, 0.3, 0.1), ((0.7, 0.2, 0.1), (0.25, 0.5, 0.25), (0.1, 0.1, 0.8))
B = ((0.9, 0.1), (0.35, 0.65), (0.2, 0.8))


def blobs(offset=0.0, n=40, d=2, seed=3):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(0, 1, (n, d)), rng.normal(6, 1, (n, d))]) + offset
    return x[rng.permutation(len(x))]


def frame(spark, x, *more):
    names = [f"f{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r), *(m[i] for m in more)) for i, r in enumerate(x)]
    kinds = ["label string" if isinstance(m[0], str) else "label int" for m in more]
    return spark.createDataFrame(rows, ", ".join(["k long", *(f"{n} double" for n in names), *kinds])), names


# ---- hidden Markov model

@pytest.mark.parametrize("method", ["forward", "backward"])
def test_hmm_sums_over_all_paths(spark, method):
    r = random.Random(1)
    seqs = {k: [r.choice("ab") for _ in range(n)] for k, n in enumerate((1, 2, 5, 7))}
    df = spark.createDataFrame([(k, t, o) for k, s in seqs.items() for t, o in enumerate(s)], "k int, t int, o string")
    got = {x["k"]: x for x in sequence.hmm_score(df, "k", ["t"], "o", PI, A, B, symbols=["a", "b"], method=method, chunk=2).collect()}
    for k, s in seqs.items():
        obs = ["ab".index(o) for o in s]
        p = sum(PI[path[0]] * math.prod(A[i][j] for i, j in zip(path, path[1:])) * math.prod(B[i][o] for i, o in zip(path, obs))
                for path in itertools.product(range(3), repeat=len(s)))
        assert got[k]["n_obs"] == len(s) and got[k]["log_likelihood"] == pytest.approx(math.log(p))


@pytest.mark.parametrize("method", ["forward", "backward"])
def test_hmm_unknown_symbols_are_impossible_not_absent(spark, method):
    rows = [(1, 1, "a"), (1, 2, "x"), (1, 3, "b"), (2, 1, None), (3, 1, "a"), (3, 2, "b")]
    df = spark.createDataFrame(rows, "k int, t int, o string")
    got = {r["k"]: (r["n_obs"], r["log_likelihood"]) for r in
           sequence.hmm_score(df, "k", ["t"], "o", PI, A, B, symbols=["a", "b"], method=method).collect()}
    assert got[1] == (3, float("-inf")) and got[2] == (1, float("-inf")) and got[3][0] == 2 and got[3][1] < 0
    pos = {(r["k"], r["pos"]): r["obs"] for r in sequence.positions(df, "k", ["t"], "o", symbols=["a", "b"]).collect()}
    assert pos == {(1, 1): 0, (1, 2): None, (1, 3): 1, (2, 1): None, (3, 1): 0, (3, 2): 1}


def log_forward(pi, a, b, obs):
    u, s = None, 0.0
    for o in obs:
        u = (pi if u is None else u @ a) * b[:, o]
        s, u = s + math.log(u.sum()), u / u.sum()
    return s


@pytest.mark.parametrize("method", ["forward", "backward"])
@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_hmm_of_many_states_and_symbols(spark, method, limit, monkeypatch):
    """64 states, 100,000 symbols; one key holds a third of the events and lies in several partitions."""
    monkeypatch.setattr(sequence, "BROADCAST_BYTES", limit)
    rng, n, m = np.random.default_rng(4), 64, 100_000
    pi, a, b = rng.dirichlet(np.ones(n)), rng.dirichlet(np.ones(n), n), rng.dirichlet(np.ones(m), n)
    seqs = {k: rng.integers(0, m, 400 if k == 3 else int(rng.integers(1, 40))) for k in range(40)}
    rows = [(f"k{k:02d}", t, f"s{o}") for k, s in seqs.items() for t, o in enumerate(s)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "k string, t int, o string")
    got = {r["k"]: (r["n_obs"], r["log_likelihood"]) for r in sequence.hmm_score(
        df, "k", ["t"], "o", pi, a, b, symbols=[f"s{i}" for i in range(m)], method=method, partitions=7, chunk=50).collect()}
    assert len(got) == len(seqs)
    for k, s in seqs.items():
        assert got[f"k{k:02d}"] == (len(s), pytest.approx(log_forward(pi, a, b, s)))


def test_hmm_pieces_without_mass_null_keys_and_emission_tables(spark):
    """A chain that cannot leave its state, cut into one partition per event or so; emissions as a table."""
    pi, a, b = (1.0, 0.0), ((1.0, 0.0), (0.0, 1.0)), spark.createDataFrame(
        [("x", [1e-20, 0.5]), ("y", [0.5, 0.0])], "sym string, p array<double>")
    rows = [(None, t, "x") for t in range(9)] + [(1, t, "y") for t in range(9)] + [(2, 0, "y"), (2, 1, "z"), (2, 2, "y")]
    df = spark.createDataFrame(rows, "k int, t int, o string")
    for method in ("forward", "backward"):
        for partitions in (1, 3, 20):
            got = {r["k"]: r["log_likelihood"] for r in sequence.hmm_score(df, "k", ["t"], "o", pi, a, b, method=method, partitions=partitions).collect()}
            assert got[None] == pytest.approx(9 * math.log(1e-20)) and got[1] == pytest.approx(9 * math.log(0.5))
            assert got[2] == float("-inf") and len(got) == 3


def test_hmm_moves_the_events_once(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"), F.lit("a").alias("o"))
    plan = sequence._sorted_events(df, "k", ["t"], "o", B, ["a", "b"], 3, False, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(_key") == 1 and "SortMergeJoin" not in plan.split("rangepartitioning(_key")[0]
    assert plan.split("rangepartitioning(_key")[1].split("BroadcastExchange")[0].count("Exchange") == 0


# ---- ID3

def tree_rows(n=60, seed=2):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        sky, wind, day = r.choice(["sun", "rain", "fog"]), r.choice(["calm", "gale"]), r.choice("mtwtf")
        go = "yes" if sky == "sun" or (sky == "fog" and wind == "calm") else "no"
        rows.append((i, sky if r.random() > 0.05 else None, wind, day, go if r.random() > 0.08 else "maybe"))
    return rows


def entropy(labels):
    n = len(labels)
    return -sum(c / n * math.log2(c / n) for c in Counter(labels).values()) if n else 0.0


def gain(rows, f):
    parts = defaultdict(list)
    for r in rows:
        parts[r[f]].append(r[4])
    return entropy([r[4] for r in rows]) - sum(len(p) / len(rows) * entropy(p) for p in parts.values())


def grown(rows, used=()):
    """Nested (label, n, feature, {value: subtree})."""
    counts = Counter(r[4] for r in rows)
    label = min(counts, key=lambda v: (-counts[v], v))
    left = [f for f in (1, 2, 3) if f not in used]
    if len(counts) == 1 or not left:
        return label, len(rows), None, {}
    best = max(left, key=lambda f: (gain(rows, f), -f))
    if gain(rows, best) < 0.05:
        return label, len(rows), None, {}
    values = sorted({r[best] for r in rows if r[best] is not None})
    return label, len(rows), best, {v: grown([r for r in rows if r[best] == v], (*used, best)) for v in values}


def test_id3_equals_recursive_growth(spark):
    rows, names = tree_rows(), ["sky", "wind", "day"]
    df = spark.createDataFrame(rows, "k long, sky string, wind string, day string, go string")
    g = {r["feature"]: r["gain"] for r in tree.info_gain(df, "go", names).collect()}
    for i, f in enumerate(names):
        assert g[f] == pytest.approx(gain(rows, i + 1))
    h = tree.label_entropy(df, "go").first()
    assert (h["n"], h["entropy"]) == (60, pytest.approx(entropy([r[4] for r in rows])))
    model = tree.id3_fit(df, names, "go", threshold=0.05)
    nodes = model.nodes.collect()
    kids = defaultdict(dict)
    for n in nodes:
        kids[n["parent_id"]][n["edge_value"]] = n

    def same(node, want):
        label, n, feature, children = want
        assert (node["label"], node["n"]) == (label, n)
        assert node["split_feature"] == (names[feature - 1] if feature else None)
        assert set(kids[node["node_id"]]) == set(children)
        for v, sub in children.items():
            same(kids[node["node_id"]][v], sub)

    want = grown(rows)
    same(kids[None][None], want)

    def walk(r, t):
        while t[2] and r[t[2]] in t[3]:
            t = t[3][r[t[2]]]
        return t[0]

    more = rows + [(100, "snow", "calm", "m", None), (101, "fog", "storm", "t", None), (101, None, None, None, None)]
    out = tree.id3_predict(spark.createDataFrame(more, df.schema), model).collect()
    assert sorted((r["k"], r["prediction"]) for r in out) == sorted((r[0], walk(r, want)) for r in more)


def test_id3_feature_with_very_many_values(spark):
    df = spark.range(100_000).select(F.concat(F.lit("v"), "id").alias("f"), F.pmod("id", F.lit(2)).cast("string").alias("y"))
    model = tree.id3_fit(df, ["f"], "y")
    assert model.nodes.count() == 100_001
    assert tree.id3_predict(df, model).where("prediction <> y").count() == 0


# ---- naive Bayes

def test_naive_bayes_equals_counting(spark):
    r = random.Random(5)
    rows = [(r.choice(["u", "v", "w", None]), r.choice(["1", "2"]), r.choice(["p", "q", "q"])) for _ in range(50)] + [("rare", "1", "p")]
    df = spark.createDataFrame(rows, "a string, b string, y string")
    for lam in (1.0, 0.5, "none"):
        model = bayes.nb_fit(df, ["a", "b"], "y", smoothing=lam)
        add = 0.0 if lam == "none" else lam
        n_c = Counter(x[2] for x in rows)
        seen = [{x[f] for x in rows if x[f] is not None} for f in (0, 1)]

        def p(c, f, v):
            return (sum(x[2] == c and x[f] == v for x in rows) + add) / (n_c[c] + add * len(seen[f]))

        cells = {(x["y"], x["feature"], x["value"]): (x["n"], x["prob"]) for x in model.cells_df.collect()}
        assert set(cells) == {(c, "ab"[f], v) for c in n_c for f in (0, 1) for v in seen[f]}  # zero cells too
        for (c, f, v), (n, prob) in cells.items():
            assert prob == pytest.approx(p(c, "ab".index(f), v))
        queries = [(a, b) for a in ("u", "v", "w", "rare", "new", None) for b in ("1", "2", "new", None)] * 2

        def best(q):
            score = {}
            for c in sorted(n_c):
                s = math.log((n_c[c] + add) / (len(rows) + add * len(n_c)))
                for f, v in enumerate(q):
                    if v is not None:
                        s += math.log(p(c, f, v)) if p(c, f, v) > 0 else -math.inf
                score[c] = s
            return max(sorted(score), key=lambda c: score[c])

        got = bayes.nb_predict(spark.createDataFrame(queries, "a string, b string"), model).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(((*q, best(q)) for q in queries), key=repr)


def test_naive_bayes_of_many_classes(spark):
    """100,000 classes, their counts and cells as tables: against counting over the candidates of each row."""
    n = 100_000
    c = F.format_string("c%06d", F.col("id") % n)
    train = spark.range(3 * n).select(
        c.alias("y"), F.when(F.col("id") % n < 7, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("a"),
        F.when(F.col("id") % 4 != 0, (F.col("id") % 11).cast("string")).alias("b"))
    extra = spark.range(50).select(F.lit("c000500").alias("y"), F.lit("500").alias("a"), F.lit(None).cast("string").alias("b"))
    train = train.unionByName(extra)
    model = bayes.nb_fit(train, ["a", "b"], "y")
    assert model.n_classes == n and model.n_rows == 3 * n + 50
    queries = [("500", "3"), ("hot", "1"), ("hot", None), ("none", "none"), (None, "10"), (None, None), ("4999", None)]
    got = {tuple(r)[:2]: r["prediction"] for r in bayes.nb_predict(spark.createDataFrame(queries, "a string, b string"), model).collect()}
    rows = train.toPandas()
    n_c = Counter(rows["y"])
    cells = [Counter(zip(rows["y"], rows[f])) for f in "ab"]
    seen = [rows[f].nunique() for f in "ab"]
    for q in queries:
        score = {y: math.log(n_c[y] + 1) + sum(math.log((cells[f][y, v] + 1) / (n_c[y] + seen[f])) for f, v in enumerate(q) if v is not None)
                 for y in n_c}
        top = max(score.values())
        assert got[q] == min(y for y, s in score.items() if s > top - 1e-9)


def test_naive_bayes_scores_a_stream(spark, tmp_path):
    rows = [("u", "1", "p"), ("u", "2", "p"), ("v", "1", "q"), (None, "2", "q")]
    df = spark.createDataFrame(rows, "a string, b string, y string")
    model = bayes.nb_fit(df, ["a", "b"], "y")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = bayes.nb_predict(stream, model).writeStream.format("memory").queryName("nb_stream").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(repr, spark.table("nb_stream").collect())) == sorted(map(repr, bayes.nb_predict(df, model).collect()))


# ---- kNN

SCALES = (1.0, 2.0, 0.0)


def plain_value(metric, a, b):
    """The measure as a distance, or a negative similarity (None where there is none)."""
    diff, dot = [abs(x - y) for x, y in zip(a, b)], lambda u, w: sum(x * y for x, y in zip(u, w))
    if metric in ("cosine", "tanimoto"):
        if not dot(a, a) or not dot(b, b):
            return None
        ab = dot(a, b)
        return -ab / (math.sqrt(dot(a, a)) * math.sqrt(dot(b, b)) if metric == "cosine" else dot(a, a) + dot(b, b) - ab)
    return {"euclidean": lambda: math.dist(a, b), "manhattan": lambda: sum(diff), "chebyshev": lambda: max(diff),
            "minkowski": lambda: sum(d ** 3 for d in diff) ** (1 / 3),
            "std_euclidean": lambda: math.sqrt(sum((d / s) ** 2 for d, s in zip(diff, SCALES) if s))}[metric]()


def knn_options(metric):
    return {"metric": metric, "p": 3.0 if metric == "minkowski" else None, "scales": SCALES if metric == "std_euclidean" else None}


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "minkowski", "std_euclidean", "cosine", "tanimoto"])
def test_knn_equals_all_pairs(spark, metric):
    r = random.Random(4)
    rows = [(i, [float(r.randint(-2, 6)) for _ in range(3)]) for i in range(150)] + [(200 + i, [1.0, 1.0, 1.0]) for i in range(60)]
    rows += [(300, [0.0, 0.0, 0.0]), (301, None), (302, [1.0, None, 2.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got, value = defaultdict(list), "similarity" if metric in ("cosine", "tanimoto") else "distance"
    for x in pairwise.nearest(df, df, "id", "id", "v", "v", 3, 4, exclude_self=True, block=40, fan=5, **knn_options(metric)).collect():
        got[x["id"]].append((x["rank"], x["id_neighbor"], x[value]))
    whole = [(i, v) for i, v in rows if v is not None and None not in v]
    for i, v in whole:
        scored = [(plain_value(metric, v, w), j) for j, w in whole if j != i]
        want = sorted((s, j) for s, j in scored if s is not None)[:4]
        mine = sorted(got.pop(i, []))
        # ties within rounding may stand in another order only where the values differ in the last digits
        sign = -1 if value == "similarity" else 1
        assert [d for _, _, d in mine] == pytest.approx([sign * s for s, _ in want], abs=1e-9)
        if metric in ("euclidean", "manhattan", "chebyshev", "tanimoto"):
            assert [j for _, j, _ in mine] == [j for _, j in want]
    assert not got


def test_knn_of_strings_by_positions(spark):
    r = random.Random(6)
    rows = [(i, "".join(r.choice("abß") for _ in range(r.choice([0, 1, 5, 9])))) for i in range(260)] + [(900, None), (901, "solitary length")]
    df = spark.createDataFrame(rows, "id long, s string")
    got = defaultdict(list)
    for x in pairwise.nearest(df, df, "id", "id", "s", "s", None, 3, exclude_self=True, metric="hamming", block=30, fan=4).collect():
        got[x["id"]].append((x["rank"], x["distance"], x["id_neighbor"]))
    for i, s in rows:
        want = sorted((float(sum(a != b for a, b in zip(s, t))), j) for j, t in rows if j != i and t is not None and len(t) == len(s))[:3] if s is not None else []
        assert [(d, j) for _, d, j in sorted(got.get(i, []))] == want


@pytest.mark.parametrize("metric", ["cosine", "tanimoto"])
def test_knn_directory_spares_pairs_of_clustered_vectors(spark, metric):
    """Forty distant clusters: a search compares a small share of all pairs, over several levels."""
    r = np.random.default_rng(3)
    centres = r.normal(0, 50, (40, 4))
    points = np.concatenate([c + r.normal(0, 0.05, (30, 4)) for c in centres])
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "_tr long, _tv array<double>")
    space = directory.Space(metric, 4)
    made = directory.build(space.with_place(df, "t"), space, block=40, fan=6)
    assert len(made.levels) >= 2
    sizes = made.blocks.collect()
    assert sum(b["n"] for b in sizes) == 1200 and max(b["n"] for b in sizes) <= 80
    found, sent = directory.search(space.with_place(df.toDF("_qr", "_qv"), "q"), made, 5)
    assert found.count() == 1200 * 5
    assert directory.visited_pairs(sent, made) < 0.25 * 1200 * 1200


def test_knn_directory_bounds_blocks_of_equal_distances(spark):
    """Nodes that no level divides are cut into rings and, where distances are equal, by hash; every vector is in one block."""
    rows = [(i, [1.0 if j == i else 0.0 for j in range(90)]) for i in range(90)]
    df = spark.createDataFrame(rows, "_tr long, _tv array<double>")
    space = directory.Space("euclidean", 90)
    made = directory.build(space.with_place(df, "t"), space, block=8, fan=3, levels=2)
    blocks = made.blocks.collect()
    assert sum(b["n"] for b in blocks) == 90 and max(b["n"] for b in blocks) <= 30 and len(blocks) > 6
    found, _ = directory.search(space.with_place(df.toDF("_qr", "_qv"), "q"), made, 3)
    got = defaultdict(list)
    for x in found.collect():
        got[x["_qr"]].append((x["_score"], x["_tr"]))
    assert all([j for _, j in sorted(got[i])] == [i] + [j for j in range(4) if j != i][:2] for i in range(90))


def test_knn_queries_of_a_block_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(directory, "ASKED", 4)
    monkeypatch.setattr(directory, "ROWS", 3)
    rows = [(i, [float(i % 37), float(i // 37)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {(x["id"], x["rank"]): x["id_neighbor"] for x in pairwise.nearest(df, df, "id", "id", "v", "v", 2, 2, exclude_self=True).collect()}
    for i, v in rows:
        assert [got[i, 1], got[i, 2]] == [j for _, j in sorted((math.dist(v, w), j) for j, w in rows if j != i)[:2]]


def test_nearest_sets_equal_all_pairs(spark):
    r = random.Random(8)
    rows = [(i, [r.choice("abcdefghijklmnopqrstuvwxyz") * r.randint(1, 3) for _ in range(r.randint(0, 7))]) for i in range(200)]
    rows += [(300 + i, ["hot", "set"]) for i in range(40)] + [(400, None), (401, [None]), (402, [""]), (403, ["?"]), (404, ["x", None, "x"])]
    df = spark.createDataFrame(rows, "id long, s array<string>")
    out = pairwise.nearest_sets(df, df, "id", "id", "s", "s", 4, exclude_self=True).collect()
    got = defaultdict(list)
    for x in out:
        got[x["id"]].append((x["rank"], x["id_neighbor"], round(x["distance"], 9)))
    sets = [(i, set(s)) for i, s in rows if s is not None]
    for i, a in sets:
        want = sorted((round(1 - len(a & b) / len(a | b), 9) if a | b else 0.0, j) for j, b in sets if j != i)[:4]
        assert [(d, j) for _, j, d in sorted(got.pop(i))] == want
    assert not got
    few = spark.createDataFrame([(1, ["a"]), (2, ["b"])], "id long, s array<string>")
    assert [tuple(x) for x in pairwise.nearest_sets(few, few, "id", "id", "s", "s", 4).orderBy("id", "rank").collect()] == [
        (1, 1, 1, 0.0), (1, 2, 2, 1.0), (2, 2, 1, 0.0), (2, 1, 2, 1.0)]
    empty = few.limit(0)
    assert pairwise.nearest_sets(empty, few, "id", "id", "s", "s", 1).count() == pairwise.nearest_sets(few, empty, "id", "id", "s", "s", 1).count() == 0


def test_knn_refuses_unknown_measures(spark):
    df = spark.createDataFrame([(1, [0.0])], "id long, v array<double>")
    for options in ({"metric": "jaccard"}, {"metric": "minkowski", "p": 0.5}, {"metric": "std_euclidean", "scales": [1.0, 2.0]}):
        with pytest.raises(ValueError):
            pairwise.nearest(df, df, "id", "id", "v", "v", 1, 1, **options)


def test_knn_all_distances_equal_keeps_candidates_bounded(spark):
    rows = [(i, [1.0 if j == i else 0.0 for j in range(40)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = pairwise.nearest(df, df, "id", "id", "v", "v", 40, 3, exclude_self=True, block=8).collect()
    assert len(out) == 120
    for i in range(40):
        assert sorted(r["id_neighbor"] for r in out if r["id"] == i) == [j for j in range(5) if j != i][:3]


def test_knn_refuses_other_lengths(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0, 9.0]), (2, [0.0, 0.0, 0.0])], "id long, v array<double>")
    with pytest.raises(Exception, match="length"):
        pairwise.nearest(df, df, "id", "id", "v", "v", 2, 1).collect()


# ---- k-means, linear models

def test_kmeans_equals_lloyd(spark):
    x = blobs()
    df, names = frame(spark, x)
    m = cluster.kmeans_fit(df, names, 2, key="k")
    c, before = x[:2].copy(), None
    for it in range(1, 41):
        d = np.sqrt(((x[:, None] - c) ** 2).sum(2))
        own = d.argmin(1)
        cost = d.min(1).sum()
        c = np.array([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(2)])
        if before is not None and abs(cost - before) <= 1e-8:
            break
        before = cost
    assert m.iterations == it and m.converged and np.allclose(m.centers, c) and sum(m.costs) == pytest.approx(cost)


def test_logreg_equals_gradient_descent(spark):
    x = blobs(d=3)
    y = ["far" if r.sum() > 9 else "near" for r in x]
    y[0], y[1] = "near", "near"
    df, names = frame(spark, x, y)
    m = linear.logreg_fit(df, names, "label", max_iter=30, tol=-1.0)
    positive = min(Counter(y), key=lambda v: (Counter(y)[v], v))
    t = np.array([v == positive for v in y], float)
    w = np.zeros(3)
    for _ in range(30):
        w -= 0.05 * ((1 / (1 + np.exp(-x @ w)) - t)[:, None] * x).mean(0)
    assert m.weights == pytest.approx(w.tolist(), abs=1e-9) and m.iterations == 30 and not m.converged
    stopped = linear.logreg_fit(df, names, "label")
    assert stopped.converged and stopped.iterations < 40
    with pytest.raises(ValueError):
        linear.logreg_fit(spark.createDataFrame([(1.0, c) for c in "abc"], "x double, y string"), ["x"], "y")


def test_perceptron_and_pocket_equal_their_loops(spark):
    x = blobs(n=15)
    y = [1 if r.sum() > 6 else -1 for r in x]
    df, names = frame(spark, x, y)

    def loop(y, lr, most):
        w, b, best = np.zeros(2), 0.0, None
        for it in range(most + 1):
            z = x @ w + b
            wrong = [i for i in range(len(x)) if (1 if z[i] >= 0 else -1) != y[i]]
            if best is None or len(wrong) < best[0]:
                best = (len(wrong), w.copy(), b)
            if not wrong or it == most:
                return it, w, b, best
            w, b = w + lr * y[wrong[0]] * x[wrong[0]], b + lr * y[wrong[0]]

    m = linear.perceptron_fit(df, names, "label", "k", lr=0.2)
    it, w, b, _ = loop(y, 0.2, 1000)
    assert m.converged and m.iterations == it and m.weights == pytest.approx(w.tolist()) and m.bias == pytest.approx(b)
    assert linear.linear_predict(df, m).where("prediction <> label").count() == 0
    a, b = (linear.perceptron_fit(df, names, "label", "k", lr=0.2, seed=5) for _ in range(2))
    assert a.converged and a.weights == b.weights
    y[:2] = [-v for v in y[:2]]  # no longer separable
    df, names = frame(spark, x, y)
    p = linear.pocket_fit(df, names, "label", "k", lr=0.1, max_iter=25)
    _, _, _, (errors, w, b) = loop(y, 0.1, 25)
    assert p.best_errors == errors and p.weights == pytest.approx(w.tolist()) and p.bias == pytest.approx(b)


# ---- Gaussian mixture

def em(x, means, steps):
    n, d = x.shape
    k = len(means)
    mu, w, s = np.array(means), np.full(k, 1 / k), np.array([np.diag(x.var(0))] * k)
    for _ in range(steps):
        lp = np.stack([np.log(w[j]) - 0.5 * (d * math.log(2 * math.pi) + np.linalg.slogdet(s[j])[1]
                       + np.einsum("ni,ij,nj->n", x - mu[j], np.linalg.inv(s[j]), x - mu[j])) for j in range(k)], 1)
        g = np.exp(lp - lp.max(1, keepdims=True))
        g /= g.sum(1, keepdims=True)
        w, mu = g.mean(0), (g.T @ x) / g.sum(0)[:, None]
        s = np.array([((x - mu[j]).T * g[:, j]) @ (x - mu[j]) / g[:, j].sum() for j in range(k)])
    return w, mu, s


@pytest.mark.parametrize("d", [2, 9])
def test_gmm_equals_em(spark, d):
    x = blobs(d=d)
    df, names = frame(spark, x)
    m = mixture.gmm_fit(df, names, 2, init_means=[x[0], x[1]], max_iter=4, tol=-1.0)
    w, mu, s = em(x, [x[0], x[1]], 4)
    assert np.allclose(m.weights, w) and np.allclose(m.means, mu) and np.allclose(m.covs, s)


def test_gmm_does_not_depend_on_the_origin(spark):
    near, names = frame(spark, blobs())
    far, _ = frame(spark, blobs(offset=1e8))
    a, b = (mixture.gmm_fit(f, names, 2, key="k", max_iter=15) for f in (near, far))
    assert np.allclose(a.weights, b.weights, atol=1e-5) and np.allclose(a.covs, b.covs, atol=1e-4)
    assert np.allclose(np.array(a.means) + 1e8, b.means, atol=1e-4)


def test_gmm_default_start_separates_two_groups(spark):
    x = np.concatenate([np.arange(20)[:, None] / 10, np.arange(20)[:, None] / 10 + 9]) + np.array([0.0, 1.0])
    x += np.random.default_rng(1).normal(0, 0.1, x.shape)
    df, names = frame(spark, x)
    m = mixture.gmm_fit(df, names, 2, key="k")
    assert m.converged and sorted(m.weights) == pytest.approx([0.5, 0.5], abs=0.01)
    assert sorted(v[0] for v in m.means) == pytest.approx([0.95, 9.95], abs=0.2)


@pytest.mark.parametrize("d", [2, 9])
def test_gmm_empty_component_has_no_weight(spark, d):
    x = blobs(d=d)
    df, names = frame(spark, x)
    m = mixture.gmm_fit(df, names, 2, init_means=[[0.0] * d, [1e6] * d], max_iter=2, tol=-1.0)
    assert m.weights == [pytest.approx(1.0), 0.0]
    out = mixture.gmm_predict(df.unionByName(df.limit(1).withColumn("f0", F.lit(None).cast("double"))), m).collect()
    assert Counter(r["prediction"] for r in out) == {0: len(x), None: 1}
    assert all((r["probability"] is None) == (r["prediction"] is None) for r in out)


# ---- preparation

def test_more_labels_than_any_literal_map(spark):
    n = 100_500
    df = spark.range(n).select("id", F.concat(F.lit("label"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("y"))
    df = df.union(spark.createDataFrame([(n, "label0000777"), (n + 1, None)], "id long, y string"))
    mapping = encode.label_counts(df, "y")
    back = encode.apply_label_unindex(encode.apply_label_index(df, mapping, "y"), mapping, "y")
    r = back.agg(F.count("*").alias("n"), F.sum(F.when(~F.col("y").eqNullSafe(F.col("label_back")), 1)).alias("off"),
                 F.countDistinct("label_index").alias("d"), F.max("label_index").alias("m")).first()
    assert tuple(r) == (n + 2, None, n, float(n - 1))
    assert mapping.where("label_index = 0").first()["y"] == "label0000777"
    kids = tree.route_children(df, "y")
    assert kids.count() == n + 1 and kids.agg(F.max("node_id")).first()[0] == n


def test_null_features_score_null_everywhere(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 1.0, 2.0)], "k long, x1 double, x2 double")
    out = {r["k"]: r for r in cluster.kmeans_assign(df, ["x1", "x2"], [[0.0, 0.0], [1.0, 2.0]]).collect()}
    assert (out[1]["cluster"], out[1]["distance"]) == (None, None) and (out[2]["cluster"], out[2]["distance"]) == (1, 0.0)
    for kind in ("sign", "logistic"):
        m = linear.LinearModel(["x1", "x2"], [1.0, 1.0], 0.0, kind)
        got = {r["k"]: r["prediction"] for r in linear.linear_predict(df, m).collect()}
        assert got == {1: None, 2: 1}


def test_vector_lengths_are_checked(spark):
    rows = [(1, [0.0, 0.0, 9.0], [0.0, 0.0, 0.0]), (2, [1.0, 2.0], [1.0, 3.0]), (3, [1.0], [1.0, 2.0]), (4, None, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "k long, a array<double>, b array<double>")
    for name in ("euclidean", "manhattan", "chebyshev", "minkowski", "std_euclidean", "tanimoto", "cosine"):
        more = {"scales": [1.0, 1.0]} if name == "std_euclidean" else {}
        for x, y in (("a", "b"), (F.col("a"), F.col("b"))):
            got = {r["k"]: r["v"] for r in df.select("k", D.metric(name, x, y, dim=2, **more).alias("v")).collect()}
            assert got[1] is None and got[3] is None and got[4] is None and got[2] is not None, name
        if name != "std_euclidean":
            free = {r["k"]: r["v"] for r in df.select("k", D.metric(name, "a", "b").alias("v")).collect()}
            assert free[3] is None and free[4] is None and free[2] == pytest.approx(got[2])
    assert df.where("k = 1").select(D.euclidean("a", "b")).first()[0] == 9.0
    assert df.where("k in (2, 4)").select(D.metric("euclidean", "a", "b", strict=True)).count() == 2
    with pytest.raises(Exception, match="different length"):
        df.select(D.metric("euclidean", "a", "b", strict=True)).collect()


def test_mean_of_vectors_of_different_lengths_is_null(spark):
    df = spark.createDataFrame([("x", [1.0, 2.0]), ("x", [3.0, 4.0]), ("y", [1.0, 2.0]), ("y", [1.0, 2.0, 3.0])], "g string, v array<double>")
    got = {r["g"]: r["mean_vec"] for r in pairwise.group_means(df, "g", "v", 2).collect()}
    assert got == {"x": [2.0, 3.0], "y": None}


# ---- perceptron updates replayed from runs of rows

def one_by_one(rows, lr, most):
    """Weights after every single update: the wrong row of smallest key."""
    w, b, out = [0.0] * len(rows[0][1]), 0.0, [([0.0] * len(rows[0][1]), 0.0)]
    for _ in range(most):
        wrong = [(k, x, y) for k, x, y in rows if (1 if sum(p * q for p, q in zip(x, w)) + b >= 0 else -1) != y]
        if not wrong:
            break
        _, x, y = min(wrong)
        w, b = [p + (lr * y) * q for p, q in zip(w, x)], b + lr * y
        out.append((w, b))
    return out


@pytest.mark.parametrize("rows_in_run", [5, None])
def test_perceptron_replay_equals_single_updates(spark, rows_in_run):
    r = random.Random(3)
    for apart in (True, False):
        rows = []
        for k in range(90):
            x = [round(r.uniform(-2, 2), 3), round(r.uniform(0, 9), 3)]
            side = x[0] * 2 - x[1] * 0.3 + 0.4
            rows.append((k, x, (1 if side >= 0 else -1) if apart else r.choice([1, -1])))
        r.shuffle(rows)
        df = spark.createDataFrame([(k, *x, y) for k, x, y in rows] + [(200, None, 1.0, 1), (201, 1.0, 1.0, None)], "k long, a double, b double, y int")
        want = one_by_one(rows, 0.2, 60)
        got = linear.perceptron_fit(df, ["a", "b"], "y", "k", max_iter=60, rows=rows_in_run)
        assert (got.weights, got.bias, got.iterations) == (*want[-1], len(want) - 1)
        errors = [sum((1 if sum(p * q for p, q in zip(x, w)) + b >= 0 else -1) != y for _, x, y in rows) for w, b in want]
        assert got.converged == (errors[-1] == 0) and got.history[-1]["errors"] == errors[-1]
        pocket = linear.pocket_fit(df, ["a", "b"], "y", "k", lr=0.2, max_iter=60, rows=rows_in_run)
        assert [h["errors"] for h in pocket.history] == errors and pocket.iterations == len(want) - 1
        assert (pocket.weights, pocket.bias, pocket.best_errors) == (*want[errors.index(min(errors))], min(errors))


def test_perceptron_replay_needs_few_jobs(spark):
    """Rows far from the boundary don't end a run: the jobs are much fewer than the updates."""
    r = np.random.default_rng(5)
    size = r.integers(1, 51, 3000)
    x = np.c_[size / 50, r.uniform(0, 1, 3000)]
    df = spark.createDataFrame([(i, float(a), float(b), 1 if s >= 26 else -1) for i, ((a, b), s) in enumerate(zip(x, size))], "k long, a double, b double, y int")
    made = linear._Replay(df.persist(), [F.col("a"), F.col("b")], "y", "k", 0.2, 200)
    w, b, n, ended = [0.0, 0.0], 0.0, 0, False
    while not ended:
        more, ended = made.updates(w, b, 100_000)
        w, b, n = (*more[-1], n + len(more)) if more else (w, b, n)
    assert n > 5 * made.jobs and ((x @ np.array(w) + b >= 0) == (size >= 26)).all()


# ---- wide vectors

def test_means_of_wide_vectors(spark):
    """2,000 entries: one aggregate of arrays."""
    r = np.random.default_rng(1)
    x = r.normal(size=(60, 2000))
    rows = [(i, i % 3, [float(v) for v in x[i]]) for i in range(60)] + [(90, 1, None), (91, 7, [1.0]), (92, 8, [None] + [1.0] * 1999)]
    df = spark.createDataFrame(rows, "id long, g int, v array<double>")
    out = pairwise.group_means(df, "g", "v", 2000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("avg(") == 0
    got = {q["g"]: q["mean_vec"] for q in out.collect()}
    for g in range(3):
        assert got[g] == pytest.approx(x[g::3].mean(0), abs=1e-12)
    assert got[7] is None and got[8] is None


def test_fits_of_wide_tables_equal_narrow_ones(spark, monkeypatch):
    r = np.random.default_rng(2)
    x = r.normal(size=(80, 6)) + r.integers(0, 2, (80, 1)) * 4
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame([(i, "a" if x[i].sum() > 9 else "b", *map(float, x[i])) for i in range(80)], "id long, y string, " + ", ".join(f"{n} double" for n in names))

    def fits():
        lr, km = linear.logreg_fit(df, names, "y", tol=-1.0, max_iter=6), cluster.kmeans_fit(df, names, 3, "id", max_iter=5, tol=-1.0)
        return lr.weights, [v for c in km.centers for v in c]

    narrow = fits()
    for module in (linear, cluster):
        monkeypatch.setattr(module, "WIDE", 2)
    for a, b in zip(narrow, fits()):
        assert a == pytest.approx(b, abs=1e-9)
