"""Decontamination, n-gram join, line dedup, repeated passages: brute force and hard cases."""

import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablelearn.llm import line_dedup
from tablelearn.llm.common import Scratch, connected_components, read_table
from tablelearn.llm.decontaminate import contaminated, decontaminate, digest, words_of
from tablelearn.llm.line_dedup import dedup_lines, line_report
from tablelearn.llm.ngram_join import boundary, missing, ngram_components, subset_keys
from tablelearn.llm.substring_dedup import anchors, repeated_passages, tuned_bands

from ..conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string"


def vocabulary(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) for _ in range(n)]


def hard_texts():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text."""
    r, v = random.Random(5), vocabulary(400, 1)
    base = [r.choice(v) for _ in range(80)]
    rows = [(1, None), (2, ""), (3, "  \n \t "), (4, "one"), (5, "ONE"), (6, "two words"), (7, " ".join(base)), (8, " ".join(base)),
            (8, " ".join(base)), (9, " ".join(base[:40] + ["other"] + base[41:])), (None, " ".join(base)), (None, None),
            (10, " ".join(r.choice(v) for _ in range(30000))), (11, "é À " + " ".join(base[:9])), (12, "\n".join(base[:20])), (12, None)]
    return [(i, t, "en") for i, t in rows]


# ---- components

def test_saved_tables_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {n for n in disk.getAllFiles().mkString("\n").split("\n") if n.endswith(".data")}
    before = files()
    with Scratch(spark, "t") as own:
        assert own.save(spark.range(10000).groupBy((F.col("id") % 77).alias("k")).count()).count() == 77
        for _ in range(50):  # the count above has a shuffle of its own, which stays
            if len(files() - before) <= 1:
                break
            time.sleep(0.2)
    assert len(files() - before) <= 1


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    random.Random(1).shuffle(edges)
    with Scratch(spark, "t") as own:
        got = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), own).collect())
    want = {i: 100 for i in range(100, 161)} | {i: 0 for i in range(50)} | {i: 200 for i in range(200, 203)}
    assert got == want


# ---- decontamination

def brute_contamination(docs, items, window=13):
    out = []
    for _, text, *_ in docs:
        w = words_of((text or "").encode())
        hit, found = set(), set()
        for item, t in items:
            x = words_of((t or "").encode())
            n = min(window, len(x))
            if n:
                grams = {tuple(x[j:j + n]) for j in range(len(x) - n + 1)}
                for p in range(len(w) - n + 1):
                    if tuple(w[p:p + n]) in grams:
                        hit |= set(range(p, p + n))
                        found.add("" if item is None else str(item))
        out.append((len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def benchmark_rows():
    r, v = random.Random(9), vocabulary(60, 2)
    items = [(i, " ".join(r.choice(v) for _ in range(r.choice([3, 12, 13, 14, 40])))) for i in range(30)]
    return items + [(100, None), (101, ""), (102, "!!"), (None, "alpha beta gamma"), (7, items[0][1]), (103, items[1][1])], v


def contaminated_docs(items, v):
    r = random.Random(3)
    docs = [(i, " ".join(r.choice(v) for _ in range(60)), "x") for i in range(20)]
    for i in range(20, 60):
        a, b = r.choice(items)[1] or "", r.choice(items)[1] or ""
        docs.append((i, " ".join(["Zz"] * r.randint(0, 400)) + " " + a.upper() + ", " + b[:r.randint(0, 80)] + " . " + a, "x"))
    return docs + hard_texts() + [docs[-1], (70, "alpha BETA gamma", "x")]


@pytest.mark.parametrize("part_bytes", [1 << 20, 400])
def test_decontamination_equals_brute_force(spark, part_bytes):
    items, v = benchmark_rows()
    docs = contaminated_docs(items, v)
    df = spark.createDataFrame(docs, DOCS).withColumn("contamination", F.lit("old")).withColumn("n_words", F.lit(0)).repartition(3)
    got = decontaminate(df, spark.createDataFrame(items, "item_id long, text string"), max_benchmark_bytes=part_bytes)
    assert set(got.columns) == {"doc_id", "text", "lang", "n_words", "contamination"}
    rows = got.select("contamination.*", contaminated().alias("c")).collect()
    assert sorted((r["n_words"], r["n_hit"], tuple(r["items"]), r["c"]) for r in rows) == brute_contamination(docs, items)
    for r in rows:
        assert (r["longest"] > 0) == (r["n_hit"] > 0)


def test_decontamination_longest_match_and_empty_inputs(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b " + " ".join(f"w{i}" for i in range(5, 25)) + " c", "x")], DOCS)
    r = decontaminate(docs, items).first()["contamination"]
    assert (r["n_hit"], r["longest"], r["longest_item"], r["longest_at"], r["spans"]) == (20, 20, "1", 2, [2, 22])
    assert decontaminate(docs.limit(0), items).count() == 0
    none = decontaminate(docs, items.limit(0))
    assert none.select(*digest(none)).first()["contaminated"] is False


# ---- n-gram join

def brute_groups(docs, num=90, den=100, k=3):
    sets = []
    for i, t, *_ in docs:
        w = (t or "").encode().lower().split()
        n = min(k, len(w))
        sets.append({tuple(w[p:p + n]) for p in range(len(w) - n + 1)} if n else set())
    parent = list(range(len(docs)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    names = defaultdict(list)
    for a in range(len(docs)):
        names[root(a)].append(docs[a][0])
    def name(a):
        ids = [i for i in names[root(a)] if i is not None]
        return min(ids) if ids and sets[a] else docs[a][0]
    return sorted(((i, len(s), name(a)) for a, ((i, *_), s) in enumerate(zip(docs, sets))), key=repr)


def near_copies(seed, sizes, copies):
    r, v = random.Random(seed), vocabulary(3000, 4)
    docs, n = [], 1000
    for size in sizes:
        base = [r.choice(v) for _ in range(size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                at = r.randrange(len(w))
                w[at:at + r.randint(0, 1)] = [r.choice(v)] * r.randint(0, 2)
            docs.append((n, " ".join(w), "x"))
            n += 1
    return docs


def test_ngram_join_equals_brute_force(spark):
    docs = near_copies(1, [3, 5, 9, 11, 12, 13, 14, 20, 22, 25, 31, 40, 60, 90, 120, 200], 14) + hard_texts()
    df = spark.createDataFrame(docs, DOCS).withColumn("n", F.lit(1)).withColumn("node", F.lit(2)).repartition(5)
    got = ngram_components(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_groups(docs)


def test_ngram_join_other_threshold(spark):
    docs = near_copies(2, [8, 15, 30, 50], 12)
    got = ngram_components(spark.createDataFrame(docs, DOCS), k=5, num=80, den=100).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_groups(docs, 80, 100, 5)


def test_ngram_join_empty_table(spark):
    assert ngram_components(spark.createDataFrame([], DOCS)).count() == 0


def test_subset_sizes_cover_what_a_partner_can_share():
    import numpy as np

    for n in range(1, 30):
        sizes = {c for c, _ in subset_keys(np.arange(n, dtype=np.uint64), 90, 100)}
        assert sizes == set(range(n - missing(n, 90, 100), n + 1))
    few = np.zeros(40)
    assert boundary(few, 90, 100) >= 9
    few[12] = 10**9
    assert boundary(few, 90, 100) >= 12  # long lists make subsets worth while


# ---- line dedup

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute_lines(docs, edits, min_chars):
    docs = sorted(docs, key=lambda d: d[0])
    places = [(i, p, x) for i, t in docs if t is not None for p, x in enumerate(t.split("\n"))]
    gone = defaultdict(list)
    for a, (i, p, x) in enumerate(places):
        if len(x) >= min_chars and any(len(y) >= min_chars and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits
                                       for _, _, y in places[:a]):
            gone[i].append(p)
    return {i: gone[i] for i, _ in docs}


def line_docs(seed=7):
    r = random.Random(seed)
    bases = ["".join(r.choice("abcdé ") for _ in range(r.randint(8, 40))) for _ in range(15)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(r.randint(0, 5)):
            x = list(r.choice(bases))
            for _ in range(r.randint(0, 3)):
                at = r.randrange(len(x))
                x[at:at + r.randint(0, 1)] = r.choice(["", "z", "é", "ab"])
            lines.append("".join(x))
        docs.append((i, "\n".join(lines)))
    # a family that differs in one or two places only, so that all lists of the index are long
    docs += [(100 + i, f"a very common line number {i:03d} of the family\nshort") for i in range(60)]
    return docs + [(200, None), (201, ""), (202, "\n\n"), (203, "x" * 20000), (204, "x" * 19999 + "y"), (205, "x" * 20001)]


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_line_dedup_equals_brute_force(spark, edits):
    docs = line_docs()
    long = {203, 204, 205}
    want = brute_lines([d for d in docs if d[0] not in long], edits, 12)
    want |= {203: [], 204: [0] if edits else [], 205: [0] if edits else []}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("pos", F.lit("clash")).withColumn("gone", F.lit(1)).repartition(4)
    out = dedup_lines(df, max_edits=edits, min_chars=12)
    assert set(out.columns) == {"doc_id", "text", "pos", "gone", "dropped_lines"}
    got = {r["doc_id"]: r for r in out.collect()}
    assert {i: r["dropped_lines"] for i, r in got.items()} == want
    for i, t in docs:
        left = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in want[i])
        assert got[i]["text"] == left


def test_line_dedup_repeated_rows_null_ids_and_empty_table(spark):
    line = "this line is long enough to be looked at"
    docs = [(1, line), (1, line), (None, line), (2, line + "\n" + line)]
    got = sorted(map(tuple, line_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()), key=repr)
    # the null id comes first; repeated rows are judged alike
    assert got == sorted([(1, 1, 1, "0"), (1, 1, 1, "0"), (None, 1, 0, ""), (2, 2, 2, "0,1")], key=repr)
    assert line_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_dedup_pairs_lines_of_a_common_passage_only_where_they_can_be_near(spark, monkeypatch):
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n)).replace("  ", " x")
    passage = text(200)
    lines = [passage + text(200) for _ in range(60)]
    lines += [lines[7][:300] + "#" + lines[7][301:350] + lines[7][351:], lines[9] + "!"]
    tried = []
    plain = line_dedup._late_by_length

    def counted(lines, own, near):
        def counting(pairs):
            tried.append(pairs.count())
            return near(pairs)
        return plain(lines, own, counting)

    monkeypatch.setattr(line_dedup, "_late_by_length", counted)
    out = dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), copy_chars=1, double_from=64)
    assert {x["doc_id"] for x in out.collect() if x["dropped_lines"]} == {60, 61}
    assert sum(tried) < 5 * len(lines)


def test_line_dedup_runs_no_python(spark):
    plan = line_report(read_table(spark, SF_SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- repeated passages

def test_planted_passages_are_found_and_clean_documents_left(spark):
    r, v = random.Random(11), vocabulary(5000, 6)
    text = lambda n: [r.choice(v) for _ in range(n)]
    docs, planted = [], defaultdict(set)
    passages = [text(51) for _ in range(20)]
    for i in range(100):
        body = text(r.randint(0, 300))
        if i < 60:
            at = r.randint(0, len(body))
            planted[i % 20].add(i)
            body[at:at] = passages[i % 20]
        docs.append((i, " ".join(body), "x"))
    docs += [(500 + i, t, x) for i, (_, t, x) in enumerate(hard_texts()[:4])]
    got = repeated_passages(spark.createDataFrame(docs, DOCS).withColumn("start", F.lit(1)).repartition(4)).collect()
    touched = {r["doc_id"] for r in got} | {r["kept_id"] for r in got}
    assert touched == set(range(60))
    for ids in planted.values():  # the smallest id keeps its passage
        assert {r["doc_id"] for r in got} & ids == ids - {min(ids)}
    assert all(r["kept_id"] < r["doc_id"] for r in got)


def test_near_passages_and_hard_cases(spark):
    r, v = random.Random(12), vocabulary(5000, 7)
    base = [r.choice(v) for _ in range(400)]
    docs = [(1, " ".join(base)), (2, " ".join(w if j % 60 else "changed" for j, w in enumerate(base))), (3, " ".join(base)), (3, " ".join(base)),
            (4, " ".join(["same"] * 500)), (5, None), (6, ""), (7, " ".join(base[:19]))]
    got = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == {2, 3} and {r["kept_id"] for r in got} == {1}
    assert repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_paragraphs_behind_an_unrelated_pivot_are_found(spark):
    # one phrase in all paragraphs: most bands hold many contents, whose least one is similar to none of a pair
    r, v = random.Random(21), vocabulary(5000, 8)
    phrase, docs = [r.choice(v) for _ in range(17)], []
    for i in range(100):
        own = [f"own{i}a", f"own{i}b"]
        docs += [(2 * i, " ".join(phrase + own + ["left"])), (2 * i + 1, " ".join(phrase + own + ["right"]))]
    got = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {(r["doc_id"], r["kept_id"]) for r in got} == {(2 * i + 1, 2 * i) for i in range(100)}


def test_anchors_cover_every_window():
    import numpy as np

    rng = np.random.default_rng(1)
    for h in (rng.integers(0, 1 << 60, 5000).astype(np.uint64), rng.integers(1, 5, 3000).astype(np.uint64)):
        at = anchors(h, np.array([len(h)]), 32)
        assert len(at) < len(h) / 5 and np.all(np.diff(at) > 0) and np.diff(at).max() <= 64
    h = rng.permutation(4000).astype(np.uint64) + np.uint64(1)
    distinct = anchors(h, np.array([4000]), 32)
    assert np.diff(distinct).max() <= 32 and distinct[0] < 32
    assert set(distinct) == {s + int(np.argmin(h[s:s + 32])) for s in range(4000 - 31)}
    # texts do not see each other
    parts = np.array([7, 0, 100, 31, 32, 1])
    apart = [int(a + b) for a, n in zip(np.cumsum(parts) - parts, parts) for b in anchors(h[a:a + n], np.array([n]), 32)]
    assert anchors(h[:parts.sum()], parts, 32).tolist() == apart


def test_tuned_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.999):  # bands of two rows or more
        b, r = tuned_bands(0.8, recall)
        assert 1 - (1 - 0.8**r) ** b >= recall
