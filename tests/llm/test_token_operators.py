"""Byte-level BPE, spelling variants, token alignment: libraries, brute force and hard cases."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tablelearn.llm import byte_bpe, spelling, token_alignment
from tablelearn.llm.byte_bpe import BytePairs, decode, encode, vocabulary
from tablelearn.llm.common import Scratch, read_table
from tablelearn.llm.spelling import spelling_forms
from tablelearn.llm.token_alignment import (Rows, added, align, groups_of, overlap_links, product, shared_links,
                                            token_links, tokenizer_a, tokenizer_b)

from ..conftest import SF_SMALL

DOCS = "doc_id long, text string, ids string, k string, t string, block string, word string"


def rows_of(pairs):
    return [(i, t, "x", "x", "x", "x", "x") for i, t in pairs]


def hard_texts():
    """Nulls, empty texts, ties, repeated rows, runs without a break, names of special tokens, other scripts, a very long text."""
    r = random.Random(9)
    any_char = [*range(1, 0xD800), *range(0xE000, 0x33500)]
    texts = [(1, None), (2, ""), (None, "x " * 5), (None, None), (3, "a<|endoftext|>b <s> </s> <unk> ▁ <0x0A>"), (4, "=" * 5000),
             (4, "=" * 5000), (5, "  \n\n\t x" + " " * 300), (6, "日本語 テスト 🎉🎊" * 40), (7, "\x01\x85\x1c a"), (8, "ＡＢＣ ﬁ é é"),
             (9, "a" * 3000 + "b" * 777), (10, " ".join(r.choice(["word", "Wörter", "mots", "42"]) for _ in range(30000)))]
    for i in range(40):
        texts.append((20 + i, "".join(chr(r.choice(any_char)) for _ in range(r.choice([1, 7, 80, 400])))))
        texts.append((70 + i, "".join(r.choice("=- .\nab'") for _ in range(r.choice([5, 70, 600])))))
    return texts


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_bpe.RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# ---- byte-level BPE

def test_encoding_is_the_librarys_and_decodes_back(spark):
    want, texts = library(), hard_texts()
    df = spark.createDataFrame(rows_of(texts), DOCS).repartition(3)
    got = decode(encode(df)).collect()  # the column named ids is replaced
    assert set(got[0].asDict()) == {"doc_id", "text", "ids", "k", "t", "block", "word", "decoded"}
    assert Counter((r.doc_id, r.text) for r in got) == Counter(texts)
    for r in got:
        assert r.ids == want.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_encoding_of_a_whole_table(spark):
    want = library()
    docs = read_table(spark, SF_SMALL, "documents")
    for r in encode(docs, keep=["doc_id", "text"]).collect():
        assert r.ids == want.encode_ordinary(r.text or "")


def test_pattern_agrees_with_the_library_for_every_character():
    """Of all characters, the same ones count as letters, numbers and spaces."""
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    ones = {bytes([i]): i for i in range(256)}
    for pattern in (r"\p{L}", r"\p{N}", r"\s"):
        match = tiktoken.Encoding("one", pat_str=pattern, mergeable_ranks=ones, special_tokens={})
        mine = byte_bpe.pieces_of(everything.encode(), byte_bpe.regex.compile(pattern))
        assert "".join(mine).encode() == bytes(match.encode_ordinary(everything))
    assert vocabulary().pattern.pattern == public_tokenizers.PATTERN


def plain_merge(ranks, piece):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        options = [(ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(options)
        if rank == 1 << 40:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


@pytest.mark.parametrize("seed", range(25))
def test_merges_in_any_rank_order(seed):
    """Vocabularies whose longer entries may come before their parts: both forms of the merge keep the order of single merges."""
    r = random.Random(seed)
    entries = {bytes([i]) for i in range(256)}
    while len(entries) < 256 + 40:
        entries.add(bytes(r.choice(b"abc") for _ in range(r.randint(2, 5))))
    order = sorted(entries)
    r.shuffle(order)
    ranks = {t: i for i, t in enumerate(order)}
    own = BytePairs(ranks)
    for _ in range(40):
        piece = bytes(r.choice(b"abcd") for _ in range(r.randint(1, 60)))
        want = plain_merge(ranks, piece)
        ids = own.byte_ids[np.frombuffer(piece, np.uint8)]
        row = own.merge_rows(np.r_[ids, np.full(7, -1, np.int32)][None])[0]
        assert row[row >= 0].tolist() == want
        assert own.merge_long(ids.copy()).tolist() == want


def test_pieces_are_forgotten_and_found_again(monkeypatch):
    own = BytePairs(vocabulary().ranks)
    monkeypatch.setattr(byte_bpe, "KEPT_PIECES", 3)
    text = b"several different words of one text"
    first = own.encode([text, b"", text])
    again = own.encode([text, b"", text])
    assert all((a == b).all() for a, b in zip(first, again)) and first[1][1] == 0


def test_decoding_of_nulls_and_unknown_ids(spark):
    rows = [(1, None), (2, []), (3, [64, None, 65]), (4, [50255] * 9)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded and bytes(r.decoded) for r in decode(df, most=2).collect()}
    back = {i: t for t, i in vocabulary().ranks.items()}
    assert got[1] is None and got[2] in (b"", None) and got[3] == back[64] + back[65] and got[4] == back[50255] * 9
    for bad in ([60000], [-5]):
        with pytest.raises(Exception, match="not in the vocabulary"):
            decode(spark.createDataFrame([(1, bad)], "doc_id long, ids array<int>")).collect()
    assert decode(encode(spark.createDataFrame([], DOCS))).collect() == []
    with pytest.raises(ValueError, match="single byte"):
        BytePairs({b"a": 0})


# ---- spelling variants

def brute_forms(texts, every=31, ratio=10):
    count = Counter()
    for k, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= 2}
    near, by = defaultdict(set), defaultdict(list)
    for w in count:
        for i in range(len(w)):
            by[w[:i], w[i + 1:]].append(w)
            if (d := w[:i] + w[i + 1:]) in count:
                near[w].add(d)
                near[d].add(w)
    for group in by.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w in count:
        f = min(near[w], key=lambda x: (-count[x], x), default=None)
        if f and count[f] >= ratio * count[w]:
            form[w] = f
    out = set()
    for w in count:
        last = w
        while last in form:
            last = form[last]
        out.add((w, form.get(w), last, count[w], len(near[w]), count.get(form.get(w))))
    return out


def word_texts():
    """Families of words one edit apart, chains of forms, ties, doubled letters, long words, one word in most texts."""
    r = random.Random(4)
    base = ["".join(r.choice("abcdé") for _ in range(r.randint(7, 10))) for _ in range(12)]
    words = []
    for w in base:
        words += [w] * r.choice([2, 30, 300])
        for _ in range(12):
            i = r.randrange(len(w))
            x = r.choice([w[:i] + w[i + 1:], w[:i] + r.choice("abcdeÿÀ×") + w[i + 1:], w[:i] + r.choice("abcde") + w[i:]])
            words += [x] * r.choice([1, 2, 3, 40])
    words += ["chained"] * 400 + ["chaine"] * 50 + ["chainee"] * 30 + ["chaineee"] * 3 + ["aaaaaaa"] * 2 + ["aaaaaaaa"] * 20 + ["BBBBBBBB", "bbbbbbbb", "bbbbbbbé"]
    long = "".join(r.choice("abcdefgh") for _ in range(3000))
    words += [long] * 2 + [long[:1500] + "z" + long[1501:]] * 20 + [long[1:]] * 3 + ["c" * 63] * 2 + ["c" * 64] * 20 + ["c" * 65] * 2
    r.shuffle(words)
    texts = [(i, " ".join(words[i * 40:i * 40 + 40]) + " hotword-hotword") for i in range(len(words) // 40 + 1)]
    return texts + [(1, None), (2, ""), (None, "nulltext nulltext"), (3, "short and 12"), (3, "repeated"), (3, "repeated")]


def test_spelling_against_brute_force(spark):
    texts = word_texts()
    df = spark.createDataFrame(rows_of(texts), DOCS).repartition(4)
    assert {tuple(r) for r in spelling_forms(df, drop_every=31).collect()} == brute_forms(texts)
    got = spelling_forms(df, ratio=3).collect()
    assert {tuple(r) for r in got} == brute_forms(texts, None, 3)
    assert len(got) == len({r.word for r in got})


def test_spelling_in_several_passes(spark, monkeypatch):
    """Filters beyond the bound are probed part by part, with the same result."""
    monkeypatch.setattr(spelling, "CHUNK", 256)
    sizes = {7: 1024, 8: 3000, spelling.LONG: 1024}
    parts = spelling.passes(sizes, 4 * 8 * 256)
    assert max(sum(n for _, _, n in p) for p in parts) <= 4 and len(parts) == 5
    docs = read_table(spark, SF_SMALL, "documents")
    want = {tuple(r) for r in spelling_forms(docs, drop_every=31).collect()}
    with Scratch(spark, "t") as own:
        words = own.save(spelling.vocabulary(docs, drop_every=31))
        few = {tuple(r) for r in spelling.near_words(words, own, most=4 * 8 * 256).collect()}
        one = {tuple(r) for r in spelling.near_words(words, own).collect()}
    assert few == one and want == brute_forms([(r.doc_id, r.text) for r in docs.collect()])


def test_spelling_filters_lose_nothing_and_let_little_through():
    r = random.Random(2)
    words = sorted({"".join(r.choice("abcdefghijkl") for _ in range(9)) for _ in range(20000)})
    sizes = {9: spelling.blocks_of(len(words), 9)}
    bits = np.zeros(sizes[9], np.uint64)
    m = spelling.matrix(words, 9)
    block, mask = spelling.block_and_mask(spelling.finished(spelling.position_sums(m), 9), sizes[9])
    np.bitwise_or.at(bits, block, mask)
    loaded = {9: (0, bits)}
    assert len(spelling.let_through(spelling.position_sums(m), 9, sizes, loaded)) == len(words)
    others = ["".join(r.choice("mnopqrst") for _ in range(9)) for _ in range(20000)]
    passed = spelling.let_through(spelling.position_sums(spelling.matrix(others, 9)), 9, sizes, loaded)
    assert len(passed) < 0.01 * len(others)


def test_sums_of_deletions_are_those_of_the_shorter_words():
    words = ["abcdefg", "aabbccd", "ggggggg"]
    m = spelling.matrix(words, 7)
    row, at, sums = spelling.deletions(m)
    shorter = [words[i][:j] + words[i][j + 1:] for i, j in zip(row, at)]
    assert (spelling.position_sums(spelling.matrix(shorter, 6)) == sums).all()
    assert Counter(row.tolist()) == {0: 7, 1: 4, 2: 1}


def test_spelling_of_empty_tables(spark):
    assert spelling_forms(spark.createDataFrame([], DOCS)).collect() == []
    assert spelling_forms(spark.createDataFrame(rows_of([(1, "a b"), (2, None)]), DOCS)).collect() == []
    with pytest.raises(ValueError):
        spelling_forms(spark.createDataFrame([], DOCS), ratio=1)


# ---- token alignment

def brute_alignment(texts):
    a, b = tokenizer_a(ranks=None), tokenizer_b()
    docs, count, best = [], Counter(), defaultdict(int)
    for k, t in texts:
        x, y = (a.encode([t])[0], b.encode([t])[0]) if t else ([], [])
        raw = (" " + (t or "")).encode()
        if any(b"".join(c.bytes_of[i] for i in ids) != raw for c, ids in ((a, x), (b, y))):
            x = y = []
        ends_a, ends_b = (np.cumsum([len(c.bytes_of[i]) for i in ids]).tolist() for c, ids in ((a, x), (b, y)))
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = [([], []) for _ in cuts]
        for side, ids, ends in ((0, x, ends_a), (1, y, ends_b)):
            for i, g in zip(ids, np.searchsorted(cuts, ends).tolist()):
                groups[g][side].append(i)
        links = Counter((i, j) for g in groups for i in g[0] for j in g[1])
        count.update(links.keys())
        docs.append((k, x, y, groups, links))
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for k, x, y, groups, links in docs:
        listing = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((k, len(x), len(y), len(groups), sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]),
                    sum(n * count[p] for p, n in links.items()), hashlib.sha256(listing.encode()).hexdigest() if x else ""))
    return Counter(out)


def test_alignment_against_brute_force(spark):
    texts = hard_texts()
    df = spark.createDataFrame(rows_of(texts), DOCS).repartition(3)
    assert Counter(map(tuple, align(df).collect())) == brute_alignment(texts)


def test_alignment_of_a_whole_table_in_many_slices(spark, monkeypatch):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    want = brute_alignment([tuple(r) for r in docs.collect()])
    assert Counter(map(tuple, align(docs).collect())) == want
    texts = [(r.text or "").encode() for r in docs.limit(60).collect()]
    a, b = tokenizer_a(), tokenizer_b()
    whole = token_alignment.aligned(texts, a, b)
    small = [token_alignment.aligned([t], a, b) for t in texts]
    assert whole.listing == [s.listing[0] for s in small]
    assert whole.pair.tolist() == [p for s in small for p in s.pair.tolist()]
    assert whole.links.tolist() == [p for s in small for p in s.links.tolist()]


def test_products_of_compressed_rows():
    r = np.random.default_rng(5)
    x, y = (r.integers(0, 3, (17, 11)) * (r.random((17, 11)) < 0.3), r.integers(0, 3, (11, 13)) * (r.random((11, 13)) < 0.4))

    def rows(m):
        row, column = np.nonzero(m)
        return Rows(np.r_[0, np.cumsum((m > 0).sum(1))], column, m[row, column], m.shape[1])

    for most in (1, 7, 1000):  # a run of rows at a time
        out = np.zeros((17, 13), int)
        for i, j, v in product(rows(x), rows(y), most):
            out[i, j] += v
        assert (out == x @ y).all()
    t = rows(x).transposed()
    back = np.zeros((11, 17), int)
    back[t.row_of(), t.column] = t.value
    assert (back == x.T).all()
    assert [v.tolist() for v in added(np.array([3, 1, 3]), np.array([1, 1, 5]))] == [[1, 3], [1, 6]]


def test_links_of_intervals_and_crowded_groups(monkeypatch):
    a, b = np.array([2, 1, 3, 1]), np.array([1, 1, 3, 1, 1])
    left, right, shared = overlap_links(a, b)
    assert [*zip(left.tolist(), right.tolist(), shared.tolist())] == [(0, 0, 1), (0, 1, 1), (1, 2, 1), (2, 2, 2), (2, 3, 1), (3, 4, 1)]
    ga, gb, n = groups_of(left, right, 4, 5)
    assert (ga.tolist(), gb.tolist(), n) == ([0, 1, 1, 2], [0, 0, 1, 1, 2], 3)
    ids_a, ids_b = np.array([7, 7, 7, 9]), np.array([4, 4, 5, 5, 4])
    doc = np.zeros(3, np.int64)
    want = None
    for crowded in (0, 3, 1000):  # ids added first or not, the same links
        monkeypatch.setattr(token_alignment, "CROWDED", crowded)
        got = [v.tolist() for v in shared_links(ids_a, ids_b, ga, gb, n, doc)]
        want = want or got
        assert got == want
    assert dict(zip(want[1], want[2])) == {7 << 20 | 4: 2, 7 << 20 | 5: 4, 9 << 20 | 4: 1}


def test_token_links_cover_the_text(spark):
    texts = [(1, "Grüße, 42 naïve words"), (2, None), (3, "=" * 700), (4, "")]
    a, b = tokenizer_a(), tokenizer_b()
    for r in token_links(spark.createDataFrame(rows_of(texts), DOCS)).collect():
        text = dict(texts)[r.doc_id]
        if not text:
            assert r.a_ids == r.b_ids == r.link_a == []
            continue
        raw = (" " + text).encode()
        assert a.covers(r.a_ids, raw) and b.covers(r.b_ids, raw) and sum(r.link_bytes) == len(raw)
        assert all(r.a_group[i] == r.b_group[j] for i, j in zip(r.link_a, r.link_b))
        assert r.a_group[-1] == r.b_group[-1] == len(set(r.a_group)) - 1


def test_alignment_of_empty_tables(spark):
    assert align(spark.createDataFrame([], DOCS)).collect() == []
    got = align(spark.createDataFrame(rows_of([(1, None), (2, "")]), DOCS)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_fast_and_slow_library_of_tokenizer_a_agree(spark):
    texts = [r.text for r in read_table(spark, "/root/testdata/sf0.01", "documents").select("text").where(F.col("text") != "").collect()]
    assert tokenizer_a().encode(texts) == tokenizer_a(ranks=None).encode(texts)
