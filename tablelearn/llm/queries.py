"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them.

Each reads its whole table with the parameters an operator has in production.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import decode, encode
from .common import read_table
from .decontaminate import decontaminate, digest
from .language_model import language_model_scores
from .line_dedup import MAX_EDITS, MIN_CHARS, line_report
from .ngram_join import ngram_components
from .packing import pack
from .quality import fit, score
from .spelling import MIN_COUNT, MIN_LENGTH, RATIO, spelling_forms
from .substring_dedup import repeated_passages
from .token_alignment import align
from .topk import top_k
from .url_rules import SITE_RULES, judge_urls
from .warc import round_trip

LABEL_FOLD = 5  # rows whose crc32(doc_id) is divisible by it are held out
THRESHOLD = 0.3
SLIP_EVERY = 31  # runs whose crc32 with the document's id it divides lose one character
LM_FOLD, LM_HELD_OUT = 7, 2  # rows with this remainder of crc32(doc_id) don't train the language model


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), with_ids=False)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(LABEL_FOLD)) == 0
    scored = score(docs, fit(docs, labels.where(~held_out)), keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(LM_FOLD)) == LM_HELD_OUT
    return language_model_scores(read_table(spark, sf_dir, "documents"), held_out)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return (found := decontaminate(docs, benchmark, keep=["doc_id"])).select("doc_id", *digest(found))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), is_query=F.pmod(F.col("vec_id"), F.lit(50)) == 0, k=5)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(read_table(spark, sf_dir, "documents"), drop_every=SLIP_EVERY)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = encode(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return decode(ids).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_url_filter": op2_url_filter,
    "op3_warc": op3_warc,
    "op4_quality": op4_quality,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_language_model": op6_language_model,
    "op7_decontamination": op7_decontamination,
    "op8_topk": op8_topk,
    "op9_ngram_join": op9_ngram_join,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": pipeline,
}


def _url_sql() -> str:
    parts = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
    fits = " ".join(
        f"WHEN path LIKE '{p}%' AND (host = '{h}' OR host LIKE '%.{h}') THEN '{{}}'".format(f"{h}{p}")
        for h, p, _ in sorted(SITE_RULES, key=lambda r: -len(r[0] + r[1])))
    acts = " ".join(f"WHEN '{h}{p}' THEN '{a}'" for h, p, a in SITE_RULES)
    return f"""
WITH u AS (SELECT page_id, coalesce(regexp_extract(url, {parts}, 1), '') AS h, coalesce(regexp_extract(url, {parts}, 2), '') AS path FROM pages),
v AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
w AS (SELECT *, CASE {fits} END AS rule FROM v)
SELECT page_id, host, path, rule, CASE rule {acts}
  ELSE CASE WHEN regexp_matches(host || path, '^([^/]*[.-])?cheap-pills\\.') OR regexp_matches(host || path, '^([^/]*[.-])?online-casino\\.')
    OR regexp_matches(host || path, '/(login|signup|logout)(/|$)') OR regexp_matches(host || path, '^([^/]*\\.)?ads?\\.[^/]+\\.[a-z]+/')
    THEN 'block' ELSE 'allow' END END AS verdict
FROM w"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
j AS (SELECT item_id, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
k AS (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM j),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s FROM k),
sizes AS (SELECT DISTINCT n FROM j),
spot AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s FROM spot),
hit AS (SELECT dw.doc_id, dw.n, dw.p, win.item_id FROM dw JOIN win ON dw.n = win.n AND dw.s = win.s),
words AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS p FROM hit),
nh AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY doc_id),
ids AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM ids GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN nh USING (doc_id) LEFT JOIN it USING (doc_id)"""

_TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.w AS DOUBLE[]), CAST(c.w AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_NGRAM_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, least(3, len(w)) AS n, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS p FROM d WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + n - 1], ' ') AS s FROM p),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM inter JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y WHERE 100 * i >= 90 * (a.n + b.n - i)),
two AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT x, y FROM two UNION SELECT reach.x, two.y FROM reach JOIN two ON reach.y = two.x),
low AS (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM documents LEFT JOIN size USING (doc_id) LEFT JOIN low USING (doc_id)"""

_LINES_SQL = f"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
o AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM s WHERE l IS NOT NULL),
e AS (SELECT doc_id, i - 1 AS pos, l[i] AS line FROM o WHERE length(l[i]) >= {MIN_CHARS}),
f AS (SELECT line, length(line) AS n, min((doc_id, pos)) AS place FROM e GROUP BY line),
late AS (SELECT DISTINCT CASE WHEN a.place < b.place THEN b.line ELSE a.line END AS line FROM f a
  JOIN f b ON b.n BETWEEN a.n AND a.n + {MAX_EDITS} AND a.line <> b.line AND levenshtein(a.line, b.line) <= {MAX_EDITS}),
gone AS (SELECT e.doc_id, e.pos FROM e JOIN f USING (line) LEFT JOIN late ON late.line = e.line
  WHERE (e.doc_id, e.pos) <> f.place OR late.line IS NOT NULL),
g AS (SELECT doc_id, count(*) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS dropped FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(l), 0) AS n_lines, coalesce(n, 0) AS n_dropped, coalesce(dropped, '') AS dropped
FROM s LEFT JOIN g USING (doc_id)"""

def _crc_table() -> str:
    """The 256 steps of the checksum, from its polynomial, as a SQL list."""
    steps = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        steps.append(c)
    return "[" + ", ".join(map(str, steps)) + "]::BIGINT[]"


# crc32 of "id:run" by bytes (characters up to U+00FF have at most two)
_SPELLING_SQL = f"""
WITH RECURSIVE steps AS MATERIALIZED (SELECT {_crc_table()} AS t),
r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents WHERE text IS NOT NULL),
d AS (SELECT doc_id, run, length(run) AS len, count(*) AS n FROM r GROUP BY ALL HAVING length(run) >= {MIN_LENGTH}),
b AS (SELECT run, len, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
  lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bytes FROM d),
h AS (SELECT run, len, n, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c, x::BIGINT) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM b, steps),
e AS (SELECT CASE WHEN h % {SLIP_EVERY} = 0 THEN run[:h % len] || run[h % len + 2:] ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM e WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
k AS (SELECT word, n, i, word[:i - 1] AS a, word[i + 1:] AS z FROM p),
pairs AS (SELECT x.word, y.word AS near, y.n AS near_n FROM k x JOIN k y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT k.word, v.word, v.n FROM k JOIN v ON k.a || k.z = v.word
  UNION SELECT v.word, k.word, k.n FROM k JOIN v ON k.a || k.z = v.word),
best AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS top FROM pairs GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= {RATIO} * v.n THEN top[2] END AS form,
  CASE WHEN -top[1] >= {RATIO} * v.n THEN -top[1] END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL),
last AS (SELECT walk.word, root FROM walk JOIN f ON f.word = root WHERE f.form IS NULL)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, CAST(form_n AS BIGINT) AS form_n FROM f LEFT JOIN last ON last.word = f.word"""

SQL = {
    "op2_url_filter": _url_sql(),
    "op7_decontamination": _DECONTAMINATION_SQL,
    "op8_topk": _TOPK_SQL,
    "op9_ngram_join": _NGRAM_SQL,
    "op10_line_dedup": _LINES_SQL,
    "op11_spelling_variants": _SPELLING_SQL,
}
