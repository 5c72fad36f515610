"""Line deduplication with a segment-partition edit join, in DataFrame operations only.

Equal lines collapse first (partial minimum per line, so a line that a third of
all documents hold is one row).  Each distinct line of length l is cut into
``max_edits`` + 1 segments; two lines within that many edits share a segment
at nearly the same place.  An index holds (l, segment number, segment), and a line of
length L looks up, for every l from L - max_edits to L, the substrings at the few
places where a segment could have moved.  Lists of the index with more than ``HOT``
lines are split again by the segments of what is left of the line, until they are short or
their lines differ in ``max_edits`` characters only; so the pairs grow with the
lines, not with the square of a list.  Candidates are verified with Spark's
threshold edit distance, which computes a band of 2 * max_edits + 1 diagonals (an
expression of our own over bit vectors would leave code generation and be slower).

A line is dropped where an equal line, or one within ``max_edits`` edits, comes earlier
in the order of (id, text hash, line number); the earlier one need not be kept itself.

Defined results: lines shorter than ``min_chars`` are never dropped (with ``copy_chars``, blank lines and near copies
of shorter lines are not); a null text stays
null and has no lines; an empty text has one empty line; a null id comes first;
repeated rows (same id and text) get the same result, so both keep what the
first would keep; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

MIN_CHARS = 32
MAX_EDITS = 1
HOT = 8  # lines in one list of the index before it is split
FEW = 4  # lines in one list of the index that are paired without a look at their outlines
WORD_LONGS, CHAR_LONGS = 4, 1  # longs of the two parts of an outline, 64 cells each


def _segment(n: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i of a text of n characters; later segments take the remainder."""
    base, over = F.floor(n / parts).cast("int"), (n % parts).cast("int")
    longer = F.lit(i) - (F.lit(parts) - over)  # how many segments before i are longer
    return F.lit(i) * base + F.greatest(longer, F.lit(0)), base + F.when(longer >= 0, 1).otherwise(0)


def _index(text: Column, n: Column, edits: int, under: Column) -> Column:
    """Array of (key, start, length) of the segments of ``text``."""
    out = []
    for i in range(edits + 1):
        start, size = _segment(n, i, edits + 1)
        out.append(F.struct(F.xxhash64(under, F.lit(i), n, F.substring(text, start + 1, size)).alias("key"),
                            start.alias("start"), size.alias("size")))
    return F.array(*out)


def _probes(text: Column, n: Column, edits: int, under: Column) -> Column:
    """Array of (key, start, length): the substrings to look up for shorter and equal lines."""
    out = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            start, size = _segment(n - less, i, edits + 1)
            for move in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1):
                at = start + move
                fits = (at >= 0) & (at + size <= n) & (n - less > 0)
                out.append(F.when(fits, F.struct(
                    F.xxhash64(under, F.lit(i), n - less, F.substring(text, at + 1, size)).alias("key"),
                    at.alias("start"), size.alias("size"))))
    return F.array_compact(F.array(*out))


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, th, pos, line, n): all lines; ``th`` is the hash of the whole text."""
    return (docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
            .withColumn("n", F.char_length("line")))


def _allowed(n: Column, max_edits: int, double_from: int) -> Column:
    """Edits that a line of n characters may differ in: one more from ``double_from`` on and at each doubling."""
    return F.lit(max_edits) + F.greatest(F.lit(0), F.floor(F.log2(n / double_from) + 1e-9).cast("int") + 1)


def _index_rows(side: DataFrame, edits: int | None) -> DataFrame:
    """A row with key, start and size per segment.  Without ``edits`` the column e has them, and one plan serves all lengths."""
    if edits is not None:
        return side.select("*", F.explode(_index(F.col("rest"), F.col("m"), edits, F.col("under"))).alias("x")).select("*", "x.*")
    start, size = _segment(F.col("m"), F.col("i"), F.col("e") + 1)
    return (side.select("*", F.explode(F.sequence(F.lit(0), "e")).alias("i"))
            .select("*", start.cast("int").alias("start"), size.cast("int").alias("size"))
            .withColumn("key", F.xxhash64("under", "i", "m", F.substring("rest", F.col("start") + 1, F.col("size")))))


def _probe_rows(side: DataFrame, edits: int | None) -> DataFrame:
    """A row with key, start and size per substring to look up; as in ``_index_rows``."""
    if edits is not None:
        return side.select("*", F.explode(_probes(F.col("rest"), F.col("m"), edits, F.col("under"))).alias("x")).select("*", "x.*")
    e, i, less = F.col("e"), F.col("i"), F.col("less")
    moves = F.sequence(F.greatest(-i, less - (e - i)), F.least(i, less + e - i))
    start, size = _segment(F.col("m") - less, i, e + 1)
    return (side.select("*", F.explode(F.sequence(F.lit(0), "e")).alias("less")).where("m > less")
            .select("*", F.explode(F.sequence(F.lit(0), "e")).alias("i"))
            .select("*", F.explode(moves).alias("move"))
            .select("*", (start + F.col("move")).cast("int").alias("start"), size.cast("int").alias("size"))
            .where("start >= 0 and start + size <= m")
            .withColumn("key", F.xxhash64("under", "i", F.col("m") - less, F.substring("rest", F.col("start") + 1, F.col("size")))))


def _pairs(lines: DataFrame, own: Scratch, edits: int) -> DataFrame:
    """Candidate pairs (a, b) of line hashes; ``lines`` has h, first, line, n.

    The lists of a level that are longer than ``HOT`` are split by the text around their
    segment (``rest``), which must be as near.  Where no more than ``edits`` characters are
    left, lines with the same places (``trace``) differ in these characters only:
    each is paired with the earliest of every trace instead of with all others.
    """
    sides, found = (_whole(lines, F.lit(edits)),) * 2, []
    while True:
        index, probe = _index_rows(sides[0], edits), _probe_rows(sides[1], edits)
        hot = own.save(index.where("size > 0").groupBy("key").count().where(F.col("count") > HOT).select("key"))
        none = hot.isEmpty()
        cold = (index, probe) if none else (x.join(hot, "key", "left_anti") for x in (index, probe))
        i, p = (x.select("key", F.col("h").alias(c)) for x, c in zip(cold, "ab"))
        found.append(own.save(i.join(p, "key").where("a <> b").select("a", "b").distinct()))
        if none:
            return reduce(DataFrame.union, found)
        sides = tuple(own.save(_around(x.join(hot, "key"))) for x in (index, probe))
        earliest = _ends(sides).groupBy("under", "trace").agg(F.min(F.struct("first", "h"))["h"].alias("b"))
        found.append(own.save(_ends(sides).join(earliest.select("under", "b"), "under").where("h <> b")
                              .select(F.col("h").alias("a"), "b").distinct()))
        sides = tuple(side.where("m > 0") for side in sides)


def _whole(lines: DataFrame, e: Column) -> DataFrame:
    """The lines as rows of the first level: nothing is cut out yet."""
    return lines.select("h", "first", e.alias("e"), e.cast("long").alias("under"), F.lit(0).cast("long").alias("trace"),
                        F.col("line").alias("rest"), F.col("n").alias("m"))


def _around(rows: DataFrame) -> DataFrame:
    """Rows of the next level: the text around the segment of each row."""
    return rows.select(
        "h", "first", "e", F.col("key").alias("under"), F.xxhash64("trace", "start", "m").alias("trace"),
        F.concat(F.substring("rest", F.lit(1), F.col("start")), F.expr("substring(rest, start + size + 1)")).alias("rest"),
        (F.col("m") - F.col("size")).cast("int").alias("m")).distinct()


def _parities(elements: Column, longs: int) -> list[Column]:
    """For each of 64 hash cells a long: whether the number of elements in it is odd."""
    hashes = F.transform(elements, lambda x: F.xxhash64(x))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 8), F.lit(64)).cast("int"))
    return [F.aggregate(F.filter(hashes, lambda h: F.pmod(h, F.lit(longs)) == i), F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(bit(h)))
            for i in range(longs)]


def _outline(line: Column) -> Column:
    """Parities of the words and of the characters of a line.

    An edit changes three words at most (a space comes or goes: two words for one) and two characters, each by one.
    """
    return F.array(*_parities(F.split(line, " "), WORD_LONGS), *_parities(F.split(line, ""), CHAR_LONGS))


def _outlines_allow(x: Column, y: Column, edits: Column) -> Column:
    apart = [F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(WORD_LONGS + CHAR_LONGS)]
    words, chars = apart[:WORD_LONGS], apart[WORD_LONGS:]
    return (sum(words[1:], words[0]) <= 3 * edits) & (sum(chars[1:], chars[0]) <= 2 * edits)


def _ends(sides: tuple[DataFrame, DataFrame]) -> DataFrame:
    return sides[0].union(sides[1]).where("m <= e").select("h", "first", "under", "trace")


def _late_by_length(lines: DataFrame, own: Scratch, near) -> DataFrame:
    """(_h, _line) of the lines with an earlier one within the edits that their lengths allow; one plan for all lengths.

    ``near`` turns pairs (a, b) into hash and text of the later line of those that are near.  As in ``_pairs``, long lists of the index
    are split, where that makes fewer rows than pairing: at level k a line of a list has up to (e + 1)^(k + 3) of them.  But first their lines are compared with the earliest of the list, and a list goes on only while it
    holds others that no comparison has found late: copies of one line, however many, end at the first level that they share.
    In the other lists of more than ``FEW`` lines, as a common passage makes them, all are compared with the earliest too, and then only
    lines are paired whose outlines allow it and whose later one has not been found late.
    """
    sides, late, found, level = (lines, lines), None, [], 0
    while True:
        index, probe = _index_rows(sides[0], None), _probe_rows(sides[1], None)
        split = (F.col("size") > 0) & (F.col("count") > F.pow(F.col("e") + 1, F.lit(level + 3)))
        large = own.save(index.groupBy("key", "e", "size").count().where(F.col("count") > FEW).select("key", split.alias("hot")))
        hot, listed = large.where("hot").select("key"), large.where("not hot").select("key")
        none = hot.isEmpty()
        cold = (index, probe) if large.isEmpty() else (x.join(large, "key", "left_anti") for x in (index, probe))
        i, p = (x.select("key", F.col("h").alias(c)) for x, c in zip(cold, "ab"))
        level += 1
        found.append(own.save(p.join(i, "key").where("a <> b")
                              .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()))
        if not listed.isEmpty():
            i, p = (own.save(x.join(listed, "key").select("key", "e", "first", "h").distinct()) for x in (index, probe))
            held = i.union(p).distinct()
            pivot = held.groupBy("key").agg(F.min(F.struct("first", "h"))["h"].alias("b"))
            checks = held.join(pivot, "key").where("h <> b").select(F.least("h", "b").alias("a"), F.greatest("h", "b").alias("b")).distinct()
            more = near(own.save(checks))
            late = own.save((more if late is None else late.union(more)).distinct())
            outlines = lines.join(held.select("h").distinct(), "h", "left_semi").select("h", _outline(F.col("rest")).alias("o")).distinct()
            outlines = own.save(outlines.join(late.select(F.col("_h").alias("h"), F.lit(True).alias("found")).distinct(), "h", "left"))
            i, p = (x.join(outlines, "h").select("key", "e", *(F.col(f).alias(f + c) for f in ("h", "first", "o", "found")))
                    for x, c in ((i, "a"), (p, "b")))
            later = F.when(F.col("firsta") < F.col("firstb"), F.col("foundb")).otherwise(F.col("founda"))
            found.append(own.save(p.join(i, ["key", "e"]).where("ha <> hb").where(later.isNull()).where(_outlines_allow(F.col("oa"), F.col("ob"), F.col("e")))
                                  .select(F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b")).distinct()))
        if none:
            last = near(own.save(reduce(DataFrame.union, found).distinct()))
            return last if late is None else late.union(last)
        sides = tuple(own.save(_around(x.join(hot, "key"))) for x in (index, probe))
        held = sides[0].union(sides[1]).select("h", "first", "under").distinct()
        pivot = held.groupBy("under").agg(F.min(F.struct("first", "h"))["h"].alias("b"))
        earliest = _ends(sides).groupBy("under", "trace").agg(F.min(F.struct("first", "h"))["h"].alias("b"))
        checks = (held.join(pivot, "under").union(_ends(sides).select("h", "first", "under").distinct()
                  .join(earliest.select("under", "b").distinct(), "under").select("under", "h", "first", "b")))
        more = near(checks.where("h <> b").select(F.least("h", "b").alias("a"), F.greatest("h", "b").alias("b")).distinct())
        late = own.save((more if late is None else late.union(more)).distinct())
        on = own.save(held.join(pivot, "under").where("h <> b").join(late.select("_h"), F.col("h") == F.col("_h"), "left_anti")
                      .select("under").distinct())
        sides = tuple(side.where("m > 0").join(on, "under", "left_semi") for side in sides)


def _growing(distinct: DataFrame, max_edits: int, double_from: int) -> DataFrame:
    """``distinct`` with e: a row for the edits of each length class in which the line can be the longer one of a pair."""
    e = _allowed(F.col("n"), max_edits, double_from)
    under = e - 1  # a line just over a bound is compared with shorter ones by their edits
    return distinct.withColumn("e", F.explode(F.when(
        (e > max_edits) & (_allowed(F.col("n") - under, max_edits, double_from) == under), F.array(under, e)).otherwise(F.array(e))))


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = MAX_EDITS,
                  min_chars: int = MIN_CHARS, scratch: Scratch | None = None, copy_chars: int | None = None,
                  double_from: int | None = None) -> DataFrame:
    """(id, th, pos) of every line that goes."""
    near_chars = max(min_chars, 2 * (max_edits + 1))
    own = scratch or Scratch(docs.sparkSession, "line-dedup")
    lines = lines_of(docs, key, text)
    if copy_chars is None:
        lines = lines.where(F.col("n") >= near_chars)
    else:
        lines = lines.where((F.col("n") >= min(copy_chars, near_chars)) & F.col("line").rlike(r"\S"))
    place = F.struct("id", "th", "pos")
    distinct = own.save(lines.groupBy("line", "n").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
                        .withColumn("h", F.xxhash64("line")))
    some = distinct.where(F.col("n") >= near_chars)
    x, y = (distinct.select(F.col("h").alias(f"h{z}"), F.col("line").alias(f"line{z}"), F.col("first").alias(f"first{z}"),
                            F.col("n").alias(f"n{z}")) for z in "xy")

    def near(pairs: DataFrame, allowed: Column) -> DataFrame:
        later = [F.when(F.col("firstx") < F.col("firsty"), F.col(f"{c}y")).otherwise(F.col(f"{c}x")).alias(f"_{c}") for c in ("h", "line")]
        return (pairs.join(x, F.col("a") == F.col("hx")).join(y, F.col("b") == F.col("hy"))
                .where("linex <> liney").withColumn("allowed", allowed).where("abs(nx - ny) <= allowed")
                .where(F.expr("levenshtein(linex, liney, allowed)") >= 0).select(*later))

    if double_from is None:
        close = near(own.save(_pairs(some, own, max_edits).distinct()), F.lit(max_edits))
    else:
        allowed = _allowed(F.least("nx", "ny"), max_edits, double_from)
        close = _late_by_length(_whole(_growing(some, max_edits, double_from), F.col("e")), own, lambda pairs: near(pairs, allowed))
    late = own.save(close.select("_line").distinct())
    marked = distinct.join(late, F.col("line") == F.col("_line"), "left").where("copies > 1 or _line is not null").select(
        F.col("h").alias("_h"), F.xxhash64(F.lit(1), "line").alias("_h2"), "first", F.col("_line").isNotNull().alias("late"))
    occurrences = lines.select("id", "th", "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"))
    return (occurrences.join(marked, (F.col("h") == F.col("_h")) & (F.col("h2") == F.col("_h2")))
            .where(F.col("late") | (place != F.col("first"))).select("id", "th", "pos"))


def dropped_by_document(docs: DataFrame, own: Scratch, key: str, text: str, max_edits: int, min_chars: int,
                        copy_chars: int | None = None, double_from: int | None = None) -> DataFrame:
    """(_id, _th, gone): the sorted numbers of the dropped lines of each document that loses some."""
    gone = dropped_lines(docs, key, text, max_edits, min_chars, own, copy_chars, double_from).distinct()
    return own.save(gone.groupBy(F.col("id").alias("_id"), F.col("th").alias("_th"))
                    .agg(F.sort_array(F.collect_list("pos")).alias("gone")), keep=True)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = MAX_EDITS,
                min_chars: int = MIN_CHARS, out: str = "dropped_lines", copy_chars: int | None = None,
                double_from: int | None = None) -> DataFrame:
    """``docs`` with ``text`` reduced to the lines that stay, and ``out``, the array of dropped line numbers (from 0).

    With ``copy_chars``, equal lines of that many characters or more go unless blank, and ``min_chars`` holds for the
    edit join only.  With ``double_from``, one more edit is allowed where the shorter line has that many characters,
    and one more at each doubling of them; all lengths are joined by one plan.

    A text that loses all its lines becomes empty.  A column of ``docs`` named like ``out`` is replaced.
    """
    with Scratch(docs.sparkSession, "line-dedup") as own:
        gone = dropped_by_document(docs, own, key, text, max_edits, min_chars, copy_chars, double_from)
    # the row travels as one struct, so no name of docs can clash
    row = F.col("row")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(text).alias("th"))
    joined = rows.join(gone, row[key].eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    left = F.array_join(F.filter(F.split(row[text], "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    return joined.select(
        *(F.when(F.col("gone").isNull(), row[c]).otherwise(left).alias(c) if c == text else row[c].alias(c)
          for c in docs.columns if c != out), F.coalesce("gone", F.array().cast("array<int>")).alias(out))


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = MAX_EDITS,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: id, n_lines, n_dropped, and the dropped line numbers joined by commas; texts are not moved."""
    with Scratch(docs.sparkSession, "line-dedup") as own:
        gone = dropped_by_document(docs, own, key, text, max_edits, min_chars)
    sized = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_th_of"),
                        F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("long").alias("n_lines"))
    return (sized.join(gone, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_th_of") == F.col("_th")), "left")
            .select(F.col("_key").alias(key), F.when(F.col("n_lines") < 0, 0).otherwise(F.col("n_lines")).alias("n_lines"),
                    F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.coalesce(F.array_join("gone", ","), F.lit("")).alias("dropped")))
