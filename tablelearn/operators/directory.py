"""Directory of balls over distinct vectors, and the exact search for the k nearest in it.

The directory is a set of tables, built level by level: a node of more than ``block``
vectors is divided among ``fan`` of its own vectors (its centres, taken in hash order), each vector
going to the nearest one; a child is a ball with its centre and the largest distance in it.
What is left at the bottom are blocks.  A node that cannot be divided further (levels used up) is cut into rings by
the distance from its centre, and a ring of equal distances by hash, so a block is bounded in any case;
every block has its own smallest and largest distance from the centre.

A query descends once to its home block, which gives a first bound on its k-th distance (the centres on its way, which
are vectors themselves, give another), and then goes to every block that the triangle inequality
cannot rule out: d(q, x) >= d(q, c) - R for a ball, and >= lo - d(q, c) for a ring.  For that, queries of neighbouring home
blocks form parts and neighbouring blocks form slabs; a part and a slab that it reaches are one Arrow group of bounded size (a tile), so that
a vector travels once a part and not once a query.  In a tile each block meets the queries that reach it: products of single
precision, whose error is bounded, leave the pairs that can be within the query's bound, which falls as the tile goes on; those are compared
by plain sums.  Strings go to their blocks one by one, by equi-joins on node numbers.

Measures that are no distances over all vectors are searched in a space where a distance bounds them:

* euclidean, manhattan, chebyshev, minkowski (p >= 1): the vectors themselves;
* std_euclidean: every axis divided by its deviation;
* cosine: unit vectors (the chord grows as the cosine falls);
* tanimoto: unit vectors, and the range of lengths in a ball: with c an upper bound of the cosine and m the least
  value of |q|/|t| + |t|/|q|, the similarity is at most c / (m - c);
* hamming: characters of strings of one length, a tree for each length (for what `strings_within_one` leaves).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import distance as D
from ..session import ship_package
from .relational import row_join, top_k_per_group, written

FAN = 16  # centres of a node
BLOCK = 2048  # vectors of a block, about
LEVELS = 10
ASKED = 8192  # queries that meet a block at once, about
ROWS = 64  # of them in one matrix, so that it stays in the processor's cache
PART = 32_768  # queries of a tile at most, about
SLAB = 65_536  # vectors of a tile, about
PARTS = 48  # parts that are made of fewer queries, for more tasks
STRIP = 4096  # vectors of a tile that are compared at once, about
PRODUCTS = 256  # queries that meet them at once
CUTS = 64  # quantiles from which rings are cut
METRICS = ("euclidean", "manhattan", "chebyshev", "minkowski", "std_euclidean", "cosine", "tanimoto", "hamming")
SIMILARITIES = ("cosine", "tanimoto")


@dataclass(frozen=True)
class Space:
    """A measure: where its vectors are placed, distances there, and the value that orders neighbours."""
    metric: str
    dim: int | None = None
    p: float | None = None
    scales: Sequence[float] | None = None

    def __post_init__(self):
        if self.metric not in METRICS:
            raise ValueError(f"metric is one of {', '.join(METRICS)}")
        if self.metric == "minkowski" and (self.p is None or self.p < 1):
            raise ValueError("minkowski needs an order p of 1 or more")
        if self.metric == "std_euclidean" and (self.scales is None or len(self.scales) != self.dim):
            raise ValueError("std_euclidean needs a deviation for every axis")
        if self.metric != "hamming" and self.dim is None:
            raise ValueError("vectors need their declared length")

    @property
    def placed(self) -> bool:
        """Whether vectors are placed elsewhere than where they are."""
        return self.metric in ("std_euclidean", "cosine", "tanimoto", "hamming")

    def with_place(self, df: DataFrame, side: str) -> DataFrame:
        """Adds ``_<side>a`` (squared length), ``_<side>p`` (the place, where it differs) and ``_node`` (the root of its tree)."""
        v, a, p = F.col(f"_{side}v"), f"_{side}a", f"_{side}p"
        if self.metric in SIMILARITIES:
            df = df.withColumn(a, F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)).where(F.col(a) > 0)
            df = df.withColumn(p, F.transform(v, lambda x: x / F.sqrt(F.col(a))))
        else:
            df = df.withColumn(a, F.lit(0.0))
        if self.metric == "std_euclidean":
            inverse = F.array(*[F.lit(1.0 / s if s and s > 0 else 0.0) for s in self.scales])
            df = df.withColumn(p, F.zip_with(v, inverse, lambda x, i: x * i))
        if self.metric == "hamming":
            df = df.withColumn(p, F.split(v, ""))
        root = F.char_length(v) if self.metric == "hamming" else F.size(v)  # a tree for each length
        return df.withColumn("_node", root.cast("long"))

    def place(self, side: str) -> str:
        return f"_{side}p" if self.placed else f"_{side}v"

    def gap(self, a: Column, b: Column) -> Column:
        """Distance of two places."""
        if self.metric == "hamming":
            return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x != y, 1.0).otherwise(0.0)), F.lit(0.0), lambda s, x: s + x)
        name = "euclidean" if self.placed else self.metric
        return D.array_metric(name, a, b, self.p)

    def points(self, column: pa.ChunkedArray) -> np.ndarray:
        """Vectors (or strings of one length) as rows of a matrix."""
        column = column.combine_chunks()
        if self.metric != "hamming":
            return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), self.dim)
        texts = column.to_pylist()
        n = len(texts[0])
        return np.array(texts, f"<U{max(1, n)}").view(np.uint32).reshape(len(texts), -1)[:, :n]

    def scores(self, q: np.ndarray, t: np.ndarray, qa: np.ndarray, ta: np.ndarray) -> np.ndarray:
        """What orders the neighbours: distances, or negative similarities, of all rows of ``q`` and ``t``.

        Terms are added from the first axis to the last, in the order a plain sum has.
        """
        out = np.zeros((len(q), len(t)))
        for i in range(t.shape[1]):
            self._add(out, q[:, i, None], t[None, :, i], i)
        return self._ended(out, qa[:, None], ta)

    def _add(self, out: np.ndarray, x: np.ndarray, y: np.ndarray, i: int) -> None:
        """Adds the terms of axis ``i``."""
        if self.metric in SIMILARITIES:
            out += x * y
        elif self.metric == "hamming":
            out += x != y
        elif self.metric == "euclidean":
            out += (x - y) ** 2
        elif self.metric == "manhattan":
            out += np.abs(x - y)
        elif self.metric == "chebyshev":
            np.maximum(out, np.abs(x - y), out=out)
        elif self.metric == "minkowski":
            out += np.abs(x - y) ** self.p
        elif self.scales[i] and self.scales[i] > 0:
            out += ((x - y) / self.scales[i]) ** 2

    def _ended(self, out: np.ndarray, qa: np.ndarray, ta: np.ndarray) -> np.ndarray:
        """What follows the sum over the axes."""
        if self.metric == "cosine":
            return -(out / (np.sqrt(qa) * np.sqrt(ta)))
        if self.metric == "tanimoto":
            return -(out / (qa + ta - out))
        if self.metric == "minkowski":
            return out ** (1.0 / self.p)
        return np.sqrt(out) if self.metric in ("euclidean", "std_euclidean") else out

    def rough(self, q: np.ndarray, t: np.ndarray, qa: np.ndarray, ta: np.ndarray) -> tuple[np.ndarray, float] | None:
        """Values that grow with ``scores`` but for rounding, and a bound of that; None where only the plain sums will do."""
        if self.metric == "minkowski" and self.p == int(self.p) <= 8:
            out = np.zeros((len(q), len(t)))
            for i in range(t.shape[1]):
                term = step = np.abs(q[:, i, None] - t[None, :, i])
                for _ in range(int(self.p) - 1):
                    term = term * step
                out += term
            return out, 1e-11 * float(out.max(initial=0.0))
        if self.metric in SIMILARITIES:
            if min(qa.min(), ta.min()) < 1e-200 or max(qa.max(), ta.max()) > 1e200:
                return None
            dots = q @ t.T
            if self.metric == "cosine":
                return -(dots / (np.sqrt(qa)[:, None] * np.sqrt(ta))), 1e-14 * (1000 + q.shape[1])
            return -(dots / (qa[:, None] + ta - dots)), 1e-14 * (1000 + q.shape[1])
        if self.metric in ("euclidean", "std_euclidean"):
            if self.metric == "std_euclidean":
                inverse = np.array([1.0 / s if s and s > 0 else 0.0 for s in self.scales])
                q, t = q * inverse, t * inverse
            q2, t2 = (q * q).sum(1), (t * t).sum(1)
            most = float(q2.max() + t2.max())
            return q2[:, None] + t2 - 2.0 * (q @ t.T), 1e-15 * (1000 + q.shape[1]) * most
        return None

    def best(self, q: np.ndarray, t: np.ndarray, qa: np.ndarray, ta: np.ndarray, kk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``q``, row of ``t``, score) of the kk best of each row of ``q``, ties in the order of ``t``."""
        if not t.shape[1] or len(t) <= 4 * kk or (near := self.rough(q, t, qa, ta)) is None or not np.isfinite(near[0]).all():
            return self.best_plain(q, t, qa, ta, kk)
        value, off = near
        near = value <= np.partition(value, kk - 1, 1)[:, kk - 1, None] + 4 * off
        if np.count_nonzero(near) > near.size // 16:
            return self.best_plain(q, t, qa, ta, kk)
        rows, cols = np.nonzero(near)
        scores = np.empty(len(rows))
        for a in range(0, len(rows), 1 << 16):  # the plain sums of what is left
            r, c = rows[a:a + (1 << 16)], cols[a:a + (1 << 16)]
            scores[a:a + (1 << 16)] = self.paired(q[r], t[c], qa[r], ta[c])
        order = np.lexsort((cols, scores, rows))
        rows, cols, scores = rows[order], cols[order], scores[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < kk
        return rows[first], cols[first], scores[first]

    def best_plain(self, q: np.ndarray, t: np.ndarray, qa: np.ndarray, ta: np.ndarray, kk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``best`` by the plain sums of all rows."""
        scores = self.scores(q, t, qa, ta)
        at = np.argsort(scores, 1, kind="stable")[:, :kk]
        return np.repeat(np.arange(len(q)), at.shape[1]), at.ravel(), np.take_along_axis(scores, at, 1).ravel()

    def paired(self, q: np.ndarray, t: np.ndarray, qa: np.ndarray, ta: np.ndarray) -> np.ndarray:
        """``scores`` of each row of ``q`` with the row of ``t`` at its place."""
        out = np.zeros(len(q))
        for i in range(t.shape[1]):
            self._add(out, q[:, i], t[:, i], i)
        return self._ended(out, qa, ta)

    def places(self, v: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Where the rows of ``v`` (squared lengths ``a``) are placed."""
        if self.metric in SIMILARITIES:
            return v / np.sqrt(a)[:, None]
        if self.metric == "std_euclidean":
            return v * np.array([1.0 / s if s and s > 0 else 0.0 for s in self.scales])
        return v

    def gaps(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Distances of all rows of two places, and a bound of their error."""
        if self.placed or self.metric == "euclidean":
            middle = y.mean(0)
            x, y = x - middle, y - middle
            x2, y2 = (x * x).sum(1), (y * y).sum(1)
            off = 1e-15 * (1000 + x.shape[1]) * float(x2.max() + y2.max())
            return np.sqrt(np.maximum(x2[:, None] + y2 - 2.0 * (x @ y.T), 0.0)), math.sqrt(off)
        none = np.zeros(max(len(x), len(y)))
        if (near := self.rough(x, y, none, none)) is not None:
            return near[0] ** (1.0 / self.p), 0.0
        return self.scores(x, y, none[:len(x)], none[:len(y)]), 0.0

    def reached(self, d: np.ndarray, off: float, lo: np.ndarray, hi: np.ndarray, a_lo: np.ndarray, a_hi: np.ndarray,
                qa: np.ndarray, gap: np.ndarray, score: np.ndarray) -> np.ndarray:
        """``reaches`` for all queries (rows) and blocks (columns); NaN: no bound, or no centre."""
        least = np.maximum(np.maximum(0.0, d - hi), lo - d) - self.slack * (1.0 + d) - off
        least = np.where(np.isnan(least), 0.0, least)
        if self.metric != "tanimoto":
            return ~(least > gap[:, None])
        chord = np.maximum(0.0, least)
        cos = 1.0 - chord * chord / 2.0
        near = np.minimum(np.maximum(qa[:, None], a_lo), a_hi)
        m = np.sqrt(qa[:, None] / near) + np.sqrt(near / qa[:, None])
        most = np.where(cos > 0, cos / (m - cos), 0.0)
        return ~(most + 1e-9 < -score[:, None])

    def sieve(self, x: np.ndarray, y: np.ndarray, xa: np.ndarray, ya: np.ndarray, limit: np.ndarray):
        """For rows ``x`` and ``y`` (places; vectors under tanimoto): (right, function of rows and scores), None where the numbers allow none.

        ``limit`` has the bounds to expect for the rows of ``x``.

        The function gives (left, bars): ``left @ right``, of single precision, is at least the row's bar for all pairs whose score is at
        most the row's.
        """
        raw = max(float(np.abs(x).max(initial=0.0)), float(np.abs(y).max(initial=0.0)))
        if self.metric != "tanimoto":
            middle = y.mean(0)
            x, y = x - middle, y - middle
        unit = max(float(np.abs(x).max(initial=0.0)), float(np.abs(y).max(initial=0.0))) * math.sqrt(x.shape[1])
        if not 1e-100 < unit < 1e100:
            return None
        x, y = x / unit, y / unit
        x2, y2 = (x * x).sum(1), (y * y).sum(1)
        long_x, long_y, single = np.sqrt(x2), math.sqrt(float(y2.max())), 1e-7 * (x.shape[1] + 8)
        moved = 1e-15 * raw * math.sqrt(x.shape[1]) / unit  # what rounding moves a place by, at most
        off = single * (long_x * long_y + long_y ** 2) + moved * (long_x + long_y + moved)
        if self.metric in ("minkowski", "manhattan"):
            return self._sieve_of_powers(x, y, limit / unit, unit, single, moved * (long_x + long_y + moved))
        if self.metric == "tanimoto":
            xa, right = xa / unit ** 2, np.vstack([y.T, ya / unit ** 2]).astype(np.float32)
        else:
            right = np.vstack([y.T, -y2 / 2.0]).astype(np.float32)
        stretch = math.sqrt(x.shape[1]) if self.metric == "chebyshev" else 1.0  # of the largest difference, to the euclidean distance at most
        left = np.concatenate([x, np.ones((len(x), 1))], 1).astype(np.float32)

        def barred(of: slice, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if self.metric == "tanimoto":
                s = np.maximum(-scores - 1e-9, -0.5)
                share = s / (1.0 + s)
                bars, mine = share * xa[of], left[of].copy()
                mine[:, -1] = -share
                return mine, (bars - off[of] - single * np.abs(bars)).astype(np.float32)
            if self.metric == "cosine":
                within = np.maximum(0.0, 2.0 + 2.0 * scores) + 1e-9
            else:
                within = (scores * (stretch * (1 + 1e-9))) ** 2
            bars = (x2[of] - within / unit ** 2) / 2.0
            return left[of], (bars - off[of] - single * np.abs(bars)).astype(np.float32)

        return right, barred

    def _sieve_of_powers(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray, unit: float, single: float, moved: np.ndarray):
        """``sieve`` for sums of powers p of differences, over places of at most 1.

        With u a squared difference, u^(p/2) is at least the parabola that touches it at ``u0`` and meets it at ``w`` (0, or for p between 2 and 4
        the largest u): the third derivative has one sign.  A sum of parabolas in u is a product of x, x², x³ with what depends on y.
        """
        p, dim = self.p if self.metric == "minkowski" else 1.0, x.shape[1]
        limit = limit[np.isfinite(limit)]
        if not len(limit):
            return None
        largest = (float(np.abs(x).max()) + float(np.abs(y).max())) ** 2
        usual = 2 ** (p / 2) * math.gamma((p + 1) / 2) / math.sqrt(math.pi)  # mean of |z|^p for normal z
        u0 = max(1e-6, min(largest / 2, (float(np.median(limit)) ** p / (dim * usual)) ** (2 / p)))
        w, h = largest * (1 + 1e-9) if 2 < p < 4 else 0.0, p / 2
        if w and u0 >= w:
            return None
        at, slope = u0 ** h, h * u0 ** (h - 1)
        c = (w ** h - at - slope * (w - u0)) / (w - u0) ** 2
        b, a = slope - 2 * c * u0, at - slope * u0 + c * u0 * u0
        xx, yy = x * x, y * y
        x_parts, y_parts = [x, xx, xx * x], [(2 * b + 4 * c * yy) * y, -6 * c * yy, 4 * c * y]
        alone = -((b + c * yy) * yy).sum(1)
        long = lambda v: np.sqrt((v * v).sum(1))
        off = sum(long(i) * float(long(j).max()) for i, j in zip(x_parts, y_parts)) + float(np.abs(alone).max())
        mine = dim * a + ((b + c * xx) * xx).sum(1)
        off = 3 * single * (off + np.abs(mine)) + 2 * (abs(b) + 2 * abs(c) * largest) * moved + 1e-12 * dim * (abs(a) + at)
        left = np.concatenate([*x_parts, np.ones((len(x), 1))], 1).astype(np.float32)

        def barred(of: slice, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sums = (scores / unit) ** p
            return left[of], (mine[of] - sums * (1 + 1e-9) - off[of] - single * sums).astype(np.float32)

        return np.vstack([np.concatenate(y_parts, 1).T, alone]).astype(np.float32), barred

    def tile(self, q: np.ndarray, t: np.ndarray, qa: np.ndarray, ta: np.ndarray, bounds: np.ndarray, reach: np.ndarray,
             block: np.ndarray, rank: np.ndarray, kk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``q``, row of ``t``, score): the kk best of each row of ``q``, ties by ``rank``, in the blocks that it reaches.

        ``block`` numbers the rows of ``t`` and rises; ``reach`` tells for each row of ``q`` which blocks count; scores beyond ``bounds`` may be left out.
        """
        worst, at = np.full((len(q), kk), np.inf), np.full((len(q), kk), -1)
        bounds = np.where(np.isnan(bounds), np.inf, bounds)
        places = (q, t) if self.metric == "tanimoto" else (self.places(q, qa), self.places(t, ta))
        first = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(t))
        ends = np.unique(np.append(first[np.searchsorted(first, np.arange(STRIP, len(t), STRIP))], len(t)))
        for start, end in zip(np.append(0, ends[:-1]), ends):
            asks = np.flatnonzero(reach[:, np.unique(block[start:end])].any(1))
            here = start + np.argsort(rank[start:end])
            t_here, ta_here, y = t[here], ta[here], places[1][here]
            limits = np.minimum(bounds[asks], worst[asks, -1])
            sieve = self.sieve(places[0][asks], y, qa[asks], ta_here, limits) if y.shape[1] and len(asks) else None
            for s in range(0, len(asks), PRODUCTS):
                r = asks[s:s + PRODUCTS]
                limit = np.minimum(bounds[r], worst[r, -1])
                near = self._sifted(sieve, slice(s, s + PRODUCTS), limit, len(here), max(kk, len(here) // (4 if self.metric == "minkowski" else 16)))
                if near is None:  # many pairs, or it cannot be told
                    rows, cols, scores = self.best(q[r], t_here, qa[r], ta_here, kk)
                else:
                    rows, cols = near
                    some = reach[r[rows], block[here[cols]]]
                    rows, cols = rows[some], cols[some]
                    if self.metric == "minkowski" and self.p == int(self.p) <= 8:
                        rows, cols = self._powers(places[0][r], y, limit, rows, cols)
                    scores = np.empty(len(rows))
                    for c in range(0, len(rows), 2048):  # the plain sums of what is left
                        of, to = rows[c:c + 2048], cols[c:c + 2048]
                        scores[c:c + 2048] = self.paired(q[r[of]], t_here[to], qa[r[of]], ta_here[to])
                _keep(worst, at, r[rows], here[cols], scores, rank)
        rows, place = np.nonzero(at >= 0)
        return rows, at[rows, place], worst[rows, place]

    @staticmethod
    def _sifted(sieve, of: slice, limit: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray] | None:
        """(row, column) of the pairs that ``sieve`` lets through; None where those are more than ``most`` a row."""
        if sieve is None or not np.isfinite(limit).all():
            return None
        left, bars = sieve[1](of, limit)
        if not np.isfinite(bars).all():
            return None
        near = (left @ sieve[0]) >= bars[:, None]
        if np.count_nonzero(near) > most * len(near):
            return None
        return np.divmod(np.flatnonzero(near), n)

    def _powers(self, x, y, limit, rows, cols):
        """The pairs whose sums of powers, of single precision, can be within ``limit``."""
        raw = max(float(np.abs(x).max()), float(np.abs(y).max()))
        x, y = x - y.mean(0), y - y.mean(0)
        most = math.sqrt(float((x * x).sum(1).max() + (y * y).sum(1).max()))
        if not 1e-4 < most < 1e4 or raw > 1e4 * most or self.p < 2:
            return rows, cols
        x, y, kept = x.astype(np.float32), y.astype(np.float32), np.empty(len(rows), bool)
        for s in range(0, len(rows), 4096):
            step = np.abs(x[rows[s:s + 4096]] - y[cols[s:s + 4096]])
            term = step
            for _ in range(int(self.p) - 1):
                term = term * step
            kept[s:s + 4096] = term.sum(1, dtype=np.float64) ** (1.0 / self.p) <= limit[rows[s:s + 4096]] * (1 + 1e-5) + 1e-6 * most
        return rows[kept], cols[kept]

    @property
    def slack(self) -> float:
        return 1e-7 if self.metric in SIMILARITIES else 1e-9

    def gap_bound(self, score: Column) -> Column | None:
        """The largest distance of places that a neighbour of this score can have (None: lengths count too)."""
        if self.metric == "cosine":
            return F.when(score.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) + F.lit(2.0) * score)))
        return None if self.metric == "tanimoto" else score

    def reaches(self, d: Column, lo: Column, hi: Column, a_lo: Column, a_hi: Column) -> Column:
        """Whether a ball or ring at distance ``d`` can hold a vector within the query's ``_gap`` or ``_score`` (null: no bound)."""
        least = F.greatest(F.lit(0.0), d - hi, lo - d) - F.lit(self.slack) * (F.lit(1.0) + d)
        least = F.coalesce(least, F.lit(0.0))  # the root has no centre
        if self.metric != "tanimoto":
            return F.col("_gap").isNull() | (least <= F.col("_gap"))
        chord = F.greatest(F.lit(0.0), least)
        cos = F.lit(1.0) - chord * chord / 2.0
        near = F.least(F.greatest(F.col("_qa"), a_lo), a_hi)  # the squared length in the ball that suits the query best
        m = F.sqrt(F.col("_qa") / near) + F.sqrt(near / F.col("_qa"))
        most = F.when(cos > 0, cos / (m - cos)).otherwise(0.0)
        return F.col("_score").isNull() | (most + F.lit(1e-9) >= -F.col("_score"))


@dataclass
class Directory:
    space: Space
    fan: int
    levels: list  # of (centres of each node as an array, children)
    points: DataFrame  # _level, _node, _ring, _tr, _tv, …
    blocks: DataFrame  # _level, _node, _ring, n, _lo, _hi, _alo, _ahi
    whole: bool  # every tree is one block


KEYS = ["_level", "_node", "_ring"]


def _keep(worst: np.ndarray, at: np.ndarray, rows: np.ndarray, found: np.ndarray, scores: np.ndarray, rank: np.ndarray) -> None:
    """Puts (row, ``found``, score) among the best of each row: ``worst`` scores, rising, and ``at``, what has them (-1: nothing)."""
    kk = worst.shape[1]
    some = (at[rows, -1] < 0) | (scores <= worst[rows, -1])
    rows, found, scores = rows[some], found[some], scores[some]
    if not len(rows):
        return
    mine = np.unique(rows)
    old = at[mine].ravel()
    rows = np.concatenate([rows, np.repeat(mine, kk)[old >= 0]])
    scores = np.concatenate([scores, worst[mine].ravel()[old >= 0]])
    found = np.concatenate([found, old[old >= 0]])
    order = np.lexsort((rank[found], scores, rows))
    rows, found, scores = rows[order], found[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    best = place < kk
    worst[mine], at[mine] = np.inf, -1
    worst[rows[best], place[best]], at[rows[best], place[best]] = scores[best], found[best]


def _near(df: DataFrame, centres: DataFrame, space: Space, side: str) -> DataFrame:
    """``df`` with the distances to its node's centres (null in a node without children), and the nearest one."""
    at = F.col(space.place(side))
    return (df.join(centres, "_node", "left")
            .withColumn("_all", F.transform("_cs", lambda c: F.struct(space.gap(at, c["_centre"]).alias("d"), c["_c"].alias("c"))))
            .drop("_cs").withColumn("_best", F.array_min("_all")))


def build(vectors: DataFrame, space: Space, block: int = BLOCK, fan: int = FAN, levels: int = LEVELS) -> Directory:
    """The directory over distinct ``vectors`` (_tr, _tv, and what ``Space.with_place`` adds)."""
    place, spread = space.place("t"), [F.min("_ta").alias("_alo"), F.max("_ta").alias("_ahi")]
    whole = False
    here, made, ended = vectors.withColumn("_d", F.lit(None).cast("double")), [], []
    for level in range(levels):
        large = written(here.groupBy("_node").count().where(F.col("count") > block).select("_node"), "ball-nodes")
        if large.isEmpty():
            whole = level == 0
            break
        chosen = top_k_per_group(here.join(large, "_node").select("_node", "_tr", F.col(place).alias("_centre")),
                                 ["_node"], [F.xxhash64("_tr"), F.col("_tr")], fan, "_c")
        centres = written(chosen.groupBy("_node").agg(F.sort_array(F.collect_list(F.struct((F.col("_c") - 1).alias("_c"), "_centre"))).alias("_cs")),
                          "ball-centres")
        moved = written(_near(here, centres, space, "t").drop("_all"), "ball-points")
        ended.append(moved.where("_best IS NULL").drop("_best").withColumn("_level", F.lit(level)))
        here = (moved.where("_best IS NOT NULL").withColumn("_node", F.col("_node") * fan + F.col("_best.c"))
                .withColumn("_d", F.col("_best.d")).drop("_best"))
        balls = here.groupBy("_node").agg(F.max("_d").alias("_hi"), *spread)
        named = centres.select(F.col("_node").alias("_parent"), F.explode("_cs").alias("c")).select(
            "_parent", (F.col("_parent") * fan + F.col("c._c")).alias("_node"), F.col("c._centre").alias("_centre"))
        made.append((centres, written(named.join(balls, "_node"), "balls")))
    ended.append(here.withColumn("_level", F.lit(len(made))))
    points = reduce(DataFrame.unionByName, ended)
    points = points.drop("_tp") if space.placed else points
    points = written(_rings(points, block), "ball-blocks")
    blocks = written(points.groupBy(*KEYS).agg(F.count("*").alias("n"), F.min("_d").alias("_lo"), F.max("_d").alias("_hi"), *spread), "ball-list")
    return Directory(space, fan, made, points, blocks, whole)


def _rings(points: DataFrame, block: int) -> DataFrame:
    """Adds ``_ring``: nodes beyond twice the block are cut by distance, rings beyond that by hash."""
    cuts = [i / CUTS for i in range(1, CUTS)]
    large = (points.groupBy("_level", "_node").agg(F.count("*").alias("_n"), F.percentile_approx("_d", cuts, 1000).alias("_q"))
             .where(F.col("_n") > 2 * block)
             .select("_level", "_node", F.least(F.ceil(F.col("_n") / block), F.lit(CUTS)).alias("_parts"), "_q"))
    below = F.size(F.filter("_q", lambda x: x < F.col("_d")))
    cut = F.when(F.col("_q").isNull(), 0).otherwise(F.floor(below * F.col("_parts") / CUTS))
    points = points.join(large, ["_level", "_node"], "left").withColumn("_r", F.coalesce(cut, F.lit(0)).cast("long")).drop("_q", "_parts")
    full = (points.groupBy("_level", "_node", "_r").agg(F.count("*").alias("_n")).where(F.col("_n") > 2 * block)
            .select("_level", "_node", "_r", F.ceil(F.col("_n") / block).alias("_subs")))
    sub = F.pmod(F.xxhash64("_tr"), F.coalesce("_subs", F.lit(1)))
    return (points.join(full, ["_level", "_node", "_r"], "left")
            .withColumn("_ring", F.col("_r") * (1 << 32) + sub).drop("_r", "_subs"))


def _met(sent: DataFrame, queries: DataFrame, directory: Directory, kk: int) -> DataFrame:
    """(_qr, _tr, _score): the kk best vectors of each query in the blocks it was sent to.

    A block and at most about ``ASKED`` of its queries are one group: a block that many queries reach is
    repeated for each such part of them.  The group returns kk rows a query.
    """
    space = directory.space
    ship_package(sent.sparkSession)
    parts = F.broadcast(sent.groupBy(*KEYS).agg(F.ceil(F.count("*") / ASKED).alias("_parts")))  # a row a block
    renamed = {k: f"_q{k}" for k in [*KEYS, "_part"]}
    asked = (row_join(sent.join(parts, KEYS).withColumn("_part", F.pmod(F.xxhash64("_qr"), "_parts")), queries.select("_qr", "_qv", "_qa"), "_qr")
             .select("_qr", "_qv", "_qa", *(F.col(k).alias(v) for k, v in renamed.items())))
    held = (directory.points.select("_tr", "_tv", "_ta", *KEYS).join(parts, KEYS)
            .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))))
    schema = T.StructType([queries.schema["_qr"], directory.points.schema["_tr"], T.StructField("_score", T.DoubleType())])

    def compare(q: pa.Table, t: pa.Table) -> pa.Table:
        out = []
        if len(q) and len(t):
            t = t.sort_by("_tr")  # equal scores then stand in the order of ids
            points, ids, sizes = space.points(t.column("_tv")), t.column("_tr").combine_chunks(), t.column("_ta").to_numpy()
            for s in range(0, len(q), ROWS):
                part = q.slice(s, ROWS)
                rows, at, scores = space.best(space.points(part.column("_qv")), points, part.column("_qa").to_numpy(), sizes, kk)
                out.append(pa.table({"_qr": part.column("_qr").take(rows), "_tr": ids.take(pa.array(at)), "_score": scores}))
        if not out:
            return pa.table({"_qr": q.column("_qr").slice(0, 0), "_tr": t.column("_tr").slice(0, 0), "_score": pa.array([], pa.float64())})
        return pa.concat_tables(out)

    pairs = asked.groupBy(*renamed.values()).cogroup(held.groupBy(*KEYS, "_part")).applyInArrow(compare, schema)
    return top_k_per_group(pairs, ["_qr"], [F.col("_score"), F.col("_tr")], kk, rank="_rk").drop("_rk")


def search(queries: DataFrame, directory: Directory, kk: int) -> tuple[DataFrame, DataFrame]:
    """The kk best vectors (_qr, _tr, _score) of ``queries`` (_qr, _qv, and what ``with_place`` adds), and the blocks each one met."""
    space, by_bound = directory.space, directory.space.metric != "tanimoto"
    if directory.whole:  # nothing to rule out
        sent = written(queries.select("_qr", F.lit(0).alias("_level"), "_node", F.lit(0).cast("long").alias("_ring")), "ball-sent")
        return _met(sent, queries, directory, kk), sent
    here, homes = queries.withColumn("_d", F.lit(None).cast("double")).withColumn("_gap", F.lit(None).cast("double")), []
    keep = ["_qr", "_node", "_d", "_gap"]
    for level, (centres, _) in enumerate(directory.levels):
        moved = _near(here, centres, space, "q")
        own = F.when(F.size("_all") >= kk, F.sort_array(F.transform("_all", lambda x: x["d"]))[kk - 1])
        moved = written(moved.withColumn("_gap", F.least("_gap", own)).drop("_all"), "ball-home")
        homes.append(moved.where("_best IS NULL").select(*keep).withColumn("_level", F.lit(level)))
        here = (moved.where("_best IS NOT NULL").withColumn("_node", F.col("_node") * directory.fan + F.col("_best.c"))
                .withColumn("_d", F.col("_best.d")).drop("_best"))
    homes.append(here.select(*keep).withColumn("_level", F.lit(len(directory.levels))))
    home = reduce(DataFrame.unionByName, homes)
    # the block of the home node whose ring is nearest
    off = F.greatest(F.lit(0.0), F.coalesce(F.col("_lo") - F.col("_d"), F.lit(0.0)), F.coalesce(F.col("_d") - F.col("_hi"), F.lit(0.0)))
    first = (home.join(F.broadcast(directory.blocks.select(*KEYS, "_lo", "_hi")), ["_level", "_node"])
             .groupBy("_qr", "_level", "_node").agg(F.min_by("_ring", F.struct(off.alias("o"), "_ring")).alias("_ring")))
    found = _met(first, queries, directory, kk).groupBy("_qr").agg(F.max("_score").alias("_worst"), F.count("*").alias("_got"))
    bound = F.when(F.col("_got") >= kk, F.col("_worst"))
    if space.metric != "hamming":
        return _tiled(queries, home, found, bound, directory, kk)
    asked = queries.select("_qr", F.col("_node").alias("_root"), "_qa", F.col(space.place("q")).alias("_at"))
    gaps = home.select("_qr", F.col("_gap").alias("_way"))
    asked = row_join(row_join(asked, gaps, "_qr", "left"), found, "_qr", "left")
    limit = F.least("_way", space.gap_bound(bound)) if by_bound else F.lit(None).cast("double")
    asked = written(asked.select("_qr", "_root", "_qa", "_at", limit.alias("_gap"), bound.alias("_score")), "ball-asked")
    # all nodes within reach, level by level
    front, reached = asked.withColumnRenamed("_root", "_node").withColumn("_d", F.lit(None).cast("double")), []
    for level in range(len(directory.levels) + 1):
        met = front.join(F.broadcast(directory.blocks.where(F.col("_level") == level)), "_node")
        reached.append(met.where(space.reaches(F.col("_d"), F.col("_lo"), F.col("_hi"), F.col("_alo"), F.col("_ahi")))
                       .select("_qr", *KEYS))
        if level == len(directory.levels):
            break
        balls = directory.levels[level][1]
        inner = front.withColumnRenamed("_node", "_parent").drop("_d").join(F.broadcast(balls), "_parent")
        inner = inner.withColumn("_d", space.gap(F.col("_at"), F.col("_centre")))
        inner = inner.where(space.reaches(F.col("_d"), F.lit(0.0), F.col("_hi"), F.col("_alo"), F.col("_ahi")))
        front = written(inner.select("_qr", "_node", "_qa", "_at", "_gap", "_score", "_d"), "ball-front")
    sent = written(reduce(DataFrame.unionByName, reached), "ball-sent")
    return _met(sent, queries, directory, kk), sent


def _numbered(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """(first number, numbers) of each of these groups: neighbours share a number up to ``most``, larger ones have several."""
    out, number, filled = [], -1, most
    for n in sizes:
        if filled + n > most:
            number, filled = number + 1, 0
        pieces = max(1, -(-n // most))
        out.append((number, pieces))
        number, filled = number + pieces - 1, most if pieces > 1 else filled + n
    return out


def _tiled(queries: DataFrame, home: DataFrame, found: DataFrame, bound: Column, directory: Directory, kk: int) -> tuple[DataFrame, DataFrame]:
    """The second descent of vectors: parts of queries meet the slabs of blocks that they reach."""
    space, spark = directory.space, queries.sparkSession
    ship_package(spark)
    tree_order = lambda r: (r["_node"] * directory.fan ** (len(directory.levels) - r["_level"]), r["_level"], r["_node"])
    # parts: home nodes in the order of the tree
    home = written(home.select("_qr", F.col("_level").alias("_hl"), F.col("_node").alias("_hn"), F.col("_gap").alias("_way")), "ball-homes")
    homes = sorted((r.asDict() for r in home.groupBy(F.col("_hl").alias("_level"), F.col("_hn").alias("_node")).count().collect()), key=tree_order)
    size = min(PART, max(STRIP // 2, sum(r["count"] for r in homes) // PARTS))
    parts = [(r["_level"], r["_node"], *x) for r, x in zip(homes, _numbered([r["count"] for r in homes], size))]
    parts = F.broadcast(spark.createDataFrame(parts, "_hl int, _hn long, _first long, _pieces long"))
    # slabs: blocks in the order of the tree, with the centres of their nodes
    centres = [balls.select("_node", "_centre").withColumn("_level", F.lit(i + 1)) for i, (_, balls) in enumerate(directory.levels)]
    blocks = directory.blocks.join(reduce(DataFrame.unionByName, centres), ["_level", "_node"], "left").collect()
    blocks = sorted(blocks, key=lambda r: (*tree_order(r), r["_ring"]))
    slabs = [x[0] for x in _numbered([r["n"] for r in blocks], SLAB)]
    listed = F.broadcast(spark.createDataFrame([(*(r[k] for k in KEYS), i, s) for i, (r, s) in enumerate(zip(blocks, slabs))],
                                               "_level int, _node long, _ring long, _block int, _slab int"))
    number = lambda name: np.array([np.nan if r[name] is None else r[name] for r in blocks], float)
    middle = np.array([r["_centre"] or [np.nan] * space.dim for r in blocks], float).reshape(len(blocks), space.dim)
    rings = spark.sparkContext.broadcast((middle, *map(number, ("_lo", "_hi", "_alo", "_ahi"))))

    asked = row_join(row_join(queries.select("_qr", "_qv", "_qa"), home, "_qr"), found, "_qr", "left")
    limit = F.least("_way", space.gap_bound(bound)) if space.metric != "tanimoto" else F.lit(None).cast("double")
    asked = asked.join(parts, ["_hl", "_hn"]).select("_qr", "_qv", "_qa", limit.alias("_gap"), bound.alias("_score"),
                                                     (F.col("_first") + F.pmod(F.xxhash64("_qr"), "_pieces")).cast("int").alias("_part"))

    def routed(batches):
        """The queries with the blocks that they reach, as bits."""
        centre, lo, hi, a_lo, a_hi = rings.value
        rooted = np.isnan(centre).any(1)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not len(table):
                continue
            qa, gap, score = (table.column(c).to_numpy().astype(float) for c in ("_qa", "_gap", "_score"))
            x, bits = space.places(space.points(table.column("_qv")), qa), []
            for s in range(0, len(x), PRODUCTS):
                of = slice(s, s + PRODUCTS)
                d, off = space.gaps(x[of], np.where(rooted[:, None], 0.0, centre))
                d[:, rooted] = np.nan
                bits.append(np.packbits(space.reached(d, off, lo, hi, a_lo, a_hi, qa[of], gap[of], score[of]), 1))
            reach = pa.array([b.tobytes() for b in np.concatenate(bits)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in ("_qr", "_qv", "_qa", "_score", "_part")), reach],
                                             ["_qr", "_qv", "_qa", "_score", "_part", "_reach"])

    field = lambda name: asked.schema[name]
    asked = written(asked.mapInArrow(routed, T.StructType([*map(field, ("_qr", "_qv", "_qa", "_score", "_part")), T.StructField("_reach", T.BinaryType())])),
                    "ball-asked")
    n = len(blocks)

    def bits_of(column: pa.ChunkedArray) -> np.ndarray:
        raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
        return np.unpackbits(raw, 1, count=n).astype(bool)

    def unions(batches):
        for batch in batches:
            part, reach = batch.column(0).to_numpy(), bits_of(batch.column(1))
            for k in np.unique(part):
                block = np.flatnonzero(reach[part == k].any(0)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(block), k, np.int32)), pa.array(block)], ["_part", "_block"])

    met = asked.select("_part", "_reach").mapInArrow(unions, "_part int, _block int").distinct()
    met = written(met.join(listed.select("_block", "_slab"), "_block"), "ball-met")  # a row a part and block
    held = (directory.points.select("_tr", "_tv", "_ta", *KEYS).join(listed.drop("_slab"), KEYS).drop(*KEYS)
            .join(F.broadcast(met), "_block"))
    sides = asked.join(F.broadcast(met.select("_part", "_slab").distinct()), "_part").withColumnsRenamed({"_part": "_qpart", "_slab": "_qslab"})
    schema = T.StructType([queries.schema["_qr"], directory.points.schema["_tr"], T.StructField("_score", T.DoubleType())])

    def compare(q: pa.Table, t: pa.Table) -> pa.Table:
        if not len(q) or not len(t):
            return pa.table({"_qr": q.column("_qr").slice(0, 0), "_tr": t.column("_tr").slice(0, 0), "_score": pa.array([], pa.float64())})
        t = t.sort_by("_block")
        ids, rank = t.column("_tr").combine_chunks(), np.empty(len(t), np.int64)
        rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(t))  # equal scores stand in the order of ids
        rows, at, scores = space.tile(space.points(q.column("_qv")), space.points(t.column("_tv")), q.column("_qa").to_numpy(), t.column("_ta").to_numpy(),
                                      q.column("_score").to_numpy().astype(float), bits_of(q.column("_reach")), t.column("_block").to_numpy(), rank, kk)
        return pa.table({"_qr": q.column("_qr").combine_chunks().take(pa.array(rows)), "_tr": ids.take(pa.array(at)), "_score": scores})

    pairs = sides.groupBy("_qpart", "_qslab").cogroup(held.groupBy("_part", "_slab")).applyInArrow(compare, schema)

    def apart(batches):
        for batch in batches:
            rows, block = np.nonzero(bits_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(block.astype(np.int32))], ["_qr", "_block"])

    sent = asked.select("_qr", "_reach").mapInArrow(apart, T.StructType([field("_qr"), T.StructField("_block", T.IntegerType())]))
    sent = sent.join(listed.drop("_slab"), "_block").drop("_block")
    return top_k_per_group(pairs, ["_qr"], [F.col("_score"), F.col("_tr")], kk, rank="_rk").drop("_rk"), sent


SHORT = 64  # characters of the strings that are looked up by their characters
PATTERNS = 16  # sets of places for which the strings are indexed


def _kept(text: str, keep: str) -> Column:
    return F.array_join(F.transform(keep, lambda i: F.substring(F.col(text), i, F.lit(1))), "")


def strings_within_one(queries: DataFrame, vectors: DataFrame, kk: int) -> DataFrame:
    """(_qr, _tr, _score) of the queries that have ``kk`` strings within one place of the least distance possible.

    ``queries`` (_qr, _qv) and ``vectors`` (_tr, _tv) are distinct strings, neighbours have equal lengths.  Where a place of a query
    holds a character that no string of its length has there, every distance counts it; where all strings have the query's
    character, none does.  On the places that remain, its pattern, strings that agree, or agree but for one place, are found by equal keys.
    A key lists no more of its strings than a query can need: the kk smallest ids of each character at the open place, 2·kk in all.
    Queries with longer strings, of rarer patterns or with fewer than ``kk`` answers are left to ``search``.
    """
    t = vectors.select("_tr", "_tv", F.char_length("_tv").alias("_n")).where(F.col("_n").between(1, SHORT))
    q = queries.select("_qr", "_qv", F.char_length("_qv").alias("_n"))
    places = F.sequence(F.lit(1), F.col("_n"))
    at = t.select("_n", "_tv", F.explode(places).alias("_i")).select("_n", "_i", F.substring("_tv", F.col("_i"), F.lit(1)).alias("_c"))
    letters = (at.groupBy("_n", "_i").agg(F.collect_set("_c").alias("_cs"))
               .groupBy("_n").agg(F.sort_array(F.collect_list(F.struct("_i", "_cs"))).alias("_a")))
    letters = F.broadcast(letters.select("_n", F.transform("_a", lambda x: x["_cs"]).alias("_a")))

    def known(i: Column) -> Column:
        return F.array_contains(F.get("_a", i - 1), F.substring(F.col("_qv"), i, F.lit(1)))

    q = (q.join(letters, "_n")
         .select("_qr", "_qv", "_n", F.filter(places, lambda i: known(i) & (F.size(F.get("_a", i - 1)) > 1)).alias("_keep"),
                 F.size(F.filter(places, lambda i: ~known(i))).alias("_base")))
    q = written(q, "string-queries")
    frequent = q.groupBy("_n", "_keep").count().orderBy(F.desc("count"), "_n", "_keep").limit(PATTERNS).select("_n", "_keep")
    patterns = F.broadcast(written(frequent.withColumn("_p", F.xxhash64("_n", "_keep")), "string-patterns"))
    asked = q.join(patterns, ["_n", "_keep"]).select("_qr", "_p", "_base", _kept("_qv", "_keep").alias("_r"))
    held = t.join(patterns, "_n").select("_tr", "_p", _kept("_tv", "_keep").alias("_r"))
    held = written(top_k_per_group(held, ["_p", "_r"], [F.col("_tr")], kk, "_rk").drop("_rk"), "string-index")

    def opened(df: DataFrame) -> DataFrame:
        """A row for the whole string (_j = 0) and one for each place left open, with its character."""
        j, r, one = F.col("_j"), F.col("_r"), F.lit(1)
        return (df.withColumn("_j", F.explode(F.sequence(F.lit(0), F.char_length("_r"))))
                .withColumn("_c", F.when(j == 0, "").otherwise(F.substring(r, j, one)))
                .withColumn("_r", F.when(j == 0, r).otherwise(F.concat(F.substring(r, one, j - 1), F.substring(r, j + 1, F.char_length(r))))))

    lists = (top_k_per_group(opened(held), ["_p", "_j", "_r"], [F.col("_tr")], 2 * kk, "_rk").groupBy("_p", "_j", "_r")
             .agg(F.sort_array(F.collect_list(F.struct("_tr", F.col("_c").alias("c")))).alias("_list")))
    met = row_join(opened(asked), lists, ["_p", "_j", "_r"])
    other = F.slice(F.filter("_list", lambda x: (F.col("_j") == 0) | (x["c"] != F.col("_c"))), 1, kk)
    score = (F.col("_base") + F.when(F.col("_j") == 0, 0).otherwise(1)).cast("double")
    met = met.select("_qr", F.transform(other, lambda x: F.struct(score.alias("_score"), x["_tr"].alias("_tr"))).alias("_got"))
    best = met.groupBy("_qr").agg(F.slice(F.sort_array(F.flatten(F.collect_list("_got"))), 1, kk).alias("_got"))
    return (best.where(F.size("_got") == kk).select("_qr", F.explode("_got").alias("x"))
            .select("_qr", F.col("x._tr").alias("_tr"), F.col("x._score").alias("_score")))


def visited_pairs(sent: DataFrame, directory: Directory) -> int:
    """Pairs of vectors that a search compared in its last step."""
    return sent.join(directory.blocks.select(*KEYS, "n"), KEYS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
