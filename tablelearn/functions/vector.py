"""Vector arithmetic as plain column expressions.

A vector is either a list of columns (one per feature; the fast form, it stays
inside whole-stage codegen) or one array column with a known length, which is
unrolled into element accesses.  Array lambdas (``zip_with``/``aggregate``)
are only used when the length is not known at plan time.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

VectorLike = Union[Sequence[Union[str, Column]], Column, str]


def col(c: Union[str, Column]) -> Column:
    return F.col(c) if isinstance(c, str) else c


def components(x: VectorLike, dim: int | None = None) -> list[Column] | None:
    """Columns of a vector, or None when it must stay an array (dim unknown).

    ``dim`` declares the length of an array column: an array of another length has null components.
    """
    if isinstance(x, (list, tuple)):
        return [col(c).cast("double") for c in x]
    if dim is None:
        return None
    c = col(x)
    return [F.when(F.size(c) == dim, F.get(c, F.lit(i))).cast("double") for i in range(dim)]


def lit_vector(values: Sequence[float]) -> list[Column]:
    return [F.lit(float(v)) for v in values]


def total(terms: Sequence[Column]) -> Column:
    """Left-to-right sum (the same order a SQL ``a + b + c`` uses)."""
    if not terms:
        return F.lit(0.0)
    return reduce(lambda a, b: a + b, terms)


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return total([x * y for x, y in zip(a, b)])


def linear(xs: Sequence[Column], weights: Sequence[float], bias: float = 0.0) -> Column:
    """w·x + b with the model as literals."""
    z = total([x * F.lit(float(w)) for x, w in zip(xs, weights)])
    return z + F.lit(float(bias))


def as_array(xs: Sequence[Column]) -> Column:
    return F.array(*[x.cast("double") for x in xs])


def any_null(values: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [v.isNull() for v in values])


def _arg_first(values: Sequence[Column], best: Column) -> Column:
    expr = F.lit(len(values) - 1)
    for i in range(len(values) - 2, -1, -1):
        expr = F.when(values[i] == best, F.lit(i)).otherwise(expr)
    return F.when(~any_null(values), expr)


WIDE = 64  # entries beyond which means of vectors are one aggregate of arrays, not one aggregate an entry


def mean_array(vector: Column, dim: int) -> Column:
    """Element-wise mean of a column of ``dim`` doubles as one aggregate (null vectors don't count; null if there is no other).

    The aggregate keeps one buffer of sums however long the vector is, where one aggregate an entry would
    make a row of as many buffers and more code than the JVM compiles.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    filled = F.coalesce(vector, F.array_repeat(F.lit(0.0), dim))  # adds nothing to the sum
    total_ = vector_to_array(Summarizer.metrics("sum").summary(array_to_vector(filled)).getField("sum"))
    n = F.count(vector)
    return F.when(n > 0, F.zip_with(total_, F.array_repeat(n, dim), lambda x, c: x / c))


def argmin(values: Sequence[Column]) -> Column:
    """Index of the smallest value; ties go to the smallest index; null if any value is null."""
    return _arg_first(values, F.least(*values) if len(values) > 1 else values[0])


def argmax(values: Sequence[Column]) -> Column:
    """Index of the largest value; ties go to the smallest index; null if any value is null."""
    return _arg_first(values, F.greatest(*values) if len(values) > 1 else values[0])


def pick(values: Sequence[Column], index: Column) -> Column:
    """values[index] for a small literal list of columns; null for a null index."""
    expr = values[-1]
    for i in range(len(values) - 2, -1, -1):
        expr = F.when(index == i, values[i]).otherwise(expr)
    return F.when(index.isNotNull(), expr)
