"""Least squares of every series at once: sums of products as one grouped
aggregate of vectors, the small normal equations solved by SQL functions.

A system is an ``array<array<double>>`` of k rows and k + 1 columns, the matrix
of sums with the right-hand side behind it. The matrix is symmetric and positive
definite (a ridge makes it so where regressors are collinear), so it is reduced
without pivoting, in k steps - nothing is iterated until convergence.

Arguments and results named ``Sql`` are SQL expression texts, which nest without
a round trip to the JVM per function; wrap the outermost in ``F.expr``.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F

Sql = str


def products(regressors: Sql, target: Sql, rows: Sql = "true") -> Column:
    """A row's contribution to :func:`product_sums` (a vector): every regressor
    (elements of an array) times every regressor and the target, then the
    target's square and 1; zeros outside ``rows`` (a condition)."""
    on = f"IF({rows}, 1D, 0D)"
    pairs = (f"flatten(transform({regressors}, x -> transform(concat({regressors}, array({target})), y -> x * y * {on})))")
    return array_to_vector(F.expr(f"concat({pairs}, array({target} * {target} * {on}, {on}))"))


def product_sums(contribution: str) -> Column:
    """The sums of a column of :func:`products`, as an array: k rows of k + 1
    sums, the target's squares, the row count."""
    return vector_to_array(Summarizer.sum(F.col(contribution)))


def target_squares(sums: Sql, k: int) -> Sql:
    return f"element_at({sums}, {k * (k + 1) + 1})"


def row_count(sums: Sql, k: int) -> Sql:
    return f"element_at({sums}, {k * (k + 1) + 2})"


def right_side(sums: Sql, k: int) -> Sql:
    """Sums of each regressor times the target."""
    return f"transform(sequence(1, {k}), i -> element_at({sums}, i * {k + 1}))"


def system(sums: Sql, k: int, used: Sql | None = None, ridge: Sql | None = None, unpenalised: tuple[int, ...] = ()) -> Sql:
    """The normal equations of :func:`product_sums`. Regressors that are not
    ``used`` (an array of k booleans) get a zero coefficient; ``ridge`` is added
    to the diagonal."""
    matrix = f"transform(sequence(0, {k - 1}), i -> slice({sums}, i * {k + 1} + 1, {k + 1}))"
    if ridge is not None:
        free = "".join(f" AND i != {i}" for i in unpenalised)
        matrix = f"transform({matrix}, (row, i) -> transform(row, (v, j) -> IF(i = j{free}, v + {ridge}, v)))"
    if used is not None:
        live = f"concat({used}, array(true))"
        matrix = (f"transform({matrix}, (row, i) -> transform(row, (v, j) -> "
                  f"IF(element_at({live}, i + 1) AND element_at({live}, j + 1), v, IF(i = j, 1D, 0D))))")
    return matrix


def solved(equations: Sql, k: int) -> Sql:
    """The solution as an array; nulls where the matrix is singular."""
    done = (f"aggregate(sequence(1, {k}), {equations}, (m, s) -> transform(m, (row, at) -> IF(at + 1 = s, row, "
            "zip_with(row, element_at(m, s), (x, p) -> x - p * try_divide(element_at(row, s), element_at(element_at(m, s), s))))))")
    return f"transform({done}, (row, at) -> try_divide(element_at(row, {k + 1}), element_at(row, at + 1)))"


def dot(coefficients: Sql, values: Sql) -> Sql:
    """Sum of coefficient times value; missing coefficients count as zero."""
    none = "CAST(array() AS ARRAY<DOUBLE>)"
    return (f"aggregate(zip_with(coalesce({coefficients}, {none}), {values}, (c, v) -> coalesce(c, 0D) * v), 0D, (t, x) -> t + x)")
