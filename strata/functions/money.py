"""Money: ``round(sum(x), 2)`` with one rounding and no dependence on the order of rows.

A sum of doubles depends on the order in which rows are added, so a retried task could flip a rounding at a tie.  A double
is a whole number of some power of two, so amounts can be added as whole numbers instead: each is cut into limbs of 24
bits at fixed powers of two, every limb is summed as BIGINT (exact, whatever the split), and the limb sums of a group
give the double nearest to the true sum.  That is rounded to cents once, as ``round`` does with a double.

The limbs reach from 2^-96 to 2^120: amounts below 1.3e36 whose last digit is not below 2^-96, as has every amount of 1e-13
and more.  Others (smaller, larger, NaN, infinite) are not dropped: they are summed in doubles and added to the rest.  A
limb sum overflows, with an error, beyond 5e11 rows of a group.

An average divides the sum rounded to 6 decimals: written in binary, amounts in cents add up to a little more or less
than cents, which would decide quotients that end in half a cent.

Putting the limbs of a group together is the dear part, and most sums need no such care: every order of adding n doubles
ends within n roundings of the true sum, so where no tie of the rounding lies that near, the plain sum rounds to the same
cents.  Only the other groups are put together from limbs (``_rounded``).

Everything is SQL text over built-in functions, so the DataFrame and the SQL forms of a view share it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS, _LOW, _LIMBS = 24, -96, 9
_MASK = (1 << _BITS) - 1


def _double(value: float) -> str:
    return f"{value!r}D"


def _held(x: str) -> str:
    """Whether the limbs hold ``x`` exactly (FALSE for NaN and infinities; NULL for NULL)."""
    lowest = f"{x} * {_double(2.0 ** -_LOW)}"
    return f"(abs({x}) < {_double(2.0 ** (_LOW + _BITS * _LIMBS))} AND rint({lowest}) = {lowest})"


def _limb(x: str, i: int) -> str:
    """What rounding to the next higher power of two leaves over of rounding to this one: 24 bits and a sign."""
    power = _LOW + _BITS * i
    own, above = (f"rint({x} * {_double(2.0 ** -p)})" for p in (power, power + _BITS))
    return f"CAST(CASE WHEN {_held(x)} THEN {own} - {above} * {_double(2.0 ** _BITS)} ELSE 0D END AS BIGINT)"


def _carried(sums: str) -> str:
    """Limb sums, lowest first, as limbs from 0 to 2^24; three more on top, the last of them with the sign."""
    return (f"aggregate({sums}, named_struct('c', 0L, 'd', CAST(array() AS ARRAY<BIGINT>)), (s, y) -> named_struct("
            f"'c', shiftright(s.c + y, {_BITS}), 'd', concat(s.d, array((s.c + y) & {_MASK}L))), "
            f"s -> concat(s.d, array(s.c & {_MASK}L, shiftright(s.c, {_BITS}) & {_MASK}L, shiftright(s.c, {2 * _BITS}))))")


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _nearest(sums: str) -> str:
    """The double nearest to the sum: the four limbs from the highest on, and one bit for whatever is below them."""
    last = _LIMBS + 2
    magnitude = _let("p", _carried("a"), f"named_struct('g', if(p[{last}] < 0, -1D, 1D), 'd', if(p[{last}] < 0, "
                     f"{_carried('transform(a, z -> -z)')}, p))")
    top = "array_max(transform(v.d, (y, i) -> if(y > 0, i, -1)))"
    limbs = " + ".join(f"CAST(coalesce(get(v.d, k - {j}), 0L) AS DECIMAL(20,0)) * CAST({1 << _BITS * (3 - j)} AS DECIMAL(23,0))"
                       for j in range(4))
    below = "if(exists(slice(v.d, 1, greatest(k - 3, 0)), y -> y > 0), 1, 0)"
    value = f"v.g * CAST(({limbs}) * 2 + {below} AS DOUBLE) * pow(2D, {_BITS} * (k - 3) + {_LOW - 1})"
    return _let("a", sums, _let("v", magnitude, _let("k", top, value)))


def sum_sql(amount: str) -> str:
    """SQL text of an aggregate: the double nearest to the sum of ``amount`` (a column name); NULL without an amount."""
    x = f"CAST(`{amount}` AS DOUBLE)"
    sums = f"array({', '.join(f'sum({_limb(x, i)})' for i in range(_LIMBS))})"
    others = f"coalesce(sum(CASE WHEN NOT {_held(x)} THEN {x} END), 0D)"
    return f"CASE WHEN count({x}) > 0 THEN {_nearest(sums)} + {others} END"


def _rounded(amount: str, digits: int) -> str:
    """``round(sum_sql(amount), digits)``, from the plain sum where every order of adding rounds alike.

    ``off`` is more than twice what the plain sum, the nearest double and the scaling below can be off by, in units of
    the last digit; NaN, infinities and sums too large for their digits fail the first comparison.
    """
    x = f"CAST(`{amount}` AS DOUBLE)"
    unit = _double(10.0 ** digits)
    off = f"((count({x}) + 8) * sum(abs({x})) * {_double(2.0 ** -51)} * {unit})"
    tie = f"abs(abs(sum({x})) * {unit} - floor(abs(sum({x})) * {unit}) - 0.5D)"  # how far the nearest tie is
    return (f"CASE WHEN {off} < 0.25D AND {tie} > {off} + 0.01D THEN round(sum({x}), {digits}) "
            f"ELSE round({sum_sql(amount)}, {digits}) END")


def total_sql(amount: str) -> str:
    """SQL text of an aggregate: the sum, rounded to cents once."""
    return _rounded(amount, 2)


def average_sql(amount: str, n: str) -> str:
    """SQL text of an aggregate: the sum over ``n`` (SQL text of an aggregate), rounded to cents once; NULL where ``n`` is 0."""
    return f"round({_rounded(amount, 6)} / nullif(CAST({n} AS DOUBLE), 0D), 2)"


def amount_total(amount: str) -> Column:
    """Aggregate: the sum, rounded to cents once; NULL if the group has no amount."""
    return F.expr(total_sql(amount))


def amount_average(amount: str, n: Column) -> Column:
    """Aggregate: the sum over ``n`` (an aggregate), rounded to cents once; NULL where ``n`` is 0."""
    return F.round(F.expr(_rounded(amount, 6)) / F.nullif(n.cast("double"), F.lit(0.0)), 2)
