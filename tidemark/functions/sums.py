"""Sums of doubles that do not depend on the order of adding, in built-in expressions.

A finite double is a whole number of units of ``2 ** (24 * bin)``, where the bin follows from its size, and is cut
into four limbs of 24 bits.  Limbs are added as whole numbers, which is exact in any order and can be undone, so
partial sums of tasks and of earlier runs can be put together.  The total is the double
nearest to the exact sum.  NaN and the infinities are counted in bins of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: One bin's part of a sum; ``values`` says how many values are in it.
PARTS = "array<struct<bin:int,values:bigint,s0:bigint,s1:bigint,s2:bigint,s3:bigint>>"
_SPECIAL = 1000
_NAN, _UP, _DOWN = _SPECIAL, _SPECIAL + 1, _SPECIAL + 2
_LIMB = f"{1 << 24}L"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def bin_of(x: str) -> str:
    """The bin of a double, as SQL; NULL for NULL."""
    return (
        f"CASE WHEN isnan({x}) THEN {_NAN} WHEN {x} = double('Infinity') THEN {_UP} WHEN {x} = double('-Infinity') THEN {_DOWN} "
        f"WHEN {x} = 0 THEN 0 WHEN {x} IS NOT NULL THEN CAST(floor((floor(log2(abs({x}))) - 54) / 24) AS INT) END"
    )


def limbs_of(x: str, bin_column: str) -> list[str]:
    """Four whole numbers, as SQL, that make up ``x`` in units of its bin; all 0 for special values."""
    half = f"pow(2D, -12 * {bin_column})"
    units = f"CASE WHEN {bin_column} < {_SPECIAL} THEN abs({x}) * {half} * {half} ELSE 0D END"
    # remainders and these differences of doubles are exact
    rests = [f"(({units}) % {float(1 << 24 * k)!r}D)" for k in (1, 2, 3)] + [f"({units})"]
    limbs = [rests[0], *(f"(({rests[k]} - {rests[k - 1]}) / {float(1 << 24 * k)!r}D)" for k in (1, 2, 3))]
    return [f"(CASE WHEN {x} < 0 THEN -1L ELSE 1L END * CAST({limb} AS BIGINT))" for limb in limbs]


def total_of(parts: str) -> str:
    """The total of a column of :data:`PARTS`, as SQL; NULL if it holds no value."""
    def held(special: int) -> str:
        return f"exists({parts}, e -> e.bin = {special} AND e.values > 0)"

    at = "CASE p - e.bin WHEN 0 THEN e.s0 WHEN 1 THEN e.s1 WHEN 2 THEN e.s2 WHEN 3 THEN e.s3 ELSE 0L END"
    columns = f"transform(sequence(lo, hi), p -> aggregate(finite, 0L, (a, e) -> a + {at}))"

    def carried(values: str) -> str:
        start = "named_struct('digits', CAST(array() AS array<bigint>), 'carry', 0L)"
        step = f"named_struct('digits', concat(a.digits, array(pmod(a.carry + v, {_LIMB}))), 'carry', shiftright(a.carry + v, 24))"
        return f"aggregate({values}, {start}, (a, v) -> {step})"

    def digit(back: int) -> str:
        weight = f"CAST('{1 << 24 * (3 - back)}' AS DECIMAL(23,0))"
        return f"CAST(coalesce(get(d, t - {back + 1}), 0L) AS DECIMAL(10,0)) * {weight}"

    # the four highest digits hold at least 73 bits; one more bit says whether anything lies below them
    lead = " + ".join(digit(back) for back in range(4))
    below = "CASE WHEN exists(slice(d, 1, greatest(t - 4, 0)), x -> x <> 0) THEN 1 ELSE 0 END"
    scaled = _let("k", "24 * (lo + t - 4) - 1", f"CAST(({lead}) * 2 + {below} AS DOUBLE) * pow(2D, k div 2) * pow(2D, k - k div 2)")
    highest = "array_max(transform(sequence(1, size(d)), i -> CASE WHEN d[i - 1] <> 0 THEN i ELSE 0 END))"
    size = _let("t", highest, f"CASE WHEN t = 0 THEN 0D ELSE {scaled} END")
    negative = f"-({_let('d', carried('transform(v0, x -> -x)') + '.digits', size)})"
    positive = _let("d", "n.digits", size)
    signed = _let("n", carried("v0"), f"CASE WHEN n.carry < 0 THEN {negative} ELSE {positive} END")
    exact = _let("lo", "array_min(transform(finite, e -> e.bin))", _let("hi", "array_max(transform(finite, e -> e.bin)) + 6", _let("v0", columns, signed)))
    finite = _let("finite", f"filter({parts}, e -> e.bin < {_SPECIAL})", f"CASE WHEN size(finite) = 0 THEN 0D ELSE {exact} END")
    return (
        f"CASE WHEN aggregate({parts}, 0L, (a, e) -> a + e.values) = 0 THEN CAST(NULL AS DOUBLE) "
        f"WHEN {held(_NAN)} OR ({held(_UP)} AND {held(_DOWN)}) THEN double('NaN') WHEN {held(_UP)} THEN double('Infinity') "
        f"WHEN {held(_DOWN)} THEN double('-Infinity') ELSE {finite} END"
    )


def with_limbs(rows: DataFrame, measure: str, sign: str = "1L") -> DataFrame:
    """``rows`` with columns ``bin, values, s0 .. s3`` for one column; ``sign`` -1 takes a value back."""
    x = f"`{measure}`"
    binned = rows.withColumn("bin", F.expr(bin_of(x)))
    limbs = {f"s{k}": F.expr(f"({sign}) * {limb}") for k, limb in enumerate(limbs_of(x, "bin"))}
    return binned.withColumns({"values": F.expr(f"CASE WHEN {x} IS NULL THEN 0L ELSE {sign} END"), **limbs})


#: Sums of the columns of :func:`with_limbs`, for rows of one group and bin.
BIN_SUMS = {"values": "sum(values)", **{f"s{k}": f"coalesce(sum(s{k}), 0L)" for k in range(4)}}
#: All bins of a group as :data:`PARTS`.
COLLECTED = f"CAST(array_sort(collect_list(CASE WHEN bin IS NOT NULL THEN struct(bin, values, s0, s1, s2, s3) END)) AS {PARTS})"
