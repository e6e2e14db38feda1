"""Sums of money that do not depend on row order or partitioning, over all doubles.

A plain ``sum(double)`` changes in its last digits with the order in which partitions
arrive, and a cent can flip at a rounding tie. ``sum(decimal)`` is exact, but decimal
buffers beyond 18 digits cost three to four times as much per row, and no decimal spans the
range of a double.

Here each amount belongs to a band of 60 binary digits, 36 of which cover every double. It is
moved by a power of two to between 2^-7 and 2^56, which is exact, and taken apart by bit shifts
into its whole number and 60 binary digits after the point, six parts of 20 bits each. No digit
is cut: a double has 53. Each part is summed as BIGINT inside code generation, per group and
band. The sums of a group's bands, 36 at most, are then added up with carries and rounded once.
A part is below 2^20, so no sum can overflow before 4 * 10^12 rows of a group.

Amounts from 2^-7 (0.8 cents) to 2^56 (7 * 10^16) share one band, so usual groups have one row.
Infinite amounts and NaN are added as doubles, which gives the same in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 20
MASK = 2**BITS - 1
STEP = 3 * BITS
LARGEST = 2.0**STEP

#: Grouping column and moved amounts that ``with_bands`` adds.
BAND, MOVED = "amount_band", "_moved_amount"
LOWEST, HIGHEST = -18, 17

#: Sums of parts, lowest digits first.
PARTS = (
    "sum_fraction_low", "sum_fraction_mid", "sum_fraction_high",
    "sum_whole_low", "sum_whole_mid", "sum_whole_high",
)
ENDLESS = "sum_endless"
MONEY = "sums_by_band"

#: Part j of band b counts in units of 2^(20 * (3 b + j - 3)) and goes to slot 3 b + j + FIRST.
#: The three lowest slots stay empty, the three highest take the carries.
FIRST = 3 - 3 * LOWEST
SLOTS = 3 * HIGHEST + 5 + FIRST + 1 + 3


def with_bands(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Add each amount's band and the amount moved into the middle of it."""
    value, size = F.col(amount), F.abs(amount)
    usual = (size >= 2.0**-7) & (size < 2.0**56)
    # The logarithm may be off a little at a border: a band has four digits to spare there.
    other = F.floor((F.log2(size) + 4) / STEP).cast("int")
    endless = size >= float("inf")
    band = F.when(usual | (size == 0) | endless | size.isNull(), 0).otherwise(other)
    half = F.pow(F.lit(2.0), F.col(BAND) * (-STEP // 2))
    moved = F.when(F.col(BAND) == 0, value).otherwise(value * half * half)
    return df.withColumn(BAND, band).withColumn(MOVED, moved)


def _parts(number: Column) -> list[Column]:
    """The three 20-bit parts of a BIGINT, the highest one with its sign."""
    mid = F.shiftright(number, BITS).bitwiseAND(F.lit(MASK))
    return [number.bitwiseAND(F.lit(MASK)), mid, F.shiftright(number, 2 * BITS)]


def money_sums() -> list[Column]:
    """Aggregates over rows of ``with_bands``, to be grouped by the band as well."""
    moved = F.col(MOVED)
    regular = F.abs(moved) < LARGEST
    whole = F.when(regular, moved).cast("bigint")
    fraction = F.when(regular, F.rint((moved - whole) * LARGEST).cast("bigint"))
    parts = zip(PARTS, [*_parts(fraction), *_parts(whole)], strict=True)
    return [
        *[F.sum(part).alias(name) for name, part in parts],
        F.sum(F.when(~regular, moved)).alias(ENDLESS),
    ]


def merged_sums() -> list[Column]:
    """The same aggregates, summed up again over partial groups of one band."""
    return [F.sum(name).alias(name) for name in (*PARTS, ENDLESS)]


def gathered() -> list[Column]:
    """Aggregates over a group's bands, one row for each, for ``money_total``."""
    band = F.struct(F.col(BAND).alias("band"), F.array(*PARTS).alias("parts"))
    held = F.when(F.col(PARTS[0]).isNotNull(), band)
    return [F.collect_list(held).alias(MONEY), F.sum(ENDLESS).alias(ENDLESS)]


# The total as SQL text, which is much quicker to build than the same calls one by one.


def _let(name: str, value: str, body: str) -> str:
    """``body`` with a name for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _slots() -> str:
    """Sums of all bands by slot."""
    part = f"coalesce(get(band.parts, i - 3 * band.band - {FIRST}), 0L)"
    added = f"aggregate({MONEY}, 0L, (total, band) -> total + {part})"
    return f"transform(sequence(0, {SLOTS - 1}), i -> {added})"


def _carried(slots: str) -> str:
    """Digits of 20 bits, and what is carried beyond them: below zero for a negative sum."""
    value = "(done.carry + slot)"
    digits = f"concat(done.digits, array({value} & {MASK}L))"
    step = f"named_struct('carry', shiftright({value}, {BITS}), 'digits', {digits})"
    start = "named_struct('carry', 0L, 'digits', cast(array() as array<bigint>))"
    return f"aggregate({slots}, {start}, (done, slot) -> {step})"


def _rounded() -> str:
    """The nearest double: four digits from the highest one, and whether anything follows."""
    digit = [f"get(digits, top - {below})" for below in range(4)]
    rest = "if(exists(slice(digits, 1, top - 3), d -> d <> 0), 1, 0)"
    high = f"shiftleft({digit[0]}, {BITS}) + {digit[1]}"
    low = f"shiftleft(shiftleft({digit[2]}, {BITS}) + {digit[3]}, 1) + {rest}"
    unit = f"cast({2 ** (2 * BITS + 1)}L as decimal(13,0))"
    number = f"cast(cast({high} as decimal(20,0)) * {unit} + cast({low} as decimal(20,0)) as double)"
    power = f"((top - {3 + FIRST + 3}) * {BITS} - 1)"
    half = f"shiftright({power}, 1)"
    near = f"{number} * pow(2.0D, {half}) * pow(2.0D, {power} - {half})"
    top = "array_max(transform(digits, (d, i) -> if(d <> 0, i, null)))"
    return f"coalesce({_let('top', top, near)}, 0.0D)"


def _exact() -> str:
    """The rounded sum of all bands, from its digits or from those of its negative."""
    turned = _carried("transform(slots, one -> -one)")
    size = _let("digits", f"if(up.carry < 0, {turned}, up).digits", _rounded())
    signed = _let("size", size, "if(up.carry < 0, -size, size)")
    return _let("slots", _slots(), _let("up", _carried("slots"), signed))


def money_total() -> Column:
    """Sum as a double over ``gathered`` bands; NULL when the group holds no amount at all."""
    total = F.expr(f"if(size({MONEY}) > 0, {_exact()}, null)")
    endless = F.col(ENDLESS)
    return F.coalesce(total + endless, total, endless)
