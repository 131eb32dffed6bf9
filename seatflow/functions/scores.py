"""Occupancy scores, the four rounding rules, weights and costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seatflow.schemas import CLASS_WEIGHTS, SCORED_STATUSES, STATUS_CODES


def status_name(code: Column) -> Column:
    """Status text of a feed code, NULL for a code the feed does not define."""
    names = F.create_map(*[F.lit(x) for pair in STATUS_CODES.items() for x in pair])
    return F.try_element_at(names, code)


def score_of(status: Column) -> Column:
    """Ordinal score of a status text, NULL when it is off the scale."""
    place = F.array_position(F.array(*[F.lit(s) for s in SCORED_STATUSES]), status)
    return F.nullif(place, F.lit(0)) - 1


def exact_mean(total: str, count: str, places: int = 4) -> Column:
    """total / count at `places` decimals, as rounding the binary quotient half-even gives it (A3).

    Whole-number arithmetic throughout. A decimal tie such as 1/160 = 0.00625 is almost never
    exact in binary, so a tie goes the way the stored quotient errs: its error is read off the
    quotient's leading 30 and trailing 37 binary places, and only a zero error rounds to even.
    """
    scale = 10**places
    down = f"({total} * {scale}L) div {count}"
    tie = f"({total} * {2 * scale}L) % {count} = 0 and (({total} * {2 * scale}L) div {count}) % 2 = 1"
    shifted = f"(double({total}) / double({count})) * {2**30}D"
    quotient = (
        f"(cast(floor({shifted}) as decimal(11)) * cast({2**37}L as decimal(12))"
        f" + cast(({shifted} - floor({shifted})) * {2**37}D as decimal(12)))"
    )
    error = (
        f"cast({quotient} as decimal(21)) * cast({count} as decimal(16))"
        f" - cast({total} as decimal(16)) * {2**67}BD"
    )
    return F.expr(f"""
        case when {tie} then
            ({down} + case when {error} > 0 then 1 when {error} < 0 then 0 else ({down}) % 2 end) / {scale}D
        else (({total} * {2 * scale}L + {count}) div (2 * {count})) / {scale}D end
    """)


def clipped(value: Column) -> Column:
    """Held within 0 to 5; NaN counts as missing, not as full."""
    present = F.when(~F.isnan(value.cast("double")), value.cast("double"))
    return F.when(present < 0, 0.0).when(present > 5, 5.0).otherwise(present)


def mean_prediction(value: Column) -> Column:
    """Two decimals, halves of the scaled value to even."""
    return F.rint(clipped(value) * 100) / 100


def class_prediction(value: Column) -> Column:
    """Whole class number."""
    return F.rint(clipped(value)).cast("int")


def display_bucket(value: Column) -> Column:
    """Colour step 0 to 5, halves up."""
    return F.when(
        value.isNotNull(), F.least(F.lit(5), F.greatest(F.lit(0), F.floor(value + 0.5).cast("int")))
    )


def display_mean(value: Column) -> Column:
    """One decimal, nearest to the stored binary value, exact halves up; `-` when missing."""
    size = F.abs(value)
    tenths = F.floor(size * 10).cast("bigint")
    shifted = size * float(2**30)
    lead = F.floor(shifted).cast("bigint")
    tail = ((shifted - F.floor(shifted)) * float(2**37)).cast("bigint")
    # twenty times the value against the odd number of twentieths, in units of 2**-30
    reach = lead * 20 + F.shiftright(tail * 20, 37)
    rounded = tenths + (reach >= (tenths * 2 + 1) * F.lit(2**30)).cast("int")
    text = F.concat(
        F.when(value < 0, "-").otherwise(""),
        F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string"),
    )
    return F.coalesce(text, F.lit("-"))


def display_class(value: Column) -> Column:
    """Whole number, halves up; `-` when missing."""
    return F.coalesce(F.floor(value + 0.5).cast("string"), F.lit("-"))


def sample_weight(label: Column) -> Column:
    """More weight for fuller classes: 1 for class 0 up to 3.5 for class 5."""
    return label * 0.5 + 1.0


def class_weight(label: Column) -> Column:
    """Recall weight of a class."""
    weights = F.create_map(*[F.lit(x) for pair in CLASS_WEIGHTS.items() for x in pair])
    return F.try_element_at(weights, label.cast("int"))


def ordinal_cost_term(label: Column, predicted: Column) -> Column:
    """Distance, doubled when the prediction is too low, raised by the label."""
    return F.abs(label - predicted) * F.when(label > predicted, 2.0).otherwise(1.0) * (label * 0.2 + 1.0)
