"""Column expressions used by the silver and gold steps.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen. Values that cannot be parsed become NULL; with ``strict=True`` a bad
number or an impossible date fails the job instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp layouts of the landing files and of the ingest stamp.
SALE_TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
INGEST_STAMP_FORM = (r"^(\d+)-(\d+)-(\d+) (\d+):(\d+):(\d+).*$", "$1$2$3_$4$5$6")

# Parts of the day with the hour at which each one ends.
DAY_PARTS = [("Madrugada", 6), ("Manhã", 12), ("Tarde", 18)]
LAST_DAY_PART = "Noite"


def _convert(column: Column, to: str, strict: bool) -> Column:
    return column.cast(to) if strict else column.try_cast(to)


def sale_timestamp(text: Column, strict: bool = False) -> Column:
    """Wall-clock timestamp from ``yyyy-MM-dd HH:mm:ss`` text, free of any time zone.

    A cast accepts more layouts than this one, hence the check of the shape.
    """
    parsed = _convert(text, "timestamp_ntz", strict)
    if strict:
        shape_error = F.raise_error(F.concat(F.lit("bad timestamp: "), text))
        return F.when(text.isNull() | text.rlike(SALE_TIMESTAMP_SHAPE), parsed).otherwise(
            shape_error.cast("timestamp_ntz")
        )
    return F.when(text.rlike(SALE_TIMESTAMP_SHAPE), parsed)


def comma_decimal(text: Column, strict: bool = False) -> Column:
    """Float from text whose decimal separator is a comma."""
    return _convert(F.replace(text, F.lit(","), F.lit(".")), "float", strict)


# Fixed value: money with at most two places after a comma or point; zeros may follow.
EXACT_MONEY_SHAPE = r"^[+-]?[0-9]{1,16}([.,][0-9]{0,2}0*)?$"


def exact_money(text: Column, strict: bool = False) -> Column:
    """Decimal with two places, as the text says it.

    Text that says something else than such a number (not finite, more places, an exponent, separators of thousands)
    is NULL, or fails with ``strict``: nothing is rounded.
    """
    value = F.replace(text, F.lit(","), F.lit(".")).try_cast("decimal(18,2)")
    checked = F.when(text.rlike(EXACT_MONEY_SHAPE), value)
    if strict:
        error = F.raise_error(F.concat(F.lit("not exact money: "), text)).cast("decimal(18,2)")
        return F.when(text.isNull(), F.lit(None).cast("decimal(18,2)")).when(checked.isNull(), error).otherwise(checked)
    return checked


def exact_net(value: Column, discount: Column) -> Column:
    """Exact value after the discount fraction, which is taken with six places; NULL where that is no number."""
    return (value * (F.lit(1) - discount.try_cast("decimal(9,6)"))).cast("decimal(28,8)")


def percent_fraction(text: Column, strict: bool = False) -> Column:
    """Fraction as double from text such as ``11%``."""
    number = F.replace(text, F.lit("%"), F.lit(""))
    return _convert(number, "float", strict) / F.lit(100)


def full_name(first: Column, last: Column, trim_parts: bool = True) -> Column:
    """First and last name joined by a space, each word capitalised; NULL parts are skipped."""
    parts = [F.trim(first), F.trim(last)] if trim_parts else [first, last]
    return F.initcap(F.concat_ws(" ", *parts))


def email_domain(email: Column) -> Column:
    """Piece after the first ``@`` and before the next one; NULL without ``@``."""
    return F.get(F.split(email, "@"), F.lit(1))


def day_part(moment: Column, null_as_night: bool = False) -> Column:
    """Six-hour band of the day. A NULL moment has no band unless ``null_as_night``."""
    hour = F.hour(moment)
    bands = F
    for label, end in DAY_PARTS:
        bands = bands.when(hour < end, label)
    if null_as_night:
        return bands.otherwise(LAST_DAY_PART)
    return bands.when(hour.isNotNull(), LAST_DAY_PART)


def net_value(value: Column, discount: Column) -> Column:
    """Value after the discount fraction."""
    return value * (F.lit(1) - discount)


def without_extension(name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(name, r"\.[^./]*$", "")


def ingest_stamp(moment: Column) -> Column:
    """UTC ingest time in the form put before file names, counted from the epoch: no local time is passed through."""
    wall = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=F.unix_seconds(moment))
    return F.regexp_replace(wall.cast("string"), *INGEST_STAMP_FORM)


def source_name(name: Column, moment: Column | None = None) -> Column:
    """Lineage value of a file: its name without extension, after its ingest stamp if given."""
    bare = without_extension(name)
    return bare if moment is None else F.concat_ws("_", ingest_stamp(moment), bare)
