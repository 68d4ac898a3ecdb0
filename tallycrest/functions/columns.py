"""Column expressions for cleaning, parsing and business rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,4)"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]"
DATE_FORMAT = "yyyy-MM-dd"
NO_BREAK_SPACE = "\u00a0"

# Month spellings in quota tables.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_units(c: Column | str, digits: int) -> Column:
    """The amount cast to ``decimal(18, digits)``, as a whole number of its last place.

    Amounts that no rounding error can take over a tie are scaled in doubles, which costs a tenth of the cast;
    the others (ties, large amounts, NaN) are cast.
    """
    amount, scale = as_column(c), 10**digits
    raised = amount.cast("double") * scale + 0.5
    units = F.floor(raised)
    # below 10^12 the scaled amount is off by less than 0.001
    clear = (F.abs(raised) < 1e12) & (raised - units).between(0.001, 0.999)
    return F.when(clear, units).otherwise((amount.cast(f"decimal(18,{digits})") * scale).cast("long"))


def decimal_sum(c: Column | str, digits: int) -> Column:
    """Sum of amounts as ``decimal(18, digits)``, as a double; null if there is none.

    Summed as whole numbers in two parts, so that a long holds the sum of any amounts that a decimal can.
    """
    units = decimal_units(c, digits)
    high, low = F.sum(F.shiftright(units, 30)), F.sum(units.bitwiseAND(F.lit((1 << 30) - 1)))
    near = (high.between(-(1 << 21), 1 << 21)) & (low < 1 << 51)  # the whole is an exact double
    whole = (high * (1 << 30) + low) / F.lit(float(10**digits))
    wide = high.cast("decimal(20,0)") * F.lit(1 << 30).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    return F.when(near, whole).otherwise((wide * F.lit(10.0**-digits).cast(f"decimal({digits},{digits})")).cast("double"))


def money_sum(c: Column | str) -> Column:
    """Sum of amounts in decimals (``MONEY``), so the total does not depend on row order."""
    return F.coalesce(decimal_sum(c, 4), F.lit(0.0))


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def to_moment(df: DataFrame, name: str) -> Column:
    """A timestamp column: text is parsed strictly, dates and timestamps pass through."""
    return F.to_timestamp_ntz(F.col(name), F.lit(TIMESTAMP_FORMAT)) if is_text(df, name) else F.col(name)


def to_moment_or_null(df: DataFrame, name: str) -> Column:
    """As ``to_moment``, but text that is neither a moment nor a date becomes null."""
    if not is_text(df, name):
        return F.col(name)
    moment = F.try_to_timestamp(F.col(name), F.lit(TIMESTAMP_FORMAT)).cast("timestamp_ntz")
    return F.coalesce(moment, parse_date(name).cast("timestamp_ntz"))


def to_number(c: Column | str) -> Column:
    """Double; text that is not a number, and NaN, become null."""
    number = as_column(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def parse_date(c: Column | str) -> Column:
    """Date from ISO text; null where the text is no date."""
    return F.try_to_date(as_column(c), DATE_FORMAT)


def fix_year(c: Column | str) -> Column:
    """Repair the year 3024 that should read 2024."""
    return F.regexp_replace(as_column(c), "^3024", "2024")


def month_number(c: Column | str) -> Column:
    """1..12 from a short month name or a plain number; null for anything else."""
    text = as_column(c).cast("string")

    def place(values: list[str]) -> Column:
        found = F.array_position(F.array(*[F.lit(v) for v in values]), text)
        return F.when(found > 0, found.cast("int"))

    return F.coalesce(place(MONTH_NAMES), place([str(m) for m in range(1, 13)]))


def rep_number(df: DataFrame, name: str) -> Column:
    """Rep code as a whole number; text such as ``12.7`` is truncated, other text is null."""
    if is_text(df, name):
        return to_number(name).cast("long")
    return F.col(name).cast("long")


def strip_no_break_space(c: Column | str) -> Column:
    return F.translate(as_column(c), NO_BREAK_SPACE, "")


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole days between two moments, rounded down (so -1 for half a day too late)."""
    between = later - earlier
    days = F.extract(F.lit("DAY"), between)
    return days - F.when(between < F.make_dt_interval(days), 1).otherwise(0)


def gate(amount: Column | str, when: Column | str, limit: Column | str) -> Column:
    """The amount if its date lies strictly before the limit, else 0."""
    return F.coalesce(F.when(as_column(when) < as_column(limit), as_column(amount)), F.lit(0.0))


def growth_weight(category: Column | str) -> Column:
    c = as_column(category)
    return F.when(c == "High", 1.4).when(c == "Medium", 1.2).otherwise(1.0)


def absolute_percentage_error(actual: Column | str, predicted: Column | str) -> Column:
    """In percent; infinite for any prediction but 0 of an actual 0, null for 0 of 0."""
    a, p = as_column(actual), as_column(predicted)
    infinite = F.lit(float("inf"))
    return F.when((a == 0) & (p != 0), infinite).otherwise(F.abs(F.try_divide(a - p, a)) * 100)


def argmax_name(columns: list[str]) -> Column:
    """Name of the largest column; the first one wins ties."""
    values = F.array(*columns)
    return F.get(F.array(*[F.lit(c) for c in columns]), F.array_position(values, F.array_max(values)).cast("int") - 1)
