"""Column expressions: built-in Spark functions only, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a CSV reader treats as "missing".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The characters Unicode counts as white space.
WHITESPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ),
    )
)

UNITS_PER_ONE = 10000  # money counts in ten-thousandths
LOW_BITS = 20
NUMERIC_CHARS = "0123456789+-.eE \t\r\n"
ISO_SECONDS = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
WORD_MARK = chr(0xE000) + " "  # a private-use character


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_TOKENS), c)


def to_number(c: Column) -> Column:
    """Text to double, NULL where it is no number.

    A plain try_cast also accepts Java spellings such as ``1.0d`` and ``0x1p3``.
    """
    return F.when(F.translate(c, NUMERIC_CHARS, "") == "", c.try_cast("double"))


def to_int(c: Column, kind: str = "bigint") -> Column:
    """Text to integer, fraction cut off, 0 where it is no number."""
    return F.coalesce(c.try_cast(kind), to_number(c).try_cast(kind), F.lit(0).cast(kind))


def to_ts(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a timestamp, NULL for any other shape.

    The cast to TIMESTAMP_NTZ does not depend on the session time zone, while
    parsing with a pattern would go through it.
    """
    return F.when(c.rlike(ISO_SECONDS), c.try_cast("timestamp_ntz"))


def to_date_ts(c: Column, fmt: str) -> Column:
    return F.try_to_date(c, fmt).cast("timestamp_ntz")


def to_boolean(c: Column) -> Column:
    return c.try_cast("boolean")


def truthy(c: Column) -> Column:
    """1 unless the text is missing, empty, false or zero."""
    return F.when(~F.lower(c).isin("", "false", "0", "0.0"), 1).otherwise(0)


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds to a UTC timestamp, whatever the session time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds; TIMESTAMPDIFF would go through the session time zone."""
    return (end - start).cast("interval second").cast("bigint")


def initcap_words(c: Column) -> Column:
    """Upper-case the first letter after every character that is no ASCII letter or digit.

    ``initcap`` starts words at spaces only, so a mark and a space go in behind
    every other separator and come out again afterwards.
    """
    marked = F.regexp_replace(c, r"([^A-Za-z0-9 ])", "$1" + WORD_MARK)
    return F.replace(F.initcap(marked), F.lit(WORD_MARK), F.lit(""))


def non_negative(c: Column) -> Column:
    return F.when(c.isNull() | (c < 0), F.lit(0.0)).otherwise(c)


def clamp(c: Column, low: int, high: int) -> Column:
    """NULL stays NULL, which least/greatest would turn into a bound."""
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def band(c: Column, low: float, high: float, labels: tuple[str, str, str]) -> Column:
    return F.when(c < low, labels[0]).when(c < high, labels[1]).otherwise(labels[2])


def round2(c: Column) -> Column:
    """Two decimals, halves up, the same in every engine that has IEEE doubles."""
    return F.floor(c * 100 + 0.5) / F.lit(100.0)


#: Amounts below this fit a bigint of ten-thousandths.
MOST_MONEY = 9e14


def units(c: Column) -> Column:
    """Money as a whole number of ten-thousandths. NaN and amounts that would not fit
    stop the job: counted as whole numbers, they would be other amounts."""
    fits = F.abs(c) < MOST_MONEY
    whole = F.floor(c * UNITS_PER_ONE + 0.5)
    return F.when(c.isNull() | fits, whole).otherwise(F.raise_error(F.lit("an amount is NaN or too large")))


def sum_units(c: Column) -> Column:
    """Exact sum of whole numbers, as DECIMAL(38,0).

    Doubles added in another order give another last digit, and decimals cost
    twice the time. So the high and the low bits are summed apart as integers:
    neither sum overflows below a trillion rows, and the total has 38 digits.
    """
    high = F.sum(F.shiftright(c, LOW_BITS)).cast("decimal(38,0)")
    low = F.sum(c.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint")))
    return high * (1 << LOW_BITS) + low


def exact_sum(c: Column) -> Column:
    """Sum of money in units, the same for every order of the rows."""
    return sum_units(units(c))


def money(total: Column) -> Column:
    """Units back to a plain amount."""
    return total.cast("double") / F.lit(float(UNITS_PER_ONE))


def exact_avg(c: Column) -> Column:
    return F.try_divide(money(exact_sum(c)), F.count(c))


def safe_ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, round2(part / whole)).otherwise(0.0)
