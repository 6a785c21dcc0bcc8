"""Column functions for lenient text cleaning. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.fixed import POSTED_FORMAT, TRUE_TOKENS, WHITESPACE

# A decimal number with optional exponent, or one of the IEEE names. Guards the
# cast, which would also take Java forms such as 1.0d.
NUMBER = r"^(?i:[+-]?(?:\d++(?:\.\d*+)?+|\.\d++)(?:e[+-]?\d++)?+|nan|[+-]?inf(?:inity)?)\z"


# Text that begins and ends with printable ASCII other than the space, so with no white space.
BARE = r"^[!-~](?:(?s:.*)[!-~])?\z"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (trim alone removes only spaces).

    A trim that is given its characters searches them for each end and notes every character's place. So
    it is left out where spaces were all there was to remove.
    """
    spaceless = F.trim(text)
    return F.when(spaceless.rlike(BARE), spaceless).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def truth(text: Column) -> Column:
    """True for the accepted tokens, false for other text, null for null or blank."""
    return F.lower(blank_to_null(strip(text))).isin(TRUE_TOKENS)


def utc_timestamp(text: Column) -> Column:
    """Wall clock text taken as UTC, whatever the session zone; null if it does not fit."""
    return F.when(text.rlike(POSTED_FORMAT), F.concat(text, F.lit("Z"))).try_cast("timestamp")


def utc_wall_clock(instant: Column) -> Column:
    """The UTC wall clock of a timestamp, as timestamp_ntz, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def number(text: Column) -> Column:
    """Text as double, null if it is not a number."""
    return F.when(text.rlike(NUMBER), text).try_cast("double")


def normal_name(text: Column) -> Column:
    """Skill and group names compare stripped and in lower case."""
    return F.lower(strip(text))
