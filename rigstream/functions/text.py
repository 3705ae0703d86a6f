"""Text, number and time conversions used by the reshape operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# characters that count as blank at the ends of a message: U+0000 to U+0020
BLANKS = "".join(chr(code) for code in range(0x21))
# numbers: decimal ones, hexadecimal ones, and the special values in their one spelling
MAYBE_NUMBER = (
    r"^[\x00-\x20]*[-+]?((\d+\.?\d*|\.\d+)([eE][-+]?\d+)?[dDfF]?|0[xX][0-9a-fA-F.]+[pP][-+]?\d+[dDfF]?|NaN|Infinity)[\x00-\x20]*$"
)
LOAD_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# the calendar repeats after 400 years
CYCLE_YEARS, CYCLE_MILLIS = 400, 146_097 * 86_400_000
DEPTH_WIDTH = 10
DEFAULT_MESSAGE_LOG = "Log #messages_time"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return text.isNull() | (trimmed(text) == "")


def parsed_double(text: Column) -> Column:
    """The number in ``text``, or null; of the special values only ``NaN`` and ``Infinity``.

    Other text is screened first, as a cast that fails is slow.
    """
    return F.when(text.rlike(MAYBE_NUMBER), text.try_cast("double"))


def lenient_double(text: Column) -> Column:
    """The number in ``text``, or 0.0 when there is none."""
    return F.coalesce(parsed_double(text), F.lit(0.0))


def blank_or_double(text: Column) -> Column:
    """0.0 for missing or empty text, else the number; null marks text that is no number."""
    return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(parsed_double(text))


def text_or(text: Column, default: str = "") -> Column:
    return F.coalesce(text, F.lit(default))


def message_log_name(text: Column) -> Column:
    return F.when(is_blank(text), F.lit(DEFAULT_MESSAGE_LOG)).otherwise(text)


def depth_string(depth: Column) -> Column:
    """Zero-pad short depths so that they sort as text; longer ones stay whole."""
    return F.when(F.length(depth) < DEPTH_WIDTH, F.lpad(depth, DEPTH_WIDTH, "0")).otherwise(depth)


def event_time(millis: Column) -> Column:
    """Epoch milliseconds as ISO text in UTC, whatever the session zone; other text is passed through.

    Years have four digits or more; those before the year 1 are counted backwards, as years of their era.
    The day is looked up in the first 400 years since 1970, so that any number of milliseconds has one.
    """
    number = millis.try_cast("bigint")
    inside = F.pmod(number, F.lit(CYCLE_MILLIS))
    cycles = F.call_function("div", F.try_subtract(number, inside), F.lit(CYCLE_MILLIS))
    moment = F.timestamp_add("SECOND", F.floor(inside / 1000), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    text = F.replace(moment.cast("string"), F.lit(" "), F.lit("T"))
    far = F.year(moment) + CYCLE_YEARS * cycles
    era_year = F.when(far > 0, far).otherwise(1 - far).cast("string")
    year = F.when(cycles == 0, F.left(text, F.lit(4))).when(F.length(era_year) < 4, F.lpad(era_year, 4, "0")).otherwise(era_year)
    return F.coalesce(F.concat(year, F.substring(text, 5, 15), F.lit("Z")), millis)


def load_time(as_of: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if as_of is None else as_of, LOAD_TIME_FORMAT)


def is_reserved(key: Column, reserved: tuple[str, ...]) -> Column:
    return key.isin(*reserved)


def epoch_millis(stamp_ntz: Column) -> Column:
    """Milliseconds of a zone-free timestamp since 1970, whatever the session zone."""
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_diff("MILLISECOND", origin, stamp_ntz)
