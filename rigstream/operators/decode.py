"""Decode JSON messages into typed columns, keeping what cannot be decoded apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rigstream.functions.text import is_blank, parsed_double

CORRUPT = "_corrupt"
ERROR = "decode_error"


def computed_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a costly column so that it is computed once per row.

    As a plain column the optimizer would copy the expression into every later filter that uses
    it. A generator's output is not copied; this one yields exactly one row per row.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(expression)).alias(name))


def bound(expression: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``expression`` with the expression evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(expression), body), F.lit(0))


def non_empty(df: DataFrame, value: str = "value") -> DataFrame:
    return df.where(F.length(value) > 0)


def non_blank(df: DataFrame, value: str = "value") -> DataFrame:
    return df.where(~is_blank(F.col(value)))


def non_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def decode_record(
    df: DataFrame, fields: dict[str, str], value: str = "value", zero_missing: bool = False
) -> DataFrame:
    """Add the typed ``fields`` of a JSON object, and ``decode_error``: null when all is well.

    Every field is read as text and then converted, since numbers may be quoted.
    Unknown fields are ignored. With ``zero_missing`` an absent number becomes 0.
    """
    layout = ", ".join(f"`{name}` string" for name in (*fields, CORRUPT))
    raw = F.from_json(value, layout, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = computed_once(df, "_raw", raw)

    def cast(text: Column, kind: str) -> Column:
        return parsed_double(text) if kind == "double" else text.try_cast(kind)

    def typed(name: str, kind: str) -> Column:
        text = F.col("_raw").getField(name)
        if kind == "string":
            return text
        number = cast(text, kind)
        if zero_missing:
            number = F.when(text.isNull(), F.lit(0).cast(kind)).otherwise(number)
        return number

    broken = F.when(
        F.col("_raw").isNull() | F.col("_raw").getField(CORRUPT).isNotNull(), F.lit("not a JSON object")
    )
    for name, kind in fields.items():
        if kind != "string":
            text = F.col("_raw").getField(name)
            broken = broken.when(
                text.isNotNull() & cast(text, kind).isNull(), F.lit(f"{name} is not a number")
            )
    columns = {name: typed(name, kind) for name, kind in fields.items()}
    return parsed.withColumns({**columns, ERROR: broken}).drop("_raw")


def decoded(df: DataFrame) -> DataFrame:
    """The rows that decoded."""
    return df.where(F.col(ERROR).isNull()).drop(ERROR)


def quarantined(df: DataFrame, value: str = "value") -> DataFrame:
    """The rows that did not, with their text and the reason."""
    return df.where(F.col(ERROR).isNotNull()).select(value, ERROR)


def last_wins(entries: Column) -> Column:
    """A map from key/value entries in which a repeated key keeps its last value."""

    def without_earlier(entries: Column) -> Column:
        return F.filter(
            entries,
            lambda entry, at: ~F.exists(
                F.slice(entries, at + 2, F.size(entries)), lambda later: later["key"] == entry["key"]
            ),
        )

    def unique(entries: Column) -> Column:
        keys = F.transform(entries, lambda entry: entry["key"])
        repeats = F.size(F.array_distinct(keys)) < F.size(entries)
        return F.map_from_entries(F.when(repeats, without_earlier(entries)).otherwise(entries))

    return bound(entries, unique)


def decode_map(df: DataFrame, value: str = "value", into: str = "fields") -> DataFrame:
    """Add the message as ``map<string,string>``; text that is no JSON object gives an empty map."""

    def settled(parsed: Column) -> Column:
        unique = F.size(F.array_distinct(F.map_keys(parsed))) == F.size(parsed)
        empty = F.create_map().cast("map<string,string>")
        return F.when(parsed.isNull(), empty).when(unique, parsed).otherwise(last_wins(F.map_entries(parsed)))

    return computed_once(df, into, bound(F.from_json(value, "map<string,string>"), settled))


def non_empty_map(df: DataFrame, column: str = "fields") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.size(column) > 0))


def has_shared_well(df: DataFrame, key: str, column: str = "fields") -> DataFrame:
    """Keep records that carry the shared well-name key."""
    return df.where(F.element_at(column, key).isNotNull())


def tank_series(df: DataFrame, tank: str | None = None) -> DataFrame:
    """The (tankId, ts, waterTankLevel) triple, optionally of one tank."""
    rows = df.select("tankId", "ts", "waterTankLevel")
    return rows if tank is None else rows.where(F.col("tankId") == tank)


def as_text_line(df: DataFrame, *columns: str, into: str = "rec") -> DataFrame:
    """The columns joined by commas."""
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias(into))
