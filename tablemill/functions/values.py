"""Column clean-up on load, missing-value words, and the text form of values in CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The words a CSV field may hold to mean "missing".
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_STAMP = (T.TimestampType, T.TimestampNTZType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def missing_to_null(text: Column) -> Column:
    """NULL where the text is one of :data:`MISSING_WORDS`."""
    return F.when(~text.isin(*MISSING_WORDS), text)


def column_named(name: str) -> Column:
    """The column of exactly this name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_milliseconds(stamp: Column) -> Column:
    """Cut a timestamp to whole milliseconds, keeping its type.

    Subtracting the part below a millisecond needs no time zone, so a zone-less
    timestamp inside a daylight-saving gap stays as it is.
    """
    below = F.extract(F.lit("SECOND"), stamp) % F.lit(0.001).cast("decimal(4,3)")
    return stamp - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), below)


def for_loading(df: DataFrame) -> DataFrame:
    """The frame as it is stored: whole numbers BIGINT, floating ones DOUBLE with NaN as
    NULL, timestamps in milliseconds; every other type is stored natively."""
    return df.select(*loading_columns(df, df.columns))


def loading_columns(df: DataFrame, names: list[str]) -> list[Column]:
    """These columns of a frame as :func:`for_loading` stores them."""
    return [
        stored_value(column_named(field.name), field.dataType).alias(field.name)
        for field in df.schema.fields if field.name in names
    ]


def stored_value(value: Column, kind: T.DataType) -> Column:
    """A value of this type as :func:`for_loading` stores it."""
    if isinstance(kind, _WHOLE):
        return value.cast("bigint")
    if isinstance(kind, _FLOATING):
        return F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return to_milliseconds(value) if isinstance(kind, _STAMP) else value


def float_text(value: Column) -> Column:
    """A double as the shortest usual text: ``12345678.9``, ``1e-05``, ``1e+16``, ``inf``.

    Plain digits from 0.0001 up to 10**16, an exponent of at least two digits outside.
    """
    text = value.cast("string")
    size = F.abs(value)
    has_exponent = text.contains("E")
    digits = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(has_exponent, F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)).otherwise(text)
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    power_text = F.format_string("e%s%02d", F.when(power < 0, "-").otherwise("+"), F.abs(power))
    return (
        F.when(F.isnan(value), None)
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when((size == 0) | ((size >= 1e-4) & (size < 1e16)), plain)
        .otherwise(F.concat(mantissa, power_text))
    )


def csv_text(df: DataFrame) -> DataFrame:
    """Values as CSV text: ``True``/``False``, ``2026-01-01 00:00:01[.500000]``, floats as in
    :func:`float_text`, nested values as JSON, binary as base64.  Missing stays NULL."""
    def shown(field: T.StructField) -> Column:
        value = column_named(field.name)
        kind = field.dataType
        if isinstance(kind, T.BooleanType):
            value = F.when(value, "True").when(~value, "False")
        elif isinstance(kind, T.FloatType):
            # by way of text, so 0.1f is written 0.1 and not 0.10000000149011612
            value = float_text(value.cast("string").cast("double"))
        elif isinstance(kind, T.DoubleType):
            value = float_text(value)
        elif isinstance(kind, _STAMP):
            text = value.cast("string")
            value = F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
        elif isinstance(kind, T.BinaryType):
            value = F.base64(value)
        elif isinstance(kind, _NESTED) or kind.typeName() == "variant":
            value = F.to_json(value)
        return value.alias(field.name)

    return df.select(*[shown(field) for field in df.schema.fields])
