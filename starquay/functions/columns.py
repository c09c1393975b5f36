"""Scalar column expressions. All are built-in functions, so they stay inside
whole-stage code generation; none raises on bad input under ANSI mode."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    IntegralType,
    NumericType,
    StringType,
    StructType,
)

# Fixed value: day number 0 of the raw arrival dates.
DAY_ZERO = datetime.date(1960, 1, 1)


def named(name: str) -> Column:
    """The column of that exact name, blanks and dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def day_number_to_date(days: Column) -> Column:
    """Days since 1960-01-01 as a date; a fraction counts downward.

    NULL for NULL, NaN and text that is not a number. NaN needs its own guard:
    ``floor`` turns it into 0, which would be a valid day.
    """
    number = days.try_cast("double")
    whole = F.floor(F.nanvl(number, F.lit(None).cast("double"))).try_cast("int")
    return F.date_add(F.lit(DAY_ZERO), whole)


def to_integer(column: Column) -> Column:
    """Numeric text or number as INT, fraction cut off; NULL if it is neither."""
    return column.try_cast("double").try_cast("int")


def convert(column: Column, source: DataType, target: DataType) -> Column:
    """``column`` of type ``source`` as ``target``; NULL where that is impossible.

    ``33.8`` in a text column becomes 33, and long whole numbers in text keep all
    digits. A number that becomes a date is a day number.
    """
    if source == target:
        return column
    if isinstance(target, IntegralType) and isinstance(source, StringType):
        # No text with a point is a whole number, and a cast that fails is dear: Spark raises
        # and catches an error for each.
        whole = F.when(~column.contains("."), column.try_cast(target))
        return F.coalesce(whole, column.try_cast("double").try_cast(target))
    if isinstance(target, DateType) and isinstance(source, NumericType):
        return day_number_to_date(column)
    return column.try_cast(target)


def cast_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, in its order and with its types, in one select.

    Raises if ``df`` lacks one of them; other columns are left out.
    """
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the cast: {missing}")
    return df.select(
        *(
            convert(named(field.name), df.schema[field.name].dataType, field.dataType).alias(
                field.name
            )
            for field in schema
        )
    )


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """New names for the leading columns; the rest keep theirs, spare names are
    ignored. Prefer ``withColumnsRenamed``, which cannot swap columns."""
    used = list(names)[: len(df.columns)]
    return df.toDF(*used, *df.columns[len(used) :])


def missing_flag(column: Column) -> Column:
    """1 for NULL, else 0. NaN is a value."""
    return column.isNull().cast("int")


def percent_of(part: Column, total: Column) -> Column:
    """``part / total * 100``; NULL when there is nothing to divide by."""
    return F.when(total != 0, part / total * 100)


def text_before_comma(column: Column) -> Column:
    return F.trim(F.split_part(column, F.lit(","), F.lit(1)))


def unquote(body: Column) -> Column:
    """Body of a quoted label: doubled quotes made single, padding removed."""
    return F.trim(F.replace(body, F.lit("''"), F.lit("'")))
