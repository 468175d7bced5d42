"""Scalar column expressions: cleaning, text flattening, clipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def to_number(col: Column) -> Column:
    """Numeric value of ``col``; anything unparsable (or NaN) becomes null."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def clean_price(col: Column) -> Column:
    """Digits and dots of a price as a double; null when nothing parsable is left."""
    kept = F.regexp_replace(col.cast("string"), "[^0-9.]", "")
    return F.when(kept != "", kept.try_cast("double"))


def _plain_text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col.cast("string"))
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


def flatten_text(col: Column, dtype: T.DataType) -> Column:
    """One string from a string, number, array, struct or map; null becomes ''.

    A struct or map with a ``name`` gives that name, any other container joins its
    non-null members with a space.
    """
    if isinstance(dtype, T.ArrayType):
        text = F.array_join(F.transform(col, lambda x: _plain_text(x, dtype.elementType)), " ")
    elif isinstance(dtype, T.StructType):
        members = [_plain_text(col.getField(f.name), f.dataType) for f in dtype.fields]
        text = F.when(col.isNotNull(), F.concat_ws(" ", *members))
        named = [f for f in dtype.fields if f.name == "name" and isinstance(f.dataType, T.StringType)]
        if named:
            text = F.coalesce(col.getField("name"), text)
    elif isinstance(dtype, T.MapType):
        values = F.transform(F.map_values(col), lambda x: _plain_text(x, dtype.valueType))
        text = F.array_join(values, " ")
        if isinstance(dtype.keyType, T.StringType) and isinstance(dtype.valueType, T.StringType):
            text = F.coalesce(F.try_element_at(col, F.lit("name")), text)
    else:
        text = _plain_text(col, dtype)
    return F.coalesce(text, F.lit(""))


def concat_text(df: DataFrame, text_columns: Sequence[str]) -> Column:
    """The present text columns joined by one space and trimmed, as one document."""
    present = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in text_columns if c in df.columns]
    return F.btrim(F.concat_ws(" ", *present), F.lit(WHITE_SPACE))


def array_count(col: Column) -> Column:
    """Number of elements; a null array has none."""
    return F.when(col.isNull(), F.lit(0)).otherwise(F.size(col))


def clip(col: Column, low: float, high: float) -> Column:
    """``col`` kept inside the rating scale."""
    return F.when(col.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), col)))
