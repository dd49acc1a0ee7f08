"""JSON text in Python's default spacing, printed from typed columns.

Tool calls are trained on as text, so the spacing (``", "`` and ``": "``) and the
number and string forms must match what ``json.dumps(..., ensure_ascii=False)``
prints. ``to_json`` prints without spaces; these functions follow the column's
type instead and stay native.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JSON string escapes.
_ESCAPES = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
            ("\b", "\\b"), ("\f", "\\f")]


def json_string(col: Column) -> Column:
    out = col
    for raw, escaped in _ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    rest = out
    for code in range(32):
        if chr(code) not in "\n\r\t\b\f":
            rest = F.replace(rest, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    out = F.when(F.rlike(col, F.lit(r"[\x00-\x07\x0b\x0e-\x1f]")), rest).otherwise(out)
    return F.concat(F.lit('"'), out, F.lit('"'))


def json_double(col: Column) -> Column:
    """Python's shortest float form: plain between 1e-4 and 1e16, else ``1.5e+16``."""
    plain = col.cast("string")
    mantissa = F.regexp_replace(F.substring_index(plain, "E", 1), r"\.0$", "")
    sign = F.when(F.startswith(mantissa, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(mantissa, r"[-.]", "")
    power = F.substring_index(plain, "E", -1).cast("int")
    wide = F.when(
        F.length(digits) <= power + 1, F.concat(F.rpad(digits, power + 1, "0"), F.lit(".0"))
    ).otherwise(
        F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."),
                 F.substring(digits, power + 2, F.length(digits)))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    scientific = F.concat(
        F.regexp_replace(mantissa, "^-", ""),
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(power).cast("string"),
    )
    shifted = F.when((power >= 0) & (power < 16), wide).when(
        (power < 0) & (power >= -4), small
    ).otherwise(scientific)
    return (
        F.when(F.isnan(col), F.lit("NaN"))
        .when(col == float("inf"), F.lit("Infinity"))
        .when(col == float("-inf"), F.lit("-Infinity"))
        .when(F.contains(plain, F.lit("E")), F.concat(sign, shifted))
        .otherwise(plain)
    )


def json_text(col: Column, dtype: T.DataType) -> Column:
    """*col* as JSON text; NULL prints as ``null``."""
    if isinstance(dtype, T.StringType):
        out = json_string(col)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        out = json_double(col.cast("double"))
    elif isinstance(dtype, T.ArrayType):
        out = F.concat(
            F.lit("["),
            F.array_join(F.transform(col, lambda x: json_text(x, dtype.elementType)), ", "),
            F.lit("]"),
        )
    elif isinstance(dtype, T.MapType):
        out = F.concat(
            F.lit("{"),
            F.array_join(
                F.transform(
                    F.map_entries(col),
                    lambda e: F.concat(
                        json_string(e["key"].cast("string")),
                        F.lit(": "),
                        json_text(e["value"], dtype.valueType),
                    ),
                ),
                ", ",
            ),
            F.lit("}"),
        )
    elif isinstance(dtype, T.StructType):
        parts = [
            F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ": "), json_text(col[f.name], f.dataType))
            for f in dtype.fields
        ]
        out = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    else:
        out = col.cast("string")
    return F.when(col.isNull(), F.lit("null")).otherwise(out)


def call_arguments(col: Column, dtype: T.DataType) -> Column:
    """``key=<json>, key=<json>`` for a struct, a map, or JSON text of an object."""
    if isinstance(dtype, T.StructType):
        parts = [
            F.concat(F.lit(f.name + "="), json_text(col[f.name], f.dataType)) for f in dtype.fields
        ]
        return F.concat_ws(", ", *parts)
    if isinstance(dtype, T.MapType):
        return F.array_join(
            F.transform(
                F.map_entries(col),
                lambda e: F.concat(e["key"].cast("string"), F.lit("="), json_text(e["value"], dtype.valueType)),
            ),
            ", ",
        )
    if isinstance(dtype, T.StringType):
        raise TypeError("call arguments as JSON text: run parse_call_arguments(df) first")
    raise TypeError(f"Unsupported type for call arguments: {dtype.simpleString()}")
