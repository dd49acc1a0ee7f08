"""Small column helpers shared by every operator.

Everything here is a ``Column -> Column`` function built from Spark SQL
functions, so it stays inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that Python's str.strip() and str.split() treat as white space.
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
) + "\u2028\u2029\u202f\u205f\u3000"
# The same as a Java class. Latin-1 characters stand one by one (a table look-up), the others
# behind one range test, so that most characters of a text cost two steps.
SPACE = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0[\x{1680}-\x{3000}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"
)

# Number of buckets that the first four hex digits of an md5 give.
HASH_BUCKETS = 65536


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate *value* once and use it any number of times inside *body*.

    A one-element ``transform`` binds the value to a lambda variable. Without it
    the optimizer may inline the expression at every use, also inside lambdas,
    where it would run once per array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan_states(
    items: Column,
    start: Column,
    step: Callable[[Column, Column], Column],
    chunk: int = 256,
) -> Column:
    """Fold *items* and keep the state **before** each item, plus the last state.

    Returns ``array<state>`` with ``size(items) + 1`` entries. Appending to one
    array per item would copy it every time, so the fold runs over chunks:
    cost is ``n * chunk`` small copies instead of ``n * n``.
    """

    def run_chunk(acc: Column, part: Column) -> Column:
        inner = F.aggregate(
            part,
            F.struct(acc["state"].alias("state"), F.slice(F.array(acc["state"]), 1, 0).alias("seen")),
            lambda a, x: F.struct(
                step(a["state"], x).alias("state"),
                F.concat(a["seen"], F.array(a["state"])).alias("seen"),
            ),
        )
        return let(
            inner,
            lambda r: F.struct(
                r["state"].alias("state"),
                F.concat(acc["chunks"], F.array(r["seen"])).alias("chunks"),
            ),
        )

    def over(xs: Column) -> Column:
        last_chunk = F.expr("int(0)") + F.floor((F.size(xs) - 1) / F.lit(chunk)).cast("int")
        parts = F.when(
            F.size(xs) > 0,
            F.transform(F.sequence(F.lit(0), last_chunk), lambda c: F.slice(xs, c * chunk + 1, chunk)),
        ).otherwise(F.slice(F.array(xs), 1, 0))
        zero = F.struct(
            start.alias("state"),
            F.slice(F.array(F.array(start)), 1, 0).alias("chunks"),
        )
        return F.aggregate(
            parts,
            zero,
            run_chunk,
            lambda acc: F.concat(F.flatten(acc["chunks"]), F.array(acc["state"])),
        )

    return let(items, over)


def join_all(texts: Column, separator: str) -> Column:
    """``array_join`` that gives NULL, not a shorter text, when a piece is NULL."""
    return let(
        texts,
        lambda t: F.when(~F.exists(t, lambda x: x.isNull()), F.array_join(t, separator)),
    )


def truthy(col: Column, dtype: T.DataType) -> Column:
    """Python truth value of a column; NULL is false."""
    if isinstance(dtype, T.BooleanType):
        test = col
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        test = F.length(col) > 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        test = F.size(col) > 0
    elif isinstance(dtype, T.NumericType):
        test = col != 0
    elif isinstance(dtype, T.NullType):
        return F.lit(False)
    else:
        test = col.isNotNull()
    return F.coalesce(test, F.lit(False))


def py_strip(col: Column) -> Column:
    """``str.strip()``: removes all Unicode white space at both ends."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def words(col: Column) -> Column:
    """``str.split()``: the white-space separated pieces of a text."""
    return F.filter(F.split(col, f"{SPACE}+"), lambda w: w != "")


def word_count(col: Column) -> Column:
    """Number of :func:`words`, without building the array: gaps of the stripped text plus one."""
    return let(
        py_strip(col), lambda t: F.when(t == "", 0).otherwise(F.regexp_count(t, F.lit(f"{SPACE}+")) + 1)
    )


def order_hash(*parts: Column | str | int) -> Column:
    """md5 of ``part:part:...``; the repeatable random order of the library."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def hash_bucket(md5_hex: Column) -> Column:
    """Bucket 0..65535 from the first four hex digits; keeps the hash's order."""
    return F.conv(F.substring(md5_hex, 1, 4), 16, 10).cast("int")


def fail_when(cond: Column, message: str, value: Column, on_bad_row: str = "fail") -> Column:
    """*value*, unless *cond* holds: then raise, or give NULL with ``'drop'``.

    A NULL result marks a bad row; the callers count and drop it.
    """
    if on_bad_row == "drop":
        return F.when(F.coalesce(cond, F.lit(False)), F.lit(None)).otherwise(value)
    return F.when(F.coalesce(cond, F.lit(False)), F.raise_error(F.lit(message))).otherwise(value)


def check_policy(on_bad_row: str) -> str:
    if on_bad_row not in ("fail", "drop"):
        raise ValueError(f"on_bad_row must be 'fail' or 'drop', got '{on_bad_row}'.")
    return on_bad_row
