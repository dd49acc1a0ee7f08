"""Small helpers for the tests."""

from chatloom.operators.shaping import apply_transform


def turns(*pairs):
    """Message rows from ``(role, content)`` pairs."""
    return [{"role": r, "content": c} for r, c in pairs]


def messages_of(spark, name, schema, rows, on_bad_row="fail"):
    """Output of a transform as lists of ``(role, content)``; None for a bad row."""
    df = spark.createDataFrame(rows, schema).coalesce(1)
    out = apply_transform(df, name, enforce_schema=True, on_bad_row=on_bad_row).collect()
    return [None if r.messages is None else [(m.role, m.content) for m in r.messages] for r in out]
