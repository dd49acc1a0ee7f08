"""The ``apertus`` template: turns with inner blocks, and state carried across turns.

A chat becomes a flat list of *items* (a user turn, the start of an assistant turn, a
block, a tool result). Which brackets an item opens or closes depends only on a few
flags left by the items before it; :func:`scan_states` computes those flags, then each
item prints itself. All of it is column expressions.

Content is either text, or a struct with ``text`` (system), ``parts`` (user) or ``blocks``
(assistant).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.basics import join_all, let, scan_states
from chatloom.operators.templates import RenderOptions, Template, Turns, register_template
from chatloom.operators.tool_signatures import tool_signatures

# Control tokens and the default system text.
SYSTEM, END_SYSTEM = "<|system_start|>", "<|system_end|>"
DEVELOPER, END_DEVELOPER = "<|developer_start|>", "<|developer_end|>"
USER, END_USER = "<|user_start|>", "<|user_end|>"
ASSISTANT, END_ASSISTANT = "<|assistant_start|>", "<|assistant_end|>"
INNER, OUTER = "<|inner_prefix|>", "<|inner_suffix|>"
CALLS, END_CALLS = "<|tools_prefix|>", "<|tools_suffix|>"
IMAGE = "<|image|>"
DEFAULT_SYSTEM = (
    "You are Apertus, a helpful assistant created by the SwissAI initiative.\n"
    "Knowledge cutoff: 2024-04\nCurrent date: "
)
# Name of the call that shows the answer and so ends the inner part.
ANSWER_CALL = "display_answers"

ITEM_TYPE = "array<struct<kind:string,text:string,first:boolean,answers:boolean,turn:int>>"
_USER, _START, _STRING, _THOUGHTS, _CALLS, _OUTPUTS, _RESPONSE, _TURN_CALLS, _TOOL, _BAD = (
    "user", "start", "string", "thoughts", "tool_calls", "tool_outputs", "response",
    "turn_calls", "tool", "bad",
)


def _item(kind: Column | str, text: Column, turn: Column, first=None, answers=None) -> Column:
    return F.struct(
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        text.alias("text"),
        (F.lit(False) if first is None else first).alias("first"),
        (F.lit(False) if answers is None else answers).alias("answers"),
        turn.cast("int").alias("turn"),
    )


def _items_of(*items: Column) -> Column:
    return F.array(*items).cast(ITEM_TYPE)


def _call_list(calls: Column, name, arguments) -> Column:
    printed = F.transform(
        calls, lambda c: F.concat(F.lit('{"'), name(c), F.lit('": '), arguments(c), F.lit("}"))
    )
    return F.concat(F.lit(CALLS + "["), join_all(printed, ", "), F.lit("]" + END_CALLS))


def _content_fields(turns: Turns) -> set[str]:
    kind = turns.type_of("content")
    return set(kind.fieldNames()) if isinstance(kind, T.StructType) else set()


def _is_text(turns: Turns) -> bool:
    return isinstance(turns.type_of("content"), T.StringType)


def _user_items(turns: Turns, m: Column, i: Column) -> Column:
    if not turns.has("content"):
        return _items_of(_item(_USER, F.lit(""), i))
    if _is_text(turns):
        inner = m["content"]
    elif "parts" in _content_fields(turns):
        inner = F.aggregate(
            F.transform(
                m["content"]["parts"],
                lambda p: F.when(p["type"] == "text", p["text"]).when(p["type"] == "image", F.lit(IMAGE)),
            ),
            F.lit(""),
            lambda acc, p: F.concat(acc, p),
        )
    else:
        inner = F.lit(None).cast("string")
    return F.when(
        inner.isNotNull(), _items_of(_item(_USER, F.concat(F.lit(USER), inner, F.lit(END_USER)), i))
    ).otherwise(_items_of(_item(_BAD, F.lit(""), i)))


def _block_items(turns: Turns, m: Column, i: Column) -> Column:
    blocks = turns.type_of("content")["blocks"].dataType.elementType
    names = set(blocks.fieldNames())
    none = F.lit(None).cast("string")

    def one(b: Column, k: Column) -> Column:
        calls, answers, outputs = none, F.lit(False), none
        if "calls" in names:
            calls = _call_list(b["calls"], lambda c: c["name"], lambda c: c["arguments"])
            only = (F.size(b["calls"]) == 1) & (F.get(b["calls"], F.lit(0))["name"] == ANSWER_CALL)
            answers = F.coalesce(only, F.lit(False))
        if "outputs" in names:
            shown = F.transform(b["outputs"], lambda o: F.coalesce(o["output"], F.lit("None")))
            outputs = F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))
        text = (
            F.when(b["type"] == _CALLS, calls)
            .when(b["type"] == _OUTPUTS, outputs)
            .when(b["type"].isin(_THOUGHTS, _RESPONSE), b["text"] if "text" in names else none)
        )
        return _item(F.when(text.isNotNull(), b["type"]).otherwise(_BAD), text, i, k == 0, answers)

    return F.coalesce(
        F.transform(m["content"]["blocks"], one).cast(ITEM_TYPE),
        _items_of(_item(_BAD, F.lit(""), i)),
    )


def _assistant_items(turns: Turns, m: Column, i: Column) -> Column:
    bad = _items_of(_item(_BAD, F.lit(""), i))
    if not turns.has("content"):
        return bad
    if _is_text(turns):
        content = F.when(m["content"].isNotNull(), _items_of(_item(_STRING, m["content"], i))).otherwise(bad)
    elif "blocks" in _content_fields(turns):
        content = _block_items(turns, m, i)
    else:
        content = bad
    parts = [_items_of(_item(_START, F.lit(""), i)), content]
    if turns.has("tool_calls"):
        calls = m["tool_calls"]
        if "type" in turns.type_of("tool_calls").elementType.fieldNames():
            broken = F.exists(calls, lambda c: ~c["type"].eqNullSafe("function"))
        else:
            broken = F.lit(True)
        text = _call_list(calls, lambda c: c["function"]["name"], lambda c: c["function"]["arguments"])
        parts.append(
            F.when(
                F.size(calls) > 0,
                F.when(broken, bad).otherwise(_items_of(_item(_TURN_CALLS, text, i))),
            ).otherwise(F.array().cast(ITEM_TYPE))
        )
    return F.concat(*parts)


def _tool_items(turns: Turns, m: Column, i: Column) -> Column:
    if not turns.has("content"):
        return _items_of(_item(_TOOL, F.lit(""), i))
    if _is_text(turns):
        text = F.coalesce(m["content"], F.lit("None"))
    elif "text" in _content_fields(turns):
        text = m["content"]["text"]
    else:
        text = F.lit(None).cast("string")
    return F.when(text.isNotNull(), _items_of(_item(_TOOL, text, i))).otherwise(
        _items_of(_item(_BAD, F.lit(""), i))
    )


def _items(turns: Turns) -> Column:
    """All items after an opening system turn."""

    def one(m: Column, i: Column) -> Column:
        opening = (i == 0) & m["role"].eqNullSafe("system")
        return (
            F.when(opening, F.array().cast(ITEM_TYPE))
            .when(m["role"] == "user", _user_items(turns, m, i))
            .when(m["role"] == "assistant", _assistant_items(turns, m, i))
            .when(m["role"] == "tool", _tool_items(turns, m, i))
            .otherwise(_items_of(_item(_BAD, F.lit(""), i)))
        )

    return F.flatten(F.transform(turns.column, one))


def _flags(assistant: Column, tool: Column, inner: Column, waiting: Column) -> Column:
    return F.struct(
        assistant.alias("assistant"), tool.alias("tool"), inner.alias("inner"), waiting.alias("waiting")
    )


def _ends_inner(before: Column, item: Column) -> Column:
    """Does this item close an open inner part?"""
    shows_answer = (item["kind"] == _CALLS) & ~item["first"] & item["answers"]
    return before["inner"] & (shows_answer | (item["kind"] == _RESPONSE))


def _next_flags(before: Column, item: Column) -> Column:
    kind = item["kind"]
    keeps_tool_open = kind.isin(_START, _TURN_CALLS, _OUTPUTS)
    return _flags(
        assistant=(before["assistant"] | (kind == _START)) & (kind != _USER),
        tool=(kind == _TOOL) | (before["tool"] & keeps_tool_open),
        inner=(kind == _THOUGHTS) | (before["inner"] & (kind != _USER) & ~_ends_inner(before, item)),
        waiting=kind.isin(_CALLS, _TURN_CALLS) | (before["waiting"] & ~kind.isin(_OUTPUTS, _TOOL)),
    )


def _printed(before: Column, item: Column) -> Column:
    """An item's text with the brackets that it opens and closes; NULL where it must not stand."""
    kind = item["kind"]

    def when(cond: Column, text: str) -> Column:
        return F.when(cond, F.lit(text)).otherwise(F.lit(""))

    misplaced = (
        (kind == _BAD)
        | ((kind == _TOOL) & ~before["assistant"])
        | ((kind == _OUTPUTS) & before["tool"])
    )
    closes_tool = before["tool"] & kind.isin(_USER, _STRING, _THOUGHTS, _CALLS, _RESPONSE)
    return F.concat(
        when(closes_tool, "]"),
        when((kind == _USER) & before["assistant"], END_ASSISTANT),
        when((kind == _START) & ~before["assistant"], ASSISTANT),
        when((kind == _THOUGHTS) & ~before["inner"], INNER),
        when(_ends_inner(before, item), OUTER),
        F.when(kind == _TOOL, F.when(before["tool"], F.lit(", ")).otherwise(F.lit("["))).otherwise(F.lit("")),
        F.when(~misplaced, item["text"]),
    )


def _states(items: Column) -> Column:
    start = _flags(*[F.lit(False)] * 4)
    return scan_states(items, start, _next_flags)


def _system_text(turns: Turns) -> Column:
    first = F.get(turns.column, F.lit(0))
    if not turns.has("content"):
        return F.lit(None).cast("string")
    if _is_text(turns):
        return first["content"]
    return first["content"]["text"] if "text" in _content_fields(turns) else F.lit(None).cast("string")


def _opens_with_system(turns: Turns) -> Column:
    return F.coalesce(F.get(turns.column, F.lit(0))["role"] == "system", F.lit(False))


def _segments(turns: Turns, options: RenderOptions) -> Column:
    if options.current_date is None:
        raise ValueError("The template prints a date: set RenderOptions.current_date ('YYYY-MM-DD').")
    system = F.when(_opens_with_system(turns), _system_text(turns)).otherwise(
        F.lit(DEFAULT_SYSTEM + options.current_date)
    )
    deliberation = "enabled" if options.enable_thinking else "disabled"
    tools = F.when(turns.has_tools, F.concat(F.lit("\n"), turns.tools_text)).otherwise(F.lit(" disabled"))
    head = F.concat(
        F.lit(options.bos + SYSTEM),
        system,
        F.lit(f"{END_SYSTEM}{DEVELOPER}Deliberation: {deliberation}\nTool Capabilities:"),
        tools,
        F.lit(END_DEVELOPER),
    )

    def segment(text: Column, turn: Column) -> Column:
        return F.struct(text.alias("text"), F.lit(False).alias("train"), turn.alias("turn"))

    def body(bound: Column) -> Column:
        items, states = bound["items"], bound["states"]
        last = F.element_at(states, -1)
        closing = F.when(last["tool"], F.lit("]")).otherwise(F.lit(""))
        if not options.continue_assistant_message:
            done = last["assistant"] & ~last["waiting"]
            closing = F.concat(closing, F.when(done, F.lit(END_ASSISTANT)).otherwise(F.lit("")))
        if options.add_generation_prompt:
            closing = F.concat(closing, F.lit(ASSISTANT))
        shown = F.transform(
            items, lambda item, k: segment(_printed(F.get(states, k), item), item["turn"])
        )
        return F.concat(
            F.array(segment(head, F.lit(-1))), shown, F.array(segment(closing, F.size(turns.column)))
        )

    pair = let(_items(turns), lambda x: F.struct(x.alias("items"), _states(x).alias("states")))
    return let(pair, body)


register_template(Template("apertus", _segments, print_tools=tool_signatures))
