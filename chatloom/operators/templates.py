"""Chat templates: render ``messages`` to text, with the spans that are trained on.

A template gives, per chat, ``segments: array<struct<text, train, turn>>``. The text
is their concatenation; ``train`` marks what the loss covers. A template is a small
object with two column functions, so rendering is one native projection.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.basics import check_policy, fail_when, join_all, let
from chatloom.functions.pyjson import call_arguments
from chatloom.operators.registry import Registry

SEGMENT_TYPE = "array<struct<text:string,train:boolean,turn:int>>"


@dataclass(frozen=True)
class RenderOptions:
    """What a chat does not carry itself.

    *tools* is one tool list for all chats; *tools_column* names a column with a JSON list per chat.
    """

    eos: str = "<|im_end|>"
    bos: str = ""
    add_generation_prompt: bool = False
    tools: Sequence[dict] | None = None
    tools_column: str | None = None
    current_date: str | None = None
    enable_thinking: bool = False
    continue_assistant_message: bool = False


@dataclass(frozen=True)
class Turns:
    """The message column with its element type, and the printed tool list.

    ``tools_text`` is NULL when no list is given; ``has_tools`` tells a list with entries. ``call_texts`` and
    ``other_calls`` hold, by turn and call, what was printed ahead of the template.
    """

    column: Column
    element: T.StructType
    call_texts: Column | None = None
    tools_text: Column | None = None
    has_tools: Column | None = None
    other_calls: Column | None = None

    def has(self, name: str) -> bool:
        return name in self.element.fieldNames()

    def type_of(self, name: str) -> T.DataType:
        return self.element[name].dataType


@dataclass(frozen=True)
class Template:
    """``segments(turns, options)`` is a column; a NULL text in it marks a chat that cannot be rendered.

    *source* is the text of a user's own template file, if there is one; it only serves
    the marker test.
    """

    name: str
    segments: Callable[[Turns, RenderOptions], Column]
    trainable: bool = False
    source: str | None = field(default=None, repr=False)
    prints_arguments: bool = False
    print_tools: Callable[[Sequence[dict]], str] | None = None


_TEMPLATES: Registry[Template] = Registry("chat template", replace=True)

# Markers around the trained part of a template text, with or without dashes.
_MARKERS = [re.compile(rf"\{{%-?\s*{word}\s*-?%\}}") for word in ("generation", "endgeneration")]


def register_template(template: Template) -> None:
    """Add a template; one of the same name is replaced, with a warning."""
    _TEMPLATES.add(template.name, template)


def get_template(name: str) -> Template:
    return _TEMPLATES.get(name)


def has_generation_markers(template: Template | str | None) -> bool:
    """Does a template say which text is trained on? Takes a template or a template text."""
    if isinstance(template, Template):
        if template.source is None:
            return template.trainable
        template = template.source
    return all(marker.search(template or "") for marker in _MARKERS)


def require_markers(name: str) -> Template:
    """The template, or an error when supervised preparation could not mask with it."""
    template = get_template(name)
    if not has_generation_markers(template):
        trainable = [t.name for t in _TEMPLATES.values() if has_generation_markers(t)]
        raise ValueError(
            f"Chat template '{name}' does not mark the assistant's text, so every token would be "
            f"trained on. Use one of {trainable}, or register a template with markers."
        )
    return template


# -- rendering ------------------------------------------------------------------


def render_segments(
    df: DataFrame,
    template: str | Template,
    options: RenderOptions | None = None,
    on_bad_row: str = "fail",
    messages: str = "messages",
) -> DataFrame:
    """Add ``segments``. Chats that the template cannot render fail the job or, with ``'drop'``, go.

    With ``'null'`` they stay and have no segments, so that a preview can say so.
    """
    if on_bad_row != "null":
        check_policy(on_bad_row)
    template = get_template(template) if isinstance(template, str) else template
    options = options or RenderOptions()
    element = df.schema[messages].dataType.elementType
    call_texts = other_calls = None
    if template.prints_arguments:
        df, call_texts = _with_call_texts(df, messages, element)
        df, other_calls = _with_other_calls(df, messages, element)
    df, tools_text, has_tools = _with_tools(df, template, options)
    turns = Turns(F.col(messages), element, call_texts, tools_text, has_tools, other_calls)
    segments = template.segments(turns, options).cast(SEGMENT_TYPE)

    def broken(built: Column) -> Column:
        return F.coalesce(built.isNull() | F.exists(built, lambda s: s["text"].isNull()), F.lit(True))

    if on_bad_row == "drop":
        # One-element explode, not a filter: see shaping.sft_filter.
        good = F.filter(F.array(segments), lambda built: ~broken(built))
        out = df.select("*", F.explode(good).alias("segments"))
    elif on_bad_row == "null":
        out = df.withColumn("segments", let(segments, lambda built: F.when(~broken(built), built)))
    else:
        message = f"a chat cannot be rendered with template '{template.name}'"
        out = df.withColumn(
            "segments", let(segments, lambda built: fail_when(broken(built), message, built))
        )
    return out.drop("_call_texts", "_other_calls", "_tools")


def segments_text(segments: Column | str = "segments") -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def render(
    df: DataFrame,
    template: str | Template,
    options: RenderOptions | None = None,
    on_bad_row: str = "fail",
    messages: str = "messages",
) -> DataFrame:
    """Add ``text``, the rendered chat."""
    out = render_segments(df, template, options, on_bad_row, messages)
    return out.withColumn("text", segments_text()).drop("segments")


def train_last_turn_only(segments: Column) -> Column:
    """``mask_history``: only the last trained turn keeps its ``train`` flag."""
    last = F.array_max(F.transform(F.filter(segments, lambda s: s["train"]), lambda s: s["turn"]))
    return let(
        last,
        lambda last_turn: F.transform(
            segments,
            lambda s: F.struct(
                s["text"].alias("text"),
                (s["train"] & (s["turn"] == last_turn)).alias("train"),
                s["turn"].alias("turn"),
            ),
        ),
    )


# -- pieces -----------------------------------------------------------------------


def _segment(text: Column, turn: Column, train: bool = False) -> Column:
    return F.struct(text.alias("text"), F.lit(train).alias("train"), turn.cast("int").alias("turn"))


def _lit_segment(text: str, turn: Column) -> Column:
    return _segment(F.lit(text), turn)


def _single(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _per_turn(turns: Turns, one: Callable[[Column, Column], Column]) -> Column:
    return F.flatten(F.transform(turns.column, one))


def _empty() -> Column:
    return F.array().cast(SEGMENT_TYPE)


def _framed(before: Column | None, body: Column, prompt: str | None, turns: Turns) -> Column:
    """Optional opening segment, the turns, and the optional prompt; an empty chat stays empty."""
    parts = [p for p in (before, body) if p is not None]
    if prompt is not None:
        tail = F.array(_lit_segment(prompt, F.size(turns.column)))
        parts.append(F.when(F.size(turns.column) > 0, tail).otherwise(_empty()))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _optional(turns: Turns, m: Column, name: str, wrap: Callable[[Column], Column], other: Column | str) -> Column:
    """``wrap(m.name)`` if the field exists and is set, else *other*."""
    other = F.lit(other) if isinstance(other, str) else other
    if not turns.has(name):
        return other
    return F.when(m[name].isNotNull(), wrap(m[name])).otherwise(other)


# -- chatml -----------------------------------------------------------------------


def _chatml(turns: Turns, options: RenderOptions) -> Column:
    def one(m: Column, i: Column) -> Column:
        role = F.coalesce(m["role"], F.lit("None"))
        content = F.coalesce(m["content"], F.lit("None"))
        return F.array(_segment(_single("<|im_start|>", role, "\n", content, "<|im_end|>\n"), i))

    body = _per_turn(turns, one)
    if not options.add_generation_prompt:
        return body
    tail = F.array(_lit_segment("<|im_start|>assistant\n", F.size(turns.column)))
    return F.concat(body, tail)


# -- tulu3 ------------------------------------------------------------------------


def _tulu3(turns: Turns, options: RenderOptions) -> Column:
    def one(m: Column, i: Column) -> Column:
        last = i == F.size(turns.column) - 1
        closing = F.when(last, F.lit(options.eos)).otherwise(F.lit(options.eos + "\n"))
        return (
            F.when(m["role"] == "system", F.array(_segment(_single("<|system|>\n", m["content"], "\n"), i)))
            .when(m["role"] == "user", F.array(_segment(_single("<|user|>\n", m["content"], "\n"), i)))
            .when(
                m["role"] == "assistant",
                F.array(_segment(_single("<|assistant|>\n", m["content"], closing), i)),
            )
            .otherwise(_empty())
        )

    prompt = "<|assistant|>\n" if options.add_generation_prompt else None
    return _framed(None, _per_turn(turns, one), prompt, turns)


# -- the olmo3 family ---------------------------------------------------------------

# Texts of the default system turns.
_THINK_SYSTEM = (
    "<|im_start|>system\nYou are Olmo, a helpful AI assistant built by Ai2. Your date cutoff is "
    "December 2024, and your model weights are available at https://huggingface.co/allenai."
    "<|im_end|>\n"
)
_INSTRUCT_SYSTEM = "<|im_start|>system\nYou are a helpful function-calling AI assistant. "
_INSTRUCT_NO_FUNCTIONS = (
    "You do not currently have access to any functions. <functions></functions><|im_end|>\n"
)
_INSTRUCT_FUNCTIONS = (
    "You are provided with function signatures within <functions></functions> XML tags. You may "
    "call one or more functions to assist with the user query. Output any function calls within "
    "<function_calls></function_calls> XML tags. Do not make assumptions about what values to plug "
    "into functions."
)


def _plain_turn(role: str, m: Column) -> Column:
    return _single(f"<|im_start|>{role}\n", m["content"], "<|im_end|>\n")


def _default_system(turns: Turns, text: Column | str) -> Column:
    text = F.lit(text) if isinstance(text, str) else text
    missing = ~F.exists(turns.column, lambda m: m["role"].eqNullSafe("system"))
    return F.when(missing, F.array(_segment(text, F.lit(-1)))).otherwise(_empty())


def _assistant_turn(turns: Turns, m: Column, i: Column, calls: Column, eos: str, train: bool) -> Column:
    last = i == F.size(turns.column) - 1
    closing = F.when(last, F.lit(eos)).otherwise(F.lit("<|im_end|>\n"))
    body = _single(F.coalesce(m["content"], F.lit("")), calls, closing)
    return F.array(_lit_segment("<|im_start|>assistant\n", i), _segment(body, i, train))


def _function_calls(turns: Turns, m: Column, other: Column | str) -> Column:
    return _optional(
        turns, m, "function_calls", lambda c: _single("<function_calls>", c, "</function_calls>"), other
    )


def _olmo3(train: bool) -> Callable[[Turns, RenderOptions], Column]:
    def build(turns: Turns, options: RenderOptions) -> Column:
        def one(m: Column, i: Column) -> Column:
            functions = _optional(
                turns,
                m,
                "functions",
                lambda f: _single(" <functions>", f, "</functions><|im_end|>\n"),
                " You do not currently have access to any functions. <functions></functions><|im_end|>\n",
            )
            user_functions = _optional(
                turns, m, "functions", lambda f: _single("\n<functions>", f, "</functions>"), ""
            )
            user = _single("<|im_start|>user\n", m["content"], user_functions, "<|im_end|>\n")
            return (
                F.when(
                    m["role"] == "system",
                    F.array(_segment(_single("<|im_start|>system\n", m["content"], functions), i)),
                )
                .when(m["role"] == "user", F.array(_segment(user, i)))
                .when(
                    m["role"] == "assistant",
                    _assistant_turn(turns, m, i, _function_calls(turns, m, ""), options.eos, train),
                )
                .when(m["role"] == "environment", F.array(_segment(_plain_turn("environment", m), i)))
                .otherwise(_empty())
            )

        prompt = "<|im_start|>assistant\n<think>" if options.add_generation_prompt else None
        return _framed(_default_system(turns, _THINK_SYSTEM), _per_turn(turns, one), prompt, turns)

    return build


def _tool_calls(turns: Turns, m: Column, i: Column) -> Column:
    """``name(k=<json>, ...)`` per call, a line break after each but the last; any other call is printed as it is."""
    if not turns.has("tool_calls"):
        return F.lit("")
    calls = m["tool_calls"]
    element = turns.type_of("tool_calls").elementType
    if isinstance(element, T.StructType):
        printed = F.transform(calls, lambda call, k: _tool_call(turns, element, calls, call, i, k))
        lines = join_all(printed, "")
    else:
        lines = F.array_join(calls.cast("array<string>"), "")
    return F.when(
        calls.isNotNull(), _single("<function_calls>", lines, "</function_calls>")
    ).otherwise(F.lit(""))


def _tool_call(turns: Turns, element: T.StructType, calls: Column, call: Column, i: Column, k: Column) -> Column:
    other = F.get(F.get(turns.other_calls, i), k)
    if "function" not in element.fieldNames():
        return other
    if turns.call_texts is not None:
        arguments = F.get(F.get(turns.call_texts, i), k)
    else:
        arguments = call_arguments(call["function"]["arguments"], element["function"].dataType["arguments"].dataType)
    line_break = F.when(k < F.size(calls) - 1, F.lit("\n")).otherwise(F.lit(""))
    named = _single(call["function"]["name"], "(", arguments, ")", line_break)
    return F.when(call["function"].isNull(), other).otherwise(named)


def _instruct(turns: Turns, options: RenderOptions) -> Column:
    listed = _single("<functions>", turns.tools_text, "</functions>")
    default = F.when(
        turns.has_tools, _single(_INSTRUCT_SYSTEM + _INSTRUCT_FUNCTIONS, listed, "<|im_end|>\n")
    ).otherwise(F.lit(_INSTRUCT_SYSTEM + _INSTRUCT_NO_FUNCTIONS))

    def one(m: Column, i: Column) -> Column:
        own = _optional(turns, m, "functions", lambda f: _single(" <functions>", f, "</functions>"), "")
        functions = F.when(turns.tools_text.isNotNull(), listed).otherwise(own)
        calls = _function_calls(turns, m, _tool_calls(turns, m, i))
        return (
            F.when(
                m["role"] == "system",
                F.array(_segment(_single("<|im_start|>system\n", m["content"], functions, "<|im_end|>\n"), i)),
            )
            .when(m["role"] == "user", F.array(_segment(_plain_turn("user", m), i)))
            .when(m["role"] == "assistant", _assistant_turn(turns, m, i, calls, options.eos, True))
            .when(
                m["role"].isin("environment", "tool"),
                F.array(_segment(_plain_turn("environment", m), i)),
            )
            .otherwise(_empty())
        )

    prompt = "<|im_start|>assistant\n" if options.add_generation_prompt else None
    return _framed(_default_system(turns, default), _per_turn(turns, one), prompt, turns)


def tools_as_json(tools: Sequence[dict]) -> str:
    return json.dumps(list(tools), ensure_ascii=False)


def _with_tools(
    df: DataFrame, template: Template, options: RenderOptions
) -> tuple[DataFrame, Column | None, Column | None]:
    """The tool list as the template prints it: once for all chats, or per chat from JSON text."""
    printer = template.print_tools
    if printer is None:
        return df, None, None
    if options.tools_column is None:
        text = F.lit(None if options.tools is None else printer(options.tools)).cast("string")
        return df, text, F.lit(bool(options.tools))

    @F.arrow_udf("struct<text:string,n:int>")
    def printed(batch: pa.Array) -> pa.Array:
        import json as json_module

        lists = [json_module.loads(t) if t is not None else None for t in batch.to_pylist()]
        texts = [None if tools is None else printer(tools) for tools in lists]
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.string()), pa.array([len(tools or []) for tools in lists], pa.int32())],
            names=["text", "n"],
        )

    df = df.withColumn("_tools", printed(F.col(options.tools_column)))
    return df, F.col("_tools.text"), F.col("_tools.n") > 0


def _with_call_texts(df: DataFrame, messages: str, element: T.StructType) -> tuple[DataFrame, Column | None]:
    """Print call arguments that come as JSON text of an object with free keys.

    Spark has no type for such objects that keeps key order and Python's spacing, so this
    one field goes through an Arrow batch of ``json`` calls. Typed arguments stay native.
    """
    if "tool_calls" not in element.fieldNames():
        return df, None
    call = element["tool_calls"].dataType.elementType
    if not isinstance(call, T.StructType) or "function" not in call.fieldNames():
        return df, None
    function = call["function"].dataType
    if "arguments" not in function.fieldNames():
        return df, None
    if not isinstance(function["arguments"].dataType, T.StringType):
        return df, None

    @F.arrow_udf("array<array<string>>")
    def printed(batch: pa.Array) -> pa.Array:
        import json as json_module

        def one(text):
            try:
                fields = json_module.loads(text)
            except (TypeError, ValueError, RecursionError):
                return None  # a chat that cannot be rendered
            if not isinstance(fields, dict):
                return None
            return ", ".join(f"{k}={json_module.dumps(v, ensure_ascii=False)}" for k, v in fields.items())

        rows = [
            None if turns is None else [None if calls is None else [one(c) for c in calls] for calls in turns]
            for turns in batch.to_pylist()
        ]
        return pa.array(rows, pa.list_(pa.list_(pa.string())))

    texts = F.transform(
        messages, lambda m: F.transform(m["tool_calls"], lambda c: c["function"]["arguments"])
    )
    return df.withColumn("_call_texts", printed(texts)), F.col("_call_texts")


def _as_python(value, kind: pa.DataType):
    """An Arrow value with mappings as dicts all the way down."""
    if value is None:
        return None
    if pa.types.is_struct(kind):
        return {kind.field(n).name: _as_python(value[kind.field(n).name], kind.field(n).type) for n in range(kind.num_fields)}
    if pa.types.is_map(kind):
        return {k: _as_python(v, kind.item_type) for k, v in value}
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return [_as_python(v, kind.value_type) for v in value]
    return value


def _with_other_calls(df: DataFrame, messages: str, element: T.StructType) -> tuple[DataFrame, Column | None]:
    """Print calls that are mappings without a function as Python prints a mapping.

    Python's quoting has no native form, so these calls, and no others, go through an Arrow batch.
    """
    if "tool_calls" not in element.fieldNames():
        return df, None
    call = element["tool_calls"].dataType.elementType
    if not isinstance(call, T.StructType):
        return df, None

    @F.arrow_udf("array<array<string>>")
    def printed(batch: pa.Array) -> pa.Array:
        kind = batch.type.value_type.value_type
        rows = [
            None
            if turns is None
            else [
                None if calls is None else [None if c is None else str(_as_python(c, kind)) for c in calls]
                for calls in turns
            ]
            for turns in batch.to_pylist()
        ]
        return pa.array(rows, pa.list_(pa.list_(pa.string())))

    def others(m: Column) -> Column:
        if "function" not in call.fieldNames():
            return m["tool_calls"]
        # Calls with a function are left out; a turn without other calls sends nothing.
        other = F.exists(m["tool_calls"], lambda c: c["function"].isNull())
        return F.when(other, F.transform(m["tool_calls"], lambda c: F.when(c["function"].isNull(), c)))

    return df.withColumn("_other_calls", printed(F.transform(messages, others))), F.col("_other_calls")


register_template(Template("chatml", _chatml))
register_template(Template("tulu3", _tulu3))
register_template(Template("olmo3", _olmo3(False)))
register_template(Template("olmo3-think-sft", _olmo3(True), trainable=True))
register_template(
    Template(
        "olmo3-instruct-sft", _instruct, trainable=True, prints_arguments=True, print_tools=tools_as_json
    )
)
