import json

import pytest
from pyspark.sql import functions as F

from chatloom.functions.pyjson import json_text
from chatloom.operators import templates as t
from chatloom.operators.tool_signatures import signature_type, tool_signatures

MSG = "array<struct<role:string,content:string>>"
OPTIONS = t.RenderOptions(eos="</s>", bos="<s>", current_date="2025-01-31")
THINK = (
    "<|im_start|>system\nYou are Olmo, a helpful AI assistant built by Ai2. Your date cutoff is December 2024, and your "
    "model weights are available at https://huggingface.co/allenai.<|im_end|>\n"
)
NO_FUNCTIONS = "You do not currently have access to any functions. <functions></functions>"
INSTRUCT = f"<|im_start|>system\nYou are a helpful function-calling AI assistant. {NO_FUNCTIONS}<|im_end|>\n"
CHAT = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]


def text(spark, name, messages, schema=MSG, options=OPTIONS, policy="fail"):
    df = spark.createDataFrame([(messages,)], f"messages {schema}")
    rows = t.render(df, name, options, policy).collect()
    return rows[0].text if rows else None


def refuses(spark, name, messages, schema=MSG, options=OPTIONS):
    with pytest.raises(Exception, match="cannot be rendered"):
        text(spark, name, messages, schema, options)
    assert text(spark, name, messages, schema, options, "drop") is None


# -- registry -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "source,expected",
    [
        ("{% generation %}x{% endgeneration %}", True),
        ("a{%-generation-%}x{%-   endgeneration  -%}b", True),
        ("{%- generation %}\n{% endgeneration -%}", True),
        ("{% generation %} x {% endif %}", False),
        ("{% if y %} x {% endgeneration %}", False),
        ("{{ generation }} {{ endgeneration }}", False),
        ("", False),
        (None, False),
    ],
)
def test_markers(source, expected):
    assert t.has_generation_markers(source) is expected


def test_registered_templates():
    trainable = {n: t.has_generation_markers(t.get_template(n)) for n in
                 ("chatml", "tulu3", "olmo3", "olmo3-instruct-sft", "olmo3-think-sft", "apertus")}
    assert [n for n, ok in trainable.items() if ok] == ["olmo3-instruct-sft", "olmo3-think-sft"]
    with pytest.raises(KeyError, match="known are: apertus, chatml.*tulu3"):
        t.get_template("nope")
    with pytest.raises(ValueError, match="'olmo3' does not mark"):
        t.require_markers("olmo3")


def test_own_template(spark, caplog):
    def build(turns, options):
        return F.transform(turns.column, lambda m, i: F.struct(m["content"].alias("text"), (m["role"] == "assistant").alias("train"), i.alias("turn")))

    own = t.Template("own_test", build, source="{% generation %}{% endgeneration %}")
    t.register_template(own)
    t.register_template(own)
    assert "Replacing the chat template 'own_test'" in caplog.text
    assert t.require_markers("own_test") is own
    assert text(spark, "own_test", CHAT) == "abcd"


# -- texts ----------------------------------------------------------------------------


def test_chatml(spark):
    assert text(spark, "chatml", [("system", "s"), ("odd", None)]) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>odd\nNone<|im_end|>\n"
    assert text(spark, "chatml", [], options=t.RenderOptions(add_generation_prompt=True)) == "<|im_start|>assistant\n"


def test_tulu3(spark):
    full = "<|system|>\ns\n<|user|>\na\n<|assistant|>\nb</s>\n<|user|>\nc\n<|assistant|>\nd</s>"
    assert text(spark, "tulu3", [("system", "s"), *CHAT]) == full
    assert text(spark, "tulu3", [("assistant", "b"), ("tool", "x")]) == "<|assistant|>\nb</s>\n"
    prompt = t.RenderOptions(add_generation_prompt=True)
    assert text(spark, "tulu3", [("user", "a")], options=prompt) == "<|user|>\na\n<|assistant|>\n"
    assert text(spark, "tulu3", [], options=prompt) == ""
    refuses(spark, "tulu3", [("user", None)])


@pytest.mark.parametrize("name", ["olmo3", "olmo3-think-sft"])
def test_think(spark, name):
    turns = "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n<|im_start|>assistant\nd</s>"
    assert text(spark, name, CHAT) == THINK + turns
    system = f"<|im_start|>system\ns {NO_FUNCTIONS}<|im_end|>\n"
    assert text(spark, name, [("system", "s"), *CHAT]) == system + turns
    # A system turn anywhere switches the default off; tool turns are skipped.
    assert text(spark, name, [("environment", "e"), ("tool", "t"), ("system", "s")]) == "<|im_start|>environment\ne<|im_end|>\n" + system
    prompt = t.RenderOptions(add_generation_prompt=True)
    assert text(spark, name, [("user", "a")], options=prompt).endswith("a<|im_end|>\n<|im_start|>assistant\n<think>")
    assert text(spark, name, [("assistant", None)]) == THINK + "<|im_start|>assistant\n</s>"
    refuses(spark, name, [("system", None)])
    refuses(spark, name, [("user", None)])
    refuses(spark, name, [("environment", None)])


FIELDS = "array<struct<role:string,content:string,functions:string,function_calls:string>>"


def test_think_functions(spark):
    chat = [("system", "s", "F", None), ("user", "u", "G", None), ("assistant", None, None, "f()"), ("user", "v", None, None)]
    assert text(spark, "olmo3", chat, FIELDS) == (
        "<|im_start|>system\ns <functions>F</functions><|im_end|>\n"
        "<|im_start|>user\nu\n<functions>G</functions><|im_end|>\n"
        "<|im_start|>assistant\n<function_calls>f()</function_calls><|im_end|>\n"
        "<|im_start|>user\nv<|im_end|>\n"
    )


def test_instruct(spark):
    chat = [("user", "a"), ("tool", "t"), ("environment", "e"), ("assistant", "b")]
    body = (
        "<|im_start|>user\na<|im_end|>\n<|im_start|>environment\nt<|im_end|>\n<|im_start|>environment\ne<|im_end|>\n"
        "<|im_start|>assistant\nb</s>"
    )
    assert text(spark, "olmo3-instruct-sft", chat) == INSTRUCT + body
    assert text(spark, "olmo3-instruct-sft", [("system", "s"), *chat]) == "<|im_start|>system\ns<|im_end|>\n" + body
    with_functions = [("system", "s", "F", None), ("user", "u", "ignored", None)]
    assert text(spark, "olmo3-instruct-sft", with_functions, FIELDS) == (
        "<|im_start|>system\ns <functions>F</functions><|im_end|>\n<|im_start|>user\nu<|im_end|>\n"
    )
    refuses(spark, "olmo3-instruct-sft", [("tool", None)])


def test_instruct_tools(spark):
    tools = [{"name": "é", "args": [1, 2.5, None]}]
    options = t.RenderOptions(eos="</s>", tools=tools)
    listed = '[{"name": "é", "args": [1, 2.5, null]}]'
    got = text(spark, "olmo3-instruct-sft", [("user", "a")], options=options)
    assert got.startswith("<|im_start|>system\nYou are a helpful function-calling AI assistant. You are provided with")
    assert f"into functions.<functions>{listed}</functions><|im_end|>\n<|im_start|>user" in got
    got = text(spark, "olmo3-instruct-sft", [("system", "s")], options=options)
    assert got == f"<|im_start|>system\ns<functions>{listed}</functions><|im_end|>\n"
    empty = t.RenderOptions(tools=[])
    assert text(spark, "olmo3-instruct-sft", [("user", "a")], options=empty).startswith(INSTRUCT)
    assert text(spark, "olmo3-instruct-sft", [("system", "s")], options=empty) == "<|im_start|>system\ns<functions>[]</functions><|im_end|>\n"


@pytest.mark.parametrize("name", ["olmo3-instruct-sft", "apertus"])
def test_tools_per_chat(spark, name):
    lists = [None, [], [{"name": "f", "description": "Dö.", "parameters": {"properties": {"a": {"type": "string"}}}}]]
    rows = [(i, [(role, "x")], None if x is None else json.dumps(x)) for i, x in enumerate(lists) for role in ("user", "system")]
    df = spark.createDataFrame(rows, f"id int, messages {MSG}, tools string")
    per_chat = t.RenderOptions(current_date="2025-01-31", tools_column="tools")
    got = {(r.id, r.messages[0].role): r.text for r in t.render(df, name, per_chat).collect()}
    for i, tools in enumerate(lists):
        for role in ("user", "system"):
            options = t.RenderOptions(current_date="2025-01-31", tools=tools)
            assert got[i, role] == text(spark, name, [(role, "x")], options=options)


def test_tool_calls(spark):
    schema = "array<struct<role:string,content:string,function_calls:string,tool_calls:array<struct<function:struct<name:string,arguments:map<string,string>>>>>>"
    calls = [(("f", {"x": 'q"\n'}),), (("g", {}),)]
    got = text(spark, "olmo3-instruct-sft", [("assistant", "c", None, calls)], schema)
    assert got.endswith('assistant\nc<function_calls>f(x="q\\"\\n")\ng()</function_calls></s>')
    # The text field wins over the list.
    got = text(spark, "olmo3-instruct-sft", [("assistant", "c", "direct", calls)], schema)
    assert got.endswith("c<function_calls>direct</function_calls></s>")
    refuses(spark, "olmo3-instruct-sft", [("assistant", "c", None, [(("f", None),)])], schema)
    plain = "array<struct<role:string,content:string,tool_calls:array<string>>>"
    got = text(spark, "olmo3-instruct-sft", [("assistant", None, ["f()", "g()"])], plain)
    assert got.endswith("assistant\n<function_calls>f()g()</function_calls></s>")


def test_tool_calls_as_json_text(spark):
    schema = "array<struct<role:string,content:string,tool_calls:array<struct<function:struct<name:string,arguments:string>>>>>"
    value = {"b": [1, {"z": None}], "a": "é", "n": 1e20}
    calls = [(("f", json.dumps(value)),)]
    got = text(spark, "olmo3-instruct-sft", [("user", "u", None), ("assistant", None, calls)], schema)
    assert got.endswith('<function_calls>f(b=[1, {"z": null}], a="é", n=1e+20)</function_calls></s>')


def test_calls_without_a_function(spark):
    flat = "array<struct<role:string,content:string,tool_calls:array<struct<name:string,arguments:map<string,array<int>>>>>>"
    calls = [("it's", {"x": [1, None]}), ('a "b"\n', None)]
    printed = [{"name": "it's", "arguments": {"x": [1, None]}}, {"name": 'a "b"\n', "arguments": None}]
    got = text(spark, "olmo3-instruct-sft", [("user", "u", None), ("assistant", None, calls)], flat)
    assert got.endswith(f"assistant\n<function_calls>{printed[0]}{printed[1]}</function_calls></s>")
    mixed = "array<struct<role:string,content:string,tool_calls:array<struct<id:int,function:struct<name:string,arguments:string>>>>>"
    calls = [(1, ("f", "{}")), (2, None), (3, ("g", '{"k": 1}')), (4, None)]
    got = text(spark, "olmo3-instruct-sft", [("assistant", "c", calls)], mixed)
    other = [str({"id": i, "function": None}) for i in (2, 4)]
    assert got.endswith(f"c<function_calls>f()\n{other[0]}g(k=1)\n{other[1]}</function_calls></s>")
    refuses(spark, "olmo3-instruct-sft", [("assistant", "c", [None])], mixed)


@pytest.mark.parametrize("arguments", ["{broken", "[1]", "3", "null", "", "[" * 100_000])
def test_broken_call_arguments_make_a_bad_row(spark, arguments):
    schema = "array<struct<role:string,content:string,tool_calls:array<struct<function:struct<name:string,arguments:string>>>>>"
    refuses(spark, "olmo3-instruct-sft", [("assistant", "c", [(("f", arguments),)])], schema)


def test_unrenderable_chats_can_stay(spark):
    df = spark.createDataFrame([(1, [("user", "a")]), (2, [("user", None)])], f"id int, messages {MSG}")
    rows = {r.id: r.segments for r in t.render_segments(df, "tulu3", OPTIONS, "null").collect()}
    assert rows[1][0].text == "<|user|>\na\n" and rows[2] is None
    with pytest.raises(ValueError, match="on_bad_row"):
        t.render_segments(df, "tulu3", OPTIONS, "keep")


def test_json_text_is_pythons(spark):
    schema = "s string, d double, i bigint, b boolean, a array<double>, m map<string,array<string>>, r struct<x:int,y:string>"
    rows = [
        ('q"\\\n\t\x01\x1f\x7f é', 1e16, 5, True, [0.1, None, 1e-7], {"k": ["v", None]}, (1, None)),
        ("", 1234567.0, -1, False, [], {}, (None, "z")),
        (None, -2.5e-5, None, None, None, None, None),
        ("x", 123456789012345.6, 0, True, [1e15, 1e22, 1.5e-300], {"é": []}, (0, "")),
    ]
    df = spark.createDataFrame(rows, schema)
    fields = df.schema.fields
    got = df.select(*[json_text(F.col(f.name), f.dataType).alias(f.name) for f in fields]).collect()
    for row, printed in zip(rows, got, strict=True):
        for field, value in zip(fields, row, strict=True):
            if field.name == "r" and value is not None:
                value = {"x": value[0], "y": value[1]}
            assert printed[field.name] == json.dumps(value, ensure_ascii=False)


# -- spans ------------------------------------------------------------------------------


def spans(spark, name, messages):
    df = spark.createDataFrame([(messages,)], f"messages {MSG}")
    rows = t.render_segments(df, name, OPTIONS)
    return rows


def test_only_answers_are_trained(spark):
    rows = spans(spark, "olmo3-think-sft", CHAT)
    assert [s.text for s in rows.first().segments if s.train] == ["b<|im_end|>\n", "d</s>"]
    assert not any(s.train for s in spans(spark, "olmo3", CHAT).first().segments)
    last = rows.select(t.train_last_turn_only(F.col("segments")).alias("s")).first().s
    assert [s.text for s in last if s.train] == ["d</s>"]


def test_last_turn_only_without_answers(spark):
    rows = spans(spark, "olmo3-think-sft", [("user", "a")])
    assert not any(s.train for s in rows.select(t.train_last_turn_only(F.col("segments")).alias("s")).first().s)


# -- blocks -----------------------------------------------------------------------------

HEAD = (
    "<s><|system_start|>You are Apertus, a helpful assistant created by the SwissAI initiative.\nKnowledge cutoff: 2024-04\n"
    "Current date: 2025-01-31<|system_end|><|developer_start|>Deliberation: disabled\nTool Capabilities: disabled<|developer_end|>"
)


def test_apertus_text(spark):
    assert text(spark, "apertus", CHAT) == HEAD + (
        "<|user_start|>a<|user_end|><|assistant_start|>b<|assistant_end|><|user_start|>c<|user_end|>"
        "<|assistant_start|>d<|assistant_end|>"
    )
    system = HEAD.split("<|developer_start|>")[1]
    assert text(spark, "apertus", [("system", "S"), ("user", "a")]) == (
        "<s><|system_start|>S<|system_end|><|developer_start|>" + system + "<|user_start|>a<|user_end|>"
    )
    assert text(spark, "apertus", []) == HEAD
    joined = [("assistant", "x"), ("assistant", "y"), ("tool", "t"), ("tool", "u"), ("user", "q"), ("tool", "v")]
    assert text(spark, "apertus", joined[:5]) == HEAD + "<|assistant_start|>xy[t, u]<|assistant_end|><|user_start|>q<|user_end|>"
    assert text(spark, "apertus", joined[:4]) == HEAD + "<|assistant_start|>xy[t, u]<|assistant_end|>"
    assert text(spark, "apertus", [*joined[:3], ("assistant", "z")]) == HEAD + "<|assistant_start|>xy[t]z<|assistant_end|>"
    refuses(spark, "apertus", joined)
    for bad in ([("user", "a"), ("system", "s")], [("other", "a")], [("user", None)], [("assistant", None)], [("system", None)]):
        refuses(spark, "apertus", bad)


def test_apertus_options(spark):
    options = t.RenderOptions(bos="", current_date="2025-01-31", enable_thinking=True, add_generation_prompt=True)
    got = text(spark, "apertus", [("user", "a")], options=options)
    assert "Deliberation: enabled\n" in got and got.endswith("a<|user_end|><|assistant_start|>")
    open_end = t.RenderOptions(current_date="x", continue_assistant_message=True)
    assert text(spark, "apertus", [("assistant", "a")], options=open_end).endswith("<|assistant_start|>a")
    with pytest.raises(ValueError, match="current_date"):
        text(spark, "apertus", [("user", "a")], options=t.RenderOptions())


def test_apertus_tool_calls(spark):
    schema = "array<struct<role:string,content:string,tool_calls:array<struct<type:string,function:struct<name:string,arguments:string>>>>>"
    call = ("function", ("f", '{"x": 1}'))
    waiting = [("assistant", "a", [call, call])]
    printed = '<|tools_prefix|>[{"f": {"x": 1}}, {"f": {"x": 1}}]<|tools_suffix|>'
    assert text(spark, "apertus", waiting, schema) == HEAD + "<|assistant_start|>a" + printed
    answered = [*waiting, ("tool", "r", None), ("assistant", "b", [])]
    assert text(spark, "apertus", answered, schema) == HEAD + "<|assistant_start|>a" + printed + "[r]b<|assistant_end|>"
    refuses(spark, "apertus", [("assistant", "a", [("other", ("f", "{}"))])], schema)
    refuses(spark, "apertus", [("assistant", "a", [("function", (None, "{}"))])], schema)


BLOCKS = (
    "array<struct<role:string,content:struct<text:string,parts:array<struct<type:string,text:string>>,"
    "blocks:array<struct<type:string,text:string,calls:array<struct<name:string,arguments:string>>,outputs:array<struct<output:string>>>>>>>"
)


def block(kind, text=None, calls=None, outputs=None):
    return (kind, text, calls, outputs)


def answer(*blocks):
    return ("assistant", (None, None, list(blocks)))


def ask(*parts):
    return ("user", (None, list(parts), None))


def test_apertus_blocks(spark):
    got = text(
        spark,
        "apertus",
        [
            ("system", ("S", None, None)),
            ask(("text", "u"), ("image", None), ("text", "w")),
            answer(
                block("thoughts", "t1"),
                block("thoughts", "t2"),
                block("tool_calls", calls=[("f", "{}")]),
                block("tool_outputs", outputs=[("o",), ("p",)]),
                block("tool_calls", calls=[("display_answers", '{"a": 1}')]),
            ),
            answer(block("response", "r1"), block("thoughts", "t3")),
            answer(block("response", "r2")),
            ask(("text", "next")),
            answer(block("response", "plain")),
        ],
        BLOCKS,
    )
    developer = HEAD.split("<|developer_start|>")[1]
    assert got == (
        "<s><|system_start|>S<|system_end|><|developer_start|>" + developer
        + "<|user_start|>u<|image|>w<|user_end|><|assistant_start|><|inner_prefix|>t1t2"
        '<|tools_prefix|>[{"f": {}}]<|tools_suffix|>[o, p]'
        '<|inner_suffix|><|tools_prefix|>[{"display_answers": {"a": 1}}]<|tools_suffix|>'
        "r1<|inner_prefix|>t3<|inner_suffix|>r2<|assistant_end|><|user_start|>next<|user_end|>"
        # The answer call still awaits an output, so the last turn stays open.
        "<|assistant_start|>plain"
    )


def test_apertus_block_rules(spark):
    first_call = answer(block("tool_calls", calls=[("display_answers", "{}")]))
    got = text(spark, "apertus", [answer(block("thoughts", "t")), first_call], BLOCKS)
    # The answer call opens its turn, so the inner part stays open; tool output is awaited.
    assert got == HEAD + '<|assistant_start|><|inner_prefix|>t<|tools_prefix|>[{"display_answers": {}}]<|tools_suffix|>'
    tool = ("tool", ("out", None, None))
    got = text(spark, "apertus", [first_call, tool, answer(block("response", "r"))], BLOCKS)
    assert got.endswith("<|tools_suffix|>[out]r<|assistant_end|>")
    refuses(spark, "apertus", [first_call, tool, answer(block("tool_outputs", outputs=[("o",)]))], BLOCKS)
    refuses(spark, "apertus", [answer(block("odd", "x"))], BLOCKS)
    refuses(spark, "apertus", [ask(("video", None))], BLOCKS)
    refuses(spark, "apertus", [("assistant", ("text only", None, None))], BLOCKS)
    refuses(spark, "apertus", [("system", (None, None, None))], BLOCKS)


def test_apertus_long_chat(spark):
    turns = [("user" if i % 2 == 0 else "assistant", "x") for i in range(20_000)]
    assert len(text(spark, "apertus", turns)) == len(HEAD) + 10_000 * (27 + 37)


# -- signatures ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "spec,expected",
    [
        ({"type": "string"}, "string"),
        ({"type": "string", "nullable": True}, "string | null"),
        ({"type": "string", "enum": ["a", "b"]}, '"a" | "b"'),
        ({"type": "integer"}, "number"),
        ({"type": "number", "nullable": True}, "number"),
        ({"type": "boolean"}, "boolean"),
        ({"type": "array", "items": {"type": "integer"}}, "number[]"),
        ({"type": "array", "items": {"type": "string"}, "nullable": True}, "string[] | null"),
        ({"type": "array", "items": {"type": "array", "items": {"type": "boolean"}}}, "boolean[][]"),
        ({"type": "array"}, "any[]"),
        ({"type": "array", "items": {"type": ["object", "object"]}}, "any[]"),
        ({"type": "array", "items": {"type": "string", "enum": ["x" * 60]}}, "string[]"),
        ({"type": "array", "items": {"type": "object", "properties": {"k" * 40: {"type": "string"}}}}, "any[]"),
        ({"type": ["string", "null"]}, "string | null"),
        ({"type": ["string"]}, "string"),
        ({"oneOf": [{"type": "string"}, {"type": "number"}]}, "string | \nnumber"),
        ({"oneOf": [{"type": "string", "description": "d", "default": "x"}]}, 'string// d' + " " * 20 + '// default: "x"'),
        ({"type": "object"}, "object"),
        (
            {"type": "object", "properties": {"a": {"type": "string"}, "b": {"type": "number"}}, "required": ["a"]},
            "{\na: \n" + " " * 16 + "string, b?: \n" + " " * 16 + "number}",
        ),
        ({"type": "odd"}, "any"),
        ({}, "any"),
    ],
)
def test_signature_types(spec, expected):
    assert signature_type(spec) == expected


def test_tool_signatures():
    tools = [
        {"name": "none", "description": "Nothing."},
        {
            "name": "f",
            "description": "Do.",
            "parameters": {
                "properties": {
                    "a": {"type": "string", "description": "An a."},
                    "b": {"type": "string", "enum": ["x"], "default": "x"},
                    "c": {"oneOf": [{"type": "string"}], "default": "y"},
                    "d": {"type": "integer", "default": 3},
                },
                "required": ["a"],
            },
        },
    ]
    assert tool_signatures(tools) == (
        "// Nothing.\ntype none = () => any;\n"
        "// Do.\ntype f = (_: {\n// An a.\na: string,\nb?: \"x\", // default: x,\nc?: string// default: y,\n"
        "d?: number, // default: 3\n}) => any;"
    )
