import pytest
from pyspark.sql import functions as F

from chatloom.operators.registry import get_transform, register_transform, transform_names
from chatloom.operators.shaping import (
    apply_transform,
    dpo_filter,
    enforce_messages,
    first_message_list,
    keep_columns,
    sft_filter,
)
from tests.helpers import messages_of

MSG = "array<struct<role:string,content:string>>"
NBSP, WIDE = " ", "　"


def pair(user, assistant):
    return [("user", user), ("assistant", assistant)]


def fails(spark, name, schema, row):
    """The row fails the job by default and is a NULL list with 'drop'."""
    with pytest.raises(Exception):
        messages_of(spark, name, schema, [row])
    assert messages_of(spark, name, schema, [row], "drop") == [None]


def test_registry():
    assert len(transform_names()) >= 26
    with pytest.raises(KeyError, match="'nope'; known are: aegis_safety"):
        get_transform("nope")
    with pytest.raises(ValueError, match="already a transform with the name 'aegis_safety'"):
        register_transform("aegis_safety")(lambda schema, policy: None)


@pytest.mark.parametrize("column", ["conversation", "conversations", "dialog"])
def test_rename(spark, column):
    rows = [([("user", "a")],), ([],), (None,)]
    assert messages_of(spark, "rename_to_messages", f"{column} {MSG}", rows) == [[("user", "a")], [], None]


def test_rename_takes_first_present_column(spark):
    rows = [(None, [("user", "second")])]
    assert messages_of(spark, "rename_to_messages", f"conversation {MSG}, dialog {MSG}", rows) == [None]
    with pytest.raises(KeyError, match="holds a conversation"):
        apply_transform(spark.range(1), "rename_to_messages")


def test_instruction_response(spark):
    schema = "instruction string, input string, response string, output string"
    rows = [("i", "x", "r", "y"), ("", "x", None, "y"), (None, None, "", "")]
    assert messages_of(spark, "instruction_response_to_messages", schema, rows) == [
        pair("i", "r"),
        pair("x", "y"),
        pair(None, ""),
    ]
    assert messages_of(spark, "instruction_response_to_messages", "instruction string, output string", [("", "o")]) == [
        pair("", "o")
    ]


KWARGS = f"messages {MSG}, chat_template_kwargs struct<python_tools:array<string>,xml_tools:array<string>>"


def test_smoltalk2(spark):
    chat = [("user", "a"), ("user", "b"), ("assistant", "c"), ("assistant", "d"), ("assistant", "e"), ("user", "f")]
    merged = [("user", "a\nb"), ("assistant", "c\nd\ne"), ("user", "f")]
    rows = [
        (chat, ([], None)),
        (chat, (["t"], None)),
        (chat, (None, ["t"])),
        ([("user", None), ("assistant", "x")], (None, None)),
    ]
    assert messages_of(spark, "smoltalk2", KWARGS, rows) == [merged, [], [], [("user", None), ("assistant", "x")]]
    assert messages_of(spark, "smoltalk2", f"messages {MSG}", [(chat,)]) == [merged]


def test_smoltalk2_bad_rows(spark):
    fails(spark, "smoltalk2", KWARGS, ([], (None, None)))
    fails(spark, "smoltalk2", KWARGS, (None, (None, None)))
    fails(spark, "smoltalk2", KWARGS, ([("user", "a")], None))
    fails(spark, "smoltalk2", KWARGS, ([("user", "a"), ("user", None)], (None, None)))


def test_smoltalk2_keeps_other_fields_of_the_first_turn(spark):
    schema = "messages array<struct<role:string,content:string,name:string>>"
    df = spark.createDataFrame([([("user", "a", "n1"), ("user", "b", "n2")],)], schema)
    assert apply_transform(df, "smoltalk2").first().messages == [("user", "a\nb", "n1")]


def test_smoltalk2_preference(spark):
    schema = f"messages {MSG}, chosen {MSG}, chat_template_kwargs struct<xml_tools:array<string>>"
    chat, other = [("user", "a"), ("user", "b")], [("user", "c")]
    rows = [(chat, other, (None,)), ([], other, (None,)), (None, None, (None,)), ([], [], (["t"],)), (chat, other, (["t"],))]
    assert messages_of(spark, "smoltalk2_preference", schema, rows) == [[("user", "a\nb")], [("user", "c")], [], [], []]
    assert messages_of(spark, "smoltalk2_preference", f"chosen {MSG}", [(chat,)]) == [[("user", "a\nb")]]


FROM = "conversations array<struct<from:string,value:string>>"


def test_perfectblend(spark):
    rows = [
        ([("human", f" {NBSP}a\n"), ("human", "\tb "), ("gpt", f"{WIDE}c\x1c")],),
        ([],),
        (None,),
    ]
    assert messages_of(spark, "perfectblend", FROM, rows) == [[("user", "a\nb"), ("assistant", "c")], [], []]
    fails(spark, "perfectblend", FROM, ([("system", "x")],))
    fails(spark, "perfectblend", FROM, ([("human", None)],))
    fails(spark, "perfectblend", FROM, ([(None, "x")],))


def test_orca_json(spark):
    rows = [('[{"role": "user", "content": "a", "extra": 1}]',), ("[]",), (' [{"content":"b","role":"assistant"}]\n',)]
    assert messages_of(spark, "orca_agentinstruct_1m", "messages string", rows) == [
        [("user", "a")],
        [],
        [("assistant", "b")],
    ]
    for broken in ("[", "{}", "[] x", "[1]", '[{"role": "a"}] ]', '[], "w": []', "[], []", None, "", "['a']"):
        fails(spark, "orca_agentinstruct_1m", "messages string", (broken,))


def test_orca_json_as_python_reads_it(spark):
    rows = [
        ('[{"role": "user", "content": "a", "content": "b"}]',),
        ('[{"role": "user", "content": "a", "x": 1, "x": 2, "y": NaN, "z": -Infinity}]',),
        ('[{"role": "user", "content": "' + "a" * 30_000_000 + '"}]',),
    ]
    found = messages_of(spark, "orca_agentinstruct_1m", "messages string", rows, on_bad_row="drop")
    assert found[:2] == [[("user", "b")], [("user", "a")]]
    assert found[2] and len(found[2][0][1]) == 30_000_000


def test_hh_rlhf(spark):
    rows = [
        (f"\n\nHuman: hi{NBSP}\n\nAssistant: yes\n\nAssistant: more\n\nHuman: say Assistant: inside\n",),
        ("no markers",),
        ("Human:",),
        ("Human: \n",),
    ]
    assert messages_of(spark, "anthropic_hh_rlhf", "chosen string", rows) == [
        [("user", "hi"), ("assistant", "yes\nmore"), ("user", "say"), ("assistant", "inside")],
        [],
        [],
        [("user", "")],
    ]
    fails(spark, "anthropic_hh_rlhf", "chosen string", (None,))


def test_hh_rlhf_long_text(spark):
    text = "Human: " + "word \n" * 200_000 + "Assistant: end"
    (got,) = messages_of(spark, "anthropic_hh_rlhf", "chosen string", [(text,)])
    assert [len(c) for _, c in got] == [len(("word \n" * 200_000).strip()), 3]


def test_shp(spark):
    schema = "history string, human_ref_A string, human_ref_B string, labels int"
    rows = [("h", "A", "B", 1), ("h", "A", "B", 0), ("h", "A", "B", None), (None, "A", "B", 2)]
    assert messages_of(spark, "stanfordnlp_shp", schema, rows) == [
        pair("h", "A"),
        pair("h", "B"),
        pair("h", "B"),
        pair(None, "B"),
    ]


def test_nectar(spark):
    schema = "prompt string, answers array<struct<answer:string,rank:double>>"
    rows = [
        (f"{NBSP}\nHUMAN: \n q Human: r assistant:{WIDE}\n", [("x", 2.0), ("y", 1.0), ("z", 1.0)]),
        ("q Assistant: no ", [("x", 2.0)]),
        ("Assistant:", []),
        ("q", None),
        ("q", [("x", 2.0), (None, 1.0)]),
    ]
    assert messages_of(spark, "berkeley_nest_nectar", schema, rows) == [
        pair("q Human: r", "y"),
        pair("q Assistant: no ", "x"),
        pair("", ""),
        pair("q", ""),
        pair("q", None),
    ]
    fails(spark, "berkeley_nest_nectar", schema, (None, []))


def test_arena(spark):
    tail = "response_a string, response_b string, winner_model_a int, winner_tie int"
    rows = [("p", "A", "B", 1, 0), ("p", "A", "B", 0, 1), ("p", "A", "B", 0, None), ('["x"]', "A", "B", None, None)]
    assert messages_of(spark, "arena_preference", f"prompt string, {tail}", rows) == [
        pair("p", "A"),
        pair("p", "A"),
        pair("p", "B"),
        pair('["x"]', "B"),
    ]
    listed = f"prompt array<string>, {tail}"
    assert messages_of(spark, "arena_preference", listed, [(["p", "q"], "A", "B", 0, 0)]) == [pair("p\nq", "B")]
    fails(spark, "arena_preference", listed, (["p", None], "A", "B", 0, 0))


COMPARIA = (
    "both_equal boolean, chosen_model_name string, model_a_name string, conv_incorrect_a boolean, conv_incorrect_b boolean, "
    f"conv_useful_a boolean, conv_useful_b boolean, conversation_a {MSG}, conversation_b {MSG}, "
    "system_prompt_a string, system_prompt_b string"
)


def vote(equal=False, chosen="A", a="A", wrong=(None, None), useful=(None, None), conv=None, system=(None, None)):
    conv = conv or ([("user", "qa"), ("assistant", "ra")], [("user", "qb"), ("user", "qc"), ("assistant", "rb")])
    return (equal, chosen, a, *wrong, *useful, *conv, *system)


def test_comparia(spark):
    a = [("user", "qa"), ("assistant", "ra")]
    b = [("user", "qb\nqc"), ("assistant", "rb")]
    cases = [
        (vote(), a),
        (vote(equal=True, chosen=None), a),
        (vote(equal=None, chosen=None), []),
        (vote(chosen="B"), b),
        (vote(chosen="neither"), b),
        (vote(chosen="x", a=None), b),
        (vote(equal=True, a=None), a),
        (vote(wrong=(True, None)), []),
        (vote(wrong=(False, True)), a),
        (vote(useful=(False, None)), []),
        (vote(useful=(None, False)), a),
        (vote(system=(f" {NBSP}be kind\n", "other")), [("system", "be kind"), *a]),
        (vote(system=(" \n", None)), a),
        (vote(conv=([("system", "x"), ("user", "q")], []), system=("s", None)), [("system", "s\nx"), ("user", "q")]),
        (vote(conv=([], []), system=("s", None)), [("system", "s")]),
    ]
    got = messages_of(spark, "comparia_votes", COMPARIA, [c[0] for c in cases])
    assert got == [c[1] for c in cases]
    fails(spark, "comparia_votes", COMPARIA, vote(conv=([], [])))
    fails(spark, "comparia_votes", COMPARIA, (False, "A", "A", None, None, None, None, None, [], None, None))


@pytest.mark.parametrize("name", ["ultrafeedback", "capybara_dpo"])
def test_chosen_is_messages(spark, name):
    assert messages_of(spark, name, f"chosen {MSG}", [([("user", "a")],), ([],)]) == [[("user", "a")], []]


def test_lmsys(spark):
    assert messages_of(spark, "lmsys_chat", f"conversation {MSG}", [([("user", "a")],)]) == [[("user", "a")]]


def test_aegis(spark):
    schema = "prompt string, response string, response_label string"
    rows = [("p", "r", "unsafe"), ("p", "r", "safe"), ("REDACTED", "r", "unsafe"), ("p", "r", None), (None, "r", "unsafe")]
    assert messages_of(spark, "aegis_safety", schema, rows) == [pair("p", "r"), [], [], [], pair(None, "r")]


def test_helpsteer2(spark):
    schema = "prompt string, response_1 string, response_2 string, preference_strength double"
    rows = [("p", "first", "second", s) for s in (1.0, 0.0, -1.0)]
    assert messages_of(spark, "helpsteer2", schema, rows) == [pair("p", "second"), pair("p", "first"), pair("p", "first")]
    fails(spark, "helpsteer2", schema, ("p", "first", "second", None))


@pytest.mark.parametrize("name,prompt", [("intel_orca_dpo", "input"), ("truthy_dpo", "prompt")])
def test_optional_system(spark, name, prompt):
    schema = f"system string, {prompt} string, chosen string"
    rows = [("s", "p", "c"), ("", "p", "c"), (None, "p", "c"), (" ", "p", "c")]
    assert messages_of(spark, name, schema, rows) == [
        [("system", "s"), *pair("p", "c")],
        pair("p", "c"),
        pair("p", "c"),
        [("system", " "), *pair("p", "c")],
    ]
    assert messages_of(spark, name, f"{prompt} string, chosen string", [("p", "c")]) == [pair("p", "c")]


def test_plain_pairs(spark):
    assert messages_of(spark, "human_like_dpo", "prompt string, chosen string", [("p", "c")]) == [pair("p", "c")]
    assert messages_of(spark, "math_preference", "instruction string, chosen_response string", [("p", None)]) == [pair("p", None)]


def test_mt_bench(spark):
    chat = [("user", "a")]
    rows = [("model_b", chat), ("model_a", chat), ("tie", chat), (None, chat), ("model_b", None)]
    schema = f"winner string, conversation_b {MSG}"
    assert messages_of(spark, "mt_bench_judgments", schema, rows) == [chat, [], [], [], None]


CONTEXT = [("user", "q")]


def test_helpsteer3_preference(spark):
    schema = f"context {MSG}, response1 string, response2 string, overall_preference double"
    rows = [(CONTEXT, "first", "second", s) for s in (1.0, 0.0, -2.0)]
    assert messages_of(spark, "helpsteer3_preference", schema, rows) == [
        [*CONTEXT, ("assistant", a)] for a in ("second", "first", "first")
    ]
    fails(spark, "helpsteer3_preference", schema, (CONTEXT, "a", "b", None))
    fails(spark, "helpsteer3_preference", schema, (None, "a", "b", 1.0))


def test_helpsteer3_feedback(spark):
    schema = f"context {MSG}, response1 string, response2 string, feedback1 array<string>, feedback2 array<string>"

    def row(one, two):
        return (CONTEXT, "first", "second", one, two)

    cases = [
        (row(["mostly. not"], ["partially good"]), "first"),
        (row(["slightly"], ["mostly", "not"]), "second"),
        (row(["partially"], ["partially. perfectly"]), "first"),
        (row(["perfectly but another thing."], ["slightly"]), "second"),  # "another" holds "not"
        (row(["perfectly"], ["mostly", "perfectly"]), "first"),
    ]
    got = messages_of(spark, "helpsteer3_feedback", schema, [c[0] for c in cases])
    assert [m[-1][1] for m in got] == [c[1] for c in cases]
    for broken in (row([], ["not"]), row(["not"], None), row(["good. not"], ["not"]), row([None], ["not"])):
        fails(spark, "helpsteer3_feedback", schema, broken)


def test_helpsteer3_edits(spark):
    for name, column in (("helpsteer3_edit", "edited_response"), ("helpsteer3_edit_quality", "good_edited_response")):
        assert messages_of(spark, name, f"context {MSG}, {column} string", [(CONTEXT, "e"), ([], None)]) == [
            [*CONTEXT, ("assistant", "e")],
            [("assistant", None)],
        ]


def test_helpsteer3_principle(spark):
    schema = f"context {MSG}, response string, fulfilment string"
    rows = [(CONTEXT, "r", "Yes"), (CONTEXT, "r", "No"), (CONTEXT, "r", None), (None, "r", "No")]
    full = [*CONTEXT, ("assistant", "r")]
    assert messages_of(spark, "helpsteer3_principle", schema, rows) == [full, [], full, []]


def test_context_is_cut_to_the_narrow_schema(spark):
    schema = "context array<struct<role:string,content:string,lang:string>>, edited_response string"
    df = spark.createDataFrame([([("user", "q", "en")], "e")], schema)
    out = apply_transform(df, "helpsteer3_edit", drop_sources=True)
    assert out.schema["messages"].dataType.elementType.fieldNames() == ["content", "role"]


def test_long_merge_is_linear(spark):
    chat = [("user" if i % 3 else "assistant", "x" * 10) for i in range(60_000)]
    (got,) = messages_of(spark, "smoltalk2", f"messages {MSG}", [(chat,)])
    assert len(got) == 40_000 and got[1] == ("user", "x" * 10 + "\n" + "x" * 10)


def test_row_function(spark):
    if "upper_test" not in transform_names():

        @register_transform("upper_test", row_function=True)
        def upper(row):
            return {"messages": [{"role": "user", "content": row["text"].upper(), "extra": 1}]}

    assert messages_of(spark, "upper_test", "text string, n int", [("a", 1)]) == [[("user", "A")]]
    fails(spark, "upper_test", "text string", (None,))
    added = apply_transform(spark.createDataFrame([("a", 1)], "text string, n int"), "upper_test")
    assert added.columns == ["text", "n", "messages"]


# -- columns and filters ------------------------------------------------------------


def test_sources_stay_or_go(spark):
    df = spark.createDataFrame([("p", "c", "x")], "prompt string, chosen string, unused string")
    assert apply_transform(df, "human_like_dpo").columns == ["prompt", "chosen", "unused", "messages"]
    assert apply_transform(df, "human_like_dpo", drop_sources=True).columns == ["messages"]
    enforced = apply_transform(df, "human_like_dpo", enforce_schema=True)
    assert enforced.columns == ["messages"]
    assert enforced.dtypes[0][1] == "array<struct<content:string,role:string>>"


def test_enforce_and_keep(spark):
    df = spark.createDataFrame([([("user", "a", 1)], "x")], "messages array<struct<role:string,content:string,k:int>>, unused string")
    kept = keep_columns(df, ["messages", "absent"])
    assert kept.columns == ["messages"] and "k" in kept.schema["messages"].dataType.elementType.fieldNames()
    assert enforce_messages(kept).first().messages == [("a", "user")]
    with pytest.raises(KeyError, match="has none of the columns"):
        keep_columns(df, ["absent"], "set")


def test_filters(spark):
    df = spark.createDataFrame([(1, [("user", "a")]), (2, []), (3, None)], f"id int, messages {MSG}")
    assert [r.id for r in sft_filter(df).collect()] == [1]
    assert sft_filter(df.drop("messages")).count() == 0
    pairs = spark.createDataFrame(
        [(1, "c", [("user", "a")]), (2, "", [("user", "a")]), (3, "c", []), (4, None, [("user", "a")]), (5, "c", None)],
        f"id int, chosen string, rejected {MSG}",
    )
    assert [r.id for r in dpo_filter(pairs).collect()] == [1]
    assert dpo_filter(pairs.drop("rejected")).count() == 0


def test_filter_does_not_run_a_transform_twice(spark):
    df = spark.createDataFrame([("[]",)], "messages string")
    plan = sft_filter(apply_transform(df, "orca_agentinstruct_1m", enforce_schema=True))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") + text.count("jsontostructs") == 1


def test_first_message_list(spark):
    df = spark.createDataFrame([([], [("user", "b")]), (None, [])], f"messages {MSG}, chosen {MSG}")
    got = df.select(first_message_list(df, ["messages", "chosen", "absent"]).alias("m")).collect()
    assert [r.m for r in got] == [[("user", "b")], None]
    assert df.select(first_message_list(df.drop("messages", "chosen")).alias("m")).first().m is None


def test_row_wise_steps_run_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("p", "c"), ("", None)], "prompt string, chosen string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("prompt string, chosen string").parquet(str(tmp_path / "in"))
    shaped = sft_filter(apply_transform(stream, "human_like_dpo", enforce_schema=True))
    running = (
        shaped.withColumn("n", F.size("messages"))
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
