"""The 26 dataset transforms as native column expressions.

Conventions:

* a transform *rejects* a row by giving an empty list; the row filter then drops it;
* rows that have no valid reading (a NULL where text is needed, an unknown role,
  broken JSON) are *bad*: they fail the job, or become a NULL list with
  ``on_bad_row='drop'`` so that they can be counted;
* column names follow the public datasets that each transform is made for.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.basics import SPACE, SPACE_CHARS, fail_when, let, py_strip, truthy
from chatloom.functions.turns import (
    answer_after,
    merge_turns,
    narrow,
    no_turns,
    pair,
    role_from,
    turn,
    with_system,
)
from chatloom.operators.registry import register_transform


def _has(schema: T.StructType, name: str) -> bool:
    return name in schema.fieldNames()


def _text(schema: T.StructType, name: str, default: str | None = "") -> Column:
    """A column that may be absent from the dataset."""
    return F.col(name) if _has(schema, name) else F.lit(default).cast("string")


def _truth(schema: T.StructType, name: str) -> Column:
    return truthy(F.col(name), schema[name].dataType)


def _element_fields(schema: T.StructType, name: str) -> list[str]:
    return schema[name].dataType.elementType.fieldNames()


# -- renames --------------------------------------------------------------------


@register_transform("rename_to_messages")
def rename_to_messages(schema: T.StructType, on_bad_row: str) -> Column:
    for name in ("conversation", "conversations", "dialog"):
        if _has(schema, name):
            return F.col(name)
    raise KeyError(f"No column of {schema.fieldNames()} holds a conversation.")


@register_transform("ultrafeedback")
def ultrafeedback(schema: T.StructType, on_bad_row: str) -> Column:
    return F.col("chosen")


@register_transform("capybara_dpo")
def capybara_dpo(schema: T.StructType, on_bad_row: str) -> Column:
    return F.col("chosen")


@register_transform("lmsys_chat")
def lmsys_chat(schema: T.StructType, on_bad_row: str) -> Column:
    return F.col("conversation")


# -- prompt and answer pairs ----------------------------------------------------


@register_transform("instruction_response_to_messages")
def instruction_response_to_messages(schema: T.StructType, on_bad_row: str) -> Column:
    def either(first: str, second: str) -> Column:
        fallback = _text(schema, second)
        if not _has(schema, first):
            return fallback
        return F.when(F.length(first) > 0, F.col(first)).otherwise(fallback)

    return pair(either("instruction", "input"), either("response", "output"))


@register_transform("human_like_dpo")
def human_like_dpo(schema: T.StructType, on_bad_row: str) -> Column:
    return pair(F.col("prompt"), F.col("chosen"))


@register_transform("math_preference")
def math_preference(schema: T.StructType, on_bad_row: str) -> Column:
    return pair(F.col("instruction"), F.col("chosen_response"))


@register_transform("intel_orca_dpo")
def intel_orca_dpo(schema: T.StructType, on_bad_row: str) -> Column:
    return with_system(_text(schema, "system"), pair(F.col("input"), F.col("chosen")))


@register_transform("truthy_dpo")
def truthy_dpo(schema: T.StructType, on_bad_row: str) -> Column:
    return with_system(_text(schema, "system"), pair(F.col("prompt"), F.col("chosen")))


@register_transform("stanfordnlp_shp")
def stanfordnlp_shp(schema: T.StructType, on_bad_row: str) -> Column:
    better = F.when(F.col("labels") == 1, F.col("human_ref_A")).otherwise(F.col("human_ref_B"))
    return pair(F.col("history"), better)


@register_transform("helpsteer2")
def helpsteer2(schema: T.StructType, on_bad_row: str) -> Column:
    strength = F.col("preference_strength")
    better = F.when(strength > 0, F.col("response_2")).otherwise(F.col("response_1"))
    return fail_when(
        strength.isNull(), "preference_strength is null", pair(F.col("prompt"), better), on_bad_row
    )


@register_transform("arena_preference")
def arena_preference(schema: T.StructType, on_bad_row: str) -> Column:
    a_wins = _truth(schema, "winner_model_a") | _truth(schema, "winner_tie")
    better = F.when(a_wins, F.col("response_a")).otherwise(F.col("response_b"))
    prompt = F.col("prompt")
    if isinstance(schema["prompt"].dataType, T.ArrayType):
        return fail_when(
            F.exists(prompt, lambda p: p.isNull()),
            "null part in prompt",
            pair(F.array_join(prompt, "\n"), better),
            on_bad_row,
        )
    return pair(prompt, better)


@register_transform("aegis_safety")
def aegis_safety(schema: T.StructType, on_bad_row: str) -> Column:
    keep = F.col("response_label").eqNullSafe("unsafe") & ~F.col("prompt").eqNullSafe("REDACTED")
    return F.when(keep, pair(F.col("prompt"), F.col("response"))).otherwise(no_turns())


@register_transform("berkeley_nest_nectar")
def berkeley_nest_nectar(schema: T.StructType, on_bad_row: str) -> Column:
    prompt = F.regexp_replace("prompt", rf"(?iu)\A{SPACE}*Human:{SPACE}*", "")

    def without_label(text: Column) -> Column:
        """Cut the label off the end; only the last characters are looked at."""
        tail = F.rtrim(text, F.lit(SPACE_CHARS))
        label = F.rlike(F.right(tail, F.lit(10)), F.lit(r"(?iu)\AAssistant:\z"))
        rest = F.rtrim(F.left(tail, F.length(tail) - 10), F.lit(SPACE_CHARS))
        return F.when(label, rest).otherwise(text)

    prompt = let(prompt, without_label)
    answers = F.col("answers")

    def pick(best: Column) -> Column:
        return (
            F.when(F.size(best) > 0, F.get(best, F.lit(0))["answer"])
            .when(F.size(answers) > 0, F.get(answers, F.lit(0))["answer"])
            .otherwise("")
        )

    best = let(F.filter(answers, lambda a: a["rank"] == 1), pick)
    answer = F.when(answers.isNull(), F.lit("")).otherwise(best)
    return fail_when(F.col("prompt").isNull(), "prompt is null", pair(prompt, answer), on_bad_row)


# -- lists of turns -------------------------------------------------------------


def _without_tools(schema: T.StructType, turns: Column, fields: list[str], on_bad_row: str) -> Column:
    """Reject rows that use tools, else merge neighbouring turns of one role."""
    bad = turns.isNull() | (F.size(turns) == 0)
    merged = fail_when(bad, "messages is null or empty", merge_turns(turns, fields, on_bad_row), on_bad_row)
    if not _has(schema, "chat_template_kwargs"):
        return merged
    kwargs = F.col("chat_template_kwargs")
    kwargs_type = schema["chat_template_kwargs"].dataType
    uses_tools = F.lit(False)
    for name in ("python_tools", "xml_tools"):
        if name in kwargs_type.fieldNames():
            uses_tools = uses_tools | truthy(kwargs[name], kwargs_type[name].dataType)
    rejected = F.when(uses_tools, F.slice(turns, 1, 0) if fields != ["content", "role"] else no_turns())
    return fail_when(
        kwargs.isNull(), "chat_template_kwargs is null", rejected.otherwise(merged), on_bad_row
    )


@register_transform("smoltalk2")
def smoltalk2(schema: T.StructType, on_bad_row: str) -> Column:
    fields = _element_fields(schema, "messages")
    return _without_tools(schema, F.col("messages"), fields, on_bad_row)


@register_transform("smoltalk2_preference")
def smoltalk2_preference(schema: T.StructType, on_bad_row: str) -> Column:
    sources = [c for c in ("messages", "chosen") if _has(schema, c)]
    if not sources:
        return no_turns()
    fields = _element_fields(schema, sources[0])
    turns = F.col(sources[-1])
    if len(sources) == 2:
        turns = F.when(F.size("messages") > 0, F.col("messages")).otherwise(F.col("chosen"))
    empty = F.coalesce(F.size(turns) == 0, F.lit(True))
    return F.when(empty, F.slice(F.coalesce(turns, F.array()), 1, 0)).otherwise(
        _without_tools(schema, turns, fields, on_bad_row)
    )


@register_transform("perfectblend")
def perfectblend(schema: T.StructType, on_bad_row: str) -> Column:
    turns = F.col("conversations")
    names = {"human": "user", "gpt": "assistant"}
    bad = F.exists(turns, lambda m: ~F.coalesce(m["from"].isin(*names), F.lit(False)) | m["value"].isNull())
    clean = F.transform(turns, lambda m: turn(role_from(m["from"], names), py_strip(m["value"])))
    merged = merge_turns(clean, ["content", "role"], on_bad_row)
    return F.when(
        F.size(turns) > 0,
        fail_when(bad, "unknown role or null value in conversations", merged, on_bad_row),
    ).otherwise(no_turns())


def _is_json_list(text: Column) -> Column:
    """Whether all of *text* is one JSON list, of any size, as ``json.loads`` takes it."""

    @F.arrow_udf("boolean")
    def run(texts: pa.Array) -> pa.Array:
        def valid(value: str | None) -> bool:
            try:
                return value is not None and isinstance(json.loads(value), list)
            except (ValueError, RecursionError):
                return False

        return pa.array([valid(t.as_py()) for t in texts], pa.bool_())

    return run(text)


@register_transform("orca_agentinstruct_1m")
def orca_agentinstruct_1m(schema: T.StructType, on_bad_row: str) -> Column:
    text = F.col("messages")
    valid = F.coalesce(_is_json_list(text), F.lit(False))
    options = {"maxStringLen": str((1 << 31) - 1), "maxNestingDepth": str((1 << 31) - 1)}
    parsed = F.from_json(text, "array<struct<content:string,role:string>>", options)
    return let(
        F.when(valid, parsed),
        lambda turns: fail_when(
            turns.isNull(), "messages is not a JSON list of turns", turns, on_bad_row
        ),
    )


@register_transform("anthropic_hh_rlhf")
def anthropic_hh_rlhf(schema: T.StructType, on_bad_row: str) -> Column:
    blob = F.col("chosen")
    marked = F.regexp_extract_all(
        blob, F.lit(r"(?:Human|Assistant):[\s\S]+?(?=(?:Human|Assistant):|\z)"), F.lit(0)
    )
    turns = F.transform(
        marked,
        lambda t: F.when(
            F.startswith(t, F.lit("Human:")), turn("user", py_strip(F.substr(t, F.lit(7))))
        ).otherwise(turn("assistant", py_strip(F.substr(t, F.lit(11))))),
    )
    merged = merge_turns(turns, ["content", "role"], on_bad_row)
    return fail_when(blob.isNull(), "chosen is null", merged, on_bad_row)


@register_transform("comparia_votes")
def comparia_votes(schema: T.StructType, on_bad_row: str) -> Column:
    equal = _truth(schema, "both_equal")
    name_a = F.col("model_a_name")
    winner = F.when(equal, name_a).otherwise(F.col("chosen_model_name"))
    no_winner = ~equal & F.col("chosen_model_name").isNull()
    is_a = winner.eqNullSafe(name_a)

    def flag(prefix: str, value: bool) -> Column:
        def one(side: str) -> Column:
            name = f"{prefix}_{side}"
            return F.col(name).eqNullSafe(value) if _has(schema, name) else F.lit(False)

        return F.when(is_a, one("a")).otherwise(one("b"))

    def side(name: str) -> Column:
        return F.when(is_a, F.col(f"{name}_a")).otherwise(F.col(f"{name}_b"))

    conversation = F.when(is_a, narrow(F.col("conversation_a"))).otherwise(
        narrow(F.col("conversation_b"))
    )
    turns = with_system(py_strip(side("system_prompt")), conversation)

    def merged(t: Column) -> Column:
        return fail_when(
            t.isNull() | (F.size(t) == 0),
            "conversation of the preferred side is null or empty",
            merge_turns(t, ["content", "role"], on_bad_row),
            on_bad_row,
        )

    reject = no_winner | flag("conv_incorrect", True) | flag("conv_useful", False)
    return F.when(reject, no_turns()).otherwise(let(turns, merged))


@register_transform("mt_bench_judgments")
def mt_bench_judgments(schema: T.StructType, on_bad_row: str) -> Column:
    turns = F.col("conversation_b")
    return F.when(F.col("winner") == "model_b", turns).otherwise(
        F.slice(F.coalesce(turns, F.array()), 1, 0)
    )


# -- context plus one answer ----------------------------------------------------


@register_transform("helpsteer3_preference")
def helpsteer3_preference(schema: T.StructType, on_bad_row: str) -> Column:
    preference = F.col("overall_preference")
    better = F.when(preference > 0, F.col("response2")).otherwise(F.col("response1"))
    return fail_when(
        preference.isNull(),
        "overall_preference is null",
        answer_after(F.col("context"), better, on_bad_row),
        on_bad_row,
    )


# Rubric words, looked for in this order, and their scores.
FEEDBACK_GRADES = {"not": 0, "slightly": 1, "partially": 2, "mostly": 3, "perfectly": 4}


@register_transform("helpsteer3_feedback")
def helpsteer3_feedback(schema: T.StructType, on_bad_row: str) -> Column:
    def grade(feedback: Column) -> Column:
        opening = F.substring_index(feedback, ".", 1)
        out = F.lit(None).cast("int")
        for word, points in reversed(FEEDBACK_GRADES.items()):
            out = F.when(F.contains(opening, F.lit(word)), F.lit(points)).otherwise(out)
        return out

    def mean(name: str) -> Column:
        """NULL when the list is missing, empty, or holds a text without a rubric word."""
        total = F.aggregate(F.transform(name, grade), F.lit(0), lambda acc, g: acc + g)
        return F.when(F.size(name) > 0, total / F.size(name))

    def choose(scores: Column) -> Column:
        better = F.when(scores["one"] >= scores["two"], F.col("response1")).otherwise(F.col("response2"))
        return fail_when(
            scores["one"].isNull() | scores["two"].isNull(),
            "feedback without a rubric score",
            answer_after(F.col("context"), better, on_bad_row),
            on_bad_row,
        )

    return let(F.struct(mean("feedback1").alias("one"), mean("feedback2").alias("two")), choose)


@register_transform("helpsteer3_edit")
def helpsteer3_edit(schema: T.StructType, on_bad_row: str) -> Column:
    return answer_after(F.col("context"), F.col("edited_response"), on_bad_row)


@register_transform("helpsteer3_edit_quality")
def helpsteer3_edit_quality(schema: T.StructType, on_bad_row: str) -> Column:
    return answer_after(F.col("context"), F.col("good_edited_response"), on_bad_row)


@register_transform("helpsteer3_principle")
def helpsteer3_principle(schema: T.StructType, on_bad_row: str) -> Column:
    return F.when(F.col("fulfilment").eqNullSafe("No"), no_turns()).otherwise(
        answer_after(F.col("context"), F.col("response"), on_bad_row)
    )
