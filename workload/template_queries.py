"""Rendering and loss-mask queries on whole conversations."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from chatloom.operators import templates as t
from workload import shapes
from workload.transform_queries import FACTS, TURNS

QUERIES = {}
ORACLES = {}

OPTIONS = t.RenderOptions(eos="</s>", bos="<s>", current_date="2025-01-31")
TOOLS = [
    {
        "name": "search",
        "description": "Find pages.",
        "parameters": {
            "properties": {
                "query": {"type": "string", "description": "What to look for."},
                "limit": {"type": "integer", "default": 10},
                "kinds": {"type": "array", "items": {"type": "string"}},
            },
            "required": ["query"],
        },
    }
]
TOOLS_JSON = (
    '[{"name": "search", "description": "Find pages.", "parameters": {"properties": {"query": {"type": "string", '
    '"description": "What to look for."}, "limit": {"type": "integer", "default": 10}, "kinds": {"type": "array", '
    '"items": {"type": "string"}}}, "required": ["query"]}}]'
)
SIGNATURES = (
    "// Find pages.\ntype search = (_: {\n// What to look for.\nquery: string,\n"
    "limit?: number, // default: 10,\nkinds?: string[]\n}) => any;"
)
THINK_SYSTEM = (
    "<|im_start|>system\nYou are Olmo, a helpful AI assistant built by Ai2. Your date cutoff is December 2024, and "
    "your model weights are available at https://huggingface.co/allenai.<|im_end|>\n"
)
PLAIN_SYSTEM = (
    "<|im_start|>system\nYou are a helpful function-calling AI assistant. You do not currently have access to any "
    "functions. <functions></functions><|im_end|>\n"
)
TOOL_SYSTEM = (
    "<|im_start|>system\nYou are a helpful function-calling AI assistant. You are provided with function signatures "
    "within <functions></functions> XML tags. You may call one or more functions to assist with the user query. Output "
    "any function calls within <function_calls></function_calls> XML tags. Do not make assumptions about what values "
    f"to plug into functions.<functions>{TOOLS_JSON}</functions><|im_end|>\n"
)
NO_FUNCTIONS = " You do not currently have access to any functions. <functions></functions>"


def lit(text: str) -> str:
    """A Python text as a SQL literal."""
    return "'" + text.replace("'", "''") + "'"


SYSTEMS = "SELECT id FROM turns WHERE role = 'system'"
LAST = "pos = max(pos) OVER (PARTITION BY id)"


def olmo_segments(default_system: str, system_tail: str, eos: str = "</s>") -> str:
    """CTE ``segs(id, turn, part, text, train)``; assistant bodies are the trained part."""
    return f"""ends AS (SELECT *, {LAST} AS is_last FROM turns),
segs AS (
  SELECT DISTINCT id, -1 AS turn, 0 AS part, {lit(default_system)} AS text, false AS train
  FROM turns WHERE id NOT IN ({SYSTEMS})
  UNION ALL SELECT id, pos, 0, CASE role
    WHEN 'system' THEN {lit("<|im_start|>system" + chr(10))} || content || {lit(system_tail + "<|im_end|>" + chr(10))}
    WHEN 'user' THEN {lit("<|im_start|>user" + chr(10))} || content || {lit("<|im_end|>" + chr(10))}
    ELSE {lit("<|im_start|>assistant" + chr(10))} END, false FROM ends
  UNION ALL SELECT id, pos, 1, content || CASE WHEN is_last THEN {lit(eos)} ELSE {lit("<|im_end|>" + chr(10))} END, true
  FROM ends WHERE role = 'assistant')"""


JOINED = "SELECT id, string_agg(text, '' ORDER BY turn, part) AS text FROM segs GROUP BY id"


def query(name: str, sql: str):
    def add(fn):
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn

    return add


def _render(name: str, options: t.RenderOptions = OPTIONS):
    def run(spark, sf_dir):
        return t.render(shapes.chats(spark, sf_dir), name, options).select("id", "text")

    return run


query(
    "render_chatml",
    f"""WITH {TURNS}
SELECT id, string_agg('<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM turns GROUP BY id""",
)(_render("chatml"))

query(
    "render_tulu3",
    f"""WITH {TURNS}, ends AS (SELECT *, {LAST} AS is_last FROM turns)
SELECT id, string_agg('<|' || role || '|>' || chr(10) || content || CASE
  WHEN role <> 'assistant' THEN chr(10) WHEN is_last THEN '</s>' ELSE '</s>' || chr(10) END, '' ORDER BY pos)
  || '<|assistant|>' || chr(10) AS text
FROM ends GROUP BY id""",
)(_render("tulu3", t.RenderOptions(eos="</s>", add_generation_prompt=True)))

query("render_olmo3", f"WITH {TURNS}, {olmo_segments(THINK_SYSTEM, NO_FUNCTIONS)} {JOINED}")(_render("olmo3"))
query("render_think", f"WITH {TURNS}, {olmo_segments(THINK_SYSTEM, NO_FUNCTIONS)} {JOINED}")(_render("olmo3-think-sft"))
query("render_instruct", f"WITH {TURNS}, {olmo_segments(PLAIN_SYSTEM, '')} {JOINED}")(_render("olmo3-instruct-sft"))
query(
    "render_instruct_tools",
    f"WITH {TURNS}, {olmo_segments(TOOL_SYSTEM, '<functions>' + TOOLS_JSON + '</functions>')} {JOINED}",
)(_render("olmo3-instruct-sft", t.RenderOptions(eos="</s>", tools=TOOLS)))


def _block_sql(source: str, tools: str, tail: str = "''") -> str:
    """Turns of *source*; neighbouring assistant turns share one opening, tools print as a list."""
    head = (
        "<s><|system_start|>{}<|system_end|><|developer_start|>Deliberation: disabled\nTool Capabilities:"
        + tools
        + "<|developer_end|>"
    )
    before, after = head.split("{}")
    default = (
        "You are Apertus, a helpful assistant created by the SwissAI initiative.\nKnowledge cutoff: 2024-04\n"
        "Current date: 2025-01-31"
    )
    return f"""near AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM {source} WINDOW w AS (PARTITION BY id ORDER BY pos)),
shown AS (
  SELECT id, pos, CASE role
    WHEN 'user' THEN '<|user_start|>' || content || '<|user_end|>'
    WHEN 'tool' THEN CASE before WHEN 'tool' THEN ', ' ELSE '[' END || content
      || CASE WHEN after IS DISTINCT FROM 'tool' THEN ']' ELSE '' END
    WHEN 'assistant' THEN CASE WHEN before IN ('assistant', 'tool') THEN '' ELSE '<|assistant_start|>' END || content
    ELSE '' END
    || CASE WHEN role IN ('assistant', 'tool') AND coalesce(after, 'user') = 'user' THEN '<|assistant_end|>' ELSE '' END AS text
  FROM near)
SELECT id, {lit(before)} || coalesce(max(s.content), {lit(default)}) || {lit(after)}
  || string_agg(shown.text, '' ORDER BY pos) || {tail} AS text
FROM shown LEFT JOIN (SELECT id, content FROM {source} WHERE role = 'system') s USING (id) GROUP BY id"""


query("render_apertus_text", f"WITH {TURNS}, {_block_sql('turns', ' disabled')}")(_render("apertus"))


@query(
    "render_apertus_tools",
    f"""WITH {TURNS}, {FACTS}, doubled AS (
  SELECT id, pos * 3 AS pos, role, content FROM turns
  UNION ALL SELECT id, pos * 3 + 1, 'tool', 'result' FROM turns WHERE role = 'assistant'
  UNION ALL SELECT id, pos * 3 + 2, 'tool', content FROM turns WHERE role = 'assistant'),
{_block_sql("doubled", chr(10) + SIGNATURES, "'<|assistant_start|>'")}""",
)
def render_apertus_tools(spark, sf_dir):
    """Each assistant turn is followed by two tool results."""
    rows = shapes.chats(spark, sf_dir).withColumn(
        "messages",
        F.expr(
            """flatten(transform(messages, m -> CASE WHEN m.role = 'assistant' THEN
                 array(m, struct('tool' AS role, 'result' AS content), struct('tool' AS role, m.content AS content))
               ELSE array(m) END))"""
        ),
    )
    options = t.RenderOptions(bos="<s>", current_date="2025-01-31", tools=TOOLS, add_generation_prompt=True)
    return t.render(rows, "apertus", options).select("id", "text")


@query(
    "render_apertus_blocks",
    f"""WITH {TURNS}, {FACTS}
SELECT id, '<s><|system_start|>{{}}<|system_end|><|developer_start|>Deliberation: enabled' || chr(10)
  || 'Tool Capabilities: disabled<|developer_end|>' || string_agg(CASE role
    WHEN 'assistant' THEN '<|assistant_start|><|inner_prefix|>' || content || '<|tools_prefix|>[{{"look": {{"n": 1}}}}]<|tools_suffix|>'
      || '[found]<|inner_suffix|>' || content || '<|assistant_end|>'
    ELSE '<|user_start|>' || content || '<|image|><|user_end|>' END, '' ORDER BY pos) AS text
FROM turns GROUP BY id""".replace("{}<|system_end|>", "You are Apertus, a helpful assistant created by the SwissAI "
                                  "initiative.' || chr(10) || 'Knowledge cutoff: 2024-04' || chr(10) || "
                                  "'Current date: 2025-01-31<|system_end|>"),
)
def render_apertus_blocks(spark, sf_dir):
    """Turns with parts and inner blocks."""
    rows = shapes.chats(spark, sf_dir).withColumn(
        "messages",
        F.expr(
            """transform(messages, m -> struct(
                 CASE m.role WHEN 'assistant' THEN m.role ELSE 'user' END AS role,
                 struct(
                   CASE WHEN m.role <> 'assistant' THEN
                     array(struct('text' AS type, m.content AS text), struct('image' AS type, NULL AS text)) END AS parts,
                   CASE WHEN m.role = 'assistant' THEN array(
                     named_struct('type', 'thoughts', 'text', m.content, 'calls', NULL, 'outputs', NULL),
                     named_struct('type', 'tool_calls', 'text', NULL,
                                  'calls', array(struct('look' AS name, '{"n": 1}' AS arguments)), 'outputs', NULL),
                     named_struct('type', 'tool_outputs', 'text', NULL, 'calls', NULL,
                                  'outputs', array(struct('found' AS output))),
                     named_struct('type', 'response', 'text', m.content, 'calls', NULL, 'outputs', NULL)) END AS blocks
                 ) AS content))"""
        ),
    )
    options = t.RenderOptions(bos="<s>", current_date="2025-01-31", enable_thinking=True)
    return t.render(rows, "apertus", options).select("id", "text")


@query(
    "render_function_fields",
    f"""WITH {TURNS}, ends AS (SELECT *, {LAST} AS is_last FROM turns)
SELECT id, (CASE WHEN id IN ({SYSTEMS}) THEN '' ELSE {lit(THINK_SYSTEM)} END) || string_agg(CASE role
  WHEN 'system' THEN '<|im_start|>system' || chr(10) || content || ' <functions>f()</functions><|im_end|>' || chr(10)
  WHEN 'user' THEN '<|im_start|>user' || chr(10) || content || chr(10) || '<functions>f()</functions><|im_end|>' || chr(10)
  ELSE '<|im_start|>assistant' || chr(10) || CASE WHEN is_last THEN '' ELSE content END
    || '<function_calls>f(x=1)</function_calls>' || CASE WHEN is_last THEN '</s>' ELSE '<|im_end|>' || chr(10) END
  END, '' ORDER BY pos) || '<|im_start|>assistant' || chr(10) || '<think>' AS text
FROM ends GROUP BY id""",
)
def render_function_fields(spark, sf_dir):
    """Native message fields ``functions`` and ``function_calls``, and a content that is NULL."""
    rows = shapes.chats(spark, sf_dir).withColumn(
        "messages",
        F.expr(
            """transform(messages, (m, i) -> struct(
                 m.role AS role,
                 CASE WHEN m.role = 'assistant' AND i = size(messages) - 1 THEN NULL ELSE m.content END AS content,
                 CASE WHEN m.role <> 'assistant' THEN 'f()' END AS functions,
                 CASE WHEN m.role = 'assistant' THEN 'f(x=1)' END AS function_calls))"""
        ),
    )
    options = t.RenderOptions(eos="</s>", add_generation_prompt=True)
    return t.render(rows, "olmo3-think-sft", options).select("id", "text")


@query(
    "render_tool_calls",
    f"""WITH {TURNS}, ends AS (SELECT *, {LAST} AS is_last FROM turns)
SELECT id, (CASE WHEN id IN ({SYSTEMS}) THEN '' ELSE {lit(PLAIN_SYSTEM)} END) || string_agg(CASE role
  WHEN 'assistant' THEN '<|im_start|>assistant' || chr(10) || content || '<function_calls>look(n=' || length(content)
    || ', tags=["a", null], at={{"x": 0.5, "y": true}})' || chr(10) || 'stop(n=null, tags=null, at=null)</function_calls>'
    || CASE WHEN is_last THEN '</s>' ELSE '<|im_end|>' || chr(10) END
  ELSE '<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10) END, '' ORDER BY pos) AS text
FROM ends GROUP BY id""".replace("{{", "{").replace("}}", "}"),
)
def render_tool_calls(spark, sf_dir):
    """Typed call arguments, printed natively."""
    rows = shapes.chats(spark, sf_dir).withColumn(
        "messages",
        F.expr(
            """transform(messages, m -> struct(m.role AS role, m.content AS content,
                 CASE WHEN m.role = 'assistant' THEN array(
                   struct(struct('look' AS name, struct(length(m.content) AS n, array('a', NULL) AS tags,
                     struct(0.5D AS x, true AS y) AS at) AS arguments) AS function),
                   struct(struct('stop' AS name, struct(CAST(NULL AS INT) AS n, CAST(NULL AS ARRAY<STRING>) AS tags,
                     CAST(NULL AS STRUCT<x: DOUBLE, y: BOOLEAN>) AS at) AS arguments) AS function)) END AS tool_calls))"""
        ),
    )
    return t.render(rows, "olmo3-instruct-sft", OPTIONS).select("id", "text")


@query(
    "render_tool_calls_json",
    f"""WITH {TURNS}, ends AS (SELECT *, {LAST} AS is_last FROM turns)
SELECT id, (CASE WHEN id IN ({SYSTEMS}) THEN '' ELSE {lit(PLAIN_SYSTEM)} END) || string_agg(CASE role
  WHEN 'assistant' THEN '<|im_start|>assistant' || chr(10) || content || '<function_calls>look(n=' || length(content)
    || ', deep={{"k": [1, 2.5, null]}})</function_calls>' || CASE WHEN is_last THEN '</s>' ELSE '<|im_end|>' || chr(10) END
  ELSE '<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10) END, '' ORDER BY pos) AS text
FROM ends GROUP BY id""".replace("{{", "{").replace("}}", "}"),
)
def render_tool_calls_json(spark, sf_dir):
    """Call arguments that come as JSON text."""
    rows = shapes.chats(spark, sf_dir).withColumn(
        "messages",
        F.expr(
            """transform(messages, m -> struct(m.role AS role, m.content AS content,
                 CASE WHEN m.role = 'assistant' THEN array(struct(struct('look' AS name,
                   concat('{"n":', length(m.content), ',"deep":{"k":[1,2.5,null]}}') AS arguments) AS function)) END AS tool_calls))"""
        ),
    )
    return t.render(rows, "olmo3-instruct-sft", OPTIONS).select("id", "text")


@query(
    "render_tools_column",
    f"WITH {TURNS}, {olmo_segments(TOOL_SYSTEM, '')} {JOINED}",
)
def render_tools_column(spark, sf_dir):
    """A JSON tool list per chat; chats with their own system turn have none."""
    facts = shapes.chat_facts(shapes.chats(spark, sf_dir))
    tools = F.when(~F.col("has_system"), F.lit(json.dumps(TOOLS, separators=(",", ":"))))
    options = t.RenderOptions(eos="</s>", tools_column="tools")
    return t.render(facts.withColumn("tools", tools), "olmo3-instruct-sft", options).select("id", "text")


def _segments(spark, sf_dir, name="olmo3-think-sft"):
    return t.render_segments(shapes.chats(spark, sf_dir), t.require_markers(name), OPTIONS)


def _flat_segments(df):
    return df.select("id", F.posexplode("segments").alias("seg", "s")).select(
        "id", F.col("seg").cast("bigint").alias("seg"), "s.text", "s.train"
    )


NUMBERED = "row_number() OVER (PARTITION BY id ORDER BY turn, part) - 1 AS seg"


@query(
    "mask_segments",
    f"WITH {TURNS}, {olmo_segments(THINK_SYSTEM, NO_FUNCTIONS)} SELECT id, {NUMBERED}, text, train FROM segs",
)
def mask_segments(spark, sf_dir):
    return _flat_segments(_segments(spark, sf_dir))


@query(
    "mask_last_turn",
    f"""WITH {TURNS}, {olmo_segments(PLAIN_SYSTEM, "")}
SELECT id, {NUMBERED}, text, train AND turn = max(turn) FILTER (train) OVER (PARTITION BY id) AS train FROM segs""",
)
def mask_last_turn(spark, sf_dir):
    rows = _segments(spark, sf_dir, "olmo3-instruct-sft")
    return _flat_segments(rows.withColumn("segments", t.train_last_turn_only(F.col("segments"))))


# -- a template of one's own ----------------------------------------------------------------------


def _house(turns: t.Turns, options: t.RenderOptions):
    def one(m, i):
        text = F.concat(F.upper(m["role"]), F.lit(": "), m["content"], F.lit("\n"))
        return F.struct(text.alias("text"), (m["role"] == "assistant").alias("train"), i.cast("int").alias("turn"))

    return F.transform(turns.column, one)


@query(
    "own_template",
    f"""WITH {TURNS}
SELECT id, string_agg(upper(role) || ': ' || content || chr(10), '' ORDER BY pos) AS text,
  count(*) FILTER (role = 'assistant') AS n_trained, true AS marked, false AS unmarked, 1 AS n_refused
FROM turns GROUP BY id""",
)
def own_template(spark, sf_dir):
    """Registered, found by name, accepted for training by the marks in its text; one without marks is refused."""
    plain = "{{ messages }}"
    t.register_template(t.Template("house", _house, source="{% generation %}{{ messages }}{% endgeneration %}"))
    t.register_template(t.Template("house-plain", _house, source=plain))
    refused = 0
    try:
        t.require_markers("house-plain")
    except ValueError:
        refused += 1
    rows = t.render_segments(shapes.chats(spark, sf_dir), t.require_markers("house"), OPTIONS)
    trained = F.size(F.filter("segments", lambda x: x["train"])).cast("bigint")
    return rows.select(
        "id",
        t.segments_text().alias("text"),
        trained.alias("n_trained"),
        F.lit(t.has_generation_markers(t.get_template("house"))).alias("marked"),
        F.lit(t.has_generation_markers(plain)).alias("unmarked"),
        F.lit(refused).alias("n_refused"),
    )
