"""Queries t01-t26: each dataset transform on whole tables, one output row per turn."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions.turns import flatten_turns
from chatloom.operators.shaping import apply_transform, sft_filter
from workload import shapes

QUERIES = {}
ORACLES = {}


def _query(key: str, transform: str, sql: str, source, *columns):
    """Register one transform over ``source(spark, sf)`` with the given input columns."""

    def run(spark, sf_dir):
        rows = source(spark, sf_dir).select("id", *map(F.expr, columns))
        shaped = apply_transform(rows, transform, enforce_schema=True, carry=["id"])
        return flatten_turns(sft_filter(shaped), "id")

    QUERIES[key] = run
    ORACLES[key] = sql


def _chat_facts(spark, sf_dir):
    return shapes.chat_facts(shapes.chats(spark, sf_dir))


# -- SQL pieces -------------------------------------------------------------------

# White space as an RE2 class.
WHITESPACE = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

TURNS = """turns AS (
  SELECT conv_id AS id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, role, text AS content
  FROM conversations)"""
RELABELED = "relabeled AS (SELECT id, pos, CASE role WHEN 'system' THEN 'user' ELSE role END AS role, content FROM turns)"
FACTS = """facts AS (
  SELECT conv_id AS id, count(*) AS n, arg_min(text, turn) AS first_text, arg_max(text, turn) AS last_text,
         arg_min(role, turn) = 'system' AS has_system
  FROM conversations GROUP BY conv_id)"""


def merged(source: str) -> str:
    """CTEs that join neighbouring turns of one role of *source*(id, pos, role, content)."""
    return f"""marked AS (
  SELECT *, CASE WHEN lag(role) OVER (PARTITION BY id ORDER BY pos) = role THEN 0 ELSE 1 END AS opens FROM {source}),
runs AS (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY pos) AS run FROM marked),
merged AS (
  SELECT id, CAST(run - 1 AS BIGINT) AS pos, min(role) AS role, string_agg(content, chr(10) ORDER BY pos) AS content
  FROM runs GROUP BY id, run)"""


def strip(text: str) -> str:
    return f"regexp_replace({text}, '\\A{WHITESPACE}+|{WHITESPACE}+\\z', '', 'g')"


def _pair_sql(user: str, assistant: str, source: str = "documents", where: str = "true", doc_id: str = "doc_id") -> str:
    return f"""SELECT {doc_id} AS id, CAST(0 AS BIGINT) AS pos, 'user' AS role, {user} AS content FROM {source} WHERE {where}
UNION ALL SELECT {doc_id}, CAST(1 AS BIGINT), 'assistant', {assistant} FROM {source} WHERE {where}"""


def _system_pair_sql(system: str, user: str, assistant: str) -> str:
    shift = f"CASE WHEN length({system}) > 0 THEN 1 ELSE 0 END"
    return f"""SELECT doc_id AS id, CAST(0 AS BIGINT) AS pos, 'system' AS role, {system} AS content FROM documents WHERE length({system}) > 0
UNION ALL SELECT doc_id, CAST({shift} AS BIGINT), 'user', {user} FROM documents
UNION ALL SELECT doc_id, CAST({shift} + 1 AS BIGINT), 'assistant', {assistant} FROM documents"""


def _answer_sql(answer: str, where: str = "true") -> str:
    return f"""WITH {TURNS}, {FACTS}
SELECT id, pos, role, content FROM turns WHERE id IN (SELECT id FROM facts WHERE {where})
UNION ALL SELECT id, n, 'assistant', {answer} FROM facts WHERE {where}"""


LABELED = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
ALL_TURNS = f"WITH {TURNS} SELECT id, pos, role, content FROM turns"

# -- renames ----------------------------------------------------------------------

_query("t01_rename_to_messages", "rename_to_messages", ALL_TURNS, shapes.chats, "messages AS conversations")
_query("t12_ultrafeedback", "ultrafeedback", ALL_TURNS, shapes.chats, "messages AS chosen")
_query("t17_capybara_dpo", "capybara_dpo", ALL_TURNS, shapes.chats, "messages AS chosen")
_query("t21_lmsys_chat", "lmsys_chat", ALL_TURNS, shapes.chats, "messages AS conversation")

# -- prompt and answer pairs --------------------------------------------------------

_query(
    "t02_instruction_response_to_messages",
    "instruction_response_to_messages",
    _pair_sql(
        "CASE WHEN lang = 'en' AND length(text) > 0 THEN text ELSE source END",
        "CASE WHEN lang <> 'fr' AND length(text) > 0 THEN text ELSE lang END",
    ),
    shapes.documents,
    "CASE WHEN lang = 'en' THEN text ELSE '' END AS instruction",
    "source AS input",
    "CASE WHEN lang <> 'fr' THEN text END AS response",
    "lang AS output",
)
_query(
    "t08_stanfordnlp_shp",
    "stanfordnlp_shp",
    _pair_sql("text", "CASE WHEN quality = 1 THEN source ELSE lang END", LABELED),
    shapes.labeled_documents,
    "text AS history",
    "source AS human_ref_A",
    "lang AS human_ref_B",
    "quality AS labels",
)
_query(
    "t09_berkeley_nest_nectar",
    "berkeley_nest_nectar",
    _pair_sql(
        f"regexp_replace(regexp_replace(' human: ' || text || ' ASSISTANT:', '(?i)\\A{WHITESPACE}*Human:{WHITESPACE}*', ''),"
        f" '(?i){WHITESPACE}*Assistant:{WHITESPACE}*\\z', '')",
        """CASE WHEN lang = 'de' THEN '' WHEN lang = 'es' THEN source
             WHEN n_chars % 3 = 0 THEN source WHEN n_chars % 3 = 2 THEN lang ELSE text END""",
    ),
    shapes.spread_documents,
    "concat(' human: ', text, ' ASSISTANT:') AS prompt",
    """CASE WHEN lang <> 'de' THEN transform(
         array(struct(source AS answer, n_chars % 3 AS r), struct(lang AS answer, (n_chars + 1) % 3 AS r),
               struct(text AS answer, (n_chars + 2) % 3 AS r)),
         a -> struct(a.answer AS answer, CAST(a.r + IF(lang = 'es', 2, 1) AS DOUBLE) AS rank)) END AS answers""",
)
_query(
    "t10_arena_preference",
    "arena_preference",
    _pair_sql(
        "lang || chr(10) || source",
        "CASE WHEN quality = 1 OR toxic = 1 THEN text ELSE source END",
        LABELED,
    ),
    shapes.labeled_documents,
    "array(lang, source) AS prompt",
    "text AS response_a",
    "source AS response_b",
    "quality AS winner_model_a",
    "toxic AS winner_tie",
)
_query(
    "t13_aegis_safety",
    "aegis_safety",
    _pair_sql("source", "text", LABELED, "toxic = 1 AND lang <> 'de'"),
    shapes.labeled_documents,
    "CASE WHEN lang = 'de' THEN 'REDACTED' ELSE source END AS prompt",
    "text AS response",
    "CASE toxic WHEN 1 THEN 'unsafe' WHEN 0 THEN 'safe' END AS response_label",
)
_query(
    "t14_helpsteer2",
    "helpsteer2",
    _pair_sql("source", "CASE WHEN n_chars % 3 - 1 > 0 THEN lang ELSE text END"),
    shapes.documents,
    "source AS prompt",
    "text AS response_1",
    "lang AS response_2",
    "CAST(n_chars % 3 - 1 AS DOUBLE) AS preference_strength",
)
_SYSTEM = "CASE lang WHEN 'en' THEN source WHEN 'fr' THEN '' END"
_query(
    "t15_intel_orca_dpo",
    "intel_orca_dpo",
    _system_pair_sql(_SYSTEM, "source", "text"),
    shapes.documents,
    f"{_SYSTEM} AS system",
    "source AS input",
    "text AS chosen",
)
_query(
    "t16_human_like_dpo",
    "human_like_dpo",
    _pair_sql("source", "text"),
    shapes.documents,
    "source AS prompt",
    "text AS chosen",
)
_query(
    "t19_math_preference",
    "math_preference",
    _pair_sql("lang", "text"),
    shapes.documents,
    "lang AS instruction",
    "text AS chosen_response",
)
_query(
    "t20_truthy_dpo",
    "truthy_dpo",
    _system_pair_sql(_SYSTEM, "lang", "text"),
    shapes.documents,
    f"{_SYSTEM} AS system",
    "lang AS prompt",
    "text AS chosen",
)

# -- lists of turns -----------------------------------------------------------------

_KWARGS = """named_struct('python_tools', IF(n > 6, array('search'), array()),
                          'xml_tools', IF(n = 2, array('lookup'), NULL)) AS chat_template_kwargs"""
_query(
    "t03_smoltalk2",
    "smoltalk2",
    f"""WITH {TURNS}, {RELABELED}, {FACTS}, {merged("relabeled")}
SELECT id, pos, role, content FROM merged WHERE id IN (SELECT id FROM facts WHERE n <= 6 AND n <> 2)""",
    _chat_facts,
    f"{shapes.RELABELED} AS messages",
    _KWARGS,
)
_query(
    "t04_smoltalk2_preference",
    "smoltalk2_preference",
    f"""WITH {TURNS}, {RELABELED}, {FACTS},
picked AS (
  SELECT r.* FROM relabeled r JOIN facts USING (id) WHERE has_system
  UNION ALL SELECT t.* FROM turns t JOIN facts USING (id) WHERE NOT has_system),
{merged("picked")}
SELECT id, pos, role, content FROM merged""",
    _chat_facts,
    "IF(has_system, slice(messages, 1, 0), messages) AS messages",
    f"{shapes.RELABELED} AS chosen",
)
_query(
    "t05_perfectblend",
    "perfectblend",
    f"""WITH {TURNS}, {RELABELED},
stripped AS (SELECT id, pos, role, {strip("content")} AS content FROM relabeled),
{merged("stripped")}
SELECT id, pos, role, content FROM merged""",
    shapes.chats,
    r"""transform(messages, m -> struct(
          CASE m.role WHEN 'assistant' THEN 'gpt' ELSE 'human' END AS from,
          concat('\n \t', m.content, ' 　 ') AS value)) AS conversations""",
)
_query(
    "t06_orca_agentinstruct_1m",
    "orca_agentinstruct_1m",
    ALL_TURNS,
    shapes.chats,
    "to_json(messages) AS messages",
)
_query(
    "t07_anthropic_hh_rlhf",
    "anthropic_hh_rlhf",
    f"""WITH {TURNS}, {RELABELED},
stripped AS (SELECT id, pos, role, {strip("content")} AS content FROM relabeled),
{merged("stripped")}
SELECT id, pos, role, content FROM merged""",
    shapes.chats,
    r"""array_join(transform(messages, m -> concat(
          CASE m.role WHEN 'assistant' THEN '\n\nAssistant: ' ELSE '\n\nHuman: ' END, m.content)), '') AS chosen""",
)
_FIVE = "length(first_text) % 5"
_FOUR = "length(last_text) % 4"
_query(
    "t11_comparia_votes",
    "comparia_votes",
    f"""WITH {TURNS}, {RELABELED}, {FACTS},
votes AS (
  SELECT *, {_FIVE} IN (0, 1) AS is_a, {_FIVE} = 3 AS no_winner, {_FOUR} AS f FROM facts),
kept AS (
  SELECT * FROM votes
  WHERE NOT no_winner AND NOT (is_a AND f = 0) AND NOT (NOT is_a AND f = 1)),
system_turns AS (
  SELECT id, -1 AS pos, 'system' AS role, {strip("' ' || last_text || chr(10)")} AS content
  FROM kept WHERE is_a AND NOT has_system
  UNION ALL SELECT id, -1, 'system', 'plain' FROM kept WHERE NOT is_a AND has_system),
picked AS (
  SELECT t.* FROM turns t JOIN kept USING (id) WHERE is_a
  UNION ALL SELECT r.* FROM relabeled r JOIN kept USING (id) WHERE NOT is_a
  UNION ALL SELECT * FROM system_turns),
{merged("picked")}
SELECT id, pos, role, content FROM merged""",
    _chat_facts,
    f"{_FIVE} = 0 AS both_equal",
    f"CASE {_FIVE} WHEN 1 THEN 'm-a' WHEN 2 THEN 'm-b' WHEN 4 THEN 'm-other' END AS chosen_model_name",
    "'m-a' AS model_a_name",
    f"CASE {_FOUR} WHEN 0 THEN true WHEN 1 THEN false END AS conv_incorrect_a",
    "CAST(NULL AS BOOLEAN) AS conv_incorrect_b",
    "CAST(NULL AS BOOLEAN) AS conv_useful_a",
    f"CASE {_FOUR} WHEN 1 THEN false WHEN 2 THEN true END AS conv_useful_b",
    "messages AS conversation_a",
    f"{shapes.RELABELED} AS conversation_b",
    r"IF(has_system, ' \n ', concat(' ', last_text, '\n')) AS system_prompt_a",
    "IF(has_system, 'plain', NULL) AS system_prompt_b",
)
_query(
    "t18_mt_bench_judgments",
    "mt_bench_judgments",
    f"""WITH {TURNS}, {FACTS}
SELECT id, pos, role, content FROM turns WHERE id IN (SELECT id FROM facts WHERE {_FIVE} IN (1, 3))""",
    _chat_facts,
    f"CASE WHEN {_FIVE} IN (1, 3) THEN 'model_b' WHEN {_FIVE} = 0 THEN 'tie' ELSE 'model_a' END AS winner",
    "messages AS conversation_b",
)

# -- context plus one answer ----------------------------------------------------------

_query(
    "t22_helpsteer3_preference",
    "helpsteer3_preference",
    _answer_sql("CASE WHEN length(first_text) % 3 - 1 > 0 THEN last_text ELSE first_text END"),
    _chat_facts,
    "messages AS context",
    "first_text AS response1",
    "last_text AS response2",
    "CAST(length(first_text) % 3 - 1 AS DOUBLE) AS overall_preference",
)


def _grades(shift: int) -> str:
    words = "'not', 'slightly', 'partially', 'mostly', 'perfectly'"
    return f"transform(messages, m -> concat('is ', element_at(array({words}), (length(m.content) + {shift}) % 5 + 1), ' helpful. not more'))"


_query(
    "t23_helpsteer3_feedback",
    "helpsteer3_feedback",
    f"""WITH {TURNS}, {FACTS},
scores AS (
  SELECT id, avg(length(content) % 5) AS one, avg((length(content) + 2) % 5) AS two FROM turns GROUP BY id)
SELECT id, pos, role, content FROM turns
UNION ALL SELECT id, n, 'assistant', CASE WHEN one >= two THEN first_text ELSE last_text END
FROM facts JOIN scores USING (id)""",
    _chat_facts,
    "messages AS context",
    "first_text AS response1",
    "last_text AS response2",
    f"{_grades(0)} AS feedback1",
    f"{_grades(2)} AS feedback2",
)
_query(
    "t24_helpsteer3_edit",
    "helpsteer3_edit",
    _answer_sql("last_text"),
    _chat_facts,
    "messages AS context",
    "last_text AS edited_response",
)
_query(
    "t25_helpsteer3_edit_quality",
    "helpsteer3_edit_quality",
    _answer_sql("first_text"),
    _chat_facts,
    "messages AS context",
    "first_text AS good_edited_response",
)
_query(
    "t26_helpsteer3_principle",
    "helpsteer3_principle",
    _answer_sql("last_text", f"{_FIVE} <> 2"),
    _chat_facts,
    "messages AS context",
    "last_text AS response",
    f"CASE {_FIVE} WHEN 2 THEN 'No' WHEN 3 THEN 'Yes' END AS fulfilment",
)
