"""SQL twins of the registered queries, in the dialect of the checking engine.

``WITH`` parts are named in ``PARTS``; :func:`query` puts the needed ones, in order, before a
statement.
"""

from __future__ import annotations

import re

from tallgrass.functions.text import ID_BASE
from tallgrass.operators.governance import IDENTIFIERS, TIERS
from tallgrass.plans import inputs


def _text(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(names: str, data: list[tuple], casts: str = "") -> str:
    """A constant table."""
    body = ", ".join("(" + ", ".join(_text(v) for v in row) + ")" for row in data)
    return f"SELECT {casts or '*'} FROM (VALUES {body}) t({names})"


def pick(key: str, divisor: int, entries: dict[int, str]) -> str:
    """A text chosen by the remainder of a key, NULL for other remainders."""
    arms = " ".join(f"WHEN {k} THEN {_text(v)}" for k, v in entries.items())
    return f"(CASE ({key}) % {divisor} {arms} END)"


def unique_id(survey: str, parent: str, question: str, value: str) -> str:
    """The stable id of an answer."""
    parts = " || '|' || ".join(f"coalesce({p}, '')" for p in (survey, parent, question, value))
    return f"({ID_BASE} + CAST('0x' || substr(sha256({parts}), 1, 15) AS BIGINT))"


NUMBER = r"[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?"


def is_concept(v: str) -> str:
    return f"regexp_full_match({v}, '[0-9]{{9}}')"


def is_date(v: str) -> str:
    return f"regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"


def number(v: str) -> str:
    """The strict number in a text."""
    return f"(CASE WHEN regexp_full_match(trim({v}), '{NUMBER}') THEN TRY_CAST(trim({v}) AS DOUBLE) END)"


def typed(v: str) -> str:
    """The verbatim text and the three typed columns."""
    return f"""{v} AS response_value_as_string,
    CASE WHEN {is_concept(v)} THEN {v} END AS response_value_as_concept_id,
    CASE WHEN {is_date(v)} THEN TRY_CAST({v} AS DATE) END AS response_value_as_date,
    CASE WHEN NOT {is_concept(v)} AND NOT {is_date(v)} THEN {number(v)} END AS response_value_as_number"""


def _cells(module: str) -> str:
    names = [c for t, c, *_ in inputs.COLMAP if t == module and c != "d_199999999"]
    columns = ", ".join(names)
    return (
        f"SELECT connect_id, '{module}' AS table_name, source_column, value FROM {module}"
        f" UNPIVOT (value FOR source_column IN ({columns}))"
    )


def _shift(participant: str, salt: str, span: int) -> str:
    digest = f"CAST('0x' || substr(sha256('{salt}|' || {participant}), 1, 15) AS BIGINT)"
    return f"CAST({digest} % {2 * span + 1} - {span} AS INTEGER)"


FACT_COLUMNS = (
    "connect_id, secondary_source_concept_id, source_question_concept_id, question_concept_id, "
    "loop_instance, question_version, response_value_as_string, response_value_as_concept_id, "
    "response_value_as_date, response_value_as_number, response_unique_id, source_table, source_column"
)

PARTS: dict[str, str] = {
    "module_a": """
SELECT CAST(c.c_custkey AS VARCHAR) AS connect_id,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '200000001' WHEN 'BUILDING' THEN '200000002'
    WHEN 'FURNITURE' THEN '200000003' WHEN 'HOUSEHOLD' THEN '200000004' ELSE '200000005' END AS d_100000001,
  CASE WHEN c_custkey % 10 <> 0 THEN CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS d_100000002,
  CASE WHEN c_custkey % 3 = 0 THEN concat('note | ', c_name) WHEN c_custkey % 3 = 1 THEN '' END AS d_100000003,
  CASE c_custkey % 8 WHEN 0 THEN '2024-02-29' WHEN 1 THEN '2024-02-30' WHEN 2 THEN '2023-05' WHEN 3 THEN '12d'
    WHEN 4 THEN ' 12 ' WHEN 5 THEN '1e5' WHEN 6 THEN '1_000' END AS d_100000004,
  CASE WHEN c_custkey % 2 = 0 THEN '353358909' WHEN c_custkey % 4 = 1 THEN '104430631' END AS d_110000000_d_110000001,
  CASE WHEN c_custkey % 4 = 3 THEN '353358909' END AS d_110000000_d_110000001_v2,
  CASE WHEN c_custkey % 3 = 0 THEN '353358909' END AS d_110000000_d_110000002,
  CASE WHEN c_custkey % 5 = 0 THEN '353358909' END AS d_110000000_d_110000003_v2,
  l1 AS d_120000000_d_120000001_1, l2 AS d_120000000_d_120000001_2, l3 AS d_120000000_d_120000001_3,
  '163149180' AS d_784119588
FROM customer c LEFT JOIN (
  SELECT o_custkey, CAST(sum(v) FILTER (p IN ('1', '2')) AS VARCHAR) AS l1, CAST(sum(v) FILTER (p = '3') AS VARCHAR) AS l2,
    CAST(sum(v) FILTER (p IN ('4', '5')) AS VARCHAR) AS l3
  FROM (SELECT o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS v, left(o_orderpriority, 1) AS p FROM orders) x
  GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
    "module_b": """
SELECT CAST(s_suppkey AS VARCHAR) AS connect_id,
  CASE WHEN s_suppkey % 2 = 0 THEN '163149180' ELSE '773342525' END AS d_784119588,
  CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) AS d_100000011
FROM supplier""",
    "module_c": """
SELECT CAST(c_custkey AS VARCHAR) AS connect_id,
  CASE WHEN c_custkey % 11 <> 0 THEN CAST(4 + c_custkey % 3 AS VARCHAR) END AS d_114314839_d_340854069,
  CAST(c_custkey % 12 AS VARCHAR) AS d_114314839_d_600462977,
  CASE WHEN c_custkey % 17 = 0 THEN '0' ELSE CAST(100 + c_custkey % 250 AS VARCHAR) END AS d_746012894,
  CASE c_custkey % 4 WHEN 0 THEN '210000001' WHEN 1 THEN '210000002' WHEN 2 THEN '210000009' END AS d_367803647_d_367803647,
  CASE c_custkey % 5 WHEN 0 THEN '220000001' WHEN 1 THEN '220000002' WHEN 2 THEN '220000003' WHEN 3 THEN '220000004' END AS d_783167257,
  CASE c_custkey % 6 WHEN 0 THEN '230000001' WHEN 1 THEN '230000002' WHEN 2 THEN '230000003' WHEN 3 THEN '230000004'
    WHEN 4 THEN '230000005' END AS d_759004335,
  CASE c_custkey % 3 WHEN 0 THEN '353358909' WHEN 1 THEN '104430631' END AS d_947205597_d_712653855,
  CASE c_custkey % 5 WHEN 0 THEN '151488193' WHEN 1 THEN '805449318' WHEN 2 THEN '486319890' WHEN 3 THEN '132232896' END AS d_763164658,
  CASE c_custkey % 7 WHEN 0 THEN '419415087' WHEN 1 THEN '299561721' WHEN 2 THEN '716761013' WHEN 3 THEN '804785430'
    WHEN 4 THEN '419415087' END AS d_639684251,
  CASE c_custkey % 4 WHEN 0 THEN '317567178' WHEN 1 THEN '484055234' WHEN 2 THEN '802197176' END AS d_798549704
FROM customer""",
    "colmap": values(
        "table_name, source_column, secondary_source_concept_id, source_question_concept_id, "
        "question_concept_id, loop_instance, question_version",
        inputs.COLMAP,
        "table_name, source_column, secondary_source_concept_id, source_question_concept_id, "
        "question_concept_id, CAST(loop_instance AS BIGINT) AS loop_instance, question_version",
    ),
    "cells": " UNION ALL ".join(_cells(m) for m in inputs.MODULES),
    "fact": f"""
SELECT connect_id, secondary_source_concept_id, source_question_concept_id, question_concept_id, loop_instance,
  question_version, {typed('value')},
  {unique_id('secondary_source_concept_id', 'source_question_concept_id', 'question_concept_id', 'value')}
    AS response_unique_id,
  'clean.' || table_name AS source_table, source_column
FROM cells JOIN colmap USING (table_name, source_column)""",
    "primary_source": """
SELECT CAST(400000000 + r_regionkey AS VARCHAR) AS primary_source_concept_id, r_name AS primary_source FROM region""",
    "secondary_source": """
SELECT CASE n_nationkey WHEN 0 THEN '300000001' WHEN 1 THEN '300000002' WHEN 2 THEN '300000003'
    ELSE CAST(410000000 + n_nationkey AS VARCHAR) END AS secondary_source_concept_id,
  n_name AS secondary_source, CAST(400000000 + n_regionkey AS VARCHAR) AS primary_source_concept_id FROM nation""",
    "source_question": values(
        "source_question_concept_id, source_question_text, grid_name", inputs.SOURCE_QUESTIONS
    ),
    "question": values(
        "question_concept_id, question_text, question_type, secondary_source_concept_id, "
        "source_question_concept_id",
        inputs.QUESTIONS,
    ),
    "response": values(
        "response_concept_id, format_value",
        sorted({r: label for _, r, label in inputs.OPTION_LABELS if label}.items()),
    ),
    "question_response": values(
        "question_concept_id, response_concept_id", [(q, r) for q, r, _ in inputs.OPTION_LABELS]
    ),
    "parts": """
SELECT p_partkey AS k, p_name, p_brand, CAST(p_partkey % 25 AS BIGINT) AS nk, p_partkey // 25 AS j, n_name,
  CAST(n_regionkey AS BIGINT) AS rk, r_name,
  (n_regionkey * 100 + p_partkey % 25) * 1000000000000 + p_partkey // 25 AS rn
FROM part JOIN nation ON n_nationkey = p_partkey % 25 JOIN region ON r_regionkey = n_regionkey""",
    "sheet": f"""
SELECT CAST(rn AS BIGINT) AS rn,
  CASE WHEN nk < 5 AND j = 0 THEN CAST(rk + 400000000 AS VARCHAR) END AS prim_cid,
  CASE WHEN nk < 5 AND j = 0 THEN r_name END AS prim,
  CASE WHEN j = 0 THEN CAST(nk + 410000000 AS VARCHAR) END AS sec_cid,
  CASE WHEN j = 0 THEN n_name END AS sec,
  CASE WHEN j % 6 = 0 THEN CAST(j % 40 + 600000000 AS VARCHAR) END AS sq_cid,
  CASE WHEN j % 6 = 0 THEN 'Group ' || (j % 40) END AS sq_text,
  CASE WHEN j % 6 = 0 AND k % 4 = 0 THEN 'GRID' || (j % 40) END AS grid_name,
  CASE WHEN j % 3 = 0 THEN CAST((CASE WHEN k % 5 = 0 THEN j ELSE k END) + 500000000 AS VARCHAR) END AS q_cid,
  CASE WHEN j % 3 = 0 THEN p_name || ': ' || {pick('k', 14, inputs.ADDRESS_TEXTS)} END AS q_text,
  CASE WHEN j % 3 = 0 THEN {pick('k', 37, inputs.TYPE_TEXTS)} END AS q_type,
  CASE WHEN k % 13 <> 0 THEN CAST(k % 300 + 700000000 AS VARCHAR) END AS resp_cid,
  CASE WHEN k % 13 <> 0 THEN (k % 300) || ' = ' || p_brand END AS resp_fmt,
  CASE WHEN j % 3 = 0 THEN 'Srv_' || (k // 4) || '_v' || (1 + k % 3) || 'r' || (k % 2) END AS variable_label,
  CASE WHEN j % 3 = 0 THEN coalesce({pick('k', 5, inputs.STATUSES)}, '') END AS status,
  {pick('k', 6, {0: 'Yes', 1: 'No', 2: 'NO'})} AS pii
FROM parts""",
    "filled": """
SELECT *, last_value(prim_cid IGNORE NULLS) OVER w AS prim_cid_f, last_value(prim IGNORE NULLS) OVER w AS prim_f,
  last_value(sec_cid IGNORE NULLS) OVER w AS sec_cid_f, last_value(sec IGNORE NULLS) OVER w AS sec_f,
  last_value(q_cid IGNORE NULLS) OVER w AS q_cid_f
FROM sheet WINDOW w AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "d_primary_source": """
SELECT prim_cid AS primary_source_concept_id, arg_min(prim, rn) AS primary_source
FROM filled WHERE prim_cid IS NOT NULL GROUP BY prim_cid""",
    "d_secondary_source": """
SELECT sec_cid AS secondary_source_concept_id, arg_min(sec_f, rn) AS secondary_source,
  arg_min(prim_cid_f, rn) AS primary_source_concept_id
FROM filled WHERE sec_cid IS NOT NULL GROUP BY sec_cid""",
    "d_source_question": """
SELECT sq_cid AS source_question_concept_id, arg_min(sq_text, rn) AS source_question_text,
  arg_min(grid_name, rn) AS grid_name
FROM filled WHERE sq_cid IS NOT NULL GROUP BY sq_cid""",
    "d_question": """
SELECT q_cid AS question_concept_id, arg_min(q_text, rn) AS question_text, arg_min(q_type, rn) AS question_type,
  arg_min(sec_cid_f, rn) AS secondary_source_concept_id, arg_min(sq_cid, rn) AS source_question_concept_id
FROM filled WHERE q_cid IS NOT NULL GROUP BY q_cid""",
    "d_response": """
SELECT resp_cid AS response_concept_id, arg_min(resp_fmt, rn) AS format_value
FROM filled WHERE resp_cid IS NOT NULL GROUP BY resp_cid""",
    "d_question_response": """
SELECT DISTINCT q_cid_f AS question_concept_id, resp_cid AS response_concept_id
FROM filled WHERE resp_cid IS NOT NULL AND q_cid_f IS NOT NULL""",
    "addr": r"""
SELECT * FROM (SELECT question_concept_id AS cid, question_text AS txt,
  CASE WHEN regexp_matches(lower(question_text), 'street.*name|full street') THEN 'street_name'
    WHEN regexp_matches(lower(question_text), 'street.*number|number.*street') THEN 'street_number'
    WHEN regexp_matches(lower(question_text), 'apartment|apt|unit|suite') THEN 'apartment'
    WHEN regexp_matches(lower(question_text), '\bcity\b|town') THEN 'city'
    WHEN regexp_matches(lower(question_text), '\bstate\b|province') THEN 'state'
    WHEN regexp_matches(lower(question_text), 'zip|postal') THEN 'zip'
    WHEN regexp_matches(lower(question_text), 'country') THEN 'country' END AS component,
  CASE WHEN regexp_matches(lower(question_text), 'employer|work') THEN 'work'
    WHEN regexp_matches(lower(question_text), 'school') THEN 'school' ELSE 'residence' END AS address_class
  FROM d_question WHERE question_text IS NOT NULL) WHERE component IS NOT NULL""",
    "edges": """
SELECT cid AS concept_id_1, min(cid) OVER (PARTITION BY component, address_class) AS concept_id_2,
  'synonym' AS relationship,
  'demo: address ' || address_class || ' ' || component || ' (matched on question text)' AS relationship_source
FROM addr""",
    "names": r"""
SELECT (CASE p_partkey % 6 WHEN 0 THEN 'module0' WHEN 1 THEN 'module1_v1' WHEN 2 THEN 'module2'
    WHEN 3 THEN 'module3_V2' WHEN 4 THEN 'participants' ELSE 'unlisted' END) AS tbl,
  (CASE p_partkey % 12
    WHEN 0 THEN 'd_' || q WHEN 1 THEN 'd_' || p || '_d_' || q WHEN 2 THEN 'd_' || p || '_d_' || q || '_v2'
    WHEN 3 THEN 'd_' || q || '_3' WHEN 4 THEN 'd_' || p || '_d_' || q || '_' || l
    WHEN 5 THEN 'd_' || q || '_1_v2' WHEN 6 THEN 'd_' || p || '_d_' || p || '_d_' || q || '_10'
    WHEN 7 THEN 'D_' || p || '_D_' || q || '_3_3'
    WHEN 8 THEN 'D_' || p || '_D_' || q || '_v2_' || l || '_' || l
    WHEN 9 THEN 'd_' || q || '_AGE' WHEN 10 THEN 'token_' || p_partkey ELSE 'd_' || p END) AS col
FROM (SELECT p_partkey, p_partkey + 500000000 AS q, (p_partkey // 25) % 40 + 600000000 AS p, p_partkey % 25 + 1 AS l
  FROM part)""",
    "parsed": r"""
SELECT 'clean' AS layer, tbl, col, ids, CAST(len(ids) AS BIGINT) AS n_concepts,
  array_to_string(ids, ';') AS concept_ids,
  TRY_CAST(regexp_extract(bare, '_([0-9]{1,2})$', 1) AS BIGINT) AS loop_number,
  CASE WHEN regexp_matches(col, '_[vV][0-9]+(_|$)') THEN '_v' || regexp_extract(col, '_[vV]([0-9]+)(_|$)', 1)
    ELSE '' END AS version_tag,
  array_to_string([t FOR t IN string_split(col, '_') IF t <> '' AND upper(t) <> 'D'
    AND NOT regexp_full_match(t, '[0-9]{1,2}|[0-9]{9}') AND NOT regexp_full_match(t, '[vV][0-9]+')], ';')
    AS nonconforming_tokens
FROM (SELECT tbl, col, regexp_extract_all(col, '[dD]_([0-9]{9})', 1) AS ids,
    regexp_replace(col, '_[vV][0-9]+(_|$)', '\1', 'g') AS bare
  FROM names WHERE tbl NOT IN ('participants', 'biospecimen'))
WHERE len(ids) > 0""",
    "roles": """
SELECT concept_id, bool_or(role = 'q') AS is_question, bool_or(role = 's') AS is_source_question,
  regexp_full_match(concept_id, '[0-9]{9}') AS has_role
FROM (SELECT prim_cid AS concept_id, 'd' AS role FROM sheet UNION ALL SELECT sec_cid, 'v' FROM sheet
  UNION ALL SELECT sq_cid, 's' FROM sheet UNION ALL SELECT q_cid, 'q' FROM sheet UNION ALL SELECT resp_cid, 'r' FROM sheet)
WHERE concept_id IS NOT NULL GROUP BY concept_id""",
    "pairs": "SELECT DISTINCT q_cid_f AS q, sec_cid_f AS s FROM filled WHERE q_cid_f IS NOT NULL AND sec_cid_f IS NOT NULL",
    "stated": "SELECT DISTINCT q_cid_f AS q, sec_cid AS s FROM filled WHERE q_cid_f IS NOT NULL AND sec_cid IS NOT NULL",
    "crosswalk": """
SELECT n_nationkey AS line,
  CASE WHEN n_nationkey % 9 = 8 THEN '' ELSE trim(' module' || (n_nationkey % 4)) END AS table_name,
  CASE WHEN n_nationkey % 7 = 0 THEN '' ELSE CAST(n_nationkey + 410000000 AS VARCHAR) END AS secondary_source_concept_id
FROM nation""",
    "first_survey": """
SELECT table_name, arg_min(secondary_source_concept_id, line) AS secondary_source_concept_id
FROM crosswalk WHERE table_name <> '' AND secondary_source_concept_id <> '' GROUP BY table_name""",
    "placed": r"""
SELECT x.layer, x.tbl, x.col, x.n_concepts, x.concept_ids, x.loop_number, x.version_tag, x.nonconforming_tokens,
  coalesce(d.primary_source_concept_id, '') AS primary_source_concept_id, x.survey AS secondary_source_concept_id,
  x.sq AS source_question_concept_id, x.q AS question_concept_id, '' AS response_concept_id, x.leaf_role,
  CASE WHEN x.leaf_role = 'question' THEN 'Y' ELSE 'N' END AS question_in_dict,
  CASE WHEN p.q IS NOT NULL THEN 'Y' ELSE 'N' END AS secondary_source_match
FROM (SELECT *, CASE WHEN leaf_role = 'source_question' THEN leaf WHEN n_concepts >= 2 THEN ids[1] ELSE '' END AS sq,
    CASE WHEN leaf_role = 'source_question' THEN '' ELSE leaf END AS q
  FROM (SELECT parsed.*, ids[-1] AS leaf, coalesce(f.secondary_source_concept_id, '') AS survey,
      CASE WHEN r.is_question THEN 'question' WHEN r.is_source_question THEN 'source_question' ELSE 'other' END AS leaf_role
    FROM parsed LEFT JOIN roles r ON r.concept_id = ids[-1]
    LEFT JOIN first_survey f ON f.table_name = regexp_replace(tbl, '_[vV][0-9]+$', ''))) x
LEFT JOIN d_secondary_source d ON d.secondary_source_concept_id = x.survey
LEFT JOIN pairs p ON p.q = x.q AND p.s = x.survey""",
    "worklist": """
SELECT * FROM (SELECT CASE
    WHEN nonconforming_tokens <> '' THEN 'impure_token_present'
    WHEN leaf_role = 'source_question' THEN 'source_question_level_column'
    WHEN leaf_role = 'other' AND has_role THEN 'concept_present_but_not_as_question'
    WHEN leaf_role = 'other' THEN 'concept_absent_from_dictionary'
    WHEN secondary_source_match = 'N' AND tbl = 'module2' THEN 'bio_survey_mapping_unconfirmed'
    WHEN secondary_source_match = 'N' THEN 'reused_concept_survey_not_in_dict' END AS issue,
  tbl AS "table", col AS "column", leaf_role, question_concept_id, source_question_concept_id,
  secondary_source_concept_id, coalesce(lab, '') AS dict_secondary_sources, version_tag, loop_number, nonconforming_tokens
  FROM placed LEFT JOIN roles ON concept_id = question_concept_id
  LEFT JOIN (SELECT q, string_agg(coalesce(secondary_source, s), ';' ORDER BY coalesce(secondary_source, s)) AS lab
    FROM stated LEFT JOIN d_secondary_source ON secondary_source_concept_id = s GROUP BY q) z ON z.q = question_concept_id)
WHERE issue IS NOT NULL""",
    "enriched": """
SELECT r.connect_id, r.secondary_source_concept_id, ss.secondary_source AS survey, ps.primary_source AS domain,
  r.source_question_concept_id, sq.source_question_text AS source_question, r.question_concept_id, q.question_text,
  q.question_type, r.question_version, r.loop_instance, r.response_value_as_string, r.response_value_as_concept_id,
  o.format_value AS response_label, r.response_value_as_number, r.response_value_as_date, s.response_option_set,
  r.source_table, r.source_column
FROM fact r LEFT JOIN secondary_source ss USING (secondary_source_concept_id)
LEFT JOIN primary_source ps ON ps.primary_source_concept_id = ss.primary_source_concept_id
LEFT JOIN question q ON q.question_concept_id = r.question_concept_id
LEFT JOIN source_question sq ON sq.source_question_concept_id = r.source_question_concept_id
LEFT JOIN response o ON o.response_concept_id = r.response_value_as_concept_id
LEFT JOIN option_set s ON s.question_concept_id = r.question_concept_id""",
    "option_set": """
SELECT question_concept_id, string_agg(format_value, '; ' ORDER BY response_concept_id) AS response_option_set
FROM question_response LEFT JOIN response USING (response_concept_id) GROUP BY question_concept_id""",
    "documents_fact": f"""
SELECT connect_id, secondary_source_concept_id, question_concept_id, {typed('value')},
  {unique_id('secondary_source_concept_id', 'NULL', 'question_concept_id', 'value')} AS response_unique_id
FROM (SELECT CAST(doc_id AS VARCHAR) AS connect_id, 'survey ' || source AS secondary_source_concept_id,
  CASE lang WHEN 'en' THEN '130000001' WHEN 'de' THEN '130000002' ELSE '130000003' END AS question_concept_id,
  text AS value FROM documents)""",
    "codes": f"""
SELECT d.response_unique_id, d.secondary_source_concept_id, d.source_question_concept_id, d.question_concept_id,
  d.response_value_as_string AS response_value_verbatim,
  CASE WHEN qr.response_concept_id IS NOT NULL THEN 'coded'
    WHEN {number('d.response_value_as_string')} IS NOT NULL
      OR regexp_matches(d.response_value_as_string, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'numeric_or_date'
    ELSE 'free_text' END AS response_kind,
  lower(regexp_replace(nfc_normalize(trim(d.response_value_as_string)), '\\s+', ' ', 'g')) AS response_value_norm,
  coalesce(q.question_text, '') || ' | ' || coalesce(o.format_value, d.response_value_as_string) AS source_code_description
FROM (SELECT DISTINCT secondary_source_concept_id, source_question_concept_id, question_concept_id,
  response_value_as_string, response_unique_id FROM fact
  WHERE response_value_as_string IS NOT NULL AND response_value_as_string <> '') d
LEFT JOIN question q ON q.question_concept_id = d.question_concept_id
LEFT JOIN question_response qr ON qr.question_concept_id = d.question_concept_id
  AND qr.response_concept_id = d.response_value_as_string
LEFT JOIN response o ON o.response_concept_id = d.response_value_as_string""",
    "people": "SELECT DISTINCT connect_id FROM fact",
    "anthro": f"""
SELECT *, (weight_nozeroes / pow(height_combined_nozeroes, 2)) * 703 AS bmi_derived FROM (
SELECT *, CASE WHEN height_ft * 12 + height_in > 0 THEN height_ft * 12 + height_in END AS height_combined_nozeroes,
  CASE WHEN weight > 0 THEN weight END AS weight_nozeroes
FROM (SELECT connect_id,
  max(CASE WHEN question_concept_id = '340854069' AND source_question_concept_id = '114314839'
    THEN {number('response_value_as_string')} END) AS height_ft,
  max(CASE WHEN question_concept_id = '600462977' AND source_question_concept_id = '114314839'
    THEN {number('response_value_as_string')} END) AS height_in,
  max(CASE WHEN question_concept_id = '746012894' THEN {number('response_value_as_string')} END) AS weight
  FROM fact GROUP BY connect_id))""",
    "smoke": """
SELECT connect_id,
  max(CASE WHEN question_concept_id = '712653855' AND source_question_concept_id = '947205597'
    THEN response_value_as_string END) AS smoker_status_concept_id,
  max(CASE WHEN question_concept_id = '763164658' THEN response_value_as_string END) AS cigs_lifetime_concept_id,
  max(CASE WHEN question_concept_id = '639684251' THEN response_value_as_string END) AS smoke_cigs_now_concept_id,
  max(CASE WHEN question_concept_id = '798549704' THEN response_value_as_string END) AS cigs_lasttime_concept_id
FROM fact GROUP BY connect_id""",
    "lifetime_codes": values("code, over", [("132232896", 1), ("151488193", 0), ("805449318", 0), ("486319890", 0)]),
    # combinations of status, lifetime number, smoking now and last time, as patterns; '' is no answer
    "smoking_codes": values(
        "s_is, l_is, n_is, t_is, category",
        [
            (inputs.NO, "%", "%", "%", "Never Smoker"),
            (inputs.YES, "151488193", "%", "%", "Never Smoker"),
            (inputs.YES, "805449318", "%", "%", "Never Smoker"),
            (inputs.YES, "486319890", "%", "317567178", "Current Smoker"),
            (inputs.YES, "486319890", "%", "484055234", "Current Smoker"),
            (inputs.YES, "486319890", "%", "802197176", "Former Smoker"),
            (inputs.YES, "486319890", "299561721", "", "Current Smoker"),
            (inputs.YES, "486319890", "716761013", "", "Current Smoker"),
            (inputs.YES, "486319890", "804785430", "", "Current Smoker"),
            (inputs.YES, "486319890", "419415087", "", "Former Smoker"),
            (inputs.YES, "132232896", "%", "317567178", "Current Smoker"),
            (inputs.YES, "132232896", "%", "484055234", "Current Smoker"),
            (inputs.YES, "132232896", "%", "802197176", "Former Smoker"),
            (inputs.YES, "132232896", "299561721", "", "Current Smoker"),
            (inputs.YES, "132232896", "716761013", "", "Current Smoker"),
            (inputs.YES, "132232896", "804785430", "", "Current Smoker"),
            (inputs.YES, "132232896", "419415087", "", "Former Smoker"),
            (inputs.YES, "", "419415087", "802197176", "Former Smoker"),
        ],
    ),
    "chosen": """
SELECT connect_id, secondary_source_concept_id, source_question_concept_id AS question_concept_id,
  question_concept_id AS response_value_as_concept_id, loop_instance, question_version, source_table, source_column
FROM fact WHERE source_question_concept_id = '110000000' AND response_value_as_string = '353358909'""",
    "versions": """
SELECT CAST(p_partkey + 500000000 AS VARCHAR) AS question_concept_id,
  CASE p_partkey % 10 WHEN 0 THEN 'Deprecated' WHEN 1 THEN 'Revised' WHEN 2 THEN 'New' END AS status,
  CAST(1 + p_partkey % 3 AS BIGINT) AS max_version,
  CASE WHEN p_partkey % 10 = 0 THEN CAST(p_partkey + 500000001 AS VARCHAR) END AS successor_concept_id,
  p_name AS current_text,
  CASE p_partkey % 4 WHEN 1 THEN p_name || ' (first)' WHEN 2 THEN '' END AS v1_text,
  CASE WHEN p_partkey % 4 = 3 THEN p_name || ' (second)' END AS v2_text,
  CAST(p_partkey % 40 + 600000000 AS VARCHAR) AS current_source_question,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey % 40 + 600000000 AS VARCHAR) END AS v1_source_question
FROM part""",
    "chains": """
SELECT CAST(p_partkey + 500000000 AS VARCHAR) AS q, CAST(t + 500000000 AS VARCHAR) AS successor FROM (SELECT p_partkey,
  CASE WHEN p_partkey % 12 IN (1, 2, 3, 4, 5, 7, 8, 9) THEN p_partkey + 1 WHEN p_partkey % 12 = 10 THEN p_partkey - 2 END AS t FROM part)""",
    "steps": """
SELECT c.q, c.successor AS at, CAST(1 AS BIGINT) AS hops FROM chains c JOIN chains n ON n.q = c.successor
UNION ALL SELECT s.q, c.successor, s.hops + 1 FROM steps s JOIN chains c ON c.q = s.at JOIN chains n ON n.q = c.successor WHERE s.hops < 12""",
    "ends": """
SELECT c.q AS question_concept_id, coalesce(e.at, c.q) AS current_question_cid,
  CASE WHEN e.q IS NOT NULL THEN e.hops WHEN NOT EXISTS (SELECT 1 FROM steps s WHERE s.q = c.q) THEN 0 END AS hops,
  e.q IS NULL AND EXISTS (SELECT 1 FROM steps s WHERE s.q = c.q) AS in_cycle
FROM chains c LEFT JOIN (SELECT s.* FROM steps s JOIN chains x ON x.q = s.at
  LEFT JOIN chains y ON y.q = x.successor WHERE y.q IS NULL) e ON e.q = c.q""",
    "release_people": """
SELECT c_custkey, CAST(floor(c_acctbal / 150) AS BIGINT) + 20 AS age, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || (c_custkey % 3) AS postal, day
FROM customer LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS day FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "release_forms": """
SELECT la, lp, ld, CASE la WHEN 0 THEN coalesce(CAST(age // 5 * 5 AS VARCHAR), 'unknown') WHEN 1 THEN coalesce(CAST(age // 20 * 20 AS VARCHAR), 'unknown') ELSE '*' END AS age,
  CASE lp WHEN 0 THEN postal WHEN 1 THEN substr(postal, 1, 2) ELSE '*' END AS postal,
  CASE ld WHEN 0 THEN coalesce(strftime(day, '%Y-%m'), 'unknown') WHEN 1 THEN coalesce(strftime(day, '%Y'), 'unknown') ELSE '*' END AS day
FROM release_people, (VALUES (0), (1), (2)) a(la), (VALUES (0), (1), (2)) p(lp), (VALUES (0), (1), (2)) d(ld)""",
    "release_cells": "SELECT la, lp, ld, age, postal, day, count(*) AS n FROM release_forms GROUP BY ALL",
    "lifecycle": f"""
SELECT q_cid AS question_concept_id, arg_min(status, rn) AS status, arg_min(status_date, rn) AS status_date
FROM (SELECT rn, last_value(q_cid IGNORE NULLS) OVER (ORDER BY rn) AS q_cid, status, status_date
  FROM (SELECT rn, CASE WHEN j % 3 = 0 THEN CAST((CASE WHEN k % 5 = 0 THEN j ELSE k END) + 500000000 AS VARCHAR) END AS q_cid,
    CASE WHEN j % 3 < 2 THEN {pick('k', 5, inputs.STATUSES)} END AS status,
    CASE WHEN j % 3 < 2 AND k % 5 < 3 THEN DATE '2022-06-01' + CAST(k % 1400 AS INTEGER) END AS status_date FROM parts))
GROUP BY q_cid""",
    "part_answers": """
SELECT CAST(l_orderkey AS VARCHAR) AS connect_id, CAST(l_partkey + 500000000 AS VARCHAR) AS question_concept_id,
  CASE WHEN l_linenumber > 3 THEN '_v2' END AS question_version,
  CASE l_returnflag WHEN 'A' THEN '353358909' WHEN 'N' THEN '104430631' END AS response_value_as_concept_id
FROM lineitem""",
    "offered_options": """
SELECT * FROM (SELECT DISTINCT question_concept_id, CASE WHEN question_version = '_v2' THEN 2 ELSE 1 END AS version,
    response_value_as_concept_id AS response_concept_id
  FROM fact WHERE response_value_as_concept_id IS NOT NULL) s
WHERE NOT EXISTS (SELECT 1 FROM overrides o WHERE o.q = s.question_concept_id AND o.v = s.version AND o.r = s.response_concept_id)
UNION ALL SELECT q, v, r FROM overrides WHERE offered""",
    "overrides": """
SELECT * FROM (VALUES ('110000001', 2, '353358909', FALSE), ('110000001', 3, '353358909', TRUE),
  ('784119588', 1, '773342525', TRUE), ('110000002', 2, '353358909', TRUE)) t(q, v, r, offered)""",
    "variables": """
SELECT q_cid AS question_concept_id, variable_label, status, pii, q_text AS question_text,
  resp_cid AS response_concept_id, rn FROM sheet WHERE q_cid IS NOT NULL""",
    "type_norm": r"""
SELECT question_concept_id, question_type,
  CASE WHEN regexp_matches(raw, 'xor=') THEN 'XOR_AGE_OR_YEAR' WHEN regexp_matches(raw, '^grid') THEN 'GRID'
    WHEN regexp_matches(raw, 'select all that apply') THEN 'SELECT_ALL_THAT_APPLY'
    WHEN regexp_matches(raw, 'multiple choice with text box|text box plus check box') THEN 'MC_WITH_TEXT_BOX'
    WHEN regexp_matches(raw, 'multiple choice|^nested|dropdown menu') THEN 'MULTIPLE_CHOICE'
    WHEN regexp_matches(raw, 'multiple text boxes') THEN 'MULTIPLE_TEXT_BOXES'
    WHEN regexp_matches(raw, 'special function|self populates') THEN 'SPECIAL_FUNCTION'
    WHEN regexp_matches(raw, 'text only response|^text box$') THEN 'TEXT_FREE' END AS base_type,
  coalesce(regexp_matches(raw, '^required'), FALSE) AS is_required,
  coalesce(regexp_matches(raw, '^optional'), FALSE) AS is_optional,
  coalesce(regexp_matches(raw, 'loops'), FALSE) AS has_loop,
  coalesce(regexp_matches(raw, 'display ?if'), FALSE) AS has_displayif,
  coalesce(regexp_matches(raw, 'piped text'), FALSE) AS has_piped_text,
  coalesce(regexp_matches(raw, 'with text box'), FALSE) AS has_inline_text_box
FROM (SELECT *, replace(regexp_replace(lower(trim(question_type)), '\s+', ' ', 'g'), 'mulitple', 'multiple') AS raw
  FROM d_question)""",
    "star_types": r"""
SELECT question_concept_id, CASE WHEN lower(question_type) LIKE '%select all that apply%' THEN 'SELECT_ALL_THAT_APPLY'
  WHEN lower(question_type) LIKE 'grid%' THEN 'GRID'
  WHEN lower(question_type) LIKE '%multiple choice%' THEN 'MULTIPLE_CHOICE'
  WHEN lower(question_type) LIKE 'text only response%' OR lower(question_type) = 'text box' THEN 'TEXT_FREE' END AS base_type FROM question""",
    "tagged": """
SELECT 'module' || (b % 3) AS tbl, 'd_' || (b + 500000000) || CASE WHEN b % 4 = 1 THEN '_v2' WHEN b % 4 = 0 THEN ''
    ELSE (CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_v2' ELSE '_V3' END) END AS col
FROM (SELECT p_partkey, p_partkey // 3 AS b FROM part)""",
    "triads": "SELECT CAST(user_id AS VARCHAR) AS connect_id, w, s, c FROM (SELECT DISTINCT user_id FROM events) u"
    " CROSS JOIN (SELECT unnest(range(5)) AS w) ws LEFT JOIN (SELECT user_id AS u2, (day(ts) - 1) // 7 AS w2,"
    " min(CASE WHEN event_type = 'signup' THEN ts END) AS s, max(CASE WHEN event_type = 'purchase' THEN ts END) AS c"
    " FROM events GROUP BY ALL) e ON e.u2 = u.user_id AND e.w2 = ws.w",
    "sessions": """
SELECT *, CASE status_concept_id WHEN '972455046' THEN 0 WHEN '615768760' THEN 1 ELSE 2 END AS status,
  status_concept_id = '231311385' AS is_complete
FROM (SELECT CAST(c_custkey AS VARCHAR) AS connect_id, '300000001' AS secondary_source_concept_id,
  CASE WHEN filled >= 3 THEN '231311385' WHEN st IS NOT NULL THEN '615768760' ELSE '972455046' END AS status_concept_id,
  st AS started_at, CASE WHEN filled >= 3 THEN en END AS completed_at
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS st, max(o_orderdate) AS en,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS filled FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), '300000002',
  CASE WHEN filled >= 190 THEN '231311385' WHEN st IS NOT NULL THEN '615768760' ELSE '972455046' END,
  st, CASE WHEN filled >= 190 THEN en END
  FROM supplier LEFT JOIN (SELECT l_suppkey, min(l_shipdate) AS st, max(l_shipdate) AS en,
    count(*) FILTER (WHERE l_returnflag = 'R') AS filled FROM lineitem GROUP BY l_suppkey) l ON l_suppkey = s_suppkey)""",
    "asked": values(
        "secondary_source_concept_id, question_concept_id, added_at",
        inputs.ASKED,
        "secondary_source_concept_id, question_concept_id, CAST(added_at AS DATE) AS added_at",
    ),
    "answers": """
SELECT connect_id, question_concept_id, response_value_as_string AS v, response_value_as_number AS n FROM fact""",
    "who": "SELECT DISTINCT connect_id, secondary_source_concept_id AS s FROM fact",
    "told": f"""
SELECT connect_id,
  bool_or(k = 'a1' AND v = '200000001') AS seg1, bool_or(k = 'a1' AND v = '200000002') AS seg2,
  bool_or(k = 'a1' AND v = '200000003') AS seg3, bool_or(k = 'a1' AND v = '200000004') AS seg4,
  bool_or(k = 'a2') AS balance, max(CASE WHEN k = 'a2' THEN n END) AS balance_n, bool_or(k = 'a4') AS edge,
  bool_or(k = 'acc' AND v = '{inputs.YES}') AS accident, bool_or(k = 'dec' AND v = '{inputs.YES}') AS decay,
  bool_or(k = 'lang_b' AND v = '773342525') AS spanish_b, bool_or(k = 'b1' AND n > 0) AS other_balance,
  max(CASE WHEN k = 'weight' THEN n END) AS weight_n, bool_or(k = 'weight') AS weight, bool_or(k = 'weight' AND n >= 200) AS heavy,
  bool_or(k = 'edu' AND v = '210000001') AS school, bool_or(k = 'marital' AND v = '220000001') AS never_married,
  bool_or(k = 'income') AS income, bool_or(k = 'income' AND v = '230000005') AS high_income,
  bool_or(k = 'ever' AND v = '{inputs.NO}') AS never_smoked, bool_or(k = 'ever' AND v = '{inputs.YES}') AS ever,
  bool_or(k = 'life' AND v = '486319890') AS life3, bool_or(k = 'life' AND v = '132232896') AS life4,
  bool_or(k = 'now' AND v = '299561721') AS rarely
FROM (SELECT connect_id, response_value_as_string AS v, {number('response_value_as_string')} AS n,
    CASE secondary_source_concept_id || question_concept_id
      WHEN '300000001100000001' THEN 'a1' WHEN '300000001100000002' THEN 'a2' WHEN '300000001100000004' THEN 'a4'
      WHEN '300000001110000001' THEN 'acc' WHEN '300000001110000002' THEN 'dec' WHEN '300000002784119588' THEN 'lang_b'
      WHEN '300000002100000011' THEN 'b1' WHEN '300000003746012894' THEN 'weight' WHEN '300000003367803647' THEN 'edu'
      WHEN '300000003783167257' THEN 'marital' WHEN '300000003759004335' THEN 'income' WHEN '300000003712653855' THEN 'ever'
      WHEN '300000003763164658' THEN 'life' WHEN '300000003639684251' THEN 'now' END AS k FROM fact) GROUP BY connect_id""",
    "shown": """
SELECT connect_id, s AS secondary_source_concept_id, g.q AS question_concept_id, CASE g.q
    WHEN '100000002' THEN NOT edge WHEN '100000003' THEN seg1 OR seg2 WHEN '110000002' THEN accident AND seg2
    WHEN '110000003' THEN seg3 OR (accident AND decay)
    WHEN '120000001' THEN coalesce((weight_n - balance_n) / nullif(weight_n, 0) >= 0.05, FALSE)
    WHEN '784119588' THEN other_balance WHEN '783167257' THEN seg1 WHEN '763164658' THEN ever
    WHEN '639684251' THEN ever AND (life3 OR life4) WHEN '798549704' THEN heavy OR NOT weight END AS is_shown
FROM who JOIN told USING (connect_id) JOIN (VALUES ('300000001', '100000002'), ('300000001', '100000003'), ('300000001', '110000002'),
  ('300000001', '110000003'), ('300000001', '120000001'), ('300000002', '784119588'), ('300000003', '783167257'),
  ('300000003', '763164658'), ('300000003', '639684251'), ('300000003', '798549704')) g(s2, q) ON g.s2 = who.s""",
    "axis": """
SELECT s, "at", q FROM (VALUES ('300000001', ['100000001', '100000002', '100000004', '100000003', '110000001', '110000002', '110000003',
    '120000001', '784119588']), ('300000002', ['784119588', '100000011']), ('300000003', ['340854069', '600462977', '746012894',
    '367803647', '783167257', '759004335', '712653855', '763164658', '639684251', '798549704'])) t(s, list),
  LATERAL (SELECT unnest(list) AS q, unnest(range(1, len(list) + 1)) AS "at")""",
    "leaps": """
SELECT connect_id, s, "at", CASE s || ':' || "at"
    WHEN '300000001:1' THEN (CASE WHEN seg2 THEN 4 WHEN seg4 THEN 8 END) WHEN '300000001:2' THEN (CASE WHEN NOT balance THEN 6 END)
    WHEN '300000001:4' THEN 7 WHEN '300000001:5' THEN (CASE WHEN accident THEN 8 END) WHEN '300000001:6' THEN (CASE WHEN decay THEN 9 END)
    WHEN '300000002:1' THEN (CASE WHEN spanish_b THEN 99 END) WHEN '300000003:4' THEN (CASE WHEN school THEN 6 END)
    WHEN '300000003:5' THEN (CASE WHEN never_married THEN 7 END)
    WHEN '300000003:6' THEN (CASE WHEN high_income THEN 9 WHEN NOT income THEN 10 END)
    WHEN '300000003:7' THEN (CASE WHEN never_smoked THEN 99 END) WHEN '300000003:8' THEN (CASE WHEN life4 THEN 10 END)
    WHEN '300000003:9' THEN (CASE WHEN rarely THEN 99 END) END AS target
FROM who JOIN told USING (connect_id) JOIN axis USING (s)""",
    "walk": """
SELECT connect_id, s, CAST(1 AS BIGINT) AS "at" FROM who
UNION ALL
SELECT w.connect_id, w.s, CASE WHEN l.target IS NOT NULL AND coalesce(g.is_shown, TRUE) THEN l.target ELSE w."at" + 1 END
FROM walk w JOIN axis a ON a.s = w.s AND a."at" = w."at"
JOIN leaps l ON l.connect_id = w.connect_id AND l.s = w.s AND l."at" = w."at"
LEFT JOIN shown g ON g.connect_id = w.connect_id AND g.secondary_source_concept_id = w.s AND g.question_concept_id = a.q""",
    "walked": """
SELECT who.connect_id, who.s AS secondary_source_concept_id, axis.q AS question_concept_id, walk."at" IS NOT NULL AS is_open,
  walk."at" IS NOT NULL AND coalesce(g.is_shown, TRUE) AS is_shown
FROM who JOIN axis ON axis.s = who.s LEFT JOIN walk ON walk.connect_id = who.connect_id AND walk.s = who.s AND walk."at" = axis."at"
LEFT JOIN shown g ON g.connect_id = who.connect_id AND g.secondary_source_concept_id = who.s AND g.question_concept_id = axis.q""",
    "events_long": """
SELECT CAST(user_id AS VARCHAR) AS connect_id, strftime(date_trunc('week', ts), '%Y-%m-%d') AS round_id,
  CASE event_type WHEN 'view' THEN 'collection' WHEN 'click' THEN 'kit' WHEN 'purchase' THEN 'incentive'
    WHEN 'error' THEN 'refusal' END AS category,
  CAST(event_id % 4 + 900000001 AS VARCHAR) AS item_concept_id,
  CASE WHEN value > 50 THEN '231311385' ELSE '972455046' END AS status_concept_id, CAST(ts AS DATE) AS event_date,
  CASE event_id % 4 WHEN 0 THEN 'Mouthwash' WHEN 1 THEN 'MW Collection' WHEN 2 THEN 'mouthwash collection '
    ELSE 'Saliva kit' END AS specimen_label
FROM events WHERE event_type <> 'signup'""",
    "scan": "SELECT doc_id, "
    + ", ".join(
        f"regexp_matches(lower(text), {_text(p)}) AS {name}" for name, p in IDENTIFIERS.items()
    )
    + " FROM documents",
    "variable_scan": "SELECT *, "
    + " OR ".join(
        f"regexp_matches(lower(question_text || ' ' || variable_label), {_text(p)})"
        for p in IDENTIFIERS.values()
    )
    + " AS is_identifier FROM variables",
    "tiered": f"""
SELECT fact.*, greatest(coalesce(list_position({list(TIERS)!r}, qt.tier) - 1, {len(TIERS)}),
    CASE WHEN rt.tier IS NULL THEN 0 ELSE coalesce(list_position({list(TIERS)!r}, rt.tier) - 1, {len(TIERS)}) END) AS tier_rank
FROM fact LEFT JOIN (VALUES ('100000003', 'free_text'), ('100000002', 'quasi_identifier'),
  ('712653855', 'health_sensitive'), ('110000001', 'non_sensitive')) qt(q, tier) ON qt.q = question_concept_id
LEFT JOIN (VALUES ('200000004', 'geolocation'), ('353358909', 'quasi_identifier')) rt(r, tier)
  ON rt.r = response_value_as_concept_id""",
    "lines": r"""
SELECT p_partkey * 3 + o AS line_id, CASE o WHEN 0 THEN (CASE p_partkey % 9
    WHEN 0 THEN '[Q' || p_partkey || '?] Plain question about ' || p_name
    WHEN 1 THEN '[Q' || p_partkey || ',displayif=equals(SEX,3)!] Gated question'
    WHEN 2 THEN '[Q' || p_partkey || '?,displayif=or(equals(SEX,2),equals(MOM1,1))] Gated question'
    WHEN 3 THEN '[Q' || p_partkey || '?,displayif=and(equals(SEX,3),equals(SEX2,6))] Gated question'
    WHEN 4 THEN '[Q' || p_partkey || '?,displayif=greaterThanOrEqual(NUMSIB,1)] Gated question'
    WHEN 5 THEN '[Q' || p_partkey || '?,displayif=greaterThanOrEqual(percentDiff(W1,W2),.05)] Gated question'
    WHEN 6 THEN '[Q' || p_partkey || '?,displayif=or(equals(SEX,2),and(equals(SEX,3),equals(SEX2,6)))] Gated'
    WHEN 7 THEN '[Q' || p_partkey || '?,displayif=isNotDefined(AGE,age)] Gated question'
    ELSE '[Q' || p_partkey || '?] Is |displayif=equals(SIB2,1)|he| |displayif=equals(SIB2,2)|she| well?' END)
  WHEN 1 THEN (CASE p_partkey % 5 WHEN 0 THEN '(1) Yes -> Q' || p_partkey
    WHEN 1 THEN '[1,displayif=equals(SEX,2)] Fibroids -> UF'
    WHEN 2 THEN '|__|__|xor=G' || p_partkey || ' id=A min=0| Age or |__|__|xor=G' || p_partkey || ' id=B| Year'
    WHEN 3 THEN '|__|__|__|min=0 max=999 softedit=true modalif=value<70 modalvalue=''Sure?''| Pounds'
    ELSE '<loop max=25>' END)
  ELSE (CASE p_partkey % 3 WHEN 0 THEN '< -> END' || p_partkey || ' >' WHEN 1 THEN '< #NR -> Q' || p_partkey || ' >'
    ELSE '(0) No' END) END AS line, 'Q' || p_partkey AS question
FROM part CROSS JOIN (SELECT unnest(range(3)) AS o)""",
    "mechanisms": r"""
SELECT line_id, question, 'question_gate' AS mechanism, 'hide_question' AS action, NULL AS option, NULL AS target,
  regexp_extract(line, 'displayif=(.*?)!?\]', 1) AS raw_expression FROM lines WHERE line LIKE '[Q%,displayif=%'
UNION ALL SELECT line_id, question, 'option_gate', 'hide_option', '1', NULL, 'equals(SEX,2)' FROM lines WHERE line LIKE '[1,%'
UNION ALL SELECT line_id, question, 'answer_jump', 'jump_to', '1', regexp_extract(line, '-> (\w+)$', 1), NULL
  FROM lines WHERE line LIKE '(%->%' OR line LIKE '[1,%->%'
UNION ALL SELECT line_id, question, 'unconditional_jump', 'unconditional_jump', NULL, regexp_extract(line, '-> (\w+)', 1), NULL
  FROM lines WHERE line LIKE '< -> %'
UNION ALL SELECT line_id, question, 'no_response_jump', 'jump_to', NULL, regexp_extract(line, '-> (\w+)', 1), NULL
  FROM lines WHERE line LIKE '< #NR%'
UNION ALL SELECT line_id, question, 'loop', 'loop', NULL, NULL, '25' FROM lines WHERE line LIKE '<loop%'
UNION ALL SELECT line_id, question, 'soft_edit', 'confirm', NULL, NULL, 'value<70' FROM lines WHERE line LIKE '%softedit=%'
UNION ALL SELECT line_id, question, 'xor_group', 'exclude', NULL, unnest(regexp_extract_all(line, 'xor=(\w+)', 1)), NULL FROM lines
UNION ALL SELECT line_id, question, 'inline_text', 'wording', NULL, NULL,
  unnest(regexp_extract_all(line, '[|]displayif=([^|]*)[|]', 1)) FROM lines""",
    "classed": r"""
SELECT *, CASE WHEN mechanism NOT IN ('question_gate', 'option_gate', 'inline_text') THEN NULL
  WHEN raw_expression LIKE 'equals(%' THEN 'equals' WHEN raw_expression LIKE 'or(%and(%' THEN 'nested'
  WHEN raw_expression LIKE 'or(%' THEN 'or_of_equals' WHEN raw_expression LIKE 'and(%' THEN 'and_of_equals'
  WHEN raw_expression LIKE '%percentDiff%' THEN 'percent_change' WHEN raw_expression LIKE 'greater%' THEN 'comparison'
  ELSE 'defined_check' END AS expression_class FROM mechanisms""",
    "rule_rows": r"""
SELECT line_id, question, mechanism, action, option, target, raw_expression, expression_class,
  CASE WHEN expression_class IS NULL OR expression_class = 'nested' THEN NULL
    WHEN expression_class = 'and_of_equals' THEN i ELSE 1 END AS group_no,
  CASE WHEN expression_class LIKE '%equals' THEN 'equals' WHEN expression_class = 'percent_change' THEN 'percentDiff'
    WHEN expression_class IN ('comparison', 'defined_check') THEN regexp_extract(raw_expression, '^(\w+)\(', 1) END AS operator,
  CASE WHEN expression_class LIKE '%equals' THEN regexp_extract_all(raw_expression, 'equals\((\w+),(\w+)\)', 1)[i]
    WHEN expression_class = 'percent_change' THEN 'W1;W2'
    WHEN expression_class IN ('comparison', 'defined_check') THEN regexp_extract(raw_expression, '\((\w+),(\w+)\)', 1) END AS trigger,
  CASE WHEN expression_class LIKE '%equals' THEN regexp_extract_all(raw_expression, 'equals\((\w+),(\w+)\)', 2)[i]
    WHEN expression_class = 'percent_change' THEN '.05'
    WHEN expression_class IN ('comparison', 'defined_check') THEN regexp_extract(raw_expression, '\((\w+),(\w+)\)', 2) END AS trigger_value
FROM (SELECT *, unnest(range(1, 1 + CASE WHEN expression_class LIKE '%equals'
    THEN len(regexp_extract_all(raw_expression, 'equals\(')) ELSE 1 END)) AS i FROM classed)""",
    "prompts": """
SELECT p_partkey AS prompt_id, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN '<b>' || p_name || '</b>?'
  WHEN 2 THEN p_name || ' |__|__|min=40 max=70|' WHEN 3 THEN 'You are {$u:age}. ' || p_name
  ELSE p_name || ' |displayif=equals(SEX,1)|he|' END AS prompt FROM part""",
    "fidelity": r"""
SELECT prompt_id, w IN (SELECT trim(regexp_replace(regexp_replace(lower(p_name), '<[^>]*>', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))
    FROM part) AS is_verbatim,
  prompt LIKE '%<b>%' AS has_html, contains(prompt, '|__|') OR contains(prompt, 'min=') AS has_numeric_box,
  prompt LIKE '%displayif=%' AS has_displayif, prompt LIKE '%{$%' AS has_piping
FROM (SELECT *, trim(regexp_replace(regexp_replace(lower(prompt), '<[^>]*>', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS w FROM prompts)""",
}


def _needed(sql: str, seen: list[str], pending: tuple[str, ...] = ()) -> None:
    """Parts named in a statement, each after the parts it needs itself."""
    for name, text in PARTS.items():
        if name not in seen and name not in pending and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", _without_literals(sql)):
            _needed(text, seen, (*pending, name))
            if name not in seen:
                seen.append(name)


def _without_literals(sql: str) -> str:
    return re.sub(r"'(?:[^']|'')*'", "''", sql)


def query(sql: str) -> str:
    """A statement preceded by the parts it reads."""
    seen: list[str] = []
    _needed(sql, seen)
    parts = ",\n".join(f"{name} AS ({PARTS[name].strip()})" for name in seen)
    start = "WITH RECURSIVE" if {"walk", "steps"} & set(seen) else "WITH"
    return f"{start} {parts}\n{sql.strip()}" if parts else sql.strip()
