"""Skip rules: extraction from questionnaire markup, exclusive pairs, and how faithful prompts are.

Who could see which question is in :mod:`tallgrass.operators.flow`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.text import plain_words
from tallgrass.operators.dictionary import forward_fill

# The markup forms.
QUESTION_HEAD = r"^\[([A-Z][A-Za-z0-9_]*)[^\]]*\]"
QUESTION_GATE = r"^\[[A-Z][A-Za-z0-9_]*[^\],]*,\s*displayif=([^\]]*?)!?\]"
OPTION_GATE = r"^\[([0-9]+),\s*displayif=([^\]]*)\]"
ANSWER_JUMP = r"^[\[(]([0-9]+)[^\])]*(?:\)[^\]]*)?[\])].*->\s*([A-Za-z_][A-Za-z0-9_]*)\s*$"
PLAIN_JUMP = r"^<\s*->\s*([A-Za-z_][A-Za-z0-9_]*)\s*>"
NO_RESPONSE_JUMP = r"^<\s*#NR\s*->\s*([A-Za-z_][A-Za-z0-9_]*)\s*>"
LOOP_HEADER = r"^<loop\s+max=([0-9]+)\s*>"
XOR_GROUP = r"xor=\s*([A-Za-z][A-Za-z0-9_]*)"
SOFT_EDIT = r"modalif=([^ |]+)"
INLINE_TEXT = r"[|]displayif=([^|]*)[|]"
EQUALS_ARM = r"equals\(\s*([A-Za-z][A-Za-z0-9_]*)\s*,\s*([^,()]+?)\s*\)"
COMPARISON = r"^(greaterThanOrEqual|greaterThan)\(\s*([A-Za-z][A-Za-z0-9_]*)\s*,\s*([^,()]+?)\s*\)$"
CHANGE = r"^greaterThanOrEqual\(\s*percentDiff\(\s*([A-Za-z0-9_]+)\s*,\s*([A-Za-z0-9_]+)\s*\)\s*,\s*([^,()]+?)\s*\)$"
DEFINED = r"^(isDefined|isNotDefined)\(\s*([A-Za-z][A-Za-z0-9_]*)\s*(?:,\s*([^,()]*?)\s*)?\)$"
ONE_EQUALS = r"^equals\([^()]*\)$"
MANY_EQUALS = r"^(or|and)\((?:equals\([^()]*\)\s*,?\s*)+\)$"


def expression_class(expression: Column) -> Column:
    """Structural class of a condition: flat forms by name, everything deeper ``nested``."""
    bare = F.trim(expression)
    return (
        F.when(bare.rlike(ONE_EQUALS), "equals")
        .when(bare.rlike(MANY_EQUALS) & bare.startswith("or"), "or_of_equals")
        .when(bare.rlike(MANY_EQUALS), "and_of_equals")
        .when(bare.rlike(CHANGE), "percent_change")
        .when(bare.rlike(COMPARISON), "comparison")
        .when(bare.rlike(DEFINED), "defined_check")
        .otherwise("nested")
    )


def _found(line: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(line, pattern, group), F.lit(""))


def _mechanism(name: str, action: str, option: Column, target: Column, expression: Column) -> Column:
    return F.struct(
        F.lit(name).alias("mechanism"),
        F.lit(action).alias("action"),
        option.cast("string").alias("option"),
        target.cast("string").alias("target"),
        expression.cast("string").alias("raw_expression"),
    )


def skip_mechanisms(lines: DataFrame) -> DataFrame:
    """Every skip mechanism on every markup line, with the question it belongs to.

    ``lines`` is ``line_id, line`` in file order. Option and jump lines belong to the last question
    head above them. With ``questionnaire, line_no`` as well, as :func:`tallgrass.sources.readers.read_markup`
    gives them, a head counts in its own questionnaire only and both columns stay.
    """
    line = F.trim("line")
    keys = [c for c in ("questionnaire", "line_no") if c in lines.columns]
    none = F.lit(None)
    one_per_line = [
        ("question_gate", "hide_question", none, none, _found(line, QUESTION_GATE)),
        ("option_gate", "hide_option", _found(line, OPTION_GATE), none, _found(line, OPTION_GATE, 2)),
        ("answer_jump", "jump_to", _found(line, ANSWER_JUMP), _found(line, ANSWER_JUMP, 2), none),
        ("unconditional_jump", "unconditional_jump", none, _found(line, PLAIN_JUMP), none),
        ("no_response_jump", "jump_to", none, _found(line, NO_RESPONSE_JUMP), none),
        ("loop", "loop", none, none, _found(line, LOOP_HEADER)),
        ("soft_edit", "confirm", none, none, _found(line, SOFT_EDIT)),
    ]
    singles = [
        F.when(F.coalesce(target.cast("string"), expression.cast("string")).isNotNull(),
               _mechanism(name, action, option, target, expression))
        for name, action, option, target, expression in one_per_line
    ]
    def each(pattern: str, build: Callable[[Column], Column]) -> Column:
        return F.transform(F.regexp_extract_all(line, F.lit(pattern), F.lit(1)), build)

    many = [
        each(XOR_GROUP, lambda group: _mechanism("xor_group", "exclude", none, group, none)),
        each(INLINE_TEXT, lambda text: _mechanism("inline_text", "wording", none, none, text)),
    ]
    head = _found(line, QUESTION_HEAD)
    if keys:  # the empty name ends what the questionnaire before carries on
        head = F.coalesce(head, F.when(F.col("line_no") == 1, ""))
    placed = forward_fill(lines.withColumn("question", head), "line_id", ["question"])
    found = F.concat(F.array_compact(F.array(*singles)), *many)
    return placed.select(
        *keys, "line_id", F.nullif("question_f", F.lit("")).alias("question"), F.explode(found).alias("m")
    ).select(*keys, "line_id", "question", "m.*")


def skip_rules(lines: DataFrame) -> DataFrame:
    """Rule rows with their conditions taken apart.

    Arms of an ``or`` share ``group_no`` 1; each arm of an ``and`` gets its own, so a rule holds when
    every group has a true arm. Nested conditions keep one row with the raw text only.
    """
    raw = F.trim("raw_expression")
    kind = F.when(
        F.col("mechanism").isin("question_gate", "option_gate", "inline_text"), expression_class(raw)
    )

    def arm(group: Column, operator: Column, trigger: Column, value: Column) -> Column:
        return F.struct(
            group.cast("bigint").alias("group_no"),
            operator.cast("string").alias("operator"),
            trigger.cast("string").alias("trigger"),
            value.cast("string").alias("trigger_value"),
        )

    none, first = F.lit(None), F.lit(1)
    triggers = F.regexp_extract_all(raw, F.lit(EQUALS_ARM), F.lit(1))
    values = F.regexp_extract_all(raw, F.lit(EQUALS_ARM), F.lit(2))
    equals_arms = F.transform(
        F.arrays_zip(triggers.alias("t"), values.alias("v")),
        lambda pair, i: arm(
            F.when(F.col("expression_class") == "and_of_equals", i + 1).otherwise(first),
            F.lit("equals"), pair["t"], pair["v"],
        ),
    )
    arms = (
        F.when(F.col("expression_class").isin("equals", "or_of_equals", "and_of_equals"), equals_arms)
        .when(
            F.col("expression_class") == "comparison",
            F.array(arm(first, _found(raw, COMPARISON), _found(raw, COMPARISON, 2), _found(raw, COMPARISON, 3))),
        )
        .when(
            F.col("expression_class") == "percent_change",
            F.array(
                arm(
                    first, F.lit("percentDiff"),
                    F.concat_ws(";", _found(raw, CHANGE), _found(raw, CHANGE, 2)), _found(raw, CHANGE, 3),
                )
            ),
        )
        .when(
            F.col("expression_class") == "defined_check",
            F.array(arm(first, _found(raw, DEFINED), _found(raw, DEFINED, 2), _found(raw, DEFINED, 3))),
        )
        .otherwise(F.array(arm(none, none, none, none)))
    )
    return (
        skip_mechanisms(lines)
        .withColumn("expression_class", kind)
        .select("*", F.inline(arms))
    )


def rule_census(rules: DataFrame) -> DataFrame:
    """Mechanisms by condition class; a rule with several arms counts once."""
    distinct = rules.groupBy(
        "line_id", "question", "mechanism", "option", "target", "raw_expression", "expression_class"
    ).agg(F.count(F.lit(1)).alias("arms"))
    return distinct.groupBy("mechanism", "expression_class").agg(F.count(F.lit(1)).alias("n"))


def trigger_census(rules: DataFrame) -> DataFrame:
    """How often each trigger is referred to."""
    return (
        rules.where("trigger IS NOT NULL")
        .groupBy("trigger")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "trigger")
    )


def xor_violations(fact: DataFrame, pair: Sequence[str]) -> DataFrame:
    """Participants who answered more than one question of an exclusive pair.

    The pair is judged within one survey, source question and loop pass, since the same two questions
    are reused under many parents.
    """
    scope = ["connect_id", "secondary_source_concept_id", "source_question_concept_id", "loop_instance"]
    answered = fact.where(
        F.col("question_concept_id").isin(*pair) & (F.col("response_value_as_string") != "")
    )
    return (
        answered.groupBy(*scope)
        .agg(F.countDistinct("question_concept_id").alias("n_answered"))
        .where("n_answered > 1")
    )


def text_fidelity(prompts: DataFrame, question: DataFrame) -> DataFrame:
    """Compare questionnaire prompts with dictionary texts by their plain words.

    ``prompts`` is ``prompt_id, prompt``. The flags tell what a plain text cannot hold.
    """
    raw = F.col("prompt")
    known = question.select(plain_words(F.col("question_text")).alias("words")).distinct()
    flagged = prompts.select(
        "prompt_id",
        plain_words(raw).alias("words"),
        raw.rlike(r"<(b|br|u|i)/?>").alias("has_html"),
        raw.rlike(r"[|]__[|]|min=|max=").alias("has_numeric_box"),
        raw.contains("displayif=").alias("has_displayif"),
        raw.rlike(r"\{\$[^}]*\}").alias("has_piping"),
    )
    return flagged.join(known.withColumn("is_verbatim", F.lit(True)), "words", "left").select(
        "prompt_id",
        F.coalesce("is_verbatim", F.lit(False)).alias("is_verbatim"),
        "has_html",
        "has_numeric_box",
        "has_displayif",
        "has_piping",
        F.expr("has_html OR has_displayif OR has_piping").alias("display_text_lossy"),
    )


def fidelity_summary(compared: DataFrame) -> DataFrame:
    """Prompts, verbatim matches and features in one row."""
    flags = ("is_verbatim", "has_html", "has_numeric_box", "has_displayif", "has_piping", "display_text_lossy")
    return compared.agg(
        F.count(F.lit(1)).alias("prompts"), *[F.count_if(flag).alias(flag) for flag in flags]
    )
