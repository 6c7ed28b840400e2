"""Who could see which question: skip rules and jumps from questionnaires, evaluated over the answers.

Rules stay tables. Every condition they name is evaluated once, by joining the answers to its trigger; a
participant then carries the set of conditions that hold, and the rules of a survey, one row, are
evaluated against that set. So nothing is made per participant and rule, and the number of rules adds
no column to a plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.text import strict_number
from tallgrass.operators.rules import EQUALS_ARM, QUESTION_HEAD
from tallgrass.plans.session import scratch_path
from tallgrass.sources.writers import store

# Condition forms beyond the flat ones, targets that are no question, the code before a label.
EQUALS = r"equals\([^()]*\)"
OR_WITH_AND = rf"^or\((?:{EQUALS}\s*,\s*)*and\((?:{EQUALS}\s*,?\s*)+\)(?:\s*,\s*{EQUALS})*\)$"
AND_WITH_OR = rf"^and\((?:{EQUALS}\s*,\s*)*or\((?:{EQUALS}\s*,?\s*)+\)(?:\s*,\s*{EQUALS})*\)$"
INNER = rf"(?:and|or)\(((?:{EQUALS}\s*,?\s*)+)\)"
DEFAULTED = r"^(greaterThanOrEqual|greaterThan)\(\s*isDefined\(\s*([A-Za-z][A-Za-z0-9_]*)\s*,\s*([^,()]*?)\s*\)\s*,\s*([^,()]+?)\s*\)$"
RESUME, END = "_CONTINUE", "END"
LABEL_CODE = r"^\s*([0-9]+)\s*="

AFTER_ALL = (1 << 62) - 1  # place behind the last question
SURVEY, QUESTION = "secondary_source_concept_id", "question_concept_id"
CONDITION = ["operator", "trigger_survey", "trigger", "other_survey", "other", "value", "default_value"]


@dataclass(frozen=True)
class Flow:
    """Resolved rules of all surveys.

    ``axis``: ``survey, question, place``, the questions in the order of their questionnaire. ``gates``: one
    row per arm, ``survey, question, group_no`` and the condition; a question shows when every group has a
    true arm. ``jumps``: ``survey, question, place, kind, value, target`` with the target's place.
    ``unresolved``: ``questionnaire, line_id, question, mechanism, reason``; such gates and jumps have no effect.
    """

    axis: DataFrame
    gates: DataFrame
    jumps: DataFrame
    unresolved: DataFrame


def response_codes(question_response: DataFrame, response: DataFrame) -> DataFrame:
    """``question_concept_id, code, response_concept_id``: the option numbers that labels begin with."""
    label = F.regexp_extract("format_value", LABEL_CODE, 1)
    coded = response.select("response_concept_id", label.alias("code")).where("code <> ''")
    return (
        question_response.join(coded, "response_concept_id")
        .groupBy(QUESTION, "code")
        .agg(F.min("response_concept_id").alias("response_concept_id"))
    )


def _nested_arms(raw: Column) -> Column:
    """Arms of the two-level conditions as groups that must all hold, NULL for other forms.

    ``or(a, and(b, c))`` holds when ``a or b`` and ``a or c`` do; ``and(a, or(b, c))`` when ``a`` and
    ``b or c`` do.
    """

    def equals(text: Column) -> Column:
        pairs = F.arrays_zip(
            F.regexp_extract_all(text, F.lit(EQUALS_ARM), F.lit(1)).alias("t"), F.regexp_extract_all(text, F.lit(EQUALS_ARM), F.lit(2)).alias("v")
        )
        return F.transform(pairs, lambda p: F.struct(F.lit("equals").alias("operator"), p["t"].alias("t"), p["v"].alias("v"), F.lit(None).cast("string").alias("d")))

    def grouped(arms: Column, number: Column) -> Column:
        return F.transform(arms, lambda a: F.struct(number.cast("bigint").alias("group_no"), a["operator"], a["t"], a["v"], a["d"]))

    inner = equals(F.regexp_extract(raw, INNER, 1))
    outer = equals(F.regexp_replace(raw, INNER, ""))
    spread = F.flatten(F.transform(inner, lambda b, i: grouped(F.concat(outer, F.array(b)), i + 1)))
    each = F.concat(grouped(inner, F.lit(0)), F.flatten(F.transform(outer, lambda a, i: grouped(F.array(a), i + 1))))
    single = F.struct(
        F.regexp_extract(raw, DEFAULTED, 1).alias("operator"), F.regexp_extract(raw, DEFAULTED, 2).alias("t"),
        F.regexp_extract(raw, DEFAULTED, 4).alias("v"), F.regexp_extract(raw, DEFAULTED, 3).alias("d"),
    )
    return (
        F.when(raw.rlike(OR_WITH_AND), spread)
        .when(raw.rlike(AND_WITH_OR), each)
        .when(raw.rlike(DEFAULTED), grouped(F.array(single), F.lit(1)))
    )


def _gate_arms(rules: DataFrame) -> DataFrame:
    """Arms of question gates; ``operator`` is NULL where the condition is of no known form."""
    gates = rules.where("mechanism = 'question_gate'")
    keys = ["questionnaire", "line_id", "question"]
    flat = gates.where("expression_class <> 'nested'").select(
        *keys, "group_no", "operator", F.col("trigger").alias("t"), F.col("trigger_value").alias("v"),
        # the second argument of isDefined names the value inside an answer and is no comparison
        F.lit(None).cast("string").alias("d"),
    )
    nested = gates.where("expression_class = 'nested'").select(*keys, F.inline_outer(_nested_arms(F.trim("raw_expression"))))
    return flat.unionByName(nested)


def question_axis(lines: DataFrame) -> DataFrame:
    """``questionnaire, question, place``: question heads by the line of their first appearance."""
    head = F.nullif(F.regexp_extract(F.trim("line"), QUESTION_HEAD, 1), F.lit(""))
    heads = lines.select("questionnaire", head.alias("question"), "line_no").where("question IS NOT NULL")
    return heads.groupBy("questionnaire", "question").agg(F.min("line_no").alias("place"))


def resolve(
    lines: DataFrame, rules: DataFrame, surveys: DataFrame, names: DataFrame, codes: DataFrame
) -> Flow:
    """Rules with names replaced by concept ids and option numbers by response concepts.

    ``lines`` are those of :func:`tallgrass.sources.readers.read_markup`, ``rules`` what
    :func:`tallgrass.operators.rules.skip_rules` makes of them. ``surveys`` is ``questionnaire, survey id``,
    ``names`` is ``survey id, name, question_concept_id``, ``codes`` comes from :func:`response_codes`.

    A name is looked up in the rule's own survey first, then in the others, where it must be known once. A
    gate with an arm of unknown form or name is left out as a whole. A jump goes forward only: one to itself
    or back is how a live form insists on an answer. ``_CONTINUE`` goes nowhere, ``END`` behind the last
    question.
    """
    spark = lines.sparkSession
    held = store(rules, scratch_path(spark, "rules"))
    owned = surveys.select("questionnaire", F.col(SURVEY).alias("survey"))
    known = names.select(F.col(SURVEY).alias("in_survey"), "name", F.col(QUESTION).alias("concept")).distinct()
    known = known.groupBy("in_survey", "name").agg(F.min("concept").alias("concept"))
    axis = question_axis(lines).join(owned, "questionnaire").join(
        known.select(F.col("in_survey").alias("survey"), F.col("name").alias("question"), "concept"), ["survey", "question"]
    )
    axis = axis.select("questionnaire", "survey", "question", F.col("concept"), "place")

    arms = _gate_arms(held).join(owned, "questionnaire")
    arms = arms.select("*", F.split("t", ";")[0].alias("name"), F.get(F.split("t", ";"), F.lit(1)).alias("second"))

    # where each name used in a rule leads to, per survey
    used = arms.select("survey", F.explode(F.array("name", "second")).alias("name")).where("name IS NOT NULL").distinct()
    places = used.join(known, "name").withColumn("foreign", F.col("in_survey") != F.col("survey"))
    found = places.groupBy("survey", "name").agg(
        F.min_by(F.struct("in_survey", "concept"), F.struct("foreign", "in_survey")).alias("at"),
        F.bool_and("foreign").alias("elsewhere"), F.count(F.lit(1)).alias("n"),
    ).where("NOT elsewhere OR n = 1")
    found = found.select("survey", "name", "at.in_survey", "at.concept")

    def looked_up(table: DataFrame, column: str, as_survey: str, as_concept: str) -> DataFrame:
        to = found.select("survey", F.col("name").alias(column), F.col("in_survey").alias(as_survey), F.col("concept").alias(as_concept))
        return table.join(to, ["survey", column], "left")

    placed = looked_up(looked_up(arms, "name", "trigger_survey", "trigger"), "second", "other_survey", "other")
    option = codes.select(F.col(QUESTION).alias("trigger"), F.col("code").alias("v"), F.col("response_concept_id"))
    placed = placed.join(option, ["trigger", "v"], "left")
    own = axis.select("questionnaire", "question", F.col("concept").alias("gated"))
    placed = placed.join(own, ["questionnaire", "question"], "left")
    reason = (
        F.when(F.col("operator").isNull(), "form of the condition")
        .when(F.col("trigger").isNull() | (F.col("second").isNotNull() & F.col("other").isNull()), "name of the trigger")
        .when(F.col("gated").isNull(), "name of the question")
    )
    placed = store(placed.withColumn("reason", reason), scratch_path(spark, "placed"))
    broken = placed.where("reason IS NOT NULL").groupBy("questionnaire", "line_id", "question").agg(F.min("reason").alias("reason"))
    value = F.when(F.col("operator") == "equals", F.coalesce("response_concept_id", "v")).when(~F.col("operator").like("is%"), F.col("v"))
    gates = placed.join(broken, ["questionnaire", "line_id"], "left_anti").select(
        "survey", F.col("gated").alias("question"),
        # a question with several gates shows when all of them hold
        F.xxhash64("line_id", "group_no").alias("group_no"), "operator", "trigger_survey", "trigger", "other_survey", "other",
        value.alias("value"), F.col("d").alias("default_value"),
    )

    jumps = held.where("mechanism IN ('answer_jump', 'unconditional_jump', 'no_response_jump')").join(owned, "questionnaire")
    jumps = jumps.join(axis.select("questionnaire", "question", F.col("concept").alias("from_question"), "place"), ["questionnaire", "question"], "left")
    goal = axis.select("questionnaire", F.col("question").alias("target"), F.col("place").alias("target_place"))
    jumps = jumps.join(goal, ["questionnaire", "target"], "left")
    option = codes.select(F.col(QUESTION).alias("from_question"), F.col("code").alias("option"), "response_concept_id")
    jumps = jumps.join(option, ["from_question", "option"], "left").where(F.col("target") != RESUME)
    to = F.when(F.col("target") == END, AFTER_ALL).otherwise(F.col("target_place"))
    kind = F.regexp_replace("mechanism", "_jump$", "")
    jumps = store(
        jumps.select(
            "questionnaire", "line_id", "mechanism", F.col("question").alias("name"), "survey", F.col("from_question").alias("question"), "place", kind.alias("kind"),
            F.coalesce("response_concept_id", "option").alias("value"), to.alias("target"),
        ),
        scratch_path(spark, "jumps"),
    )
    lost = jumps.where("question IS NULL OR target IS NULL").select(
        "questionnaire", "line_id", F.col("name").alias("question"), "mechanism",
        F.when(F.col("question").isNull(), "name of the question").otherwise("target").alias("reason"),
    )
    broken = broken.select("questionnaire", "line_id", "question", F.lit("question_gate").alias("mechanism"), "reason")
    return Flow(
        axis=axis.select("survey", F.col("concept").alias("question"), "place").groupBy("survey", "question").agg(F.min("place").alias("place")),
        gates=gates,
        jumps=jumps.where("target > place").select("survey", "question", "place", "kind", "value", "target"),
        unresolved=broken.unionByName(lost),
    )


def _holds_unanswered() -> Column:
    """Whether a condition holds for someone who has no answer to its trigger."""
    default, value = strict_number(F.col("default_value")), strict_number(F.col("value"))
    compared = (
        F.when(F.col("operator") == "equals", F.col("default_value") == F.col("value"))
        .when(F.col("operator") == "greaterThan", default > value)
        .when(F.col("operator") == "greaterThanOrEqual", default >= value)
    )
    return F.coalesce((F.col("operator") == "isNotDefined") | compared, F.lit(False))


def _identified(conditions: DataFrame) -> DataFrame:
    """``condition`` names a condition by its parts; ``by_default``: it holds without an answer."""
    parts = [F.coalesce(F.col(c), F.lit("\x00")) for c in CONDITION]
    return conditions.withColumn("condition", F.xxhash64(*parts)).withColumn("by_default", _holds_unanswered())


def _participants(fact: DataFrame, conditions: DataFrame) -> DataFrame:
    """``connect_id, holds, blocked``: conditions that answers make true, and defaults that answers rule out.

    ``conditions`` is distinct. Comparisons for equality are joined by trigger and value, so that an answer
    meets only what it makes true; the others by trigger.
    """
    answer, number = F.col("response_value_as_string"), strict_number(F.col("response_value_as_string"))
    answers = fact.select(
        "connect_id", F.col(SURVEY).alias("trigger_survey"), F.col(QUESTION).alias("trigger"), answer.alias("value")
    )
    equal = conditions.where("operator = 'equals'").select("condition", "trigger_survey", "trigger", "value")
    by_value = answers.join(equal, ["trigger_survey", "trigger", "value"]).select("connect_id", "condition", F.lit(True).alias("hit"))
    rest = conditions.where("operator IN ('greaterThan', 'greaterThanOrEqual', 'isDefined') OR by_default").select(
        "condition", "operator", "trigger_survey", "trigger", F.col("value").alias("bound")
    )
    number, bound = strict_number(F.col("value")), strict_number(F.col("bound"))
    hit = (
        F.when(F.col("operator") == "greaterThan", number > bound)
        .when(F.col("operator") == "greaterThanOrEqual", number >= bound)
        .when(F.col("operator") == "isDefined", F.lit(True))
    )
    by_trigger = answers.join(rest, ["trigger_survey", "trigger"]).select("connect_id", "condition", F.coalesce(hit, F.lit(False)).alias("hit"))
    change = conditions.where("operator = 'percentDiff'")
    sides = change.select("condition", F.col("value").alias("least"), F.inline(F.array(
        F.struct(F.col("trigger_survey"), F.col("trigger"), F.lit(True).alias("first")),
        F.struct(F.col("other_survey").alias("trigger_survey"), F.col("other").alias("trigger"), F.lit(False).alias("first")),
    )))
    both = answers.join(sides, ["trigger_survey", "trigger"]).groupBy("connect_id", "condition").agg(
        F.max(F.when(F.col("first"), strict_number(F.col("value")))).alias("x"),
        F.max(F.when(~F.col("first"), strict_number(F.col("value")))).alias("y"),
        F.max(strict_number(F.col("least"))).alias("least"),
    )
    by_change = both.select("connect_id", "condition", F.coalesce(F.try_divide(F.col("x") - F.col("y"), "x") >= F.col("least"), F.lit(False)).alias("hit"))
    met = by_value.unionByName(by_trigger).unionByName(by_change)
    state = met.groupBy("connect_id").agg(
        F.collect_set(F.when(F.col("hit"), F.col("condition"))).alias("holds"), F.collect_set("condition").alias("met")
    )
    return state.select("connect_id", "holds", F.array_except("met", "holds").alias("blocked"))


def _groups(gates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``survey, question, ids`` with the groups of each question, and ``survey, groups`` with all different ones.

    A group has its conditions and those of them that hold by default. Questions share groups, so a survey has
    far fewer than its questions have together.
    """
    per_group = gates.groupBy("survey", "question", "group_no").agg(
        F.array_sort(F.collect_set("condition")).alias("any_of"),
        F.array_sort(F.collect_set(F.when(F.col("by_default"), F.col("condition")))).alias("defaults"),
    ).withColumn("id", F.xxhash64("any_of", "defaults"))
    questions = per_group.groupBy("survey", "question").agg(F.collect_set("id").alias("ids"))
    surveys = per_group.groupBy("survey").agg(F.collect_set(F.struct("id", "any_of", "defaults")).alias("groups"))
    return questions, surveys


def _open_groups() -> Column:
    """Ids of the groups of the row's survey with an arm that holds for its participant."""

    def is_open(g: Column) -> Column:
        by_default = (F.size(g["defaults"]) > 0) & (F.size(F.array_except(g["defaults"], F.col("blocked"))) > 0)
        return F.arrays_overlap(g["any_of"], F.col("holds")) | by_default

    return F.transform(F.filter("groups", is_open), lambda g: g["id"])


def _open(ids: Column) -> Column:
    """Whether all groups ``ids`` are among those open to the participant of the row."""
    return F.size(F.array_except(ids, F.col("open"))) == 0


def _with_state(fact: DataFrame, participants: DataFrame, conditions: DataFrame) -> DataFrame:
    """``connect_id, survey, holds, blocked`` for every participant of every survey."""
    none = F.array().cast("array<bigint>")
    who = participants.select("connect_id", F.col(SURVEY).alias("survey")).distinct()
    return who.join(_participants(fact, conditions), "connect_id", "left").select(
        "connect_id", "survey", F.coalesce("holds", none).alias("holds"), F.coalesce("blocked", none).alias("blocked")
    )


def reachable(fact: DataFrame, participants: DataFrame, gates: DataFrame) -> DataFrame:
    """``connect_id, survey id, question_concept_id, is_shown`` for every participant and gated question of a survey.

    ``participants`` is ``connect_id, survey id``; ``gates`` as in :class:`Flow`. A question that several surveys
    use is judged in each by that survey's gates. Where a trigger has several answers, one that fits is enough.
    ``percentDiff`` is the drop from the first trigger to the second as a share of the first.
    """
    spark = fact.sparkSession
    named = store(_identified(gates), scratch_path(spark, "conditions"))
    conditions = named.select("condition", "by_default", *CONDITION).distinct()
    questions, groups = _groups(named)
    asked = questions.groupBy("survey").agg(F.collect_list(F.struct("question", "ids")).alias("asked"))
    surveys = store(asked.join(groups, "survey"), scratch_path(spark, "asked"))
    state = _with_state(fact, participants, conditions).join(surveys, "survey").withColumn("open", _open_groups())
    rows = state.select("connect_id", F.col("survey").alias(SURVEY), "open", F.inline("asked"))
    return rows.select("connect_id", SURVEY, F.col("question").alias(QUESTION), _open(F.col("ids")).alias("is_shown"))


def reachable_jumps(fact: DataFrame, participants: DataFrame, flow: Flow) -> DataFrame:
    """``connect_id, survey id, question_concept_id, is_open, is_shown`` for every participant and question of a survey.

    ``is_open``: no jump passes the question; ``is_shown``: its gate holds too. The jumps of a survey are folded
    in the order of its questionnaire, one participant at a time: a question that is closed or gated jumps
    nowhere; from a shown one an answer's target comes first (the nearest, if several were chosen), then the
    target for no answer, then the plain one. A jump closes what lies between, so one inside a closed stretch
    is not taken.
    """
    spark = fact.sparkSession
    gates = _identified(flow.gates)
    none = F.lit(None).cast("string")
    empty = {c: none.alias(c) for c in CONDITION}
    asked = {"trigger_survey": F.col("survey").alias("trigger_survey"), "trigger": F.col("question").alias("trigger")}
    chosen = {**empty, **asked, "operator": F.lit("equals").alias("operator"), "value": F.col("value")}
    given = {**empty, **asked, "operator": F.lit("isDefined").alias("operator")}
    keys = ["survey", "question", "place", "kind", "target"]
    steps = flow.jumps.where("kind = 'answer'").select(*keys, *chosen.values()).unionByName(flow.jumps.where("kind <> 'answer'").select(*keys, *given.values()))
    steps = _identified(steps)
    named = store(gates, scratch_path(spark, "conditions"))
    columns = ["condition", "by_default", *CONDITION]
    conditions = named.select(*columns).union(steps.select(*columns)).distinct()

    gated, groups = _groups(named)
    ids = F.coalesce("ids", F.array().cast("array<bigint>")).alias("ids")
    per_step = steps.groupBy("survey", "question", "place").agg(
        F.collect_list(F.when(F.col("kind") == "answer", F.struct("condition", "target"))).alias("answers"),
        F.max(F.when(F.col("kind") != "answer", F.col("condition"))).alias("answered"),
        F.min(F.when(F.col("kind") == "no_response", F.col("target"))).alias("no_response"),
        F.min(F.when(F.col("kind") == "unconditional", F.col("target"))).alias("plain"),
    ).join(gated, ["survey", "question"], "left")
    step = F.struct("place", "answers", "answered", "no_response", "plain", ids)
    paths = per_step.groupBy("survey").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    axis = flow.axis.join(gated, ["survey", "question"], "left").groupBy("survey").agg(
        F.array_sort(F.collect_list(F.struct("place", "question", ids))).alias("axis")
    )
    surveys = store(axis.join(paths, "survey", "left").join(groups, "survey", "left"), scratch_path(spark, "paths"))

    begin = F.struct(F.lit(0).cast("bigint").alias("open"), F.array().cast("array<struct<past:bigint,upto:bigint>>").alias("closed"))

    def taken(x: Column) -> Column:
        fit = F.filter(x["answers"], lambda a: F.array_contains(F.col("holds"), a["condition"]))
        return F.coalesce(
            F.array_min(F.transform(fit, lambda a: a["target"])),
            F.when(~F.array_contains(F.col("holds"), x["answered"]), x["no_response"]),
            x["plain"],
        )

    def fold(s: Column, x: Column) -> Column:
        goes = (x["place"] >= s["open"]) & _open(x["ids"]) & taken(x).isNotNull()
        stretch = F.array(F.struct(x["place"].cast("bigint").alias("past"), taken(x).cast("bigint").alias("upto")))
        return F.when(goes, F.struct(taken(x).cast("bigint").alias("open"), F.concat(s["closed"], stretch).alias("closed"))).otherwise(s)

    none_yet = F.array().cast(surveys.schema["steps"].dataType)
    walked = _with_state(fact, participants, conditions).join(surveys, "survey")
    walked = walked.withColumn("open", F.coalesce(_open_groups(), F.array().cast("array<bigint>")))
    walked = walked.withColumn("closed", F.aggregate(F.coalesce("steps", none_yet), begin, fold)["closed"])
    rows = walked.select("connect_id", F.col("survey").alias(SURVEY), "open", "closed", F.inline("axis"))
    is_open = ~F.exists("closed", lambda c: (c["past"] < F.col("place")) & (F.col("place") < c["upto"]))
    return rows.select(
        "connect_id", SURVEY, F.col("question").alias(QUESTION), is_open.alias("is_open"), (is_open & _open(F.col("ids"))).alias("is_shown")
    )
