"""Sensitivity of questions, release tiers, masking and suppression.

The keyword scan is a heuristic for scoping, not a legal determination. Offsets and cell sizes are
parameters; none is offered as policy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Tiers from least to most restricted.
TIERS = (
    "non_sensitive",
    "quasi_identifier",
    "direct_identifier",
    "geolocation",
    "free_text",
    "genetic",
    "health_sensitive",
)
# Keyword classes of direct identifiers, tested on lower-case text.
IDENTIFIERS = {
    "address": r"\b(address|street|apartment|zip|postal|city|county|town)\b",
    "dates": r"date of birth|birth ?date|date/time|\bdob\b",
    "names": r"\b(first|last|middle|maiden|full) name\b",
    "email": r"\be-?mail\b|[a-z0-9._%+-]@[a-z0-9-]+[.][a-z]{2,}",
    "phone": r"\b(tele)?phone\b|\bmobile number\b",
    "ssn": r"social security|\bssn\b",
    "biometric": r"fingerprint|biometric|genetic",
}
UNCLASSIFIED = "unclassified"  # behind all tiers: no release reaches it


def sensitivity_scan(items: DataFrame, id_column: str, *texts: str, also: Sequence[str] = ()) -> DataFrame:
    """One flag per identifier class and ``is_identifier`` over all of them, from the whole text; ``also`` stays as it is."""
    whole = F.lower(F.concat_ws(" ", *texts))
    flags = [whole.rlike(p).alias(name) for name, p in IDENTIFIERS.items()]
    scanned = items.select(id_column, *also, *flags)
    return scanned.withColumn("is_identifier", F.expr(" OR ".join(IDENTIFIERS)))


def scan_summary(scanned: DataFrame) -> DataFrame:
    """Items per identifier class."""
    names = [*IDENTIFIERS, "is_identifier"]
    counted = scanned.agg(*[F.count_if(name).alias(name) for name in names])
    return counted.unpivot([], names, "identifier", "n")


def pii_flag_audit(scanned: DataFrame) -> DataFrame:
    """Items flagged and found, found only, flagged only, neither. ``scanned`` has the flag ``pii`` as text as well."""
    both = scanned.select((F.lower(F.coalesce("pii", F.lit(""))) == "yes").alias("flagged"), "is_identifier")
    return both.agg(
        F.count_if(F.expr("flagged AND is_identifier")).alias("flag_and_scan"),
        F.count_if(F.expr("NOT flagged AND is_identifier")).alias("scan_only"),
        F.count_if(F.expr("flagged AND NOT is_identifier")).alias("flag_only"),
        F.count_if(F.expr("NOT flagged AND NOT is_identifier")).alias("neither"),
    )


def tier_rank(tier: Column) -> Column:
    """Position of a tier in the restriction order; an unclassified item or an unknown name comes last, most restricted."""
    ranks = [F.when(tier == name, F.lit(rank)) for rank, name in enumerate(TIERS)]
    return F.coalesce(*ranks, F.lit(len(TIERS)))


def unknown_tiers(tiers: DataFrame) -> DataFrame:
    """Rows of a tier table whose tier is no known name."""
    return tiers.where(F.col("tier").isNull() | ~F.col("tier").isin(*TIERS))


def effective_tier(
    fact: DataFrame, question_tiers: DataFrame, response_tiers: DataFrame
) -> DataFrame:
    """Answers with the stricter of their question's and their response's tier.

    A harmless parent never makes a sensitive option harmless, so the maximum is taken per row. A
    question without a known tier is ``unclassified``, which no release lets out; an answer without a
    tier of its own has its question's.
    """
    questions = question_tiers.select("question_concept_id", F.col("tier").alias("question_tier"))
    responses = response_tiers.select(
        F.col("response_concept_id").alias("response_value_as_concept_id"),
        F.col("tier").alias("response_tier"),
    )
    names = F.array(*[F.lit(t) for t in (*TIERS, UNCLASSIFIED)])
    own = F.when(F.col("response_tier").isNull(), F.lit(0)).otherwise(tier_rank(F.col("response_tier")))
    rank = F.greatest(tier_rank(F.col("question_tier")), own)
    return (
        fact.join(questions, "question_concept_id", "left")
        .join(responses, "response_value_as_concept_id", "left")
        .select(*fact.columns, rank.alias("tier_rank"))
        .withColumn("sensitivity_tier", F.element_at(names, F.col("tier_rank") + 1))
    )


def release(tiered: DataFrame, up_to: str) -> DataFrame:
    """Rows whose tier is at most ``up_to``."""
    return tiered.where(F.col("tier_rank") <= TIERS.index(up_to))


def mask_free_text(fact: DataFrame) -> DataFrame:
    """Hide the verbatim text, and the id that is a hash of it, unless one of the typed columns took it."""
    typed = F.coalesce(
        F.col("response_value_as_concept_id"),
        F.col("response_value_as_date").cast("string"),
        F.col("response_value_as_number").cast("string"),
    )
    hidden = [c for c in ("response_value_as_string", "response_unique_id") if c in fact.columns]
    return fact.withColumns({c: F.when(typed.isNotNull(), F.col(c)) for c in hidden})


def drop_free_text(fact: DataFrame, kinds: DataFrame) -> DataFrame:
    """Leave out every answer to a question whose answer is free text, typed or not.

    ``kinds`` is ``question_concept_id, base_type`` of :func:`tallgrass.operators.versions.question_type_norm`. A text
    beside a coded answer is a question of its own, so the coded answer stays.
    """
    free = kinds.where("base_type = 'TEXT_FREE'").select("question_concept_id").distinct()
    return fact.join(free, "question_concept_id", "left_anti").select(*fact.columns)


def shift_days(participant: Column, salt: str, span: int) -> Column:
    """Days to shift a participant's dates, from ``-span`` to ``span``, fixed by a salted hash."""
    digest = F.sha2(F.concat(F.lit(f"{salt}|"), participant), 256)
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return (F.pmod(number, F.lit(2 * span + 1)) - F.lit(span)).cast("int")


def shift_dates(fact: DataFrame, salt: str, span: int) -> DataFrame:
    """Dates moved by one offset per participant, so intervals within a participant are kept.

    The source only asks for a per-participant offset; hashing with a secret salt is our rule. The
    verbatim text of a date is replaced too, or it would give the date away; so would the id, a hash of
    it, which is cleared.
    """
    if "response_unique_id" in fact.columns:
        fact = fact.withColumn("response_unique_id", F.when(F.col("response_value_as_date").isNull(), F.col("response_unique_id")))
    shifted = F.date_add("response_value_as_date", shift_days(F.col("connect_id"), salt, span))
    return fact.withColumn("response_value_as_date", shifted).withColumn(
        "response_value_as_string",
        F.when(F.col("response_value_as_date").isNotNull(), F.col("response_value_as_date").cast("string"))
        .otherwise(F.col("response_value_as_string")),
    )


def top_code_age(fact: DataFrame, age_questions: list[str], limit: int = 89) -> DataFrame:
    """Ages over the limit as ``<limit + 1>+``; the exact number is dropped."""
    too_old = F.col("question_concept_id").isin(*age_questions) & (
        F.col("response_value_as_number") > limit
    )
    too_old = F.coalesce(too_old, F.lit(False))
    return fact.select(
        *[
            F.when(too_old, F.lit(f"{limit + 1}+")).otherwise(F.col(c)).alias(c)
            if c == "response_value_as_string"
            else F.when(~too_old, F.col(c)).alias(c)
            if c in ("response_value_as_number", "response_unique_id")
            else F.col(c)
            for c in fact.columns
        ]
    )


def drop_identifiers(fact: DataFrame, scanned: DataFrame) -> DataFrame:
    """Leave out every answer to a question that the scan found to be an identifier."""
    found = scanned.where("is_identifier").select("question_concept_id").distinct()
    return fact.join(found, "question_concept_id", "left_anti").select(*fact.columns)


Hierarchies = Mapping[str, Sequence[Column]]  # attribute to its forms, finest first


def _levels(people: DataFrame, hierarchies: Hierarchies) -> DataFrame:
    """Every form of every attribute as text, ``<attribute>__<level>``; NULL is a value of its own, ``unknown``."""
    return people.select(
        *[
            F.coalesce(form.cast("string"), F.lit("unknown")).alias(f"{name}__{level}")
            for name, forms in hierarchies.items() for level, form in enumerate(forms)
        ]
    )


def level_sizes(people: DataFrame, hierarchies: Hierarchies) -> DataFrame:
    """For every choice of levels: ``<attribute>`` (its level), ``cells``, ``smallest`` and ``participants_below``.

    ``people`` has one row per participant. All choices come from one pass: participants are counted by the
    finest combination, and grouping sets add those counts up for every choice at once.
    """
    columns = [f"{name}__{level}" for name, forms in hierarchies.items() for level in range(len(forms))]
    finest = _levels(people, hierarchies).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    choices = list(product(*[range(len(forms)) for forms in hierarchies.values()]))
    sets = [[F.col(f"{name}__{level}") for name, level in zip(hierarchies, choice, strict=True)] for choice in choices]
    cells = finest.groupingSets(sets, *columns).agg(F.sum("n").alias("n"), F.grouping_id().alias("gid"))
    sizes = cells.groupBy("gid").agg(F.count(F.lit(1)).alias("cells"), F.min("n").alias("smallest"))

    def gid(choice: Sequence[int]) -> int:
        kept = {f"{name}__{level}" for name, level in zip(hierarchies, choice, strict=True)}
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in kept)

    named = F.create_map(*[F.lit(x) for choice in choices for x in (gid(choice), ",".join(map(str, choice)))])
    chosen = F.split(F.try_element_at(named, "gid"), ",")
    return sizes.select(*[chosen[i].cast("int").alias(name) for i, name in enumerate(hierarchies)], "cells", "smallest")


def finest_levels(people: DataFrame, hierarchies: Hierarchies, least: int) -> dict[str, int] | None:
    """The finest choice of levels at which every combination has ``least`` participants, or None if there is none.

    Finest is the smallest sum of levels; of equal sums the one that keeps the attributes named first finer.
    """
    names = list(hierarchies)
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    best = level_sizes(people, hierarchies).where(F.col("smallest") >= least).orderBy(total, *names).select(*names).first()
    return None if best is None else best.asDict()


def generalised_release(people: DataFrame, hierarchies: Hierarchies, least: int) -> DataFrame:
    """Participants counted by their attributes, each generalised as far as every cell needs to hold ``least`` of them.

    ``people`` has one row per participant; what is no attribute of ``hierarchies`` is dropped. Fewer than
    ``least`` participants at the coarsest levels give an empty release.
    """
    levels = finest_levels(people, hierarchies, least)
    chosen = levels or {name: len(forms) - 1 for name, forms in hierarchies.items()}
    rows = _levels(people, hierarchies).select(*[F.col(f"{name}__{chosen[name]}").alias(name) for name in hierarchies])
    counted = rows.groupBy(*hierarchies).agg(F.count(F.lit(1)).alias("participants"))
    return counted if levels else counted.limit(0)


def suppressed_counts(fact: DataFrame, least: int) -> DataFrame:
    """Participants per coded answer, with small cells hidden.

    Cells under ``least`` are hidden. Where a question has exactly one such cell its smallest visible
    cell is hidden too (the smallest code among equals), or the total would give it away. The source
    names both rules without numbers. Only aggregates are used, so no question is held as a group.
    """
    cells = (
        fact.where("response_value_as_concept_id IS NOT NULL")
        .groupBy("question_concept_id", "response_value_as_concept_id")
        .agg(F.countDistinct("connect_id").alias("participants"))
    )
    small = F.col("participants") < least
    visible = F.struct("participants", "response_value_as_concept_id")
    per_question = cells.groupBy("question_concept_id").agg(
        F.count_if(small).alias("n_small"), F.min(F.when(~small, visible)).alias("next")
    )
    companion = (F.col("n_small") == 1) & (
        F.col("response_value_as_concept_id") == F.col("next.response_value_as_concept_id")
    )
    hidden = small | F.coalesce(companion, F.lit(False))
    return cells.join(per_question, "question_concept_id").select(
        "question_concept_id",
        "response_value_as_concept_id",
        F.when(~hidden, F.col("participants")).alias("participants"),
        hidden.alias("is_suppressed"),
    )
