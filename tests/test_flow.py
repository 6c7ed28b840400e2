"""Lines in file order, rules per questionnaire, and reachability against plain Python."""

import random
import time

import pytest

from tallgrass.operators import flow, rules
from tallgrass.sources import readers

GATES = (
    "survey string, question string, group_no bigint, operator string, trigger_survey string, trigger string, other_survey string,"
    " other string, value string, default_value string"
)
FACT = "connect_id string, secondary_source_concept_id string, question_concept_id string, response_value_as_string string"
WHO = "connect_id string, secondary_source_concept_id string"


# ---- lines -------------------------------------------------------------------------------------------


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of a few hundred bytes, packed into tasks in any order."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "1")
    spark.conf.set(names[2], "3")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_lines_of_files_of_different_size_are_numbered_in_order(spark, tmp_path, small_blocks):
    sizes = {"b_large.txt": 900, "a_small.txt": 3, "c_middle.txt": 140, "d_empty.txt": 0}
    for name, n in sizes.items():
        (tmp_path / name).write_text("".join(f"{name} line {i} {'x' * (i % 37)}\n" for i in range(n)))
    got = readers.read_markup(spark, str(tmp_path)).orderBy("line_id").collect()
    want = [(name, i + 1, f"{name} line {i} {'x' * (i % 37)}") for name in sorted(sizes) for i in range(sizes[name])]
    assert [(r.questionnaire, r.line_no, r.line) for r in got] == want
    assert [r.line_id for r in got] == list(range(1, len(want) + 1))


def test_a_folder_of_parts_is_one_questionnaire(spark, tmp_path, small_blocks):
    for survey, parts in (("s1", 3), ("s2", 1)):
        folder = tmp_path / f"questionnaire={survey}"
        folder.mkdir()
        for part in range(parts):
            (folder / f"part-{part:05d}.txt").write_text("".join(f"{survey} {part} {i}\n" for i in range(200)))
    got = readers.read_markup(spark, str(tmp_path)).orderBy("line_id").collect()
    assert [(r.questionnaire, r.line_no) for r in got] == [("s1", i + 1) for i in range(600)] + [("s2", i + 1) for i in range(200)]
    assert [r.line for r in got[:600]] == [f"s1 {p} {i}" for p in range(3) for i in range(200)]


def test_dictionary_files_follow_each_other(spark, tmp_path):
    for name, words in (("b.csv", ["three"]), ("a.csv", ["one", "two\nlines"])):
        body = "".join(f'"","","d{i}","{w}"\n' for i, w in enumerate(words))
        (tmp_path / name).write_text("h0,h1,h2,h3\n" + body)
    rows = readers.read_flat_dictionary(spark, str(tmp_path)).orderBy("rn").collect()
    assert [r[2] for r in rows] == ["one", "two\nlines", "three"]
    assert len({r.rn for r in rows}) == 3


def test_heads_stay_in_their_questionnaire(spark, tmp_path):
    (tmp_path / "one.txt").write_text("[A?] First\n(1) Yes -> B\n[B?] Second\n")
    (tmp_path / "two.txt").write_text("(1) Yes -> C\n[C?,displayif=equals(A,1)] Third\n(2) No -> D\n")
    lines = readers.read_markup(spark, str(tmp_path))
    got = {(r.questionnaire, r.line_no, r.question, r.target) for r in rules.skip_rules(lines).collect()}
    assert got == {("one.txt", 2, "A", "B"), ("two.txt", 1, None, "C"), ("two.txt", 2, "C", None), ("two.txt", 3, "C", "D")}


# ---- reachability ------------------------------------------------------------------------------------


def numbers(values):
    return [float(v) for v in values if v.replace(".", "").isdigit()]


def holds(answers, arm):
    """One condition in plain Python; ``answers`` maps (survey, question) to values."""
    operator, survey, trigger, other_survey, other, value, default = arm
    values = answers.get((survey, trigger), [])
    if operator == "isDefined":
        return bool(values)
    if operator == "isNotDefined":
        return not values
    if operator == "percentDiff":
        first, second = numbers(values), numbers(answers.get((other_survey, other), []))
        return bool(first and second and max(first) != 0 and (max(first) - max(second)) / max(first) >= float(value))
    if not values and default is not None:
        values = [default]
    if operator == "equals":
        return value in values
    return any(v > float(value) if operator == "greaterThan" else v >= float(value) for v in numbers(values))


def is_open(answers, gates, survey, question):
    groups = {}
    for g in gates:
        if g[:2] == (survey, question):
            groups.setdefault(g[2], []).append(holds(answers, g[3:]))
    return all(any(arms) for arms in groups.values())


def random_gates(rnd, n):
    triggers = [("s", "t1"), ("s", "t2"), ("s", "t3"), ("u", "t1"), ("u", "t4")]
    gates = []
    for _ in range(n):
        question, survey = f"q{rnd.randint(0, 7)}", rnd.choice("su")
        operator = rnd.choice(["equals", "equals", "greaterThan", "greaterThanOrEqual", "isDefined", "isNotDefined", "percentDiff"])
        other = rnd.choice(triggers) if operator == "percentDiff" else (None, None)
        value = None if operator.startswith("is") else "0.3" if operator == "percentDiff" else str(rnd.randint(0, 4))
        default = str(rnd.randint(0, 4)) if value and operator != "percentDiff" and rnd.random() < 0.3 else None
        gates.append((survey, question, rnd.randint(1, 3), operator, *rnd.choice(triggers), *other, value, default))
    return gates


def random_answers(rnd, people):
    fact = []
    for p in range(people):
        for survey, question in (("s", "t1"), ("s", "t2"), ("s", "t3"), ("u", "t1"), ("u", "t4")):
            fact += [(f"p{p}", survey, question, rnd.choice(["0", "1", "2", "3", "4", "", "text"])) for _ in range(rnd.choice([0, 1, 1, 2]))]
    return fact


def by_person(fact):
    answers = {}
    for p, survey, question, value in fact:
        answers.setdefault(p, {}).setdefault((survey, question), []).append(value)
    return answers


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reachability_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    gates, fact = random_gates(rnd, 30), random_answers(rnd, 50)
    who = [(f"p{p}", s) for p in range(60) for s in ("s", "u", "v")] + [("p1", "s")]
    got = flow.reachable(spark.createDataFrame(fact, FACT), spark.createDataFrame(who, WHO), spark.createDataFrame(gates, GATES))
    found = {(r.connect_id, r.secondary_source_concept_id, r.question_concept_id): r.is_shown for r in got.collect()}
    answers = by_person(fact)
    asked = {g[:2] for g in gates}
    assert found == {(p, s, q): is_open(answers.get(p, {}), gates, s, q) for p, s in who for t, q in asked if t == s}
    assert got.count() == len(found)


def walk(answers, gates, axis, jumps):
    """Places of one survey that a participant passes, and those shown."""
    order, seen, shown, at = sorted(axis.items(), key=lambda x: x[1]), set(), set(), 0
    for question, place in order:
        if place < at:
            continue
        seen.add(question)
        if not is_open(answers, gates, "s", question):
            continue
        shown.add(question)
        own = [j for j in jumps if j[1] == question]
        values = answers.get(("s", question), [])
        chosen = [j[5] for j in own if j[3] == "answer" and j[4] in values]
        none = [j[5] for j in own if j[3] == "no_response"] if not values else []
        plain = [j[5] for j in own if j[3] == "unconditional"]
        goal = min(chosen) if chosen else min(none) if none else min(plain) if plain else 0
        at = max(at, goal)
    return seen, shown


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_jumps_against_a_walk(spark, seed):
    rnd = random.Random(seed)
    axis = {q: 10 * i + 3 for i, q in enumerate(["t1", "q0", "t2", "q1", "q2", "t3", "q3", "q4", "q5", "q6"])}
    gates = [("s", *g[1:]) for g in random_gates(rnd, 6) if g[1] in axis]
    jumps = []
    for q in axis:
        for _ in range(rnd.choice([0, 1, 2])):
            kind = rnd.choice(["answer", "answer", "answer", "unconditional", "no_response"])
            target = rnd.choice([p for p in axis.values() if p > axis[q]] + [flow.AFTER_ALL])
            jumps.append(("s", q, axis[q], kind, str(rnd.randint(0, 4)) if kind == "answer" else None, target))
    fact = random_answers(rnd, 50)
    who = [(f"p{p}", s) for p in range(55) for s in ("s", "u")]
    made = flow.Flow(
        spark.createDataFrame([("s", q, p) for q, p in axis.items()], "survey string, question string, place bigint"),
        spark.createDataFrame(gates, GATES),
        spark.createDataFrame(jumps, "survey string, question string, place bigint, kind string, value string, target bigint"),
        None,
    )
    got = flow.reachable_jumps(spark.createDataFrame(fact, FACT), spark.createDataFrame(who, WHO), made).collect()
    answers, want = by_person(fact), set()
    for p in range(55):
        seen, shown = walk(answers.get(f"p{p}", {}), gates, axis, jumps)
        want |= {(f"p{p}", "s", q, q in seen, q in shown) for q in axis}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_a_thousand_rules_cost_less_than_twice_a_hundred(spark):
    """Conditions are evaluated once each and rules only read the set of those that hold."""
    rnd = random.Random(5)
    fact = spark.createDataFrame(
        [(f"p{i}", "s", f"t{t}", str(rnd.randint(0, 9))) for i in range(1000) for t in range(8)], FACT
    ).cache()
    who = fact.select("connect_id", "secondary_source_concept_id").distinct().cache()
    who.count()
    seconds = {}
    for n in (100, 1000, 100, 1000, 100, 1000):
        gates = spark.createDataFrame(
            [("s", f"q{i}", g, "equals", "s", f"t{rnd.randint(0, 7)}", None, None, str(rnd.randint(0, 9)), None) for i in range(n) for g in (1, 2)], GATES
        )
        start = time.perf_counter()
        rows = flow.reachable(fact, who, gates).groupBy("is_shown").count().collect()
        seconds[n] = min(seconds.get(n, 1e9), time.perf_counter() - start)
        assert sum(r["count"] for r in rows) == 1000 * n
    assert seconds[1000] < 2 * seconds[100]


def test_names_codes_and_nested_forms_resolve(spark, tmp_path):
    (tmp_path / "s.txt").write_text(
        "[A!] a\n(1) Yes -> C\n(2) No -> _CONTINUE\n(3) Maybe -> A\n(4) Out -> END\n"
        "[B?,displayif=or(equals(A,2),and(equals(X,1),equals(A,3)))] b\n"
        "[C?,displayif=and(equals(A,1),or(equals(X,1),equals(X,2)))] c\n< -> NOWHERE >\n"
        "[D?,displayif=greaterThanOrEqual(isDefined(X,7),5)] d\n"
        "[E?,displayif=or(equals(A,1),greaterThan(X,2))] mixed\n[F?,displayif=equals(TWICE,1)] known in two others\n"
    )
    lines = readers.read_markup(spark, str(tmp_path))
    surveys = spark.createDataFrame([("s.txt", "s")], "questionnaire string, secondary_source_concept_id string")
    names = spark.createDataFrame(
        [("s", n, n.lower()) for n in "ABCDEF"] + [("u", "X", "x"), ("u", "A", "ua"), ("u", "TWICE", "t1"), ("w", "TWICE", "t2")],
        "secondary_source_concept_id string, name string, question_concept_id string",
    )
    bridge = spark.createDataFrame([("a", "yes"), ("a", "no"), ("x", "yes")], "question_concept_id string, response_concept_id string")
    labels = spark.createDataFrame([("yes", "1 = Yes"), ("no", " 2 = No"), ("odd", "none")], "response_concept_id string, format_value string")
    made = flow.resolve(lines, rules.skip_rules(lines), surveys, names, flow.response_codes(bridge, labels))
    groups = {}
    for r in made.gates.collect():
        groups.setdefault(r.question, {}).setdefault(r.group_no, set()).add((r.operator, r.trigger_survey, r.trigger, r.value, r.default_value))
    a1, a2, a3 = (("equals", "s", "a", v, None) for v in ("yes", "no", "3"))
    x1, x2 = (("equals", "u", "x", v, None) for v in ("yes", "2"))
    assert {q: sorted(map(sorted, g.values())) for q, g in groups.items()} == {
        "b": sorted([sorted({a2, x1}), sorted({a2, a3})]),
        "c": sorted([[a1], sorted({x1, x2})]),
        "d": [[("greaterThanOrEqual", "u", "x", "5", "7")]],
    }
    assert {(r.question, r.place, r.kind, r.value, r.target) for r in made.jumps.collect()} == {("a", 1, "answer", "yes", 7), ("a", 1, "answer", "4", flow.AFTER_ALL)}
    assert {(r.question, r.mechanism, r.reason) for r in made.unresolved.collect()} == {
        ("C", "unconditional_jump", "target"), ("E", "question_gate", "form of the condition"), ("F", "question_gate", "name of the trigger"),
    }
