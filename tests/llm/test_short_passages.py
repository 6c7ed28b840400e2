"""Passages of over 50 words that have fewer than 400 bytes."""

import random

import pytest
from corpus_pipeline import repeated_passages
from tallgrass.llm import substring_arrays


def words(rng, count, most=6):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, most))) for _ in range(count))


@pytest.mark.parametrize("period", sorted(substring_arrays.COVERS))
def test_covers_hold_every_difference(period):
    cover = substring_arrays.COVERS[period].tolist()
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_pipeline_cuts_passages_by_words(spark):
    rng = random.Random(5)
    rows, planted = [], {}
    for i in range(0, 120, 2):
        passage = words(rng, rng.randint(52, 65))  # 230 to 350 bytes
        assert len(passage) < 400
        for j in (i, i + 1):
            planted[j] = words(rng, rng.randint(5, 90)), passage, words(rng, rng.randint(5, 90))
            rows.append((j, " ".join(planted[j])))
    line = " ".join("".join(rng.choices("abcdef", k=9)) for _ in range(30))  # 299 bytes, but 30 words
    rows += [(1000 + i, f"{words(rng, 60)} {line} {words(rng, 60)}") for i in range(20)]
    rows += [(2000, None), (2001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in repeated_passages(spark, docs, "").collect()}
    for i, (head, passage, tail) in planted.items():
        assert head[:-3] in left[i] and tail[3:] in left[i] and passage[:40] not in left[i] and passage[-40:] not in left[i]
        assert len(left[i]) <= len(head) + len(tail) + 2
    assert all(left[i] == text for i, text in rows if i >= 1000)


@pytest.mark.parametrize("least", [120, 200, 400])
def test_against_all_strings(spark, least):
    rng = random.Random(least)
    parts = [words(rng, 130) for _ in range(6)]
    texts = [" ".join(rng.choice(parts)[: rng.randint(60, 600)] + words(rng, rng.randint(0, 20)) for _ in range(5)) for _ in range(40)]
    seen, again = set(), set()
    for t in set(texts):
        for i in range(len(t) - least + 1):
            (again if t[i : i + least] in seen else seen).add(t[i : i + least])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.n_removed for r in substring_arrays.remove_repeats(spark, docs, least=least).collect()}
    for i, t in enumerate(texts):
        gone = {k for j in range(len(t) - least + 1) if t[j : j + least] in again for k in range(j, j + least)}
        assert found[i] == (len(t) if texts.count(t) > 1 and len(t) >= least else len(gone))
    assert sum(found.values()) > 0
