"""Passages cut by content: chunks against a plain version, recall of planted passages, and keys by rarest shingles."""

import collections
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallgrass.llm import arrays, paragraph_dedup
from tests.llm.test_text_operators import WORD, prose, rows, shouted

SCHEMA = "doc_id long, text string, cluster long, key long, word long, removed string, size int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, 3, "r", 4) for i, t in texts], SCHEMA).repartition(3)


def chunks(text):
    """``(first word, words)`` by the rule in the docstring, from the module's window hashes."""
    words = WORD.findall(text.encode().lower())
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    hashed = arrays.hash_spans(data, ends - [len(w) for w in words], ends) if words else []
    window = [None, None, *(int(arrays.mix(hashed[i : i + 1] + arrays.mix(hashed[i - 1 : i] + arrays.mix(hashed[i - 2 : i - 1])))[0]) for i in range(2, len(words)))]
    found, start = [], 0
    for i in range(len(words)):
        near = [window[k] for k in range(max(0, i - paragraph_dedup.AROUND), min(len(words), i + paragraph_dedup.AROUND + 1)) if window[k] is not None]
        if window[i] is not None and window[i] == min(near) or i == len(words) - 1 or i - start == paragraph_dedup.LONGEST - 1:
            found.append((start, i + 1 - start, tuple(words[start : i + 1])))
            start = i + 1
    return found


def test_chunks_follow_the_rule():
    texts = [t or "" for _, t, *_ in rows()] + ["a", "a b", "a b c", "x " * 900, prose(8, 700)]
    seen = {}
    for first, offsets, data in arrays.slices(pa.array(texts, pa.large_string()), 4000):
        text, at, size, digest = paragraph_dedup._chunks(data, offsets)
        for k in range(len(offsets) - 1):
            own = np.flatnonzero(text == k)
            want = chunks(texts[first + k])
            assert list(zip(at[own].tolist(), size[own].tolist(), strict=True)) == [w[:2] for w in want]
            for d, w in zip(digest[own].tolist(), want, strict=True):
                assert seen.setdefault(w[2], d) == d
    assert len(set(seen.values())) == len(seen)


def test_runs_of_repeated_chunks(spark):
    texts = [(i, t) for i, t, *_ in rows()[:-2]] + [(50, prose(1, 300)[200:1500].upper()), (51, shouted(prose(3, 6000)[3000:9000]))]
    where = collections.defaultdict(list)
    for i, t in texts:
        if i is not None:
            for at, n, words in chunks(t or ""):
                where[words].append((i, at, n))
    want = []
    for i in {i for i, _ in texts if i is not None}:
        places = sorted((at, n, min(p[:2] for p in ps)) for ps in where.values() if len(ps) > 1 for d, at, n in ps if d == i)
        run = None
        for at, n, head in places:
            gone = (i, at) != head
            if run is not None and run[0] + run[1] == at and run[3] == gone:
                run[1] += n
            else:
                run = [at, n, head, gone]
                want.append((i, run))
    want = {(i, r[0], r[1], *r[2], r[3]) for i, r in want if r[1] >= paragraph_dedup.PASSAGE}
    got = paragraph_dedup.passages(frame(spark, texts).where("doc_id is not null"))
    assert {(r.doc_id, r.first_word, r.n_words, r.first_doc, r.first_doc_word, r.removed) for r in got.collect()} == want


def test_planted_passages_inside_longer_lines_are_found(spark):
    rnd = random.Random(12)
    planted = [" ".join(prose(5000 + i, rnd.randint(51, 70)).split()) for i in range(120)]
    texts, holds = [], set()
    for i, passage in enumerate(planted):
        for k in range(2):
            before, after = (" ".join(prose(9000 + 10 * i + 2 * k + s, rnd.randint(0, 60)).split()) for s in range(2))
            own = passage if k else passage.replace(" ", "\n", rnd.randint(0, 3))
            texts.append((2 * i + k, f"{before} {own} {after}".strip()))
            holds.add(2 * i + k)
    clean = [(1000 + i, prose(20000 + i, 200)) for i in range(120)]
    got = paragraph_dedup.repeated_text(spark, frame(spark, texts + clean))
    assert got.columns == ["doc_id", "kind", "line", "first_word", "n_words", "cluster", "first_doc", "removed"]
    found = {r.doc_id for r in got.where("kind = 'passage'").collect()}
    assert len(found & holds) >= 0.95 * len(holds) and not found - holds


def test_awkward_rows_give_no_passages(spark):
    nothing = [(None, prose(1, 99)), (None, prose(1, 99)), (1, None), (2, ""), (3, " \n\t"), (4, "few words here")]
    assert paragraph_dedup.repeated_text(spark, frame(spark, nothing)).count() == 0
    assert paragraph_dedup.repeated_text(spark, frame(spark, nothing).limit(0)).count() == 0
    twice = paragraph_dedup.repeated_text(spark, frame(spark, [(1, prose(1, 30)), (1, prose(1, 30))]))
    assert {r.doc_id for r in twice.collect()} == {1}


def test_similar_sets_share_one_of_their_rarest_shingles(spark):
    rnd = random.Random(4)
    sets = {}
    for n in range(60):
        sets[n] = set(range(20)) | {rnd.randint(100, 10**9) for _ in range(rnd.randint(0, 14))}  # a passage all share, and more
    for n in range(60, 90):
        sets[n] = set(rnd.sample(sorted(sets[n - 60]), len(sets[n - 60]) - rnd.randint(0, 3)))
    members = spark.createDataFrame([(n, sorted(s)) for n, s in sets.items()], "node long, members array<long>")
    mixed = spark.createDataFrame([(7, n, n, 0, len(s)) for n, s in sets.items()], "key long, node long, label long, main long, n_shingles long")
    keyed = paragraph_dedup._closer(lambda wanted: members.join(wanted, "node", "left_semi"), 80)(mixed)
    assert set(keyed.columns) == {"key", "main", "at", "node", "label", "n_shingles"}
    by_key = collections.defaultdict(dict)
    for r in keyed.collect():
        by_key[r.key][r.node] = r.at

    def room(a, b, at):
        """Whether so many members can be shared as similar sets do, when none before this one is."""
        return 180 * (1 + min(len(sets[a]) - at[a], len(sets[b]) - at[b])) >= 80 * (len(sets[a]) + len(sets[b]))

    met = {(a, b) for at in by_key.values() for a in at for b in at if a < b and room(a, b, at)}
    alike = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert alike and alike <= met and len(met) < 3 * len(alike)
    assert keyed.where(F.col("label").isNull()).count() == 0
