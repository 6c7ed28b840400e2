"""The text operators on awkward rows, each against a brute-force version or the tokenizer library."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallgrass.llm import (
    bpe_codec, chat_format, decontaminate, jaccard_join, license_scan, lm_score, paragraph_dedup, quality_rules,
    substring_arrays, token_counts,
)

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# columns that operators use inside must not clash with those of the input
SCHEMA = "doc_id long, text string, lang string, node long, kept string, text_id long, n_words string, part int, component string"


def prose(seed, n):
    rnd = random.Random(seed)
    syllables = ["the", "on", "er", "re", "été", "ing", "of", "and", "tion", "ße", "ha"]
    text = " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(n))
    return re.sub(r"((?:\S+ ){24}\S+) ", r"\1\n", text)


def shouted(text):
    """A-Z only, as the operators fold nothing else."""
    return "".join(c.upper() if c.isascii() else c for c in text)


def changed(text, every, shift=0):
    return " ".join(w + "x" if i % every == shift else w for i, w in enumerate(text.split(" ")))


def rows():
    base, other = prose(1, 300), prose(2, 90)
    texts = [
        base, base, changed(base, 120), changed(base, 120, 3), changed(base, 4), shouted(base),
        other, changed(other, 60), "", None, " \n\t ", "one", "one two", "one two", "a" * 2000, "word " * 700,
        other + " Licensed under the Apache License, Version 2.0.\n" + base[:700], "Released under the MIT License.",
        "GNU General Public License", "mit\nLICENSE mit license", "<|endoftext|>x<|startoftext|>", "AΣ ΑΣ İ ½ 中文", prose(3, 6000),
    ]
    found = [(i, t) for i, t in enumerate(texts)] + [(None, base), (None, None), (0, base), (7, prose(9, 40))]
    return [(i, t, None if i is None else "en", 1, "k", 2, "n", 3, "c") for i, t in found]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def given():
    return [(r[0], r[1] or "") for r in rows()]


def counted(items):
    return collections.Counter(items)


def shingle_set(text, size):
    words = WORD.findall(text.encode().lower())
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join(spark, docs, empty, size, percent):
    sets = [(i, shingle_set(t, size)) for i, t in given()]
    named = [(i, s) for i, s in sets if i is not None and s]
    linked = [(a, b) for a, s in named for b, t in named if 100 * len(s & t) >= percent * len(s | t)]
    where = groups({i for i, _ in sets if i is not None}, linked)
    want = counted((i, len(s), None if i is None else where[i] if s else i) for i, s in sets)
    assert counted(tuple(r) for r in jaccard_join.jaccard_join(spark, docs, size, percent).collect()) == want
    assert jaccard_join.jaccard_join(spark, empty, size, percent).count() == 0


def test_jaccard_join_of_longer_sets(spark):
    """Sets over 64 at 0.8 take their keys from independent cuts; similarities lie on both sides of the threshold."""
    texts = []
    for seed, words in enumerate((70, 90, 130, 240, 500, 1500)):
        base = prose(500 + seed, words).replace("\n", " ")
        texts += [base] + [changed(base, every, shift) for every in (40, 44, 47, 50, 60) for shift in (0, 3, 11)]
    sets = [shingle_set(t, 5) for t in texts]
    linked = [(a, b) for a, s in enumerate(sets) for b, t in enumerate(sets[:a]) if 100 * len(s & t) >= 80 * len(s | t)]
    where = groups(set(range(len(texts))), linked)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(spark, docs, 5, 80).collect()}
    assert found == {i: where[i] for i in range(len(texts))}
    assert jaccard_join._cuts(80)[1].any() and not jaccard_join._cuts(90)[1].any()


def test_token_counts(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = counted((i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 1024) for i, t in given())
    assert counted(tuple(r) for r in token_counts.token_counts(docs, path).collect()) == want
    assert token_counts.token_counts(empty, path).count() == 0


def test_bpe_codec(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = counted(
        (i, len(ids := library.encode(t, add_special_tokens=False).ids), np.array(ids, dtype="<u4").tobytes(), library.decode(ids, skip_special_tokens=False))
        for i, t in given()
    )
    assert counted((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe_codec.encode(docs, path).collect()) == want
    assert bpe_codec.encode(empty, path, digest=True).count() == 0


def test_paragraph_dedup(spark, docs, empty):
    lines = [((i, n), shingle_set(line, 5)) for i, t in given() if i is not None for n, line in enumerate(t.split("\n")) if len(WORD.findall(line.encode())) >= 20]
    alike = [(a, b) for a, (_, s) in enumerate(lines) for b, (_, t) in enumerate(lines[:a]) if 100 * len(s & t) >= 80 * len(s | t)]
    where = groups(range(len(lines)), alike)
    want = collections.defaultdict(list)
    for n, (name, _) in enumerate(lines):
        want[where[n]].append(name)
    want = sorted(sorted(names) for names in want.values() if len(names) > 1)
    got = collections.defaultdict(list)
    for r in paragraph_dedup.paragraph_dedup(spark, docs).collect():
        got[r.cluster].append((r.doc_id, r.line))
        assert r.removed == ((r.doc_id, r.line) != (r.first_doc, r.first_line))
    assert sorted(sorted(names) for names in got.values()) == want
    assert paragraph_dedup.paragraph_dedup(spark, empty).count() == 0


def test_difference_cover_reaches_every_shift():
    cover = substring_arrays.COVER.tolist()
    assert {(a - b) % substring_arrays.PERIOD for a in cover for b in cover} == set(range(substring_arrays.PERIOD))


def test_suffix_dedup(spark, docs, empty):
    texts, least = [(i, t.encode()) for i, t in given()], 400
    seen = counted(t[k : k + least] for _, t in texts for k in range(len(t) - least + 1))
    want = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - least + 1):
            if seen[t[k : k + least]] > 1:
                gone[k : k + least] = b"\1" * least
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        want.append((i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    got = substring_arrays.remove_repeats(spark, docs).collect()
    assert counted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got) == counted(want)
    assert substring_arrays.remove_repeats(spark, empty).count() == 0


def test_suffix_dedup_of_texts_that_share_less_or_more_than_a_string(spark):
    """Open suffixes without a repeat in their batch, one in two batches, none open, and one text alone."""
    passage = prose(61, 300)
    less = [(1, prose(62, 150) + passage[:200]), (2, passage[:200] + prose(63, 150))]
    more = [(3, prose(64, 150) + passage[300:900]), (4, passage[300:900] + prose(65, 150))]
    nothing = [(5, prose(66, 150)), (6, prose(67, 150))]
    for texts in (less, more, nothing, nothing[:1], less + more + nothing):
        own = spark.createDataFrame(texts, "doc_id long, text string").repartition(len(texts))
        removed = {r.doc_id: r.n_removed for r in substring_arrays.remove_repeats(spark, own).collect()}
        assert removed == {i: len(passage[300:900].encode()) if i in (3, 4) else 0 for i, _ in texts}


def test_quality_rules(spark, docs, empty):
    want = []
    for i, t in given():
        words = [w.decode() for w in WORD.findall(t.encode())]
        lines = [line for line in t.split("\n") if WORD.search(line.encode())]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        often = counted(windows)
        covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed))
    got = quality_rules.quality_rules(spark, docs).collect()
    assert counted(tuple(r)[:7] for r in got) == counted(want)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.quality_rules(spark, empty).count() == 0


def test_divergence_rejects_symbols_and_keeps_prose(spark):
    clean = [(i, prose(i, 200), "en") for i in range(40)]
    junk = [(99, " ".join(w + "###$$$" for w in prose(50, 200).split()), "en")]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark, spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")).collect()}
    assert kept.pop(99) is False and all(kept.values())


def test_divergence_rejects_texts_without_the_common_words_of_their_language(spark):
    common = {
        "en": "the of and to in a is that for it was on are as with".split(),
        "de": "der die und den von das mit sich des auf ist im dem nicht ein".split(),
    }

    def words(seed, lang, n, share=0.22):
        rnd = random.Random(f"{lang} {seed}")
        return [rnd.choice(common[lang]) if rnd.random() < share else "".join(rnd.choice("abdefgilmnorstu") for _ in range(rnd.randint(4, 9))) for _ in range(n)]

    lengths = (100, 150, 300, 1200)
    clean = [(f"clean {lang}", " ".join(words(i, lang, lengths[i % 4])), lang) for lang in common for i in range(40)]
    junk = [("salad", " ".join(words(900 + n, "en", n, 0)), "en") for n in lengths]
    junk += [("other language", " ".join(words(900 + n, "de", n)), "en") for n in lengths]
    junk += [("blocks", " | ".join(words(910 + n, "en", n, 0)), "en") for n in lengths]
    rows = [(i, t, lang) for i, (_, t, lang) in enumerate(clean + junk)]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [name for i, (name, _, _) in enumerate(clean + junk) if kept[i]] == [name for name, _, _ in clean]


def test_license_scan(spark, docs, empty):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    want = []
    for i, t in given():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().lower().decode())
        places = [(k, label) for p, label in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        starts = [k for k, _ in places]
        want.append((i, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
    got = license_scan.license_scan(spark, docs).collect()
    assert counted(tuple(r)[:6] for r in got) == counted(want)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert license_scan.license_scan(spark, empty).count() == 0


def test_license_template_without_a_base_phrase(spark):
    text = "x y. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: a"
    row = license_scan.license_scan(spark, spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.labels, row.base_labels) == ("bsd", "") and row.score > 0.9


def test_license_scan_of_files_with_many_notices(spark):
    """Every notice counts, however many others or common licence words the file holds."""
    notices = [t for _, t, _ in license_scan.TEMPLATES]
    label = [n for n, _, _ in license_scan.TEMPLATES]
    filler = "code file form into person program version source software documentation copyright charge deal domain"
    several = [[1, 3, 5], [1, 3, 6], [0, 2, 4, 7], list(range(len(notices)))]
    texts = [(k, "\n\n".join([filler, *(notices[i] for i in some), filler])) for k, some in enumerate(several)]
    got = {r.doc_id: set(r.labels.split(",")) for r in license_scan.license_scan(spark, spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for k, some in enumerate(several):
        assert {label[i] for i in some} <= got[k], (some, got[k])


def test_chats_read_back(spark):
    said = ["</s>[INST] ok [/INST]", "<|im_end|>\n&lt;", None, "", "é\n\n", "&amp;[<"]
    turns = [(c, t, r, said[(c + t) % 6]) for c in range(6) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"][: c + 1])]
    turns += [(9, 0, "us\ner", "x"), (9, 0, "us\ner", "x"), (9, None, None, None), (None, 0, "user", "q"), (None, 1, "assistant", "a")]
    df = spark.createDataFrame([(*t, "z") for t in turns], "conv_id long, turn long, role string, text string, turns string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(df)).collect()}
    want = collections.defaultdict(list)
    for c, t, r, x in turns:
        want[c].append((-1 if t is None else t, r or "", x or ""))
    for c, own in want.items():
        own.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, r, x in own]
        assert got[c].trained == "".join(x for _, r, x in own if r == "assistant")
        assert got[c].formatted.count("<|im_end|>") == len(own)
    assert [got[c].valid for c in (0, 1, 2, 3, 4, 9, None)] == [False, False, True, False, True, False, True]
    assert got[9].stopped_at == 0
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_lm_score(spark, docs, empty):
    tokens = [(i, WORD.findall(t.encode().lower()) + [None]) for i, t in given()]

    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    seen = counted(w for i, words in tokens if not held(i) for w in words)
    total, distinct = sum(seen.values()), len(seen)
    want = sorted(
        (str(i), held(i), len(w), sum(seen[x] > 0 for x in w), total, round(sum(math.log10((seen[x] + 1) / (total + distinct + 1)) for x in w), 6))
        for i, w in tokens
    )
    got = lm_score.lm_score(spark, docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert lm_score.lm_score(spark, empty).count() == 0


def test_lm_score_of_a_filter_too_large_to_broadcast(spark, docs):
    """The filter is whole, whatever may be broadcast, and gives the same scores from the executors."""
    want, got = (sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in df.collect()) for df in (lm_score.lm_score(spark, docs), lm_score.lm_score(spark, docs, max_bits=512)))
    assert got == want


def test_lm_score_knows_pairs_seen_once(spark):
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(40)]
    words = [f"w{i}" for i in range(300)]
    learnt, back = held.index(False), held.index(True)
    texts = [(learnt, " ".join(words)), (back, " ".join(reversed(words)))]
    got = {r.doc_id: r.score for r in lm_score.lm_score(spark, spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    unseen = math.log10(0.6 * 2 / 603)  # each of 301 distinct tokens once; the first has none before it
    assert got[learnt] > 300 * math.log10(0.4) + 2 * unseen  # every pair stands once after a word that stands once
    assert got[back] < 270 * unseen  # pairs never seen, but for false levels


def test_filter_gives_back_quantised_counts():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    counts = np.random.default_rng(2).integers(1, 500, 20_000)
    part = lm_score._part(keys, 4)
    lm = lm_score.Filter([lm_score.Filter.segment(keys[part == p], counts[part == p], 1 << 22) for p in range(4)])
    assert (lm.count(keys) >= counts / lm_score.BASE).all()  # no false absence
    fresh = np.random.default_rng(3).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert (lm.count(fresh) > 0).mean() < 0.02


def levenshtein(item, text):
    last = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        last = row
    return min(last)


def test_decontamination(spark, docs, empty):
    item, far = prose(20, 30), prose(21, 30)
    typo = item[:40] + "Q" + item[41:90] + item[92:]
    texts = [(100, f"ab {item} cd"), (101, shouted(item)), (102, f"x\n{typo}  y"), (103, far[: len(far) // 2]), (104, None), (105, "")]
    own = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, far), (3, "short"), (4, None), (None, item)], "item_id long, text string")

    def normal(t):
        return b" ".join(WORD.findall((t or "").encode().lower()))

    want = set()
    for d, t in texts:
        for i, x in ((1, item), (2, far)):
            distance = levenshtein(normal(x), normal(t))
            if distance <= len(normal(x)) * 6 // 100:
                want.add((d, i, distance))
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.find_items(spark, own, items).collect()}
    assert got == want and len(got) == 3
    assert decontaminate.find_items(spark, docs, items.limit(0)).count() == 0
    assert decontaminate.find_items(spark, empty, items).count() == 0
    assert decontaminate.find_items(spark, docs, items).count() == 0


def test_short_items_are_held_word_for_word(spark, monkeypatch):
    short = [(1, "What is seven times eight?"), (2, "Capital of\nFrance"), (3, "eight by"), (4, "tiny"), (5, "x" * 39), (6, None), (7, "what is seven times eight?")]
    texts = [
        (1, "So: WHAT is  seven\ntimes eight? 56."), (2, "the capital of france, Paris"), (3, "capital of francexx capital of france"), (4, "aeight by"), (5, "eight byé eight by"),
        (6, "What is seven times eighty?"), (7, "x" * 40), (8, "x" * 39), (9, "What is seven times eight"), (10, None), (None, "eight by"), (None, "eight by"), (11, prose(71, 400) + " eight by."),
    ]
    own = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame(short, "item_id long, text string")

    def found():
        return counted((r.doc_id, r.item_id, r.distance) for r in decontaminate.find_items(spark, own, items).collect())

    want = counted([(1, 1, 0), (1, 7, 0), (2, 2, 0), (3, 2, 0), (5, 3, 0), (8, 5, 0), (None, 3, 0), (None, 3, 0), (11, 3, 0)])
    assert found() == want
    monkeypatch.setattr(decontaminate, "BLOCK", 1)  # a block for each item
    assert found() == want


def test_pipeline_stages_on_awkward_rows(spark, docs, empty, tmp_path):
    spark.createDataFrame([(1, prose(1, 300)[:300])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, str(tmp_path))
        assert left.columns == docs.columns, name
        ids = [r.doc_id for r in left.collect()]
        assert 22 in ids, name  # a long clean text stays in every stage
        assert stage(spark, empty, str(tmp_path)).count() == 0
    leaks = dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, docs, str(tmp_path))
    assert 0 not in [r.doc_id for r in leaks.collect()]
    near = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, str(tmp_path))
    kept = [r.doc_id for r in near.where(F.col("doc_id").isin(0, 1, 2, 3, 5, 12, 13)).collect()]
    assert sorted(kept) == [0, 12]


def test_pipeline_stages_keep_columns_named_like_their_own(spark, tmp_path):
    spark.createDataFrame([(1, prose(1, 300)[:300])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    base, alone = prose(81, 300), prose(82, 300)
    rows_ = [(1, base, 1, 2, 3, "a"), (2, base, 4, 5, 6, "b"), (3, alone + base[:900], 7, 8, 9, "c"), (4, None, 1, 1, 1, None)]
    own = spark.createDataFrame(rows_, "doc_id long, text string, __row long, __kept long, `row name` long, kept string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, own, str(tmp_path))
        assert left.columns == own.columns, name
        assert {(r[0], *r[2:]) for r in left.collect()} <= {(r[0], *r[2:]) for r in rows_}, name
    assert spark.createDataFrame([], own.schema).transform(lambda d: corpus_pipeline.STAGES[2][1](spark, d, str(tmp_path))).count() == 0


def test_near_duplicates_judges_rows_that_share_an_id_or_have_none(spark, tmp_path):
    base, alone, other, third = prose(40, 200), prose(41, 200), prose(42, 200), prose(43, 200)
    texts = [(1, base), (2, base), (2, alone), (3, other), (3, third), (None, base), (None, third), (None, prose(44, 90)), (None, prose(44, 90)), (4, base), (4, ""), (4, ""), (5, None)]
    own = spark.createDataFrame(texts, "doc_id long, text string")
    left = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, own, str(tmp_path))
    want = [(1, base), (2, alone), (3, other), (3, third), (None, prose(44, 90)), (4, ""), (4, ""), (5, None)]
    assert counted((r.doc_id, r.text) for r in left.collect()) == counted(want)
