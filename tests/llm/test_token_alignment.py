"""Cross-tokenizer alignment against a plain version written from its definition."""

import collections
import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallgrass.llm import token_alignment
from tallgrass.llm.merges import byte_letters
from tests.llm.test_text_operators import SCHEMA, counted, prose, rows

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["x", " ", "  two  spaces ", "a\n\nb", "▁x", "<s> [INST] <|endoftext|> </s>", "naïve café", "中文 テスト 한국어", "Ա՘ א ع", "é", "ﬁ ligature", "\x1c\x85 ", "👩‍👩‍👧 ok", "a" * 700, " " * 3000 + "x", prose(5, 9000)]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def spans(parts):
    at, found = 0, []
    for part in parts:
        found.append((at, at + len(part)))
        at += len(part)
    return found


def plain(docs, libraries):
    """One row per document, links by comparing all byte ranges."""
    a, b = libraries
    byte = {c: i for i, c in enumerate(byte_letters())}
    letters = {i: t for t, i in a.get_vocab().items()}
    facts = []
    for doc_id, text in docs:
        ids_a = ids_b = ()
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(byte[c] for c in letters[i]) for i in ids_a]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ids_a = ids_b = ()
        if not ids_a:
            facts.append((doc_id, 0, 0, 0, [], ""))
            continue
        span_a, span_b = spans(bytes_a), spans(bytes_b)
        links, low = [], 0
        for i, (s, e) in enumerate(span_a):
            while span_b[low][1] <= s:
                low += 1
            j = low
            while j < len(span_b) and span_b[j][0] < e:
                links.append((ids_a[i], ids_b[j]))
                j += 1
        ends = sorted({e for _, e in span_a} & {e for _, e in span_b})
        told = []
        for s, e in zip([0, *ends], ends, strict=False):
            told.append("|".join(",".join(str(t) for t, (x, y) in zip(ids, span, strict=True) if s <= x and y <= e) for ids, span in ((ids_a, span_a), (ids_b, span_b))))
        facts.append((doc_id, len(ids_a), len(ids_b), len(ends), links, hashlib.sha256(";".join(told).encode()).hexdigest()))
    count = collections.Counter(link for f in facts for link in f[4])
    top = collections.Counter()
    for (_, b_id), n in count.items():
        top[b_id] = max(top[b_id], n)
    return [
        (d, n_a, n_b, groups, len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), sha)
        for d, n_a, n_b, groups, links, sha in facts
    ]


def test_alignment(spark, libraries, monkeypatch):
    given = [(r[0], r[1]) for r in rows()] + [(100 + i, t) for i, t in enumerate(ODD)] + [(3, "twice"), (3, "twice")]
    docs = spark.createDataFrame([(*r, "en", 1, "k", 2, "n", 3, "c") for r in given], SCHEMA).repartition(3)
    got = token_alignment.align_tokenizers(spark, docs, PATH_A, PATH_B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert counted(tuple(r) for r in got.collect()) == counted(plain(given, libraries))
    assert token_alignment.align_tokenizers(spark, docs.limit(0), PATH_A, PATH_B).count() == 0
    blank = token_alignment.align_tokenizers(spark, spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string"), PATH_A, PATH_B)
    assert counted(tuple(r) for r in blank.collect()) == counted([(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")])


def test_lanes_and_steps_meet_every_overlap():
    rnd = np.random.default_rng(4)
    for _ in range(30):
        ends = [np.sort(rnd.choice(np.arange(1, 3000), rnd.integers(1, 1500), replace=False)) for _ in range(2)]
        a, b = (np.unique(np.r_[e, 1000, 3000]) for e in ends)  # two documents: 0-1000 and 1000-3000
        i, j, cut_a, cut_b = token_alignment.align(a, b, np.array([0, np.searchsorted(a, 1000) + 1]))
        start_a, start_b = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
        want = np.argwhere((start_a[:, None] < b[None, :]) & (start_b[None, :] < a[:, None]))
        assert np.array_equal(np.c_[i, j], want)
        assert np.array_equal(a[cut_a], np.intersect1d(a, b)) and np.array_equal(b[cut_b], np.intersect1d(a, b))


def test_both_libraries_split_the_characters_of_the_fast_path_alike():
    with open(PATH_A, encoding="utf-8") as file, open(PATH_B, "rb") as model:
        pair = token_alignment.Pair(json.dumps(json.load(file)), model.read())
    plain_ones = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) <= 0xDFFF and token_alignment.ALIKE(c)]
    texts = [f"a{c}1 {c}{c} .{c}.  {c}\n{c}'s" for c in plain_ones] + ["".join(plain_ones[i : i + 500]) for i in range(0, len(plain_ones), 500)]
    assert len(plain_ones) > 30000
    assert [pair.fast.encode_ordinary(t) for t in texts] == [e.ids for e in pair.slow.encode_batch(texts, add_special_tokens=False)]
