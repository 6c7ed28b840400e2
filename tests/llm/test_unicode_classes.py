"""Counts and ids against the library over the whole of Unicode."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallgrass.llm.bpe_codec import Codec
from tallgrass.llm.merges import Merges
from tallgrass.llm.token_counts import Counter


@pytest.fixture(scope="module")
def texts():
    """Every code point up to U+3000, and every ninth of the others, between letters, digits and marks."""
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF and (i < 0x3000 or i % 9 == 0)]
    chars += [chr(i) for i in (0x558, 0x58B, 0x88F, 0xC5C, 0x1C89, *range(0xA7CB, 0xA7DE), 0x10940)]
    return [" ".join(f"a{c}1{c}{c} .{c}" for c in chars[i : i + 40]) for i in range(0, len(chars), 40)]


def library(name):
    path = public_tokenizers.path(name)
    with open(path, encoding="utf-8") as file:
        text = file.read()
    own = Tokenizer.from_str(text)
    own.no_truncation()
    own.no_padding()
    return own, text, Merges.read(path)


def test_counts(texts):
    own, text, merges = library("byte_bpe_50k.json")
    assert Counter(merges, text).count(texts) == [len(e.ids) for e in own.encode_batch(texts, add_special_tokens=False)]


def test_ids_and_decoding(texts):
    own, text, merges = library("word_bpe_49k.json")
    for (n, ids, decoded), e in zip(Codec(merges, text).encode(texts), own.encode_batch(texts, add_special_tokens=False), strict=True):
        assert n == len(e.ids) and ids == np.array(e.ids, dtype="<u4").tobytes()
        assert decoded == own.decode(e.ids, skip_special_tokens=False)
