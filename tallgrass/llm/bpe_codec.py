"""BPE encoding and decoding: speculate, verify, and merge exactly only what fails.

Greedy longest matching proposes the tokens of each distinct word. A proposal is the true encoding when
every adjacent pair of it is compatible, that is, when merging the two tokens' symbols gives the two
tokens again. Compatibility of all pairs of a slice is tested in step by undoing merges at the border
(``compatible``). Words with a failing pair are merged exactly.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallgrass.llm.merges import NONE, Merges, byte_letters, text_slices
from tallgrass.llm.token_counts import PLAIN

# fixed value: the word end of the vocabulary
END = "</w>"
STOP = "\x01"  # stands for the word end inside the matcher; no byte is spelled like it
_L = r"a-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
# fixed value: the word pattern
PLAIN_WORDS = rf"[{_L}]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\s0-9{_L}]+"  # where PLAIN holds
KEPT = 250_000  # words whose encoding a worker remembers


def compatible(merges: Merges, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the border between adjacent tokens ``a`` and ``b`` survives all merges.

    Goes back in time: the token made last is taken apart, and the symbols then next to the border
    must not have a merge that would have come before. Of equal ranks the left place merges first.
    """
    good = np.ones(len(a), dtype=bool)
    at = np.arange(len(a))
    a, b = a.astype(np.int64), b.astype(np.int64)
    limit = np.full(len(a), NONE)  # merges of a lower rank would have joined the pair
    while len(at):
        joined = merges.find(a, b)[0] < limit
        good[at[joined]] = False
        born_a, born_b = merges.born[a], merges.born[b]
        go = ~joined & (np.maximum(born_a, born_b) >= 0)
        at, a, b, born_a, born_b = at[go], a[go], b[go], born_a[go], born_b[go]
        undo_a = born_a > born_b
        limit = np.where(undo_a, born_a, born_b + 1)
        a, b = np.where(undo_a, merges.right[a], a), np.where(undo_a, b, merges.left[b])
    return good


class Codec:
    """Encodes and decodes texts; one per Python worker and tokenizer file."""

    _own: dict[str, Codec] = {}

    def __init__(self, merges: Merges, library: str) -> None:
        self.merges = merges
        tokenizer = Tokenizer.from_str(library)
        self.normalize, self.cut_words = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = byte_letters()
        ids = {t: i for i, t in enumerate(merges.tokens) if t and t not in merges.special}
        self.ids = ids
        self.matcher = ahocorasick.Automaton()
        for token, i in ids.items():
            key = token.removesuffix(END) + STOP if token.endswith(END) and token != END else token
            self.matcher.add_word(key, (len(key), i))
        self.matcher.make_automaton()
        self.plain = re.compile(PLAIN_WORDS).findall
        self.special = regex.compile("|".join(regex.escape(s) for s in merges.special))
        self.known: dict[str, tuple[int, bytes, str]] = {}

    @classmethod
    def of(cls, path: str, merges: Merges, library: str) -> Codec:
        if path not in cls._own:
            cls._own[path] = cls(merges, library)
        return cls._own[path]

    def normal(self, text: str) -> str:
        """NFC and lower case of each character by itself; white space never reaches a word."""
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def split(self, text: str) -> list[str]:
        """Words; where case, letters and digits are a matter of the library's Unicode tables, it says itself."""
        if PLAIN(text):
            text = self.normal(text)
            if PLAIN(text):
                return self.plain(text)
        text = self.normalize(text)
        return [text[a:b] for _, (a, b) in self.cut_words(text)]

    def propose(self, spelled: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leftmost-longest tokens of all words, their word numbers, and whether they cover each word."""
        found = list(self.matcher.iter_long(STOP.join(spelled) + STOP))
        ends = np.fromiter((f[0] for f in found), np.int64, len(found)) + 1
        sizes = np.fromiter((f[1][0] for f in found), np.int64, len(found))
        tokens = np.fromiter((f[1][1] for f in found), np.int64, len(found))
        borders = np.cumsum([len(w) + 1 for w in spelled])
        owner = np.searchsorted(borders, ends, side="left")
        covered = np.bincount(owner, weights=sizes, minlength=len(spelled)) == np.diff(np.r_[0, borders])
        return tokens, owner, covered

    def symbols(self, word: str) -> list[int]:
        return [self.ids[c] for c in word[:-1]] + [self.ids[word[-1] + END]]

    def learn(self, words: list[str]) -> None:
        spelled = [w if w.isascii() and w.isalpha() else "".join([self.letters[b] for b in w.encode()]) for w in words]
        tokens, owner, covered = self.propose(spelled)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pair, back = np.unique(tokens[inner] << 20 | tokens[inner + 1], return_inverse=True)
        good = covered
        good[owner[inner[~compatible(self.merges, pair >> 20, pair & ((1 << 20) - 1))[back]]]] = False
        right = good[owner]
        self.keep(words, owner[right], tokens[right])
        wrong = np.flatnonzero(~good)
        if len(wrong):
            raw = [self.symbols(spelled[i]) for i in wrong]
            sizes = np.array([len(r) for r in raw])
            for which, size, merged in self.merges.apply(np.array([t for r in raw for t in r]), sizes):
                self.keep(words, np.repeat(wrong[which], size), merged)

    def keep(self, words: list[str], owner: np.ndarray, tokens: np.ndarray) -> None:
        """Remember the encodings that lie side by side in ``tokens``."""
        if len(owner) == 0:
            return
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        raw, names = tokens.astype("<u4").tobytes(), [self.merges.tokens[t] for t in tokens.tolist()]
        for k, a, b in zip(owner[starts].tolist(), starts.tolist(), np.r_[starts[1:], len(owner)].tolist(), strict=True):
            self.known[words[k]] = b - a, raw[4 * a : 4 * b], " ".join(names[a:b])

    def cut(self, text: str) -> list[str | int]:
        """Words, and special tokens as their ids."""
        if "<|" not in text or not self.special.search(text):
            return self.split(text)
        found: list[str | int] = []
        end = 0
        for m in self.special.finditer(text):
            found += self.split(text[end : m.start()])
            found.append(self.merges.special[m.group()])
            end = m.end()
        return found + self.split(text[end:])

    def encode(self, texts: list[str]) -> Iterator[tuple[int, bytes, str]]:
        """``(number of tokens, ids as little-endian 32-bit integers, decoded text)`` of every text."""
        cut = [self.cut(t) for t in texts]
        if len(self.known) > KEPT:
            self.known = dict(islice(self.known.items(), KEPT // 2))  # the oldest are the frequent ones
        for i in self.merges.special.values():
            self.known[i] = 1, np.array([i], dtype="<u4").tobytes(), self.merges.tokens[i]
        fresh = list({w for words in cut for w in words}.difference(self.known))
        if fresh:
            self.learn(fresh)
        known = self.known
        for words in cut:
            got = [known[w] for w in words]
            yield sum([g[0] for g in got]), b"".join([g[1] for g in got]), " ".join([g[2] for g in got])


def encode(docs: DataFrame, path: str, digest: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` for every row of ``docs(doc_id, text, ...)``.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers, ``decoded`` what they
    decode to. With ``digest`` the SHA-256 of both, in lower-case hexadecimal, takes their place
    (``ids_sha256``, ``decoded_sha256``), so that long texts are not moved twice. Null and empty texts
    have no tokens and decode to the empty text; a null ``doc_id`` and repeated rows are kept; other
    columns are ignored; empty in, empty out.
    """
    merges = docs.sparkSession.sparkContext.broadcast(Merges.read(path))
    with open(path, encoding="utf-8") as file:
        library = docs.sparkSession.sparkContext.broadcast(file.read())
    kinds = ("ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded string")
    names = ["doc_id", "n_tokens", *(k.split()[0] for k in kinds.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, merges.value, library.value)
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                n, ids, decoded = [], [], []
                for count, raw, text in codec.encode(texts):
                    n.append(count)
                    ids.append(hashlib.sha256(raw).hexdigest() if digest else raw)
                    decoded.append(hashlib.sha256(text.encode()).hexdigest() if digest else text)
                kind = pa.string() if digest else pa.binary()
                yield pa.record_batch(
                    [batch.column(0).slice(first, len(texts)), pa.array(n, pa.int64()), pa.array(ids, kind), pa.array(decoded, pa.string())],
                    names=names,
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, " + kinds
    )
