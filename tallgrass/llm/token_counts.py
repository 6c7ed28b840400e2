"""Token counts by rank-synchronous merging.

Texts are cut into pre-tokens; the distinct ones of a slice are held as one ragged array and merged
together (``Merges.apply``); what counts is how many symbols survive. Counts of pre-tokens are kept
for later slices of the same worker, up to a bounded number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallgrass.llm.merges import Merges, byte_letters, text_slices

# fixed value: the pattern that splits text before the merges of byte-level vocabularies
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# the same, split here rather than by the library, over texts of ASCII and Latin letters up to U+024F, where \p{L} and \p{N} are plain ranges
PLAIN = re.compile(r"[\x00-\x1b\x20-\x7e\xc0-\u024f]*").fullmatch
_L = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
PLAIN_PATTERN = rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s0-9{_L}]+|\s+(?!\S)|\s+"
KEPT = 400_000  # pre-tokens whose count a worker remembers


class Counter:
    """Counts tokens of texts; one per Python worker and tokenizer file."""

    _own: dict[str, Counter] = {}

    def __init__(self, merges: Merges, library: str) -> None:
        self.merges = merges
        self.cut = Tokenizer.from_str(library).pre_tokenizer.pre_tokenize_str
        letters = {token: i for i, token in enumerate(merges.tokens)}
        self.base = np.array([letters[c] for c in byte_letters()], dtype=np.int64)
        self.plain = re.compile(PLAIN_PATTERN).findall
        self.special = regex.compile("|".join(regex.escape(s) for s in merges.special)) if merges.special else None
        self.known: dict[str, int] = {}

    @classmethod
    def of(cls, path: str, merges: Merges, library: str) -> Counter:
        if path not in cls._own:
            cls._own[path] = cls(merges, library)
        return cls._own[path]

    def learn(self, pieces: list[str]) -> None:
        """Count the survivors of every piece."""
        raw = [p.encode() for p in pieces]
        symbols = self.base[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        lengths = np.array([len(r) for r in raw])
        for owner, size, _ in self.merges.apply(symbols, lengths):
            self.known.update(zip([pieces[i] for i in owner], size.tolist(), strict=True))

    def split(self, text: str) -> list[str]:
        """Pre-tokens; where letters and digits are a matter of the library's Unicode tables, it says itself."""
        return self.plain(text) if PLAIN(text) else [text[a:b] for _, (a, b) in self.cut(text)]

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and how many special strings stand between them."""
        if self.special is None or not self.special.search(text):
            return self.split(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self.split(part)], len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.pieces(t) for t in texts]
        if len(self.known) > KEPT:
            self.known = dict(islice(self.known.items(), KEPT // 2))  # the oldest are the frequent ones
        fresh = list({p for pieces, _ in cut for p in pieces}.difference(self.known))
        if fresh:
            self.learn(fresh)
        return [sum(map(self.known.__getitem__, pieces)) + extra for pieces, extra in cut]


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs(doc_id, text, ...)``.

    Counts are those of the byte-level tokenizer file at ``path`` without added begin or end tokens;
    its special strings inside a text count as one token each. Null and empty texts have no bytes and
    no tokens; a null ``doc_id`` and repeated rows are kept as they are; other columns are ignored;
    empty in, empty out. Texts are cut and counted whole, however long.
    """
    merges = docs.sparkSession.sparkContext.broadcast(Merges.read(path))
    with open(path, encoding="utf-8") as file:
        library = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(path, merges.value, library.value)
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).fill_null(0).cast(pa.int64())
            for first, texts in text_slices(batch.column(1)):
                n = len(texts)
                yield pa.record_batch(
                    [batch.column(0).slice(first, n), sizes.slice(first, n), pa.array(counter.count(texts), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
