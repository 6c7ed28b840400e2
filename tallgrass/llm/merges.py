"""Byte-pair merges of a public tokenizer file as sorted arrays, and their application to many sequences at once."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLOTS = 18
NONE = np.int64(1 << 40)  # rank of a pair that never merges


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


@dataclass(frozen=True)
class Merges:
    """Pairs as ``left << 20 | right``, sorted, with rank and result; tokens with their parts."""

    tokens: list[str]
    special: dict[str, int]
    pairs: np.ndarray
    rank: np.ndarray
    result: np.ndarray
    left: np.ndarray  # parts of the token, -1 for a base symbol
    right: np.ndarray
    born: np.ndarray  # rank of the merge that makes the token, -1 for a base symbol
    slots: list[tuple[np.uint64, np.ndarray]]  # hash tables from pair to place; what collides is in the next one

    @classmethod
    def read(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab: dict[str, int] = data["model"]["vocab"]
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        tokens = [""] * size
        for token, i in [*vocab.items(), *special.items()]:
            tokens[i] = token
        parts = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        a = np.array([vocab[m[0]] for m in parts], dtype=np.int64)
        b = np.array([vocab[m[1]] for m in parts], dtype=np.int64)
        made = np.array([vocab[m[0] + m[1]] for m in parts], dtype=np.int64)
        left, right, born = (np.full(size, -1, dtype=np.int64) for _ in range(3))
        left[made], right[made], born[made] = a, b, np.arange(len(made))
        order = np.argsort(a << 20 | b)
        pairs = (a << 20 | b)[order]
        return cls(tokens, special, pairs, order.astype(np.int64), made[order], left, right, born, cls._tables(pairs))

    @staticmethod
    def _tables(pairs: np.ndarray) -> list[tuple[np.uint64, np.ndarray]]:
        rest, tables, factor = np.arange(len(pairs)), [], 0x9E3779B97F4A7C15
        while len(rest):
            table = np.zeros(1 << SLOTS, dtype=np.int32)
            slot = (pairs[rest].astype(np.uint64) * np.uint64(factor) >> np.uint64(64 - SLOTS)).astype(np.int64)
            table[slot] = rest
            tables.append((np.uint64(factor), table))
            rest = rest[table[slot] != rest]
            factor = factor * 0xD1342543DE82EF95 & (1 << 64) - 1
        return tables

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` without a merge) and place in the pair table."""
        pair = a << 20 | b
        at = np.zeros(len(pair), dtype=np.int64)
        for factor, table in self.slots:
            here = table[(pair.astype(np.uint64) * factor >> np.uint64(64 - SLOTS)).astype(np.int64)]
            at = np.where(self.pairs[here] == pair, here, at)
        return np.where(self.pairs[at] == pair, self.rank[at], NONE), at

    def apply(self, symbols: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Merge all sequences in step: in each round every sequence applies its own lowest-rank pair.

        All places of that pair merge in the round, from the left where they overlap. Sequences that
        have no pair left leave the work; each yield is ``(sequence numbers, lengths, symbols)``.
        """
        owner = np.repeat(np.arange(len(lengths)), lengths)
        symbols = symbols.astype(np.int64)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[starts, len(owner)])
            rank = np.full(len(symbols), NONE)
            at = np.zeros(len(symbols), dtype=np.int64)
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rank[same], at[same] = self.find(symbols[same], symbols[same + 1])
            lowest = np.minimum.reduceat(rank, starts)
            ready = lowest == NONE
            if ready.any():
                done = np.repeat(ready, size)
                yield owner[starts[ready]], size[ready], symbols[done]
                symbols, owner, rank, at = symbols[~done], owner[~done], rank[~done], at[~done]
                if len(symbols) == 0:
                    return
                size, lowest = size[~ready], lowest[~ready]
            hit = rank == np.repeat(lowest, size)
            place = np.arange(len(hit))
            start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            hit &= (place - start) % 2 == 0
            symbols = np.where(hit, self.result[at], symbols)
            stay = ~np.r_[False, hit[:-1]]
            symbols, owner = symbols[stay], owner[stay]


def text_slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """``(first row, texts)`` of about ``limit`` characters; null is the empty text."""
    first, held, size = 0, [], 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= limit:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held
