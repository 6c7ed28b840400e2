"""Benchmark decontamination by pigeonhole edit matching.

A passage within ``k`` edits of a test item holds at least one of any ``k + 1`` pieces of the item
unchanged. Items are cut into ``k + 1`` pieces; documents are searched for exact pieces at every byte;
each hit fixes where the item would lie, and Myers' bit-parallel algorithm gives the edit distance there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import arrays
from tallgrass.llm.graph import keep

BLOCK = 4 << 20  # bytes of test items searched for in one pass over the documents
BITS = 22  # of the table that most places of a document are turned away by
GRAM = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)
_RESULT = "doc_id long, item_id long, distance long, start long, stop long"


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A-Z lower-cased, runs of white space as one blank, none at either end; with new offsets."""
    blank = arrays.SPACE[data]
    data = np.where(blank, np.uint8(32), arrays.LOWER[data])
    start = np.zeros(len(data) + 1, dtype=bool)
    start[offsets] = True
    after_blank = np.r_[True, blank[:-1]] if len(data) else blank
    stay = ~blank | ~(after_blank | start[:-1])
    kept = np.flatnonzero(stay)
    ends = np.searchsorted(kept, offsets)
    data = data[kept]
    filled = np.flatnonzero(ends[1:] > ends[:-1])
    trail = ends[1:][filled] - 1
    trail = trail[data[trail] == 32]
    if len(trail):
        ends = ends - np.searchsorted(trail, ends)
        data = np.delete(data, trail)
    return data, ends


def grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one integer."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    found = np.empty(n, dtype=np.uint64)
    for k in range(GRAM):
        part = data[k : k + (len(data) - k) // GRAM * GRAM]
        found[k::GRAM] = np.frombuffer(part.tobytes(), dtype="<u8")
    return found


def myers(item: bytes, text: bytes) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to any part of ``text``, and where the first such part ends."""
    m = len(item)
    match: dict[int, int] = defaultdict(int)
    for i, c in enumerate(item):
        match[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        eq = match.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (~(xh | up) & full)
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        up = mh | (~(xv | ph) & full)
        down = ph & xv
        if score < best:
            best, at = score, j
    return best, at


@dataclass
class Index:
    """Pieces of a block of items, ordered by their first eight bytes."""

    ids: list[int]
    items: list[bytes]
    budget: list[int]
    first: np.ndarray  # distinct first eight bytes
    begin: np.ndarray  # their pieces are begin[i]:begin[i + 1]
    last: np.ndarray  # last eight bytes of the piece
    size: np.ndarray
    place: np.ndarray  # of the piece in its item
    item: np.ndarray

    @classmethod
    def build(cls, items: list[tuple[int, bytes]], percent: int, least: int) -> Index:
        pieces, budget = [], [len(t) * percent // 100 if len(t) >= least else 0 for _, t in items]
        for number, (_, text) in enumerate(items):
            count = budget[number] + 1
            borders = [len(text) * i // count for i in range(count + 1)]
            pieces += [(text[a : a + GRAM], text[b - GRAM : b], b - a, a, number) for a, b in zip(borders, borders[1:], strict=False)]
        first, last = (np.frombuffer(b"".join(p[i] for p in pieces), dtype="<u8") for i in (0, 1))
        size, place, item = (np.array([p[i] for p in pieces], dtype=np.int64) for i in (2, 3, 4))
        order = np.argsort(first, kind="stable")
        distinct, begin = np.unique(first[order], return_index=True)
        return cls(
            [i for i, _ in items], [t for _, t in items], budget,
            distinct, np.r_[begin, len(order)], last[order], size[order], place[order], item[order],
        )

    def hits(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and supposed start of the item, for every exact piece in a text."""
        gram = grams(data)
        at = np.flatnonzero(table[(gram * _ODD >> np.uint64(64 - BITS)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(self.first, gram[at]), len(self.first) - 1)
        sure = self.first[slot] == gram[at]
        at, slot = at[sure], slot[sure]
        count = self.begin[slot + 1] - self.begin[slot]
        at = np.repeat(at, count)
        piece = np.repeat(self.begin[slot], count) + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        text = np.searchsorted(offsets, at, side="right") - 1
        end = at + self.size[piece]
        sure = end <= offsets[text + 1]
        at, piece, text, end = at[sure], piece[sure], text[sure], end[sure]
        sure = gram[end - GRAM] == self.last[piece]
        at, piece, text = at[sure], piece[sure], text[sure]
        return text, self.item[piece], at - self.place[piece]


def _whole(text: bytes, item: bytes, starts: list[int]) -> tuple[int, int, int] | None:
    """First supposed start where the item stands with no letter, digit or byte outside ASCII beside it."""
    for start in sorted(starts):
        stop = start + len(item)
        if start >= 0 and text[start:stop] == item and not _INSIDE[text[start - 1 : start] or b" "] and not _INSIDE[text[stop : stop + 1] or b" "]:
            return 0, start, stop
    return None


_INSIDE = {bytes([b]): b >= 0x80 or chr(b).isalnum() for b in range(256)}


def _verify(index: Index, text: bytes, item: int, starts: list[int]) -> tuple[int, int, int]:
    """Best distance of the item near the supposed starts, with begin and end of the part."""
    want, k = index.items[item], index.budget[item]
    best = (k + 1, 0, 0)
    reach = -1
    for start in sorted(starts):
        if start - k <= reach and start + len(want) + k <= reach:
            continue
        low = max(0, start - k)
        reach = start + len(want) + 2 * k
        window = text[low:reach]
        exact = window.find(want)
        if exact >= 0:
            return 0, low + exact, low + exact + len(want)
        distance, end = myers(want, window)
        if distance < best[0]:
            best = distance, max(0, low + end - len(want)), low + end
    return best


def find_items(spark: SparkSession, docs: DataFrame, items: DataFrame, percent: int = 6, least: int = 40) -> DataFrame:
    """``(doc_id, item_id, distance, start, stop)``: documents that hold a test item.

    A document holds an item when some part of it is within ``percent`` percent of the item's length in
    edits, both with A-Z lower-cased and white space as single blanks, counted in UTF-8 bytes.
    ``start`` (exact where ``distance`` is 0, else estimated) and ``stop`` are byte places in that form.
    One row per document row and item, with the best part.

    Items are read in blocks of ``BLOCK`` bytes, each searched for over all documents: the block is what
    is broadcast, so its size is bounded whatever the benchmark's; with several blocks the matches of one are
    written before the next is read. Items of under ``least`` bytes are held only where they stand word for word,
    with no letter or digit beside them; those of under ``GRAM`` bytes are single words that prove nothing and match
    nothing; so do null items. Null or empty documents hold nothing; a null ``doc_id`` and repeated rows are judged
    like others; other columns are ignored; very long documents are searched whole. No items or no documents, no
    rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found: list[DataFrame] = []
    block: list[tuple[int, bytes]] = []
    size = 0
    for row in items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        raw = np.frombuffer(row[1].encode(), dtype=np.uint8)
        text = normal(raw, np.array([0, len(raw)]))[0].tobytes()
        if len(text) < GRAM:
            continue
        if size >= BLOCK:
            found.append(_search(spark, docs, block, percent, least, last=False))
            block, size = [], 0
        block.append((row[0], text))
        size += len(text)
    if block:
        found.append(_search(spark, docs, block, percent, least, last=True))
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], _RESULT)


def _search(spark: SparkSession, docs: DataFrame, block: list[tuple[int, bytes]], percent: int, least: int, last: bool) -> DataFrame:
    """Matches of one block; written at once, and its broadcast given up, unless it is the last."""
    shared = spark.sparkContext.broadcast(Index.build(block, percent, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        table = np.zeros(1 << BITS, dtype=bool)
        table[(index.first * _ODD >> np.uint64(64 - BITS)).astype(np.int64)] = True
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0)
            for first, offsets, data in arrays.slices(batch.column(1)):
                data, offsets = normal(data, offsets)
                places: dict[tuple[int, int], set[int]] = defaultdict(set)
                for text, item, start in zip(*(x.tolist() for x in index.hits(data, offsets, table)), strict=True):
                    places[text, item].add(start - int(offsets[text]))
                for (text, item), starts in places.items():
                    own = data[offsets[text] : offsets[text + 1]].tobytes()
                    if len(index.items[item]) < least:
                        whole = _whole(own, index.items[item], list(starts))
                        if whole is not None:
                            rows.append((ids[first + text].as_py(), index.ids[item], *whole))
                        continue
                    distance, begin, end = _verify(index, own, item, list(starts))
                    if distance <= index.budget[item]:
                        rows.append((ids[first + text].as_py(), index.ids[item], distance, begin, end))
            if rows:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "item_id", "distance", "start", "stop"])

    matches = docs.mapInArrow(run, _RESULT)
    if last:
        return matches
    written = keep(spark, matches, "matches")
    shared.unpersist()
    return written
