"""Alignment of two tokenizers' tokens by their bytes, all documents of a batch in step.

Each lane holds a pointer into the tokens of A and one into those of B. In every step each lane links
the two tokens it points to, marks a cut where both end, and moves on the pointer whose token ends
first (both at a cut); lanes that are through leave the state vectors. A long document is several
lanes, each with its own run of A tokens, so that no lane keeps the others waiting.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallgrass.llm.arrays import list_array
from tallgrass.llm.graph import drop, keep
from tallgrass.llm.merges import byte_letters, text_slices
from tallgrass.llm.token_counts import PATTERN

UNIT = 8 << 20  # characters whose links are looked up together; one longer text is a unit of its own
LANE = 256  # tokens of A in a lane
B_BITS = 20
# Texts of these characters and without very long white space are split alike by both libraries for A
# (tested for every one of them); the faster one takes them.
ALIKE = re.compile(r"[\x00-\x1b\x20-ɏА-я‐-‧ぁ-ゔァ-ヺ一-龥가-힣]*").fullmatch
GAP = re.compile(r"\s{1000}").search

_UNITS = (
    "unit long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs array<long>, counts array<long>, places binary"
)
_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links ``(i, j)`` in order, and the last tokens of A and of B before each cut.

    ``ends_a`` and ``ends_b`` are rising byte offsets of all documents laid side by side; ``starts`` is
    the first A token of each document with tokens.
    """
    if len(ends_a) == 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    i = np.unique(np.r_[starts, np.arange(0, len(ends_a), LANE)])
    stop = np.r_[i[1:], len(ends_a)]
    j = np.searchsorted(ends_b, np.r_[0, ends_a][i], side="right")  # the token of B that holds the lane's first byte
    partner = np.full(len(ends_a) + len(ends_b), -1, dtype=np.int64)  # links are ordered by i + j
    cuts_a, cuts_b = [], []
    while len(i):
        partner[i + j] = j
        a, b = ends_a[i], ends_b[j]
        both = a == b
        cuts_a.append(i[both])
        cuts_b.append(j[both])
        i, j = i + (a <= b), j + (b <= a)
        live = i < stop
        if not live.all():
            i, j, stop = i[live], j[live], stop[live]
    at = np.flatnonzero(partner >= 0)
    return at - partner[at], partner[at], np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


class Pair:
    """The two tokenizers of a worker, with the bytes of their tokens."""

    _own: dict[int, Pair] = {}

    def __init__(self, a: str, b: bytes) -> None:
        self.slow = Tokenizer.from_str(a)
        self.slow.no_truncation()
        self.slow.no_padding()
        self.slow.encode_special_tokens = True
        known = json.loads(a)
        special = {t["id"] for t in known["added_tokens"]}
        byte = {c: i for i, c in enumerate(byte_letters())}
        letters = self.slow.get_vocab()
        a_bytes = {i: t.encode() if i in special else bytes(byte[c] for c in t) for t, i in letters.items()}
        ranks = {t: i for i, t in a_bytes.items() if i not in special}
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b)
        b_bytes = [self._piece(i) for i in range(self.pieces.vocab_size())]
        self.a_sizes, self.a_pool = self._pool([a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)])
        self.b_sizes, self.b_pool = self._pool(b_bytes)
        sizes = len(self.a_sizes), len(self.b_sizes)
        self.names = np.array([f"{i}{c}" for size, last in zip(sizes, "|;", strict=True) for c in ("," + last) for i in range(size)], dtype=object)

    @classmethod
    def of(cls, a: str, b: bytes) -> Pair:
        key = hash((a, b))
        if key not in cls._own:
            cls._own.clear()
            cls._own[key] = cls(a, b)
        return cls._own[key]

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    @staticmethod
    def _pool(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.array([len(t) for t in tokens], dtype=np.int64), np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        alike = [bool(ALIKE(t)) and not GAP(t) for t in texts]
        rest = iter(self.slow.encode_batch_fast([t for t, ok in zip(texts, alike, strict=True) if not ok], add_special_tokens=False))
        return [self.fast.encode_ordinary(t) if ok else next(rest).ids for t, ok in zip(texts, alike, strict=True)]

    @staticmethod
    def _flat(ids: list[list[int]], sizes: np.ndarray, pool: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray]:
        """Ids side by side, tokens per text, their joined bytes, and bytes per text."""
        count = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(count.sum()))
        first = np.cumsum(sizes) - sizes
        size = sizes[flat]
        ends = np.r_[0, np.cumsum(size)]
        joined = pool[np.repeat(first[flat] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        return flat, count, joined, np.diff(ends[np.r_[0, np.cumsum(count)]])

    def links(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Counts and digest of every text, and the id pairs of all links in order of texts."""
        spaced = [" " + t for t in texts]
        a, count_a, joined_a, bytes_a = self._flat(self.encode_a(spaced), self.a_sizes, self.a_pool)
        b, count_b, joined_b, bytes_b = self._flat(self.pieces.encode(texts, num_threads=1), self.b_sizes, self.b_pool)
        good = np.zeros(len(texts), dtype=bool)
        at_a = at_b = 0
        for k, (text, size_a, size_b) in enumerate(zip(spaced, bytes_a.tolist(), bytes_b.tolist(), strict=True)):
            if size_a == size_b:
                raw = text.encode()
                good[k] = len(text) > 1 and joined_a[at_a : at_a + size_a] == raw and joined_b[at_b : at_b + size_b] == raw
            at_a, at_b = at_a + size_a, at_b + size_b
        a, b = a[np.repeat(good, count_a)], b[np.repeat(good, count_b)]
        count_a, count_b = count_a * good, count_b * good
        last_a = np.cumsum(count_a)
        starts = (last_a - count_a)[good]
        i, j, cut_a, cut_b = align(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]), starts)
        owner = np.repeat(np.arange(len(texts)), count_a)
        n_links = np.bincount(owner[i], minlength=len(texts))
        n_groups = np.bincount(owner[cut_a], minlength=len(texts))
        return {
            "n_a": count_a, "n_b": count_b, "n_groups": n_groups, "n_links": n_links,
            "groups_sha256": self._digests(a, b, cut_a, cut_b, count_a, count_b), "pairs": a[i] << B_BITS | b[j],
        }

    def _digests(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray) -> list[str]:
        ends_a, ends_b = (np.zeros(len(x), dtype=np.int64) for x in (a, b))
        ends_a[cut_a], ends_b[cut_b] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        name_a = a + len(self.a_sizes) * ends_a
        name_b = b + 2 * len(self.a_sizes) + len(self.b_sizes) * ends_b
        order = np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")
        told = self.names[np.r_[name_a, name_b][order]].tolist()
        found, at = [], 0
        for size in (count_a + count_b).tolist():
            found.append(hashlib.sha256("".join(told[at : at + size])[:-1].encode()).hexdigest() if size else "")
            at += size
        return found


def _units(a, b):
    """Map side: align texts, and keep the links of a unit as places in its own list of id pairs."""
    schema = pa.schema([
        ("unit", pa.int64()), *((n, pa.list_(pa.int64())) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")),
        ("groups_sha256", pa.list_(pa.string())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("places", pa.binary()),
    ])

    def row(unit: int, ids: list, parts: list[dict]) -> pa.RecordBatch:
        pairs, back, counts = np.unique(np.concatenate([p["pairs"] for p in parts]), return_inverse=True, return_counts=True)
        numbers = [np.concatenate([p[n] for p in parts]) for n in ("n_a", "n_b", "n_groups", "n_links")]
        places = pa.compress(back.astype("<i4").tobytes(), codec="zstd", asbytes=True)
        shas = [s for p in parts for s in p["groups_sha256"]]
        columns = [pa.array([unit]), pa.array([ids], pa.list_(pa.int64())), *(list_array(n, [len(n)], pa.int64()) for n in numbers)]
        columns += [pa.array([shas], pa.list_(pa.string())), *(list_array(n, [len(n)], pa.int64()) for n in (pairs, counts)), pa.array([places], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Pair.of(a.value, b.value)
        unit = TaskContext.get().partitionId() << 32
        ids, parts, size = [], [], 0
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                ids += batch.column(0).slice(first, len(texts)).to_pylist()
                parts.append(both.links(texts))
                size += sum(map(len, texts))
                if size >= UNIT:
                    yield row(unit, ids, parts)
                    unit, ids, parts, size = unit + 1, [], [], 0
        if ids:
            yield row(unit, ids, parts)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the corpus counts over the links of every document of a unit."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids, n_a, n_b, n_groups, n_links, shas = (batch.column(c)[k].values for c in range(6))
            sizes = n_links.to_numpy()
            total = int(sizes.sum())
            counts, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            if total:
                answer = batch.column(7)[k].values
                place, count, top = (answer.field(f).to_numpy(zero_copy_only=False) for f in range(3))
                raw = pa.decompress(batch.column(6)[k].as_py(), decompressed_size=4 * total, codec="zstd", asbytes=True)
                of = np.empty(len(place), dtype=np.int64)
                of[place] = np.arange(len(place))
                link = of[np.frombuffer(raw, dtype="<i4")]
                counts, best = count[link], top[link].astype(np.int64)
            edge = np.r_[0, np.cumsum(sizes)]
            sums = [np.diff(np.r_[0, np.cumsum(x)][edge]) for x in (best, counts)]
            yield pa.RecordBatch.from_arrays(
                [ids, n_a, n_b, n_groups, n_links, *(pa.array(s, pa.int64()) for s in sums), shas],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def align_tokenizers(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Aligned tokens of every row of ``docs(doc_id, text, ...)`` under a byte-level BPE file and a sentencepiece model.

    Returns ``doc_id``, token counts ``n_a`` and ``n_b``, ``n_groups`` (between byte offsets where tokens
    of both end), ``n_links`` (pairs of tokens that share bytes), ``n_best`` (links whose id pair is the
    most frequent one of its B id in the whole corpus, ties included), ``count_sum`` (corpus counts of
    the id pairs, summed over links), and ``groups_sha256``.

    A encodes a space and the text, B the text. Null and empty texts, and texts that either tokenizer
    changes (joined token bytes differ from space and text), have no tokens: zeros and an empty digest.
    A null ``doc_id`` and repeated rows are kept as they are, each repeated row counting again; other
    columns are ignored; empty in, empty out. Texts are aligned whole; a task holds one unit of about
    8 million characters, or one longer text, at some hundred bytes a character.
    """
    with open(path_a, encoding="utf-8") as file:
        a = spark.sparkContext.broadcast(file.read())
    with open(path_b, "rb") as file:
        b = spark.sparkContext.broadcast(file.read())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    units = keep(spark, texts.mapInArrow(_units(a, b), _UNITS), "units")
    asked = units.select("unit", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "p"))
    asked = asked.select("unit", "place", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    counts = keep(spark, asked.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    id_b = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    top = counts.groupBy(id_b.alias("id_b")).agg(F.max("count").alias("top"))
    known = counts.join(top, id_b == top["id_b"]).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    answers = asked.join(known, "pair").groupBy("unit").agg(F.collect_list(F.struct("place", "count", "best")).alias("answer"))
    done = units.join(answers, "unit", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "answer")
    found = keep(spark, done.mapInArrow(_settle, _OUT), "aligned")
    drop(spark, units, counts)
    return found
