"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to levels ``1 + floor(log_b count)``, and an n-gram is put
into a Bloom filter once for each level up to its own. A look-up probes level after level until one is
missing; the last level found gives the count. Probabilities interpolate the pair's share of its first
word with the smoothed word frequency.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import arrays
from tallgrass.llm.collide import _runs
from tallgrass.llm.graph import keep

BASE = 1.5  # of the logarithm that levels are taken by
LEVELS = 64
PROBES = 4
BITS_EACH = 12  # bits of the filter per insertion
MAX_BITS = 1 << 29  # a filter of more bits (64 MB) is not broadcast: its parts stay on the executors and are asked
HEAVY = 1 << 16  # at most so many words have a count of N / HEAVY or more
MIX = 0.4  # weight of the pair's share
SHORT = 20  # bits that names of pairs go without: 44 bits tell far more pairs apart than the filter does
ASKED_SLICE = 1 << 22  # bytes of text that ask the parts together: the longer, the more words they share

_U = np.uint64
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
VALUES = np.r_[0.0, 1.0, [(BASE ** (q - 1) + BASE**q) / 2 for q in range(2, LEVELS)]]  # counts that levels stand for
_COUNTS = "part int, kind int, keys binary, counts binary"
_WORDS, _PAIRS = 0, 1


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes and text numbers: the words of each text, A-Z lower-cased, then its end."""
    data = arrays.LOWER[data]
    starts, ends, text = arrays.words(data, offsets)
    words = arrays.hash_spans(data, starts, ends)
    rows = len(offsets) - 1
    place = np.cumsum(np.bincount(text, minlength=rows))
    return np.insert(words, place, END), np.insert(text, place, np.arange(rows))


def _pairs(tokens: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token with the one before it, and that one's own hash."""
    before = np.r_[START, tokens[:-1]]
    before[np.r_[True, text[1:] != text[:-1]]] = START
    pairs = arrays.mix(before * _U(3) + arrays.mix(tokens ^ _U(0x2545F4914F6CDD1D)))
    return pairs >> _U(SHORT) << _U(SHORT), before


def _held_out(ids: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i in ids.to_pylist()], dtype=bool)


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    if len(keys) == 0:
        return keys, counts
    starts, _ = _runs(keys)
    return keys[starts], np.add.reduceat(counts[order], starts)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> _U(33)) % _U(parts)).astype(np.int64)


def _split(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the keys of each part."""
    part = _part(keys, parts)
    order = np.argsort(part, kind="stable")
    starts = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]]) if len(keys) else order
    for a, b in zip(starts, np.r_[starts[1:], len(order)][: len(starts)], strict=True):
        yield int(part[order[a]]), order[a:b]


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in the narrowest kind that holds them, compressed."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    raw = values.astype(f"<u{width}").tobytes()
    return bytes([width]) + len(values).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _spread(packed: bytes) -> np.ndarray:
    """What ``_squeeze`` was given."""
    width, count = packed[0], int.from_bytes(packed[1:9], "little")
    raw = pa.decompress(packed[9:], decompressed_size=width * count, codec="zstd", asbytes=True) if count else b""
    return np.frombuffer(raw, dtype=f"<u{width}").astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Rising keys as differences, byte by byte of equal weight, compressed."""
    raw = np.diff(keys, prepend=_U(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(keys).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unpack_keys(packed: bytes) -> np.ndarray:
    """What ``_pack_keys`` was given."""
    count = int.from_bytes(packed[:8], "little")
    raw = pa.decompress(packed[8:], decompressed_size=8 * count, codec="zstd", asbytes=True) if count else b""
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


class Filter:
    """The log-frequency Bloom filter, in one segment per part."""

    def __init__(self, segments: list[np.ndarray | None]) -> None:
        sizes = [0 if s is None else len(s) for s in segments]
        self.start = np.r_[0, np.cumsum(sizes)].astype(np.uint64) * _U(8)
        self.bits = np.concatenate([s for s in segments if s is not None] or [np.empty(0, dtype=np.uint8)])
        self.size = np.array(sizes, dtype=np.uint64) * _U(8)

    @staticmethod
    def places(keys: np.ndarray, level: int, probe: int, size: np.ndarray | np.uint64) -> np.ndarray:
        return arrays.mix(keys + _U((level * PROBES + probe + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % size

    @classmethod
    def segment(cls, keys: np.ndarray, counts: np.ndarray, most: int | None = None) -> np.ndarray:
        """One segment's bytes, ``most`` bits at most if given."""
        level = levels(counts)
        size = max(64, BITS_EACH * int(level.sum()))
        size = min(size, most or size) // 8 * 8
        held = np.zeros(size, dtype=bool)
        for at in range(1, int(level.max()) + 1):
            here = keys[level >= at]
            for probe in range(PROBES):
                held[cls.places(here, at, probe, _U(size)).astype(np.int64)] = True
        return np.packbits(held, bitorder="little")

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Count that the highest level found stands for; 0 without one."""
        return VALUES[self.level(keys)]

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The highest level found; 0 without one."""
        found = np.zeros(len(keys), dtype=np.int64)
        part = _part(keys, len(self.size))
        at = np.flatnonzero(self.size[part] > 0)
        for level in range(1, LEVELS):
            for probe in range(PROBES):
                if len(at) == 0:
                    break
                own = part[at]
                bit = self.places(keys[at], level, probe, self.size[own]) + self.start[own]
                at = at[(self.bits[(bit >> _U(3)).astype(np.int64)] >> (bit & _U(7)).astype(np.uint8)) & 1 == 1]
            if len(at) == 0:
                break
            found[at] = level
        return found


def levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.minimum(np.floor(np.log(counts) / np.log(BASE) + 1e-9), LEVELS - 2).astype(np.int64)


def _counts(docs: DataFrame, parts: int) -> DataFrame:
    """Counts of the words and pairs of the training texts, packed by part."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held_out = _held_out(batch.column(0))
            own: list[list[np.ndarray]] = [[], []]
            for first, offsets, data in arrays.slices(batch.column(1)):
                tokens, text = _tokens(data, offsets)
                learn = ~held_out[first + text]
                own[_WORDS].append(tokens[learn])
                own[_PAIRS].append(_pairs(tokens, text)[0][learn])
            rows = []
            for kind, lists in enumerate(own):
                keys = np.concatenate(lists) if lists else np.empty(0, dtype=np.uint64)
                keys, counts = _sum(keys, np.ones(len(keys), dtype=np.int64))
                for part, at in _split(keys, parts):
                    rows.append({"part": part, "kind": kind, "keys": keys[at].tobytes(), "counts": counts[at].astype(np.uint32).tobytes()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    return docs.mapInArrow(pack, _COUNTS)


def _model(packed: DataFrame, parts: int) -> DataFrame:
    """Per part: word counts, how many words and tokens, and the part's segment of the filter."""
    schema = "part int, keys binary, counts binary, words long, tokens long, segment binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for part, kind, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault((part, kind), []).append((np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.uint32).astype(np.int64)))
        for part in sorted({p for p, _ in held}):
            summed = []
            for kind in (_WORDS, _PAIRS):
                rows = held.pop((part, kind), [])
                summed.append(_sum(*(np.concatenate([r[i] for r in rows]) if rows else np.empty(0, dtype=(np.uint64, np.int64)[i]) for i in (0, 1))))
            (words, count), (pairs, times) = summed
            segment = Filter.segment(np.r_[words, pairs], np.r_[count, times]) if len(words) or len(pairs) else np.empty(0, np.uint8)
            yield pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([words.tobytes()], pa.binary()), pa.array([count.tobytes()], pa.binary()),
                 pa.array([len(words)], pa.int64()), pa.array([int(count.sum())], pa.int64()), pa.array([segment.tobytes()], pa.binary())],
                names=["part", "keys", "counts", "words", "tokens", "segment"],
            )

    return packed.repartitionById(parts, F.col("part")).mapInArrow(run, schema)


def _heavy(model: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with a count of ``least`` or more, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, counts = np.frombuffer(keys, np.int64), np.frombuffer(counts, np.int64)
                yield pa.record_batch([pa.array(keys[counts >= least]), pa.array(counts[counts >= least])], names=["key", "c"])

    rows = model.select("keys", "counts").mapInArrow(run, "key long, c long").collect()
    keys = np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)
    counts = np.array([r[1] for r in rows], dtype=np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


_SCORED = "doc_id long, n_tokens long, n_known long, logs double, score double"
_ASKED = "part int, kind int, slice long, a binary, b binary, c binary, d binary, e binary, f binary, g binary"
# word counts; words to look up; what a slice knows itself; what it is told; words and pairs to look up in the filter; what is found
_TABLE, _ASK, _BASE, _SUMS, _PROBE, _FOUND = range(6)


def _scores(value: np.ndarray, n: np.ndarray, back: np.ndarray, start: int, which: np.ndarray, words: int, size: int) -> np.ndarray:
    """Score of each text of a slice by the filter's counts ``value`` of its ``words`` words, then of its pairs.

    ``n`` tokens a text, ``back`` the word of each token, ``start`` that of the start, ``which`` the pair of each token.
    """
    about = value[: words]
    one = (about[back] + 1) / size
    prior = np.r_[start, back[:-1]]
    prior[np.cumsum(n) - n] = start
    base = about[prior]
    share = np.divide(value[words:][which], base, out=np.zeros(len(base)), where=base > 0)
    log = np.log10(np.where(base > 0, MIX * np.minimum(share, 1.0) + (1 - MIX) * one, one))
    return np.bincount(np.repeat(np.arange(len(n)), n), weights=log, minlength=len(n))


def _cut(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple]:
    """Slices of texts: name, ids, which are null, tokens, text numbers, tokens a text.

    A slice is named by its content, so that a task run again gives the same name.
    """
    for batch in batches:
        for first, offsets, data in arrays.slices(batch.column(1), limit):
            ids = batch.column(0).slice(first, len(offsets) - 1)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            tokens, text = _tokens(data, offsets)
            n = np.bincount(text, minlength=len(ids))
            name = int(np.bitwise_xor.reduce(arrays.mix(ids.view(np.uint64) + arrays.mix(np.cumsum(n).astype(np.uint64))))) ^ zlib.crc32(data) << 20
            yield name, ids, null, tokens, text, n


def lm_score(spark: SparkSession, docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``.

    Training texts are those whose CRC-32 of ``doc_id`` as text leaves a remainder other than 2 by 7.
    ``base_score`` is the add-one word model with exact counts, ``score`` the filter's model. The
    counts, over all training texts, are gathered packed by part and never leave the executors. What
    is broadcast is bounded: the exact counts sent along are those of the at most ``HEAVY`` words that
    each make up ``1 / HEAVY`` of all tokens, and the filter only while it has ``max_bits`` bits at most.
    Rarer words meet their exact counts in a shuffle by word, in which no word is hot. The filter grows
    with the insertions (``BITS_EACH`` bits each); a larger one stays on the executors by part, and each
    slice of texts asks the parts for the filter's counts of its distinct words and pairs, and the exact ones of
    its words. What a slice knows itself is made from ``docs`` once more and meets the answers in a second
    shuffle; so ``docs`` must give its rows in the same order again, as a stored table does (else the job fails).
    Both ways probe the same bits and give the same scores.

    A null or empty text is its end token alone; a null ``doc_id`` counts as the empty text (it is a
    training text); repeated rows each count and each keep a row; other columns are ignored; empty in,
    empty out. Words are told apart by 64-bit hashes, pairs by 44 bits.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = keep(spark, _model(_counts(docs, parts), parts), "counts")
    size = model.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum(F.octet_length("segment")), F.lit(0))).first()
    distinct, total = int(size[0]), int(size[1])
    segments: list[np.ndarray | None] = [None] * parts
    shared = 8 * int(size[2]) <= max_bits
    if shared:
        for row in model.select("part", "segment").toLocalIterator():
            segments[row[0]] = np.frombuffer(row[1], dtype=np.uint8)
    filter_ = spark.sparkContext.broadcast(Filter(segments))
    del segments
    heavy = spark.sparkContext.broadcast(_heavy(model, max(1, -(-total // HEAVY))) if shared else None)
    floor = np.log10(total + distinct + 1)
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("slice", pa.int64()), *((c, pa.binary()) for c in "abcdefg")])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Score what needs no shuffle, and ask the parts for the counts of rarer words."""
        lm, (often, count) = filter_.value, heavy.value
        for name, ids, null, tokens, text, n in _cut(batches, arrays.SLICE):
            rows = len(ids)
            word, back = np.unique(np.r_[tokens, START], return_inverse=True)
            start, back = int(back[-1]), back[:-1]
            pair, which = np.unique(_pairs(tokens, text)[0], return_inverse=True)
            at = np.minimum(np.searchsorted(often, word), max(len(often) - 1, 0))
            known = (often[at] == word) if len(often) else np.zeros(len(word), dtype=bool)
            c = np.where(known, count[at], 0) if len(often) else np.zeros(len(word))
            logs = np.bincount(text, weights=np.log10(c + 1)[back], minlength=rows) - n * floor
            sure = np.bincount(text, weights=known[back], minlength=rows).astype(np.int64)
            score = _scores(lm.count(np.r_[word, pair]), n, back, start, which, len(word), total + distinct + 1)
            asked = [{
                "part": name % parts, "kind": _BASE, "slice": name >> 1, "a": ids.tobytes(), "b": null.tobytes(), "c": n.astype(np.int64).tobytes(),
                "d": sure.tobytes(), "e": logs.tobytes(), "f": score.tobytes(),
            }]
            rare = ~known[back]
            if rare.any():  # distinct (word, text) with how often
                pair, times = np.unique(back[rare] * rows + text[rare], return_counts=True)
                w, d = pair // rows, pair % rows
                for part, places in _split(word[w], parts):
                    here, which = np.unique(word[w[places]], return_inverse=True)
                    asked.append({
                        "part": part, "kind": _ASK, "slice": name >> 1, "a": here.tobytes(), "b": _squeeze(which),
                        "c": _squeeze(d[places]), "d": _squeeze(times[places]), "e": np.int64(name % parts).tobytes(),
                    })
            yield pa.RecordBatch.from_pylist(asked, schema=schema)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ask the parts for the distinct words and pairs of each slice."""
        for name, _, _, tokens, text, _ in _cut(batches, ASKED_SLICE):
            word, pair = np.unique(np.r_[tokens, START]), np.unique(_pairs(tokens, text)[0])
            words, pairs = dict(_split(word, parts)), dict(_split(pair, parts))
            none = np.empty(0, dtype=np.int64)
            for part in sorted({*words, *pairs}):
                yield pa.RecordBatch.from_pylist([{
                    "part": part, "kind": _PROBE, "slice": name >> 1, "a": _pack_keys(word[words.get(part, none)]),
                    "b": _pack_keys(pair[pairs.get(part, none)] >> _U(SHORT)), "e": np.int64(name % parts).tobytes(),
                }], schema=schema)

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each slice needs beside the answers: its words, and the word of each token."""
        for name, ids, null, tokens, _, n in _cut(batches, ASKED_SLICE):
            word, back = np.unique(np.r_[tokens, START], return_inverse=True)
            yield pa.RecordBatch.from_pylist([{
                "part": name % parts, "kind": _BASE, "slice": name >> 1, "a": ids.tobytes(), "b": null.tobytes(), "c": n.astype(np.int64).tobytes(),
                "f": _squeeze(back), "g": _pack_keys(word),
            }], schema=schema)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Add up the logs of the rarer words of every text by the part's counts, one row per question."""
        waiting: list[dict] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        segments: list[np.ndarray | None] = [None] * parts
        for batch in batches:
            own = batch.column(1).to_numpy(zero_copy_only=False) == _BASE
            if own.any():
                yield batch.filter(pa.array(own))
            for row in batch.filter(pa.array(~own)).to_pylist():
                if row["kind"] == _TABLE:
                    held.append((np.frombuffer(row["a"], np.uint64), np.frombuffer(row["b"], np.int64)))
                    if row["c"] is not None:
                        segments[row["part"]] = np.frombuffer(row["c"], np.uint8)
                else:
                    waiting.append(row)
        keys, counts = _sum(*(np.concatenate([h[i] for h in held]) if held else np.empty(0, dtype=(np.uint64, np.int64)[i]) for i in (0, 1)))
        lm = Filter(segments)
        for row in waiting:
            asked = _unpack_keys(row["a"]) if row["kind"] == _PROBE else np.frombuffer(row["a"], np.uint64)
            c = np.zeros(len(asked), dtype=np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                c = np.where(keys[at] == asked, counts[at], 0)
            if row["kind"] == _PROBE:
                level = lm.level(np.r_[asked, _unpack_keys(row["b"]) << _U(SHORT)])
                found = {"part": int(np.frombuffer(row["e"], np.int64)[0]), "kind": _FOUND, "slice": row["slice"], "a": _squeeze(level), "b": _squeeze(c), "e": np.int64(row["part"]).tobytes()}
                yield pa.RecordBatch.from_pylist([found], schema=schema)
                continue
            which, owner, times = (_spread(row[x]) for x in "bcd")
            texts, local = np.unique(owner, return_inverse=True)
            logs = np.bincount(local, weights=times * np.log10(c + 1)[which], minlength=len(texts))
            found = np.bincount(local, weights=times * (c > 0)[which], minlength=len(texts)).astype(np.int64)
            told = {"part": int(np.frombuffer(row["e"], np.int64)[0]), "kind": _SUMS, "slice": row["slice"], "a": _squeeze(texts), "b": logs.tobytes(), "c": _squeeze(found)}
            yield pa.RecordBatch.from_pylist([told], schema=schema)

    def settled(row: dict, told: dict[int, dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, logs and known tokens of the texts of a slice by what the parts told."""
        n, word, back = np.frombuffer(row["c"], np.int64), _unpack_keys(row["g"]), _spread(row["f"])
        start, back = int(back[-1]), back[:-1]
        text = np.repeat(np.arange(len(n)), n)
        pair, which = np.unique(_pairs(word[back], text)[0], return_inverse=True)
        value, c = np.empty(len(word) + len(pair)), np.empty(len(word), dtype=np.int64)
        words, pairs = dict(_split(word, parts)), dict(_split(pair, parts))
        for part in {*words, *pairs}:
            at = words.get(part, np.empty(0, dtype=np.int64))
            c[at] = _spread(told[part]["b"])
            value[np.r_[at, len(word) + pairs.get(part, at[:0])]] = VALUES[_spread(told[part]["a"])]
        logs = np.bincount(text, weights=np.log10(c + 1)[back], minlength=len(n)) - n * floor
        known = np.bincount(text, weights=(c > 0)[back], minlength=len(n)).astype(np.int64)
        return _scores(value, n, back, start, which, len(word), total + distinct + 1), logs, known

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Put the sums of each slice together."""
        bases: dict[int, list[dict]] = {}
        sums: dict[int, list[dict]] = {}
        found: dict[int, dict[int, dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == _FOUND:
                    found.setdefault(row["slice"], {})[int(np.frombuffer(row["e"], np.int64)[0])] = row
                else:
                    (bases if row["kind"] == _BASE else sums).setdefault(row["slice"], []).append(row)
        for name, rows in bases.items():
            if shared:
                score = np.frombuffer(rows[0]["f"], np.float64)
                base_logs, sure = np.frombuffer(rows[0]["e"], np.float64), np.frombuffer(rows[0]["d"], np.int64)
                logs, known = np.zeros(len(score)), np.zeros(len(score), dtype=np.int64)
                for told in sums.pop(name, []):
                    at = _spread(told["a"])
                    logs[at] += np.frombuffer(told["b"], np.float64)
                    known[at] += _spread(told["c"])
                logs, known = base_logs + logs / len(rows), sure + known // len(rows)
            else:
                score, logs, known = settled(rows[0], found.pop(name))
            for row in rows:  # slices of the same content share a name, and are told the same
                yield pa.record_batch(
                    [pa.array(np.frombuffer(row["a"], np.int64), mask=np.frombuffer(row["b"], bool)), pa.array(np.frombuffer(row["c"], np.int64)),
                     pa.array(known), pa.array(logs), pa.array(score)],
                    names=["doc_id", "n_tokens", "n_known", "logs", "score"],
                )

    empty = [F.lit(None).cast("binary").alias(c) for c in "defg"]
    segment = F.lit(None).cast("binary") if shared else F.col("segment")
    tables = model.select("part", F.lit(_TABLE).alias("kind"), F.lit(0).cast("long").alias("slice"), F.col("keys").alias("a"), F.col("counts").alias("b"), segment.alias("c"), *empty)
    asked = docs.mapInArrow(ask if shared else probe, _ASKED).union(tables).repartitionById(parts, F.col("part")).mapInArrow(answer, _ASKED)
    if not shared:
        asked = asked.union(docs.mapInArrow(base, _ASKED))
    scored = asked.repartitionById(parts, F.col("part")).mapInArrow(settle, _SCORED)
    return scored.select(
        "doc_id",
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2).alias("held_out"),
        "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), F.col("logs").alias("base_score"), "score",
    )
