"""Rows of a large key table whose 64-bit key occurs more than once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Entries = tuple[np.ndarray, np.ndarray, np.ndarray]  # keys uint64, documents int64, positions int64

_OPEN, _DONE = 0, 1
_PACKED = "part int, kind int, keys binary, docs binary, places binary"
_ROWS = "key long, doc_id long, place long"
_CHUNK = 1 << 16


def _row(part: int, kind: int, entries: Entries) -> dict:
    keys, docs, places = entries
    return {"part": part, "kind": kind, "keys": keys.tobytes(), "docs": docs.tobytes(), "places": places.astype(np.int32).tobytes()}


def _batch(entries: Entries) -> pa.RecordBatch:
    keys, docs, places = entries
    return pa.record_batch([keys.view(np.int64), docs.astype(np.int64), places.astype(np.int64)], names=["key", "doc_id", "place"])


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each run of equal keys, and the length of the run that each key stands in."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lengths = np.diff(np.r_[starts, len(keys)])
    return starts, np.repeat(lengths, lengths)


def repeated(
    df: DataFrame, emit: Callable[[pa.RecordBatch], Iterable[Entries]], parts: int | None = None
) -> DataFrame:
    """``(key, doc_id, place)`` for all entries of ``emit`` over ``df`` whose key occurs twice or more.

    Entries travel packed, a few arrays per batch and partition, so the shuffle moves 20 bytes an
    entry and the JVM sees few rows. Before it, a block that ``emit`` gives settles keys it holds several times: those
    entries are known to repeat and go, spread over all partitions, straight to the result, and one
    mark per key goes to the key's partition. A hot key thus costs its partition one entry a block.
    A partition holds its keys in memory; raise ``parts`` (by default
    ``spark.sql.shuffle.partitions``) with the data.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("places", pa.binary())])
        turn = 0
        for given in chain.from_iterable(map(emit, batches)):
            keys, docs, places = given
            if len(keys) == 0:
                continue
            order = np.argsort(keys)
            keys, docs, places = keys[order], docs[order], places[order]
            starts, length = _runs(keys)
            many = length > 1
            rows = []
            own = [x[many] for x in (keys, docs, places)]
            turn += int(keys[0] % np.uint64(parts)) + 1
            for i in range(0, len(own[0]), _CHUNK):
                rows.append(_row((turn + i // _CHUNK) % parts, _DONE, tuple(x[i : i + _CHUNK] for x in own)))
            heads = starts[length[starts] > 1]
            single = np.sort(order[~many])  # in the order of the texts, which packs better
            keys = np.r_[given[0][single], keys[heads]]
            docs = np.r_[given[1][single], np.zeros(len(heads), dtype=np.int64)]
            places = np.r_[given[2][single], np.full(len(heads), -1)]
            part = ((keys >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            keys, docs, places, part = keys[order], docs[order], places[order], part[order]
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else part
            for a, b in zip(starts, np.r_[starts[1:], len(part)], strict=True):
                rows.append(_row(int(part[a]), _OPEN, (keys[a:b], docs[a:b], places[a:b])))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Entries] = []
        for batch in batches:
            for kind, keys, docs, places in zip(*(batch.column(n).to_pylist() for n in ("kind", "keys", "docs", "places")), strict=True):
                entries = np.frombuffer(keys, np.uint64), np.frombuffer(docs, np.int64), np.frombuffer(places, np.int32)
                if kind == _DONE:
                    yield _batch(entries)
                else:
                    held.append(entries)
        if not held:
            return
        keys, docs, places = (np.concatenate([e[i] for e in held]) for i in range(3))
        held.clear()
        order = np.argsort(keys)
        keys = keys[order]
        found = order[(_runs(keys)[1] > 1)]
        keys = keys[_runs(keys)[1] > 1]
        docs, places = docs[found], places[found]
        new = places >= 0
        for i in range(0, len(keys), _CHUNK):
            at = slice(i, i + _CHUNK)
            if new[at].any():
                yield _batch((keys[at][new[at]], docs[at][new[at]], places[at][new[at]]))

    return (
        df.mapInArrow(pack, _PACKED).repartitionById(parts, F.col("part")).mapInArrow(match, _ROWS)
    )
