"""Suffix-array dedup: repeated substrings by a difference cover and blockwise suffix buckets.

Only suffixes to a depth of ``least`` bytes matter here, and only which of them are equal, so an order
by 64-bit names of fixed-length prefixes serves as well as the alphabetical one. A difference cover
modulo a period (273 for strings of 400 bytes, 91 for 200) has, for any two places, a shift below it that
takes both onto sample places. Samples are ranked (named) first: the name of a sample is that of its
``least - period + 1`` bytes. If the first ``least`` bytes of two suffixes agree, both have a sample of the
same rank at the same shift below the period; so a suffix all of whose samples up to there have unique ranks is settled. What is left, long
ties, goes into buckets by the smallest name of a sample-long string in the suffix, and one bucket at a
time is sorted; equal neighbours are repeats. A bucket never needs the text, only names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import arrays
from tallgrass.llm.collide import repeated
from tallgrass.llm.graph import keep

PERIOD = 273
_ORBITS = {PERIOD: (2, (1, 91, 117)), 91: (3, (0, 1, 49))}  # period: factor under which the cover is closed, and what it grows from


def difference_cover(period: int = PERIOD) -> np.ndarray:
    """Residues modulo ``period`` whose differences are all residues: 273 closed under doubling, 91 under tripling."""
    factor, seeds = _ORBITS[period]
    found: set[int] = set()
    for seed in seeds:
        while seed not in found:
            found.add(seed)
            seed = seed * factor % period
    return np.array(sorted(found), dtype=np.int64)


COVERS = {period: difference_cover(period) for period in _ORBITS}
COVER = COVERS[PERIOD]


def period_for(least: int) -> int:
    """The longest period that leaves samples of 128 bytes, or else the shortest: the longer, the fewer repeat by chance."""
    return max((p for p in COVERS if least - p + 1 >= 128), default=min(COVERS))
WORD = r"[^\x20\x09-\x0D]+"
_BUCKETS = "part int, kind int, bucket long, text_id long, start int, names binary, count int"
_RUNS = "text_id long, start int, count int"


def samples(size: int, depth: int, period: int = PERIOD) -> np.ndarray:
    """Sample places of a text at which ``depth`` bytes are left."""
    if size < depth:
        return np.empty(0, dtype=np.int64)
    places = (np.arange(0, size, period, dtype=np.int64)[:, None] + COVERS[period]).ravel()
    return places[places <= size - depth]


def _sample_names(batch: pa.RecordBatch, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of all samples of the texts of ``least`` bytes or more; a text seen twice counts once."""
    period = period_for(least)
    depth = least - period + 1
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    seen: set[int] = set()
    keys, docs, places = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for first, offsets, data in arrays.slices(batch.column(1)):
        sizes = np.diff(offsets)
        sums = None
        for i in np.flatnonzero(sizes >= least):
            if ids[first + i] in seen:
                continue
            seen.add(ids[first + i])
            if sums is None:
                sums = arrays.prefix(data)
            at = samples(int(sizes[i]), depth, period)
            keys.append(arrays.span_hash(sums, at + offsets[i], at + offsets[i] + depth))
            docs.append(np.full(len(at), ids[first + i], dtype=np.int64))
            places.append(at)
    return np.concatenate(keys), np.concatenate(docs), np.concatenate(places)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _suffixes(data: np.ndarray, known: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts that unique ranks do not settle, with bucket and name; ``known``: samples of repeated rank."""
    period = period_for(least)
    depth = least - period + 1
    starts = len(data) - least + 1
    change = np.zeros(starts + 1, dtype=np.int64)
    np.add.at(change, np.minimum(np.maximum(known - period + 1, 0), starts), 1)
    np.add.at(change, np.minimum(known + 1, starts), -1)
    open_ = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    if len(open_) == 0:
        return open_, np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
    sums = arrays.prefix(data)
    first, last = int(open_[0]), int(open_[-1])
    place = np.arange(first, last + period)
    bucket = _sliding_min(arrays.span_hash(sums, place, place + depth), period)[open_ - first]
    return open_, bucket, arrays.span_hash(sums, open_, open_ + least)


def _cut_runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new run begins: any of the columns changes."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _ends(cuts: np.ndarray, total: int) -> np.ndarray:
    """Where each run ends; no runs, no ends."""
    return np.append(cuts[1:], total)[: len(cuts)]


def _to_buckets(parts: int, least: int):
    """Map side: name the open suffixes, settle what repeats within the batch, pack the rest by bucket."""
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int64()), ("text_id", pa.int64()), ("start", pa.int32()), ("names", pa.binary()), ("count", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts, buckets, names = [], [], [], []
            for text_id, text, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                at, bucket, name = _suffixes(data, known.values.to_numpy(), least)
                texts.append(np.full(len(at), text_id, dtype=np.int64))
                starts.append(at)
                buckets.append(bucket)
                names.append(name)
                if sum(map(len, texts)) >= 2_000_000:
                    yield pa.RecordBatch.from_pylist(_pack(texts, starts, buckets, names, parts), schema=schema)
                    texts, starts, buckets, names = [], [], [], []
            if texts:
                yield pa.RecordBatch.from_pylist(_pack(texts, starts, buckets, names, parts), schema=schema)

    return run


_ASK, _MARK, _DONE = 0, 1, 2  # to be compared; stands for repeats of its batch; repeats already


def _pack(texts: list, starts: list, buckets: list, names: list, parts: int) -> list[dict]:
    text, start, bucket, name = (np.concatenate(x) for x in (texts, starts, buckets, names))
    order = np.argsort(name, kind="stable")
    ordered = name[order]
    head = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.empty(0, dtype=bool)
    begin = np.flatnonzero(head)
    size = np.diff(np.r_[begin, len(ordered)])
    many = np.repeat(size > 1, size)
    kind = np.zeros(len(name), dtype=np.int64)
    kind[order[many]] = _DONE
    kind[order[many & head]] = _MARK
    rows = []
    done = np.flatnonzero(kind != _ASK)
    cuts = _cut_runs(text[done], start[done] - np.arange(len(done)))
    for turn, (a, b) in enumerate(zip(cuts, _ends(cuts, len(done)), strict=True)):
        rows.append({"part": int(text[done[a]] + turn) % parts, "kind": _DONE, "bucket": 0, "text_id": int(text[done[a]]), "start": int(start[done[a]]), "count": int(b - a)})
    sent = np.flatnonzero(kind != _DONE)
    cuts = _cut_runs(text[sent], start[sent] - np.arange(len(sent)), bucket[sent], kind[sent])
    raw = name[sent].view(np.uint8).reshape(-1, 8)[:, :6]  # 48 bits are enough within a bucket
    for a, b in zip(cuts, _ends(cuts, len(sent)), strict=True):
        i = sent[a]
        rows.append({
            "part": int((int(bucket[i]) >> 33) % parts), "kind": int(kind[i]), "bucket": int(bucket[i].view(np.int64)), "text_id": int(text[i]),
            "start": int(start[i]), "names": raw[a:b].tobytes(), "count": int(b - a),
        })
    return rows


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: sort the suffixes of the partition's buckets; equal neighbours repeat."""
    held: list[tuple] = []
    for batch in batches:
        done = batch.filter(pc.equal(batch.column(1), _DONE))
        if done.num_rows:
            yield done.select(["text_id", "start", "count"])
        rest = batch.filter(pc.less(batch.column(1), _DONE))
        held += zip(*(rest.column(n).to_pylist() for n in ("kind", "bucket", "text_id", "start", "names", "count")), strict=True)
    if not held:
        return
    kind, bucket, text, start, names, count = zip(*held, strict=True)
    held.clear()
    count = np.array(count)
    raw = np.zeros((int(count.sum()), 8), dtype=np.uint8)
    raw[:, :6] = np.frombuffer(b"".join(names), dtype=np.uint8).reshape(-1, 6)
    del names
    own = np.repeat(np.array(bucket, dtype=np.int64).view(np.uint64), count)
    key = arrays.mix(raw.view(np.uint64).ravel() ^ arrays.mix(own))
    asked = np.repeat(np.array(kind) == _ASK, count)
    text = np.repeat(np.array(text, dtype=np.int64), count)
    start = np.repeat(np.array(start) - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(int(count.sum()))
    order = np.argsort(key)
    key = key[order]
    same = np.r_[False, key[1:] == key[:-1]]
    twice = np.zeros(len(key), dtype=bool)
    twice[order] = same | np.r_[same[1:], False]
    found = np.flatnonzero(twice & asked)
    cuts = _cut_runs(text[found], start[found] - np.arange(len(found)))
    size = _ends(cuts, len(found)) - cuts
    for i in range(0, len(cuts), 1 << 16):
        at = found[cuts[i : i + (1 << 16)]]
        yield pa.record_batch(
            [pa.array(text[at]), pa.array(start[at].astype(np.int32)), pa.array(size[i : i + (1 << 16)].astype(np.int32))], names=["text_id", "start", "count"]
        )


def _long_runs(data: np.ndarray, edge: np.ndarray, words: int, sure: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between ``edge`` that hold ``words`` whole words or ``sure`` bytes."""
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    starts, ends, _ = arrays.words(data, np.array([0, len(data)]))
    held = np.searchsorted(ends, end, side="right") - np.searchsorted(starts, begin)
    long = (held >= words) | (end - begin >= sure)
    return begin[long], end[long]


def _remove(least: int, words: int, sure: int):
    """Cut the covered bytes out of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text_id, text, begins, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3), strict=True):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                change = np.zeros(len(data) + 1, dtype=np.int64)
                begin, count = begins.values.to_numpy().astype(np.int64), counts.values.to_numpy()
                np.add.at(change, begin, 1)
                np.add.at(change, begin + count - 1 + least, -1)
                covered = np.cumsum(change[:-1]) > 0
                runs = _long_runs(data, np.diff(np.r_[0, covered, 0]), words, sure)
                covered = np.zeros(len(data), dtype=bool)
                for a, b in zip(*runs, strict=True):
                    covered[a:b] = True
                kept = data[~covered].tobytes()
                spans = [{"start": int(a), "stop": int(b)} for a, b in zip(*runs, strict=True)]
                rows.append({"text_id": text_id, "n_removed": int(covered.sum()), "spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept.decode(errors="ignore")})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("text_id", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept_sha256", pa.string()), ("kept", pa.string())]))

    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, least: int = 400, texts: bool = False, words: int = 0, sure: int = 400) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept_sha256)`` for every row of ``docs(doc_id, text, ...)``.

    Removes each byte that is covered by a string of ``least`` bytes which also starts anywhere else, in
    this text or another; strings are judged on the input. ``spans`` are the maximal removed runs
    ``(start, stop)`` in bytes. With ``texts`` the remaining text comes as ``kept``, without the halves of
    characters that a span cuts (null where nothing was removed), and ``text_id``, the hash of the text. With ``words``, a run is
    removed only if it holds so many whole words or ``sure`` bytes. ``least`` must be at least 106.

    Null and empty texts have no bytes. Equal texts, repeated rows among them, are one text for the
    search; of ``least`` bytes or more, all of each copy is removed. Null ``doc_id`` and other columns
    do no harm; empty in, empty out. Strings and texts are told apart by 64-bit hashes.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("text_id", F.xxhash64("text"))
    n_bytes = F.octet_length("text").cast("long")
    long = n_bytes >= least
    if words:  # only texts between the two lengths need their words counted
        long = F.when(n_bytes >= sure, F.lit(True)).when(long, F.regexp_count("text", F.lit(WORD)) >= words).otherwise(F.lit(False))
    facts = keep(
        spark, docs.select("doc_id", "text_id", n_bytes.alias("n_bytes"), long.alias("long"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "facts"
    )
    met = repeated(docs.select("text_id", "text"), lambda batch: [_sample_names(batch, least)], parts)
    known = met.groupBy(F.col("doc_id").alias("text_id")).agg(F.collect_list(F.col("place")).alias("known"))
    first = facts.groupBy("text_id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    chosen = known.join(first.select("text_id", "doc_id"), "text_id")
    same = [docs["doc_id"].eqNullSafe(chosen["doc_id"]), docs["text_id"] == chosen["text_id"]]
    open_texts = docs.join(chosen, same).select(docs["text_id"], docs["text"].cast("binary").alias("text"), F.array_distinct("known").alias("known"))
    open_texts = keep(spark, open_texts, "open")
    runs = keep(spark, open_texts.mapInArrow(_to_buckets(parts, least), _BUCKETS).repartitionById(parts, F.col("part")).mapInArrow(_sort_buckets, _RUNS), "runs")
    runs = runs.groupBy("text_id").agg(F.collect_list("start").alias("begins"), F.collect_list("count").alias("counts"))
    schema = "text_id long, n_removed long, spans array<struct<start: long, stop: long>>, kept_sha256 string, kept string"
    done = open_texts.join(runs, "text_id").select("text_id", "text", "begins", "counts").mapInArrow(_remove(least, words, sure), schema)
    done = done.dropDuplicates(["text_id"]) if texts else done.drop("kept").dropDuplicates(["text_id"])
    all_ = facts.join(first.select("text_id", "copies"), "text_id").join(done, "text_id", "left")
    whole = (F.col("copies") > 1) & F.col("long")
    span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    none = F.array().cast("array<struct<start: long, stop: long>>")
    out = [
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, span).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    ]
    if texts:
        out += ["text_id", F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept")]
    return all_.select(*out)
