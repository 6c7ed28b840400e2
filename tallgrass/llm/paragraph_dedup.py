"""Substring dedup by MinHash banding of paragraphs.

Paragraphs are the lines of a text. Each gets MinHash values of its five-word shingles, cut into bands;
paragraphs that share a band are verified by exact Jaccard similarity, and components of similar
paragraphs keep their first occurrence. With 10 bands of 3 values a pair at the threshold of 0.8 is
met with probability 0.9992. Where a band stays mixed, because many paragraphs share a passage and little
else, its paragraphs are brought together by their rarest shingles instead: sets that are similar enough
share one of those for certain.

A passage may also stand inside longer lines or run over several. So the words of each text are cut a
second time, by content: a border falls where the hash of three words is the smallest around, wherever
the passage stands. Equal chunks are found by their digests, neighbouring ones join to passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallgrass.llm import arrays
from tallgrass.llm.collide import Entries, repeated
from tallgrass.llm.graph import drop, keep
from tallgrass.llm.jaccard_join import link

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 10, 3
_U = np.uint64
_FACTORS = np.random.default_rng(3).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * _U(2) + _U(1)
_PARAGRAPHS = "doc_id long, line long, first_word long, n_words long, n_shingles long, node long, bands array<long>"
AROUND = 3  # words on both sides among which a border has the smallest hash
PASSAGE = 20  # words that neighbouring chunks must hold together
LONGEST = 255  # words of a chunk; one without a border for longer is cut there


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the lines of all texts, their text numbers and their numbers in the text."""
    border = np.zeros(len(data) + 1, dtype=bool)
    border[np.flatnonzero(data == 0x0A) + 1] = True
    border[offsets[:-1][np.diff(offsets) > 0]] = True
    border[len(data)] = False
    starts = np.flatnonzero(border)
    text = np.searchsorted(offsets, starts, side="right") - 1
    rows = len(offsets) - 1
    count = np.bincount(text, minlength=rows)
    return np.r_[starts, len(data)], text, np.arange(len(starts)) - (np.cumsum(count) - count)[text]


def _profile(data: np.ndarray, offsets: np.ndarray) -> tuple:
    """Text, line, words and shingles of every line, its digest, and hashes with line numbers."""
    edges, text, number = _lines(data, offsets)
    low = arrays.LOWER[data]
    starts, ends, line = arrays.words(low, edges)
    n_words = np.bincount(line, minlength=len(text))
    hashes, owner = arrays.distinct(*arrays.shingles(arrays.hash_spans(low, starts, ends), line, SHINGLE))
    n = np.bincount(owner, minlength=len(text))
    digest = np.zeros(len(text), dtype=np.uint64)
    if len(hashes):
        digest[n > 0] = np.add.reduceat(arrays.mix(hashes), (np.cumsum(n) - n)[n > 0])
    return text, number, n_words, n, digest.view(np.int64), hashes, owner


def _bands(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Band keys of sets that lie one after another, ``n`` members each."""
    starts = np.cumsum(n) - n
    keys = np.empty((len(n), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        total = np.full(len(n), band + 1, dtype=np.uint64)
        for row in range(ROWS):
            low = np.minimum.reduceat(hashes * _FACTORS[band * ROWS + row], starts)
            total = arrays.mix(total + low)
        keys[:, band] = total
    return keys


def paragraphs(docs: DataFrame, least: int) -> DataFrame:
    """All paragraphs of at least ``least`` words, with digest and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in arrays.slices(batch.column(1)):
                text, number, n_words, n, digest, hashes, owner = _profile(data, offsets)
                long = np.flatnonzero((n_words >= least) & (n > 0))
                if len(long) == 0:
                    continue
                mark = np.zeros(len(text), dtype=bool)
                mark[long] = True
                keys = _bands(hashes[mark[owner]], n[long])
                before = np.cumsum(n_words) - n_words
                first_word = before - before[np.searchsorted(text, text)]  # in the text
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(first + text[long])), *(pa.array(x[long].astype(np.int64)) for x in (number, first_word, n_words, n, digest)),
                     arrays.list_array(keys.ravel().view(np.int64), np.full(len(long), BANDS), pa.int64())],
                    names=["doc_id", "line", "first_word", "n_words", "n_shingles", "node", "bands"],
                )

    return docs.mapInArrow(run, _PARAGRAPHS)


def _members(texts: DataFrame) -> DataFrame:
    """Shingles of the wanted paragraphs: those of ``texts(text, nodes)`` whose digest is in ``nodes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).to_pylist()
            for first, offsets, data in arrays.slices(batch.column(0)):
                text, _, _, n, digest, hashes, owner = _profile(data, offsets)
                asked = [(first + t, d) for t, nodes in enumerate(wanted[first : first + len(offsets) - 1]) for d in set(nodes)]
                asked = set(asked)
                chosen = np.array([i for i, (t, d) in enumerate(zip((first + text).tolist(), digest.tolist(), strict=True)) if (t, d) in asked and n[i]], dtype=np.int64)
                if len(chosen) == 0:
                    continue
                mark = np.zeros(len(text), dtype=bool)
                mark[chosen] = True
                yield pa.record_batch(
                    [pa.array(digest[chosen]), arrays.list_array(hashes[mark[owner]].view(np.int64), n[chosen], pa.int64())], names=["node", "members"]
                )

    return texts.mapInArrow(run, "node long, members array<long>").dropDuplicates(["node"])


def _closer(sets, percent: int):
    """Mixed rows by the rarest shingles of their paragraphs instead of their bands.

    Of ``n`` shingles, ordered by how many of the paragraphs hold them, the first ``n - ceil(n percent / 100) + 1`` are
    keys: two similar sets differ in fewer, so they share one of those. ``at`` is the shingle's place in that order.
    """

    def run(mixed: DataFrame) -> DataFrame:
        facts = [c for c in mixed.columns if c not in ("key", "main")]
        nodes = mixed.select(*facts).distinct()
        tokens = sets(nodes.select("node")).select("node", F.explode("members").alias("key"))
        held = tokens.groupBy("key").agg(F.count("*").alias("held"))
        ordered = tokens.join(held, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("held", "key"))).alias("all"))
        size = F.size("all")
        rarest = F.slice("all", F.lit(1), (size - F.ceil(size * percent / 100) + 1).cast("int"))
        keys = ordered.select("node", F.posexplode(rarest).alias("place", "k")).where("k.held > 1")
        keys = keys.select("node", F.col("k.key").alias("key"), (F.col("place") + 1).alias("at"))
        placed = keys.join(nodes, "node")
        sizes = placed.groupBy("key", "label").agg(F.count("*").alias("c"))
        still = sizes.groupBy("key").agg(F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("labels")).where("labels > 1")
        return placed.join(still.select("key", F.col("top.label").alias("main")), "key").select("key", "main", "at", *facts)

    return run


def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word in the text, words and digest of every chunk.

    A word ends a chunk where the hash of it and the two before is smaller than those of ``AROUND`` words on
    both sides, the text's borders counting as larger. A chunk depends on its words and the few around only.
    """
    low = arrays.LOWER[data]
    starts, ends, text = arrays.words(low, offsets)
    count = len(starts)
    if count == 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64)
    word = arrays.hash_spans(low, starts, ends)
    border = np.zeros(count, dtype=bool)
    if count >= 3:
        window = arrays.mix(word[2:] + arrays.mix(word[1:-1] + arrays.mix(word[:-2])))
        whole = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
        whole[2:] = np.where(text[2:] == text[:-2], window, whole[2:])
        least = whole.copy()
        for step in range(1, AROUND + 1):
            for a, b in ((slice(step, None), slice(None, -step)), (slice(None, -step), slice(step, None))):
                if step < count:
                    other = np.where(text[a] == text[b], whole[b], np.iinfo(np.uint64).max)
                    least[a] = np.minimum(least[a], other)
        border = (whole == least) & (whole != np.iinfo(np.uint64).max)
    last = border.copy()
    last[:-1] |= text[1:] != text[:-1]
    last[-1] = True
    since = np.arange(count) - np.r_[0, np.maximum.accumulate(np.where(last, np.arange(count) + 1, 0))[:-1]]
    last |= since % LONGEST == LONGEST - 1
    stop = np.flatnonzero(last)
    first = np.r_[0, stop[:-1] + 1]
    size = stop + 1 - first
    place = np.arange(count) - first[np.searchsorted(stop, np.arange(count))]
    digest = np.add.reduceat(arrays.mix(word + arrays.mix(place.astype(np.uint64) * _FACTORS[0] + _FACTORS[1])), first)
    owner = text[first]
    return owner, first - np.searchsorted(text, owner), size, arrays.mix(digest)


def passages(docs: DataFrame, least: int = PASSAGE) -> DataFrame:
    """``(doc_id, first_word, n_words, cluster, first_doc, first_doc_word, removed)``: runs of chunks that stand elsewhere too.

    A run is the chunks that follow each other in a text, all repeated, and all first occurrences or none of them
    (``removed``); it holds ``least`` words or more. ``cluster`` is the digest of its first chunk, whose first
    occurrence, by ``doc_id`` and word, is at ``first_doc``, ``first_doc_word``.
    """

    def emit(batch: pa.RecordBatch) -> Iterator[Entries]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, offsets, data in arrays.slices(batch.column(1)):
            text, at, size, digest = _chunks(data, offsets)
            # equal chunks have equal sizes, so the size rides in the low bits of the key
            yield digest & ~_U(LONGEST) | np.minimum(size, LONGEST).astype(np.uint64), ids[first + text], at

    chunk = repeated(docs, emit).select("key", "doc_id", F.col("place").alias("word"), F.col("key").bitwiseAND(LONGEST).alias("size"))
    # stored, so that the join below is one by itself and a hot chunk's rows are split
    chunk = keep(docs.sparkSession, chunk, "chunks")
    first = keep(docs.sparkSession, chunk.groupBy("key").agg(F.min(F.struct("doc_id", "word")).alias("head")), "heads")
    told = chunk.join(first, "key").select("*", (F.struct("doc_id", "word") != F.col("head")).alias("removed"))
    order = Window.partitionBy("doc_id").orderBy("word")
    new = (F.lag(F.col("word") + F.col("size")).over(order).eqNullSafe(F.col("word"))) & F.lag("removed").over(order).eqNullSafe(F.col("removed"))
    runs = told.withColumn("new", (~new).cast("int")).withColumn("run", F.sum("new").over(order))
    joined = runs.groupBy("doc_id", "run").agg(
        F.min("word").alias("first_word"), F.sum("size").alias("n_words"), F.min_by("key", "word").alias("cluster"),
        F.min_by("head", "word").alias("head"), F.first("removed").alias("removed"),
    )
    return joined.where(F.col("n_words") >= least).select(
        "doc_id", "first_word", "n_words", "cluster", F.col("head.doc_id").alias("first_doc"), F.col("head.word").alias("first_doc_word"), "removed"
    )


def paragraph_dedup(spark: SparkSession, docs: DataFrame, least: int = 20) -> DataFrame:
    """``(doc_id, line, first_word, n_words, cluster, first_doc, first_line, removed)`` for every repeated paragraph.

    A paragraph is a line of at least ``least`` words (shorter ones are headings, licence lines and the
    like, and are left alone). Paragraphs are similar at 0.8 or more over sets of five-word shingles,
    A-Z lower-cased. ``removed`` is false for the first occurrence of a component, by ``doc_id`` and
    line, and true for the others; paragraphs without a like are not returned.

    Equal sets are joined by their digest before anything is compared, so a paragraph in many documents
    is one node. Null and empty texts have no paragraphs; rows without ``doc_id`` are left out, as their
    paragraphs could not be named; a repeated row repeats its paragraphs under the same name; other
    columns are ignored; empty in, empty out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    table = keep(spark, paragraphs(docs, least), "paragraphs")
    nodes = table.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles"), F.min("bands").alias("bands"))

    def emit(batch: pa.RecordBatch) -> Iterator[Entries]:
        keys = batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        owner = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
        yield keys, owner, np.zeros(len(keys), dtype=np.int64)

    met = keep(spark, repeated(nodes.select("node", "bands"), emit).select("key", F.col("doc_id").alias("node")), "met")
    facts = keep(spark, nodes.select("node", "doc_id", "n_shingles"), "nodes")

    def sets(wanted: DataFrame) -> DataFrame:
        where = facts.join(wanted, "node").groupBy("doc_id").agg(F.collect_list("node").alias("nodes"))
        return _members(docs.join(where, "doc_id").select("text", "nodes"))

    na, nb = F.col("a.n_shingles"), F.col("b.n_shingles")
    near = 100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)
    groups = keep(spark, link(spark, met, facts.drop("doc_id"), near, sets, PERCENT, closer=_closer(sets, PERCENT)), "groups")
    drop(spark, met, facts)
    named = table.select("doc_id", "line", "first_word", "n_words", "node").join(groups, "node", "left").withColumn("cluster", F.coalesce("component", "node"))
    clusters = named.groupBy("cluster").agg(F.min(F.struct("doc_id", "line")).alias("head"), F.count("*").alias("c")).where("c > 1")
    return named.join(clusters, "cluster").select(
        "doc_id", "line", "first_word", "n_words", "cluster", F.col("head.doc_id").alias("first_doc"), F.col("head.line").alias("first_line"),
        (F.struct("doc_id", "line") != F.col("head")).alias("removed"),
    )


def repeated_text(spark: SparkSession, docs: DataFrame, least: int = 20, passage: int = PASSAGE) -> DataFrame:
    """Repeated paragraphs and repeated passages of ``docs(doc_id, text, ...)``, told apart by ``kind``.

    ``(doc_id, kind, line, first_word, n_words, cluster, first_doc, removed)``: see :func:`paragraph_dedup` and
    :func:`passages`; words count from 0 in the text, a passage has no ``line``. A passage of 51 words that stands twice,
    word for word but for A-Z, is found whatever stands around it with probability 0.98 or more, a longer one nearly always.

    Rows without ``doc_id``, null and empty texts give no rows; repeated rows repeat what is in them; other
    columns are ignored; empty in, empty out. Texts are cut whole, however long.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    lines = paragraph_dedup(spark, docs, least).withColumn("kind", F.lit("paragraph"))
    runs = passages(docs, passage).withColumn("kind", F.lit("passage")).withColumn("line", F.lit(None).cast("long"))
    columns = ["doc_id", "kind", "line", "first_word", "n_words", "cluster", "first_doc", "removed"]
    return lines.select(*columns).unionByName(runs.select(*columns))
