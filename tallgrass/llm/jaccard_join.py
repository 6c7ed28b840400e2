"""N-gram Jaccard join by parity sketches.

A set's parity sketch has one bit per hash value, the parity of how many members fall on it. The
sketch of a symmetric difference is the XOR of two sketches, so their Hamming distance is at most its
size. Two sets of at most ``h`` and ``h / t`` members with a Jaccard similarity of ``t`` or more differ
in ``d = h (1 - t) / t`` members at most: cut into ``d + 1`` pieces of 64 bits, their sketches agree
in one piece. Sets are put into bands by size, pieces are joined within a band, and what meets is
verified.

At a similarity of 0.8 such a piece has three or four members only, and unrelated sets agree in so
small a piece often enough for candidates to grow with the square of the corpus. Bands whose pieces
are that small are cut anew: into fewer and larger pieces, by as many independent cuts as it takes, and
only pieces with ``HEAVY`` bits or more are keys. No number of errors then forces an agreeing piece, but
the number of pieces is such that a pair at the threshold has none with probability ``MISS`` at most.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import arrays
from tallgrass.llm.collide import Entries, repeated
from tallgrass.llm.graph import components, drop, keep

BAND = 1.35  # upper size of a band over that of the band before
LEADERS = 2  # orders by which a key's leader is chosen
SKETCH = 8  # 64-bit words of the short sketch that is compared while pairs are formed
LIGHT = 3  # a piece of at most so many bits is no key by itself
SMALL = 64  # sets up to this size always have as many pieces as the pigeonhole asks for
MEMBERS = 5  # so do bands whose pieces then have so many members or more
HEAVY = 6  # bits of a key of the other bands; one more for about each tenfold corpus (by estimate)
MISS = 1e-9  # probability that a pair at the threshold shares none of those keys

_PROFILE = "doc_id long, n_shingles long, d1 long, d2 long, " + ", ".join(f"s{i} long" for i in range(SKETCH)) + ", sketch array<long>"
_ODD = np.uint64(0xA24BAED4963EE407)
_U = np.uint64


@lru_cache(maxsize=8)
def _bands(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper size and greatest symmetric difference of each band."""
    tops = [1]
    while tops[-1] < 1 << 40:
        tops.append(max(int(tops[-1] * BAND) + 1, tops[-1] * 100 // percent))
    top = np.array(tops, dtype=np.int64)
    return top, top * (100 - percent) // percent


def _agree(union: float, pieces: int, percent: int) -> float:
    """Probability that a pair at the threshold has no difference in a piece and ``HEAVY`` bits or more."""
    common, differ = union * percent / 100 / pieces, union * (100 - percent) / 100 / pieces
    odd = (1 - math.exp(-common / 32)) / 2  # that a bit is set
    heavy = sum(math.comb(64, k) * odd**k * (1 - odd) ** (64 - k) for k in range(HEAVY, 65))
    return heavy * math.exp(-differ)


@lru_cache(maxsize=8)
def _cuts(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of one cut, and pieces of all cuts, for each band; 0 for bands that follow the pigeonhole."""
    tops, differ = _bands(percent)
    cut, used = np.zeros(len(tops), dtype=np.int64), np.zeros(len(tops), dtype=np.int64)
    for i in range(1, len(tops)):
        least, most = int(tops[i - 1]) + 1, int(tops[i]) * 100 / percent  # unions of pairs that meet in the band
        if tops[i] <= SMALL or least >= MEMBERS * (differ[i] + 1):
            continue
        tried = {max(2, round(least * percent / 1000 * x)) for x in range(1, 60)}
        best = max(tried, key=lambda m: min(_agree(least, m, percent), _agree(most, m, percent)))
        chance = min(_agree(least, best, percent), _agree(most, best, percent))
        cut[i], used[i] = best, math.ceil(math.log(MISS) / math.log1p(-chance))
    return cut, used


def _parity(cell: np.ndarray, cells: int) -> np.ndarray:
    """64-bit words of the parities of how often each cell occurs; ``cells`` is a multiple of 64."""
    odd = (np.bincount(cell, minlength=cells) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def _pieces(spread: np.ndarray, text: np.ndarray, band: np.ndarray, differ: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join keys, with text numbers, of the sets in the given band each (-1: none).

    A piece of few bits agrees by chance in a share of all pairs that would make the candidates grow
    with the square of the corpus, so by itself it is no key. If a pair agrees in such pieces only, say
    ``a`` of them, the other pieces hold at least one difference each and ``a - 1`` more in all; hence
    behind one of the ``a`` comes a piece with one difference at most. The key of a light piece takes in
    the next piece, once as it is and once without each of its bits. This holds for any ``LIGHT``.
    """
    count = np.where(band >= 0, differ[band] + 1, 0)
    count[count == 1] = 0  # no difference allowed: such sets are equal and already joined
    ends = np.cumsum(count)
    here = count[text] > 0
    spread, text = spread[here], text[here]
    size = count[text].astype(np.uint64)
    slot = (ends - count)[text] + ((spread >> _U(6)) % np.maximum(size, _U(1))).astype(np.int64)
    total = int(ends[-1]) if len(ends) else 0
    if total == 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    piece = _parity(slot * 64 + (spread & _U(63)).astype(np.int64), total * 64)
    owner = np.repeat(np.arange(len(count)), count)
    index = np.arange(total) - (ends - count)[owner]
    place = arrays.mix((band[owner].astype(np.uint64) << _U(40)) + index.astype(np.uint64))
    light = np.bitwise_count(piece) <= LIGHT
    keys = [arrays.mix(arrays.mix(piece[~light] + _ODD) ^ place[~light])]
    texts = [owner[~light]]
    at = np.flatnonzero(light)
    nxt = np.where(index[at] + 1 < count[owner[at]], at + 1, at + 1 - count[owner[at]])
    base = arrays.mix(piece[at] * _ODD + place[at])
    word, left = piece[nxt], piece[nxt].copy()
    keys.append(arrays.mix(base ^ arrays.mix(word + _U(1))))
    texts.append(owner[at])
    while left.any():
        some = left != 0
        low = left[some] & (~left[some] + _U(1))
        keys.append(arrays.mix(base[some] ^ arrays.mix((word[some] ^ low) + _U(1))))
        texts.append(owner[at][some])
        left[some] ^= low
    return np.concatenate(keys), np.concatenate(texts)


def _heavy(spread: np.ndarray, text: np.ndarray, band: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Join keys, with text numbers, of the sets in bands with independent cuts: the pieces of ``HEAVY`` bits or more."""
    cut, used = _cuts(percent)
    size = np.where(band >= 0, cut[band], 0)
    left = np.where(band >= 0, used[band], 0)
    keys, texts = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)]
    number = 0
    while (left > 0).any():
        live = left[text] > 0
        spread, text = spread[live], text[live]
        number += 1
        width = np.minimum(size, left)
        left = left - width
        ends = np.cumsum(width)
        start = ends - width
        own = arrays.mix(spread + _U(number * int(_ODD) & (1 << 64) - 1))
        at = ((own >> _U(6)) % size[text].astype(np.uint64)).astype(np.int64)
        inside = at < width[text]
        piece = _parity((start[text] + at)[inside] * 64 + (own[inside] & _U(63)).astype(np.int64), int(ends[-1]) * 64)
        owner = np.repeat(np.arange(len(width)), width)
        index = np.arange(len(piece)) - start[owner]
        full = np.bitwise_count(piece) >= HEAVY
        piece, owner, index = piece[full], owner[full], index[full]
        place = arrays.mix((band[owner].astype(np.uint64) << _U(40)) + (_U(number) << _U(24)) + index.astype(np.uint64))
        keys.append(arrays.mix(arrays.mix(piece + _ODD) ^ place))
        texts.append(owner)
    return np.concatenate(keys), np.concatenate(texts)


def profiles(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Set size, set digest and sketches of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, offsets, data in arrays.slices(batch.column(1)):
                rows = len(offsets) - 1
                hashes, text = arrays.shingle_sets(data, offsets, size)
                n = np.bincount(text, minlength=rows)
                starts = np.cumsum(n) - n
                digests = []
                for salt in (_ODD, _ODD >> _U(1)):
                    d = np.zeros(rows, dtype=np.uint64)
                    if len(hashes):
                        d[n > 0] = np.add.reduceat(arrays.mix(hashes + salt), starts[n > 0])
                    digests.append(d.view(np.int64))
                spread = arrays.mix(hashes ^ _ODD)
                sketch = _parity(text * (64 * SKETCH) + (spread >> _U(55)).astype(np.int64), rows * 64 * SKETCH)
                sketch = sketch.view(np.int64).reshape(rows, SKETCH)
                width = 64 << np.ceil(np.log2(np.maximum(n * 2, 64) / 64)).astype(np.int64)  # bits: a power of two
                begin = np.cumsum(width) - width
                long = _parity(begin[text] + (arrays.mix(spread) & (width[text] - 1).astype(np.uint64)).astype(np.int64), int(width.sum()))
                yield pa.record_batch(
                    [ids.slice(first, rows), pa.array(n.astype(np.int64)), *map(pa.array, digests)]
                    + [pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH)]
                    + [arrays.list_array(long.view(np.int64), width // 64, pa.int64())],
                    names=["doc_id", "n_shingles", "d1", "d2", *(f"s{i}" for i in range(SKETCH)), "sketch"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _PROFILE)


def _meetings(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``(key, node)`` for the join keys that two or more entries of ``docs(doc_id, text)`` have."""
    tops, differ = _bands(percent)
    strict = np.where(_cuts(percent)[1] > 0, 0, differ)  # bands with independent cuts have no pieces by the pigeonhole

    def emit(batch: pa.RecordBatch) -> Iterator[Entries]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, offsets, data in arrays.slices(batch.column(1)):
            hashes, text = arrays.shingle_sets(data, offsets, size)
            n = np.bincount(text, minlength=len(offsets) - 1)
            spread = arrays.mix(hashes ^ _ODD)
            band = np.searchsorted(tops, n)
            band[n == 0] = -1
            below = np.where((band > 0) & (n <= tops[np.maximum(band, 1) - 1] * 100 // percent), band - 1, -1)
            found = [f for b in (band, below) for f in (_pieces(spread, text, b, strict), _heavy(spread, text, b, percent))]
            keys, owner = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            order = np.argsort(owner, kind="stable")
            yield keys[order], ids[first + owner[order]], np.zeros(len(order), dtype=np.int64)

    return repeated(docs, emit).select("key", F.col("doc_id").alias("node"))


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """The shingle hashes of every text as one array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in arrays.slices(batch.column(1)):
                rows = len(offsets) - 1
                hashes, text = arrays.shingle_sets(data, offsets, size)
                yield pa.record_batch(
                    [batch.column(0).slice(first, rows), arrays.list_array(hashes.view(np.int64), np.bincount(text, minlength=rows), pa.int64())],
                    names=["doc_id", "members"],
                )

    return docs.mapInArrow(run, "doc_id long, members array<long>")


def _near(percent: int) -> Column:
    """Sizes and sketches of ``a`` and ``b`` allow the similarity."""
    apart = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"a.s{i}").bitwiseXOR(F.col(f"b.s{i}"))) for i in range(SKETCH)))
    na, nb = F.col("a.n_shingles"), F.col("b.n_shingles")
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * apart <= (100 - percent) * (na + nb))


def _near_whole(percent: int) -> Column:
    """The same by the sketches whose length follows the set's; the longer one is folded to the other's length."""

    def fold(own: str, other: str) -> Column:
        half = (F.size(own) / 2).cast("int")
        folded = F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(own) > F.size(other), folded).otherwise(F.col(own))

    bits = F.zip_with(fold("x", "y"), fold("y", "x"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(bits, F.lit(0), lambda s, v: s + v)
    return (100 + percent) * apart <= (100 - percent) * (F.col("nx") + F.col("ny"))


Sets = Callable[[DataFrame], DataFrame]


def _verify(spark: SparkSession, pairs: DataFrame, facts: DataFrame, near: Column, sets: Sets, percent: int, sketches: DataFrame | None) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar enough: by ``near``, by whole sketches, then by the sets themselves."""
    left = (
        pairs.alias("p")
        .join(facts.alias("a"), F.col("p.a") == F.col("a.node"))
        .join(facts.alias("b"), F.col("p.b") == F.col("b.node"))
        .where(near)
        .select("p.a", "p.b")
        .distinct()
    )
    if sketches is not None:
        left = (
            left.join(sketches.select(F.col("node").alias("a"), F.col("n_shingles").alias("nx"), F.col("sketch").alias("x")), "a")
            .join(sketches.select(F.col("node").alias("b"), F.col("n_shingles").alias("ny"), F.col("sketch").alias("y")), "b")
            .where(_near_whole(percent))
            .select("a", "b")
        )
    left = keep(spark, left, "near")
    members = keep(spark, sets(left.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "sets")
    both = (
        left.join(members.select(F.col("node").alias("a"), F.col("members").alias("x")), "a")
        .join(members.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
        .withColumn("common", F.size(F.array_intersect("x", "y")))
        .where(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common")))
    )
    similar = keep(spark, both.select("a", "b").distinct(), "similar")
    drop(spark, left, members)
    return similar


def link(
    spark: SparkSession, met: DataFrame, facts: DataFrame, near: Column, sets: Sets, percent: int, sketches: DataFrame | None = None,
    closer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Components ``(node, component)`` under similarity of the nodes that meet in ``met(key, node)``.

    First each node is compared with one leader per key, by one of ``LEADERS`` orders of the nodes, so a
    group of near copies has few leaders and its members are joined with few comparisons. Then every pair left that shares a key and lies in different
    components is compared; where most nodes of a key are in one component, only the others are. Pairs
    within a component need no comparison, so no link between components is lost.

    ``facts(node, ...)`` has what the condition ``near`` on ``a`` and ``b`` reads; ``sketches(node,
    n_shingles, sketch)``, if given, rule out more pairs before ``sets`` gives the ``members`` of the nodes
    it is handed. ``closer(mixed)``, if given, turns the rows ``(key, node, label, main, ...)`` of keys that stay mixed
    into rows whose keys are members of the sets in one order for all, with the member's place ``at``: similar nodes of
    different components still meet by one, and what is left behind it in both sets bounds what they share.
    """
    mask = F.xxhash64(F.pmod(F.col("key"), F.lit(LEADERS))).bitwiseAND(F.lit((1 << 63) - 1))
    leader = met.groupBy("key").agg(F.min(F.col("node").bitwiseXOR(mask)).alias("a")).withColumn("a", F.col("a").bitwiseXOR(mask))
    pairs = met.join(leader, "key").where("a <> node").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
    similar = _verify(spark, pairs, facts, near, sets, percent, sketches)
    groups = components(spark, similar)

    placed = met.join(groups, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label"))
    placed = keep(spark, placed, "placed")
    sizes = placed.groupBy("key", "label").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("key").agg(F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("labels")).where("labels > 1")
    mixed = mixed.select("key", F.col("top.label").alias("main"))
    fit = near
    if closer is not None:
        far, placed = placed, keep(spark, closer(placed.join(mixed, "key").join(facts, "node")), "closer")
        drop(spark, far)
        mixed = placed.select("key", "main").distinct()
        placed = placed.select("key", "node", "label", "at")
        na, nb = F.col("a.n_shingles"), F.col("b.n_shingles")
        room = F.least(na - F.col("a.at"), nb - F.col("b.at")) + 1
        fit = near & ((100 + percent) * room >= percent * (na + nb))
    # few nodes are outside the main component of a key; only they are brought to the others
    few = placed.alias("p").join(mixed.alias("m"), (F.col("p.key") == F.col("m.key")) & (F.col("p.label") != F.col("m.main")))
    few = keep(spark, few.select("p.*", "m.main").join(facts, "node"), "few")
    met_again = (F.col("a.key") == F.col("b.key")) & (F.col("a.label") != F.col("b.label"))
    once = (F.col("b.label") == F.col("a.main")) | (F.col("a.node") < F.col("b.node"))
    others = (
        few.alias("a").join(placed.join(facts, "node").alias("b"), met_again & once & fit)
        .select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b"))
        .distinct()
        .join(pairs, ["a", "b"], "left_anti")
    )
    more = _verify(spark, others, facts, near, sets, percent, sketches)
    drop(spark, placed, few)
    return groups if more.isEmpty() else components(spark, similar.union(more))


def jaccard_join(spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text, ...)``.

    Two texts are linked when ``100 * common >= percent * union`` over their sets of ``size``-word
    shingles (A-Z lower-cased; a shorter text is one shingle). ``component_id`` is the smallest
    ``doc_id`` that links lead to. Sets are compared by 64-bit hashes of their members, and equal sets
    are found by a 128-bit digest.

    Equal sets are joined first and only the smallest ``doc_id`` of each goes on (``link``).

    Null or blank texts have no shingles and are linked with nothing; a row without ``doc_id`` keeps
    its row with a null component; of repeated ``doc_id`` each row stays and all take part under that
    id; other columns are ignored; empty in, empty out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = keep(spark, profiles(docs, size, percent), "profiles")
    known = table.where("doc_id is not null and n_shingles > 0")
    first = keep(spark, known.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "first")
    own = docs.join(first.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "text")
    met = keep(spark, _meetings(own, size, percent), "met")

    nodes = known.drop("d1", "d2").withColumnRenamed("doc_id", "node")

    def sets(wanted: DataFrame) -> DataFrame:
        own = docs.join(wanted.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
        return _sets(own.select("doc_id", "text"), size).withColumnRenamed("doc_id", "node")

    groups = link(spark, met, nodes.drop("sketch"), _near(percent), sets, percent, nodes.select("node", "n_shingles", "sketch"))
    return (
        table.select("doc_id", "n_shingles", "d1", "d2")
        .join(first, ["d1", "d2"], "left")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNull(), None)
            .when(F.col("n_shingles") == 0, F.col("doc_id"))
            .otherwise(F.coalesce("component", "rep")).alias("component_id"),
        )
    )
