"""Quality rules: counts of words, symbols and repeats, and divergence from language references.

A document's histograms of character classes and of common words are compared with the mean
histograms of its language by the Jensen-Shannon distance (root of the divergence in bits, 0 to 1).
Short documents are exempt: their histograms say little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import arrays
from tallgrass.llm.graph import keep

SYMBOLS = b"#*$%&|<>"
CLASSES = 8  # lower, upper, digit, blank, sentence marks, symbols, other ASCII, letters outside ASCII
# fixed values: common words of English, German, French and Spanish
COMMON = (
    "the of and to in a is that for it was on are as with at by from or this be an not "
    "der die und den von das mit sich des auf ist im dem nicht ein eine auch als zu für "
    "le la les et des en du que une dans qui est par pour au sur pas un plus de "
    "el los las del se una con por para su al lo como más que y no"
).split()
COMMON = list(dict.fromkeys(COMMON))

_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in _COLUMNS) + ", classes array<int>, common array<int>"


def _classes() -> np.ndarray:
    kind = np.full(256, 6, dtype=np.int64)
    kind[0x80:] = 7
    for number, group in enumerate((range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), b" \t\n\r\x0b\x0c", b".,;:!?'\"()-", SYMBOLS)):
        kind[list(group)] = number
    kind[0x80:0xC0] = -1  # later bytes of a character
    return kind


_CLASS = _classes()
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_LATER = (np.arange(256) & 0xC0) == 0x80


def _vocabulary() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the common words in rising order, with their numbers."""
    raw = [w.encode() for w in COMMON]
    ends = np.cumsum([len(r) for r in raw])
    hashes = arrays.hash_spans(np.frombuffer(b"".join(raw), dtype=np.uint8), np.r_[0, ends[:-1]], ends)
    order = np.argsort(hashes)
    return hashes[order], order


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    return np.diff(np.r_[0, np.cumsum(flags)][offsets])


def _again(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by text and hash, and the length of the run of equals each place of that order is in."""
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    h, t = hashes[order], text[order]
    starts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])]) if len(h) else np.empty(0, dtype=np.int64)
    sizes = np.diff(np.r_[starts, len(h)])
    return order, np.repeat(sizes, sizes)


def _measure(data: np.ndarray, offsets: np.ndarray, names: np.ndarray, numbers: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    rows = len(offsets) - 1
    starts, ends, text = arrays.words(data, offsets)
    n = np.bincount(text, minlength=rows)
    inside = ~arrays.SPACE[data]
    chars = _sums(inside & ~_LATER[data], offsets)
    symbols = _sums(_SYMBOL[data], offsets)

    # lines
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    breaks = np.flatnonzero(data == 0x0A)
    left = np.unique(np.r_[offsets[:-1][np.diff(offsets) > 0], (breaks + 1)[~border[breaks + 1]]])
    line_text = np.searchsorted(offsets, left, side="right") - 1
    right = np.minimum(np.r_[breaks, len(data)][np.searchsorted(breaks, left)], offsets[line_text + 1])
    filled = np.r_[0, np.cumsum(inside)]
    worded = filled[right] > filled[left]
    left, right, line_text = left[worded], right[worded], line_text[worded]
    lines = arrays.hash_spans(data, left, right)
    _, first = arrays.distinct(lines, line_text)
    dup = np.bincount(line_text, minlength=rows) - np.bincount(first, minlength=rows)

    # words in windows of three that occur twice or more
    hashes = arrays.hash_spans(data, starts, ends)
    repeat = np.zeros(rows, dtype=np.int64)
    if len(hashes) >= 3:
        whole = np.flatnonzero(text[2:] == text[:-2])
        window = arrays.mix(hashes[whole] * np.uint64(3) + arrays.mix(hashes[whole + 1]) * np.uint64(5) + arrays.mix(hashes[whole + 2] ^ np.uint64(7)))
        order, size = _again(window, text[whole])
        hit = whole[order[size > 1]]
        covered = np.zeros(len(hashes) + 3, dtype=bool)
        for i in range(3):
            covered[hit + i] = True
        repeat = np.bincount(text, weights=covered[: len(hashes)], minlength=rows).astype(np.int64)

    kind = _CLASS[data]
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    seen = kind >= 0
    classes = np.bincount(owner[seen] * CLASSES + kind[seen], minlength=rows * CLASSES).reshape(rows, CLASSES)
    low = arrays.hash_spans(arrays.LOWER[data], starts, ends)
    at = np.minimum(np.searchsorted(names, low), len(names) - 1)
    known = names[at] == low
    width = len(names) + 1
    common = np.bincount(text * width + np.where(known, numbers[at], width - 1), minlength=rows * width).reshape(rows, width)
    return [n, chars, symbols, dup, repeat], classes, common


def measures(docs: DataFrame) -> DataFrame:
    """Counts and histograms of every text, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, numbers = _vocabulary()
        for batch in batches:
            for first, offsets, data in arrays.slices(batch.column(2)):
                rows = len(offsets) - 1
                counts, classes, common = _measure(data, offsets, names, numbers)
                yield pa.record_batch(
                    [batch.column(0).slice(first, rows), batch.column(1).slice(first, rows)]
                    + [pa.array(c.astype(np.int64)) for c in counts]
                    + [arrays.list_array(h.ravel(), np.full(rows, h.shape[1]), pa.int32()) for h in (classes, common)],
                    names=["doc_id", "lang", *_COLUMNS, "classes", "common"],
                )

    return docs.mapInArrow(run, _SCHEMA)


def _shares(counts: str, total: str) -> Column:
    return F.transform(counts, lambda c: c / F.greatest(F.col(total), F.lit(1)))


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares."""

    def term(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    total = F.aggregate(F.zip_with(p, q, lambda x, y: term(x, y) + term(y, x)), F.lit(0.0), lambda s, v: s + v)
    return F.sqrt(F.greatest(total, F.lit(0.0)) / 2)


def quality_rules(
    spark: SparkSession,
    docs: DataFrame,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    guard_chars: int = 400,
    guard_words: int = 100,
    max_classes: float = 0.3,
    max_common: float = 0.22,
    common_noise: float = 0.6,
) -> DataFrame:
    """Counts, divergences and verdict for every row of ``docs(doc_id, text, lang, ...)``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` percent of
    the words in repeated windows of three. Otherwise a document is kept unless ``js_classes`` is over
    ``max_classes`` (documents of ``guard_chars`` characters or more) or ``js_common`` over
    ``max_common + common_noise / sqrt(n_words)`` (``guard_words`` words or more): even a clean text's
    distance falls with the root of its length, while that of a text without common words stays near
    the root of half their share (about 0.34 at a fifth). The limits are fitted on labels. References are means over all documents of a
    language that pass the base rules, each document counting once, so one hot source of long texts
    does not set them; documents without a language are a language of their own.

    Null and empty texts count nothing and fail the base rules. Null ``doc_id``, repeated rows and
    other columns do no harm: each row is judged by itself. A language whose documents all fail has no
    reference, and nothing is compared. Empty in, empty out.
    """
    kinds = dict(docs.dtypes)
    lang = F.col("lang").cast("string") if "lang" in kinds else F.lit(None).cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.col("text").cast("string").alias("text"))
    table = keep(spark, measures(docs), "measures").withColumn("lang", F.coalesce("lang", F.lit("")))
    table = (
        table.withColumn("n_chars", F.aggregate("classes", F.lit(0).cast("long"), lambda s, v: s + v))
        .withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
        .withColumn("classes", _shares("classes", "n_chars"))
        .withColumn("common", _shares("common", "n_words"))
    )
    sizes = {"classes": CLASSES, "common": len(COMMON) + 1}
    means = (
        table.where("not base_failed").groupBy("lang")
        .agg(*[F.avg(F.col(c)[i]).alias(f"{c}_{i}") for c, size in sizes.items() for i in range(size)])
        .select("lang", *[F.array(*[f"{c}_{i}" for i in range(size)]).alias(f"ref_{c}") for c, size in sizes.items()])
    )
    judged = table.join(means, "lang", "left").select(
        "doc_id", *_COLUMNS, "base_failed", "n_chars",
        F.coalesce(_distance(F.col("classes"), F.col("ref_classes")), F.lit(0.0)).alias("js_classes"),
        F.coalesce(_distance(F.col("common"), F.col("ref_common")), F.lit(0.0)).alias("js_common"),
    )
    odd = ((F.col("n_chars") >= guard_chars) & (F.col("js_classes") > max_classes)) | (
        (F.col("n_words") >= guard_words) & (F.col("js_common") > max_common + common_noise / F.sqrt("n_words"))
    )
    return judged.withColumn("kept", ~(F.col("base_failed") | odd)).drop("n_chars")
