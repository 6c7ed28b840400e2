"""What the slices of op9 ask the parts for, in a filter that is not broadcast."""

import zlib

import numpy as np

from tallgrass.llm import arrays, lm_score


def test_keys_come_back():
    keys = np.unique(np.random.default_rng(4).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    for some in (keys, keys[:1], keys[:0]):
        assert (lm_score._unpack_keys(lm_score._pack_keys(some)) == some).all()
    short = np.unique(keys >> np.uint64(lm_score.SHORT))
    assert len(lm_score._pack_keys(short)) < 5 * len(short)  # 8 bytes each before


def test_both_ways_agree_over_many_slices(spark, monkeypatch):
    """Repeated rows, slices of the same content, and a slice for each few texts."""
    monkeypatch.setattr(arrays, "SLICE", 1 << 9)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 40) % 500) for _ in range(60)]
    rows = [(i % 50, t) for i, t in enumerate(texts)] * 2 + [(None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, other = (
        sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in df.collect())
        for df in (lm_score.lm_score(spark, docs), lm_score.lm_score(spark, docs, max_bits=64))
    )
    assert one == other and len(one) == len(rows)
    assert all(h == (zlib.crc32((i if i != "None" else "").encode()) % 7 == 2) for i, h, *_ in one)
