"""op7 against a regression in plain Python."""

import hashlib
import random
import zlib

import llm_brute
import pytest

from popcenter.llm import quality


def test_scores_against_plain_python(spark):
    rnd = random.Random(6)
    good, bad = ["tree", "river", "stone", "ünder", "the", "and"], ["buy", "click", "now!", "the", "$$", "and"]
    rows = [(k, " ".join(rnd.choice(good if k % 2 else bad) for _ in range(rnd.randrange(1, 30)))) for k in range(120)]
    texts = rows + [(500, ""), (501, None), (502, "unseen words"), (503, "now now now"), (504, "tree,tree, buy")]
    label = {k: k % 2 for k, _ in rows}
    label[7] = 0  # one wrong label
    labels = spark.createDataFrame([(k, y, 0) for k, y in label.items()] + [(900, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = quality.train(docs, labels, shards=1, bits=21)
    got = {r[0]: r[1] for r in docs.select("doc_id", quality.scorer(model, bits=21)("text")).collect()}

    order = lambda k: int(hashlib.md5(f"5|{k}".encode()).hexdigest()[:13], 16)
    learnt = sorted((r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1), key=lambda r: order(r[0]))
    assert 0 < len(learnt) < len(rows)
    want = llm_brute.quality_scores([(t, label[k]) for k, t in learnt], [t for _, t in texts], quality.EPOCHS, quality.ALPHA,
                                    quality.BETA, quality.L1, quality.L2)
    assert len(got) == len(texts)
    for (k, _), score in zip(texts, want):
        assert got[k] == pytest.approx(score, abs=1e-6)
