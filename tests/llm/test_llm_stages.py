"""Pipeline stages against plain Python."""

import random

import llm_brute
import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from popcenter.llm import mixing, neardup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_dedup_stage_links_at_080(spark):
    rnd = random.Random(12)
    rows, kept = [], set()
    for k in range(40):
        words = [f"v{rnd.randrange(100000)}" for _ in range(204)]
        near = list(words)  # 200 shingles; n words far apart change 5 n of them
        for i in range(k % 5):
            near[20 + 40 * i] = f"new{k}-{i}"
        jaccard = (200 - 5 * (k % 5)) / (200 + 5 * (k % 5))  # 1, 0.95, 0.905, 0.860, 0.818
        assert jaccard >= 0.8
        far = list(words)
        for i in range(5):
            far[10 + 40 * i] = f"far{k}-{i}"
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(near))]
        kept.add(3 * k)
        if k % 5 == 0:  # its one neighbour is at 0.778
            rows.append((3 * k + 2, " ".join(far)))
            kept.add(3 * k + 2)
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], SCHEMA).repartition(5)
    got = [r["doc_id"] for r in neardup.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got) == sorted(kept)
    # the query's own contract stays at 0.85
    assert {r["doc_id"] for r in neardup.near_duplicates(docs).where("kept").collect()} == kept | {3 * k + 1 for k in range(4, 40, 5)}


def test_dedup_stage_keeps_one_row_of_a_component(spark):
    rnd = random.Random(5)
    prose = lambda n: " ".join(f"u{rnd.randrange(9000)}" for _ in range(n))
    base, lone = prose(120), prose(80)
    rows = [(1, base), (1, base), (1, base + " more"), (None, base), (2, base), (None, lone), (None, lone), (None, lone.upper()),
            (5, ""), (5, ""), (None, None), (6, " \t"), (7, prose(60))]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA).repartition(4)
    got = [(r["doc_id"], r["text"]) for r in neardup.drop_near_duplicates(spark, docs, "").collect()]
    near = [g for g in got if (g[1] or "").startswith(base[:60])]
    assert len(near) == 1 and near[0][0] == 1
    assert sum((g[1] or "").lower() == lone for g in got) == 1
    rest = [g for g in got if g not in near and (g[1] or "").lower() != lone]
    assert sorted(rest, key=repr) == sorted([(5, ""), (5, ""), (None, None), (6, " \t"), rows[-1]], key=repr)


@pytest.mark.parametrize("weights", [[0.01], [0.1], [0.5], [2], [50], [0.01, 50], [0.5, 1, 2]])
def test_mixing_cells_are_even_for_any_weights(spark, weights):
    n = 200_000
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("id"), F.lit(len(weights))).cast("int"))
    rows = spark.range(n).select((-F.log(mixing.unit(11, F.col("id"))) / w).alias("key"))
    cells = mixing.cells_by_rank(rows).groupBy("cell").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    got = sorted(cells.collect(), key=lambda r: r["cell"])
    assert len(got) > mixing.cell_count(n) / 2
    assert max(r["n"] for r in got) <= 4 * n / len(got)
    assert all(a["hi"] <= b["lo"] for a, b in zip(got, got[1:]))  # cells follow the keys


def test_many_mixing_cells(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BORDERS", 20)
    monkeypatch.setattr(mixing, "cell_count", lambda n: 100)
    rows = spark.range(50_000).select((-F.log(mixing.unit(11, F.col("id"))) / F.when(F.col("id") % 2 == 0, 0.01).otherwise(50.0)).alias("key"))
    got = sorted(mixing.cells_by_rank(rows).groupBy("cell").agg(
        F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect(), key=lambda r: r["cell"])
    assert len(got) >= 80 and max(r["n"] for r in got) <= 4 * 50_000 / len(got)
    assert all(a["hi"] <= b["lo"] for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("block", [7, 4096])
def test_ties_within_shared_band_values(spark, block):
    """All classes share band values with a stranger that is the smallest of them: families are tied all the same,
    strangers and families among each other are not, and no tie is weaker than asked."""
    rng = np.random.default_rng(7)
    bins, need, sketch, family, hi = 360, 270, {}, {}, 0
    for f, size in enumerate([1, 40, 25, 1, 1, 3]):
        base = rng.integers(0, 256, bins)
        for _ in range(size):
            s = base.copy()
            s[rng.choice(bins, 18, replace=False)] = rng.integers(0, 256, 18)
            sketch[hi], family[hi] = s.astype(np.uint8), f
            hi += 1
    rows = [(h, 0, [5, 6] if h % 2 else [5, 6, 7], bytearray(s.tobytes())) for h, s in sketch.items()]
    rows += [(1000, 0, [99], bytearray(bytes(bins)))]
    full = spark.createDataFrame(rows + rows[:9], "hi long, lo long, bands array<long>, sketch binary")
    ties = neardup.candidate_ties(full, need, block).collect()
    assert all((sketch[t["hi"]] == sketch[t["hub"]]).sum() >= need for t in ties)
    root = {h: h for h in sketch}
    for t in ties:
        a, b = root[t["hi"]], root[t["hub"]]
        root = {h: a if r == b else r for h, r in root.items()}
    assert {(h, g) for h in root for g in root if root[h] == root[g]} == {(h, g) for h in family for g in family if family[h] == family[g]}


def test_chains_of_weak_likeness_fall_apart(spark):
    """300 texts, each about 0.7 like the next one: few of these pairs become ties, so no cluster of all of them has to be
    compared; 40 copies with one changed word each are one component."""
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(300 * 35 + 400)]
    rows = [(k, " ".join(words[35 * k:35 * k + 200])) for k in range(300)]
    base = [f"c{k}" for k in range(200)]
    rows += [(1000 + k, " ".join(base[:4 * k] + [f"x{k}"] + base[4 * k + 1:])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("s", neardup.signer()("text"))
    ties = neardup.candidate_ties(docs.select("doc_id", "s.*"), 270)
    near = docs.select("doc_id", "s.hi").join(ties, "hi").where("doc_id < 1000")
    assert near.count() <= 40
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs.drop("s")).collect()}
    assert got == {**{k: k for k in range(300)}, **{1000 + k: 1000 for k in range(40)}}


def test_stage_threshold_against_brute_force(spark):
    """Components at 0.80 on all documents of sf0.001 are those of comparing every pair."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = neardup.near_duplicates(docs, neardup.STAGE_LINK, neardup.STAGE_BANDS, neardup.STAGE_ROWS)
    got = sorted((r["doc_id"], r["component_id"]) for r in out.collect())
    assert got == sorted((d, c) for d, _, c, _ in llm_brute.near_duplicates([(r["doc_id"], r["text"]) for r in docs.collect()], 80))
