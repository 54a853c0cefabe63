"""Periodic runs against plain Python."""

import hashlib
import random
import zlib

import llm_brute as B
import numpy as np
import pytest
from conftest import SF001

from popcenter.llm import periods
from popcenter.llm.queries import queries


def smallest_period(w):
    fail = [0] * (len(w) + 1)
    fail[0] = -1
    for i in range(len(w)):
        k = fail[i]
        while k >= 0 and w[k] != w[i]:
            k = fail[k]
        fail[i + 1] = k + 1
    return len(w) - fail[len(w)]


def brute_runs(w, min_words=0):
    """All (start, length, period): every period, every maximal stretch."""
    w, out = np.asarray(w), []
    for q in range(1, len(w) // 3 + 1):
        eq = np.r_[False, w[:-q] == w[q:], False]
        b, e = np.flatnonzero(eq[1:] & ~eq[:-1]), np.flatnonzero(~eq[1:] & eq[:-1])
        for x, y in zip(b, e):
            if y - x >= 2 * q and y - x + q >= min_words and smallest_period(w[x:y + q].tolist()) == q:
                out.append((int(x), int(y - x + q), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def strings():
    rnd = random.Random(7)
    out = [[], [0], [0] * 3, [0] * 50, [0, 1] * 30, [0, 0, 1] * 20 + [0], list(range(60)),
           [bin(i).count("1") % 2 for i in range(3000)]]  # Thue-Morse
    fib = [0]
    other = [1]
    for _ in range(13):
        fib, other = fib + other, fib
    out.append(fib)
    for k in range(150):
        sigma, n = rnd.choice([1, 2, 3, 50]), rnd.randrange(1, 200)
        out.append([rnd.randrange(sigma) for _ in range(n)])
    for k in range(200):  # nested and neighbouring loops
        w = [rnd.randrange(rnd.choice([2, 5, 100])) for _ in range(rnd.randrange(1, 12))]
        for _ in range(rnd.randrange(1, 5)):
            part = w[rnd.randrange(len(w)):] if rnd.random() < 0.5 else [rnd.randrange(3) for _ in range(rnd.randrange(1, 40))]
            w = w + part * rnd.randrange(1, 7) + [rnd.randrange(100) for _ in range(rnd.randrange(4))]
            w = w[:3000]
        out.append(w)
    return out


@pytest.mark.parametrize("together", [True, False])
def test_find_runs(together):
    texts = strings()
    groups = [texts] if together else [[t] for t in texts]
    got = []
    for g in groups:
        doc, start, length, period = periods.find_runs(
            np.array([x for t in g for x in t], np.int64), np.r_[0, np.cumsum([len(t) for t in g])].astype(int))
        by = [[] for _ in g]
        for d, *run in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist()):
            by[d].append(tuple(run))
        got += by
    for t, runs in zip(texts, got):
        assert runs == brute_runs(t), t


def expected(doc_id, text, loop=True):
    w = B.SPACE_WORD.findall(text or "")
    if loop and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    number = {}
    runs = [r for r in brute_runs([number.setdefault(x, len(number)) for x in w], 24) if r[1] >= 24]
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)), len(w))


def key(r):
    return tuple((x is not None, x) for x in r)


def test_op13(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = queries()["op13_periodic_runs"](spark, SF001).collect()
    want = [expected(r["doc_id"], r["text"]) for r in docs]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in want) >= len(want) // 20  # the looped tenth, but for the shortest


def test_odd_rows(spark, tmp_path):
    rnd = random.Random(3)
    loop = " ".join(f"w{rnd.randrange(5)}" for _ in range(7))
    texts = [None, "", " \t\n", "a", "a " * 24, "a " * 23, " ".join([loop] * 4), " ".join([loop] * 400) + " x",
             "ä \U0001f642 " * 30, "b\x0bc\x1c " * 20, " ".join(f"v{rnd.randrange(50)}" for _ in range(2000)), "x" * 5000]
    rows = [(k * 7, t) for k, t in enumerate(texts)] + [(None, "a " * 30), (None, None), (0, None), (28, "a " * 24), (28, "a " * 24)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=key) == sorted([expected(*r) for r in rows], key=key)


def test_operator_hands_columns_on(spark):
    docs = spark.createDataFrame([("a b " * 20 + "c", 1, 2, 3)], "text string, Runs int, `_runs` int, `n.x` int")
    out = periods.periodic_runs(docs)
    assert out.columns == ["text", "n.x", "n_words", "runs", "collapsed_text"]
    row = out.first()
    assert row["collapsed_text"] == "a b c" and [tuple(r) for r in row["runs"]] == [(0, 40, 2)]
    assert periods.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periods.periodic_runs(docs, min_exponent=2)
