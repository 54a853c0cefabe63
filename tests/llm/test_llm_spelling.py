"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import llm_brute as B
import numpy as np
import pytest
from conftest import SF001

from popcenter.llm import spelling
from popcenter.llm.queries import queries


def distance_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_near(vocabulary):
    """{word: set of near words}, by the words with one code point left out."""
    holes, near = defaultdict(set), defaultdict(set)
    for w in vocabulary:
        for i in range(len(w)):
            holes[i, len(w), w[:i] + w[i + 1:]].add(w)
            if w[:i] + w[i + 1:] in vocabulary:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for some in holes.values():
        for a in some:
            near[a] |= some - {a}
    return near


def brute_variants(vocabulary):
    near, forms = brute_near(vocabulary), {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda v: (-vocabulary[v], v), default=None)
        if best is not None and vocabulary[best] >= 10 * n:
            forms[w] = best
    out = []
    for w, n in vocabulary.items():
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n, len(near[w]), vocabulary.get(forms.get(w))))
    return out


def brute_counts(rows, misspelled=31):
    counts = Counter()
    for d, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            w = B.lower(run)
            h = zlib.crc32(f"{d}:{w}".encode())
            if d is not None and h % misspelled == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def key(r):
    return tuple((x is not None, x) for x in r)


def vocabulary(seed):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 9))) for _ in range(150)}
    words |= {"aaaa" * 3 + "b" * k for k in range(6)} | {"a" * k for k in range(1, 16)} | {"q" * 700, "q" * 701, "q" * 350 + "r" + "q" * 350}
    words |= {rnd.choice("abcdefghijklm") + rnd.choice("xyz") + rnd.choice("stuvw") + "ation" for _ in range(300)}
    words |= {"été" + c for c in "àéîöü"} | {"x\U0001f642y", "x\U0001f643y", "xy", "ÿz", "\U0001f642"}
    return {w: rnd.choice([2, 3, 20, 30, 300, 4000]) for w in words}


@pytest.mark.parametrize("seed,limit,block", [(1, 1024, 1 << 16), (2, 5, 40), (3, 1, 1)])
def test_variants(spark, seed, limit, block):
    words = vocabulary(seed)
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    got = spelling.spelling_variants(table, limit=limit, block=block).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_variants(words), key=key)


@pytest.mark.parametrize("limit", [1024, 3])
def test_each_pair_comes_once(spark, limit):
    words = vocabulary(5)
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    pairs = [(r["word"], r["near"]) for r in spelling.near_words(table, limit).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a, some in brute_near(words).items() for b in some}


def test_long_lists_are_split(spark):
    words = {"".join(p) + "ational": 2 for p in ((a, b, c) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh")}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    lists = spelling.short_lists(table, 30).collect()
    sizes = Counter((r["list"], r["m"], r["p"], r["s"]) for r in lists)
    assert max(n for (_, m, p, s), n in sizes.items() if m - 1 - p - s > 0) <= 30
    assert all(distance_one(a, b) for a, b in [("aaaational", "baaational")])
    pairs = spelling.near_words(table, 30).count()
    assert pairs == 512 * 21


def test_scan_jumps_over_ranges():
    words = sorted("aa" + x + y + "zz" for x in "bcdefghijk" for y in "bcdefghijk")
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.full(len(words), 6)
    q, t = spelling.scan(chars, np.arange(len(words)) * 6, size, np.r_[True, np.zeros(len(words) - 1, bool)], np.arange(len(words)))
    assert {(words[i], words[j]) for i, j in zip(q, t)} == {(a, b) for a in words for b in words if distance_one(a, b)}


def test_odd_texts(spark):
    rnd = random.Random(2)
    pool = ["Letters", "letters", "lettersX", "LETTERÀ", "letterà", "Straße", "straßenbahn", "ÀÉÎÕÜÝŸ", "a×b÷cdefg", "short", "x" * 4000]
    texts = [None, "", "12 34", "letters_letters-LETTERS", "abĀcdefghi"] + [" ".join(rnd.choices(pool, k=60)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(None, texts[-1]), (7, texts[-1]), (7, texts[-1])]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, word int").repartition(3)
    got = dict(map(tuple, spelling.word_counts(docs, misspelled=31).collect()))
    assert got == brute_counts(rows)
    plain = dict(map(tuple, spelling.word_counts(docs).collect()))
    assert plain == brute_counts([(None, t) for _, t in rows])
    assert spelling.spelling_variants(spelling.word_counts(docs.limit(0))).collect() == []


def test_op11(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = queries()["op11_spelling"](spark, SF001).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_variants(brute_counts(rows)), key=key)
