"""Periodic run detection with string synchronising sets.

A run of a text is a maximal stretch of consecutive words with smallest period q (words q apart are
equal) of at least 3 q words. All runs are found, in any text, without trying periods:

* For each dyadic scale t = 1, 2, 4, ... every t-word window has an identity, a hash built from the two
  halves' identities by a mixing step (not a polynomial, so no text is bad for it). The
  synchronising set has the places i where the least identity of the windows starting at i to i + t is that at i or
  at i + t; windows of period t/3 or less take no part. Membership depends on the 2 t words from i alone, so it
  repeats with every period, and any t places in a row hold a member unless the text there has a period of at
  most t/3 (Kempa and Kociumaka, "String synchronizing sets").
* Two members with equal 2 t-word contexts propose their distance as a period. Scale t looks for q from
  2 t - 1 to 4 t - 2. A run of such a period has at least 2 q places whose context lies inside it; they hold a member x (else the
  whole run had a period of at most t/3) and, as members repeat, x and x + q: each run is proposed. The pairs of
  a run are at most q apart and reach within 2 q of both of its ends.
* The pairs of one period are joined where they are at most q apart. For each such cluster the words of its stretch and of a
  margin are compared with those q further on: exactly, so only real, maximal runs come out.
* Runs of small period are what the next scales leave out: the highly periodic windows of scale t are those
  inside runs with q <= t/3, all found at smaller scales.
* A stretch that repeats with q also repeats with 2 q, 3 q, ...; of equal stretches the least period stays.

The work on a text of n words is n log n array steps, for a slice of many texts at once
(``SLICE_BYTES``; a separator that equals nothing ends each text). Texts too short for a scale drop
out of it. A text is judged within its row: no shuffle, no state, and a lost task is simply run again. Memory is that of a slice,
or about 150 bytes per word of one longer text.

Results in special cases: null and empty texts have no words, no runs and an empty collapsed text (null stays
null); one word repeated is a run of period 1; repeated rows are judged alike; an empty table
gives an empty result; columns whose name the operator adds give way, all others are handed on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from popcenter.llm.common import WORD, keep_columns, let, read, words
from popcenter.llm.text import SLICE_BYTES, U, list_array, mix, ranges

MIN_WORDS = 24
MIN_EXPONENT = 3
_NONE = np.uint64(2**64 - 1)
_A, _B = U(0x9E3779B97F4A7C15), U(0xD1B54A32D192ED03)


def _ahead(a: np.ndarray, by: int, fill) -> np.ndarray:
    """a[i + by], ``fill`` beyond the end."""
    out = np.full(len(a), fill, a.dtype)
    if by < len(a):
        out[:len(a) - by] = a[by:]
    return out


def _window_minima(x: np.ndarray, t: int) -> np.ndarray:
    """min(x[i], ..., x[i + t]) for a power of two t."""
    low, step = x, 1
    while step < t:
        low = np.minimum(low, _ahead(low, step, _NONE))
        step *= 2
    return np.minimum(low, _ahead(x, t, _NONE))


def _proposals(members: np.ndarray, context: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of members with equal contexts from 2 t - 1 to 4 t - 2 words apart."""
    same = context[members]
    first, k, at, by = np.arange(len(members)), 1, [], []
    while True:  # the k-th next member, for those that have it near enough
        first = first[:np.searchsorted(first, len(members) - k)]
        gap = members[first + k] - members[first]
        first, gap = first[gap <= 4 * t - 2], gap[gap <= 4 * t - 2]
        if not len(first):
            break
        good = (gap >= 2 * t - 1) & (same[first] == same[first + k])
        at.append(members[first[good]])
        by.append(gap[good])
        k += 1
    return (np.concatenate(at), np.concatenate(by)) if at else (np.empty(0, np.int64), np.empty(0, np.int64))


def _stretches(word: np.ndarray, at: np.ndarray, by: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, period) of the maximal stretches around the proposals, of 3 periods or more."""
    order = np.lexsort((at, by))
    at, by = at[order], by[order]
    first = np.flatnonzero(np.r_[True, (by[1:] != by[:-1]) | (at[1:] - at[:-1] > by[1:])])
    last = np.r_[first[1:], len(at)] - 1
    q = by[first]
    lo = np.maximum(at[first] - q - 1, 0)
    hi = np.minimum(at[last] + 2 * t + q + 1, len(word) - q)
    count = hi - lo
    places, period = ranges(lo, count), np.repeat(q, count)
    equal = word[places] == word[places + period]
    border = np.zeros(len(places) + 1, bool)
    border[np.cumsum(count)] = True
    border[0] = True
    begin = np.flatnonzero(equal & (border[:-1] | ~np.r_[False, equal[:-1]]))
    end = np.flatnonzero(equal & (border[1:] | ~np.r_[equal[1:], False]))
    long = end - begin + 1 >= 2 * period[begin]
    begin, end = begin[long], end[long]
    return places[begin], places[end] + 1 + period[begin], period[begin]


def find_runs(ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period, of texts given as word
    numbers (0 and up) and the offsets of the texts."""
    sizes = np.diff(offs)
    heads = offs[:-1] + np.arange(len(sizes))  # a separator follows each text
    word = np.empty(len(ids) + len(sizes), np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes + 1)
    inside = np.ones(len(word), bool)
    inside[heads + sizes] = False
    word[inside], word[~inside] = ids, -1 - np.arange(len(sizes))
    whole, place = word, np.arange(len(word))
    identity = mix(word.astype(U) * _A + _B)
    found: list[tuple] = []
    t = 1
    while True:
        stay = sizes[text] >= 3 * (2 * t - 1)
        if not stay.all():
            word, place, text, identity = word[stay], place[stay], text[stay], identity[stay]
        if not len(word):
            break
        ends = mix(place.astype(U) * _B + U(t))  # windows beyond the end equal nothing
        context = identity * _A + np.where(np.arange(len(word)) + t < len(word), _ahead(identity, t, 0), ends)
        context = mix(mix(context) + U(t))
        marks = identity.copy()
        for b, e, q in found:
            some = (3 * q <= t) & (e - b >= t)
            if some.any():
                b, e = b[some], e[some]
                at = np.searchsorted(place, b)
                here = (at < len(place)) & (place[np.minimum(at, len(place) - 1)] == b)
                marks[ranges(at[here], (e - b)[here] - t + 1)] = _NONE
        least = _window_minima(marks, t)
        member = (least != _NONE) & ((least == marks) | (least == _ahead(marks, t, _NONE)))
        at, by = _proposals(np.flatnonzero(member), context, t)
        if len(at):
            b, e, q = _stretches(word, at, by, t)
            found.append((place[b], place[b] + (e - b), q))
        identity = context
        t *= 2
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    b, e, q = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((q, e, b))
    b, e, q = b[order], e[order], q[order]
    new = np.r_[True, (b[1:] != b[:-1]) | (e[1:] != e[:-1])] if len(b) else np.empty(0, bool)
    b, e, q = b[new], e[new], q[new]
    doc = np.searchsorted(heads, b, "right") - 1
    order = np.lexsort((q, b, doc))
    assert not len(b) or (whole[b] >= 0).all()
    return doc[order], (b - heads[doc])[order], (e - b)[order], q[order]


def _slices(texts: list) -> Iterator[tuple[int, int]]:
    i, size = 0, 0
    for j, t in enumerate(texts):
        if j > i and size + len(t or "") > SLICE_BYTES:
            yield i, j
            i, size = j, 0
        size += len(t or "")
    if i < len(texts):
        yield i, len(texts)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _runs_udf(min_words: int, min_exponent: int):
    @arrow_udf("struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>")
    def runs(col: pa.Array) -> pa.Array:
        find = re.compile(WORD).finditer
        texts = col.to_pylist()
        counts, n_runs, parts, collapsed = [], [], [], []
        for i, j in _slices(texts):
            known: dict[str, int] = {}
            number = [np.fromiter((known.setdefault(m[0], len(known)) for m in find(t or "")), np.int64) for t in texts[i:j]]
            sizes = np.array([len(x) for x in number])
            offs = np.r_[0, np.cumsum(sizes)]
            doc, start, length, period = find_runs(np.concatenate(number), offs)
            long = length >= np.maximum(min_words, min_exponent * period)
            doc, start, length, period = doc[long], start[long], length[long], period[long]
            change = np.zeros(offs[-1] + 1, np.int64)
            np.add.at(change, offs[doc] + start + period, 1)
            np.add.at(change, offs[doc] + start + length, -1)
            stay = np.cumsum(change)[:-1] == 0
            spelled = list(known)
            for k, x in enumerate(number):
                left = x[stay[offs[k]:offs[k + 1]]]
                collapsed.append(None if texts[i + k] is None else " ".join(map(spelled.__getitem__, left.tolist())))
            counts.append(sizes)
            n_runs.append(np.bincount(doc, minlength=j - i))
            parts.append((start, length, period))
        if not texts:
            counts, n_runs, parts = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [(np.empty(0, np.int64),) * 3]
        values = pa.StructArray.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)], fields=list(_RUN))
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(counts).astype(np.int64)), list_array(values, np.concatenate(n_runs)),
             pa.array(collapsed, pa.string())], ["n_words", "runs", "collapsed"])

    return runs


def periodic_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """The documents with ``n_words``, ``runs`` (array of start, length, period, by start and
    period; those of at least ``min_words`` words and ``min_exponent`` periods) and ``collapsed_text``: the
    words of the text without any that lies in a run after the run's first period, joined by one space."""
    if min_exponent < 3:
        raise ValueError(f"min_exponent must be >= 3, got {min_exponent}")
    found = docs.select(*keep_columns(docs, "n_words", "runs", "collapsed_text", "_runs"),
                        _runs_udf(min_words, min_exponent)(F.col(text)).alias("_runs"))
    return found.select("*", F.col("_runs.n_words").alias("n_words"), F.col("_runs.runs").alias("runs"),
                        F.col("_runs.collapsed").alias("collapsed_text")).drop("_runs")


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly (ties: least start, then period)."""
    def order(x, y):
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(a != b, F.when(a > b, -1).otherwise(1)).when(
            x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)).otherwise(
            F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))
    return F.get(F.array_sort(runs, order), F.lit(0))


def looped(doc_id: Column, text: Column) -> Column:
    """The text in which, for every tenth document by the CRC-32 of its id, the words from one place
    on repeat the words that follow it. A null id changes nothing."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def loop(w):
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        turns = F.ceil((n - a) / p).cast("int")
        part = F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), turns))
        return F.array_join(F.concat(F.slice(w, 1, a.cast("int")), F.slice(part, 1, (n - a).cast("int"))), " ")

    return F.when(h % 10 == 0, let(words(text), lambda w: F.when(F.size(w) > 0, loop(w)))).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listing = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return periodic_runs(docs).withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
        F.call_function("div", 1000 * best["length"], best["period"]).alias("exponent_milli"),
        sha(listing).alias("runs_sha256"), sha(F.coalesce("collapsed_text", F.lit(""))).alias("collapsed_sha256"), "n_words")
