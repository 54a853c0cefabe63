"""Benchmark decontamination with training suffix arrays.

Every task gathers its documents into shards of as many bytes as the benchmark has, at least ``SHARD_BYTES`` and at most
``LARGEST_SHARD`` (a longer document is a shard of its own) and builds a word suffix array of each: ranks of single words, then of 3, 9 and 27
words (2, 4, 8, 16 where a shard is too long for three ranks in 64 bits) by sorting, never across
the end of a document. Every suffix of the benchmark is looked up in every shard's array by
binary search; the entries that agree in the first ``WINDOW`` words are its verbatim matches.
Matches that follow one another on a diagonal are joined to longest matches with their
locations in the item and in the document.

An item of at least ``WINDOW`` words has its suffixes of that many words or more looked up; a
shorter one is looked up whole. Words are lower-cased (A-Z) runs of letters, digits and
non-ASCII characters; two words are equal if their 64-bit hashes are.

How it scales: the documents are read once and not shuffled. The benchmark is sent to the
tasks in blocks of ``BLOCK_BYTES`` of text, one broadcast each, and a shard's suffix array is
searched with one block after the other, so neither the driver nor a task holds more than one
block. A task prepares a single block once, several blocks once for every shard. The work is that of sorting the corpus
within shards plus one search of the benchmark, a logarithm of a shard per suffix, for each shard: with shards as large as
the benchmark that is in proportion to the corpus, beyond ``LARGEST_SHARD`` it is (corpus / LARGEST_SHARD) * benchmark.
A shard takes about 25 times its bytes of memory, so larger executors may take larger shards. Smaller ones sort faster (they
fit the processor's caches), hence no larger than needed.

Results in special cases: a null or empty text has no words and matches nothing; items without
words are never found; a null item_id is reported as an empty string; repeated items count as
one in the list of items; an empty benchmark or table gives no match or no row.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from popcenter.llm.common import read
from popcenter.llm.text import buffer, letters, list_array, load, lower, ranges, slices, word_hashes, word_spans

WINDOW = 10
BLOCK_BYTES = 8 << 20
SHARD_BYTES, LARGEST_SHARD = 2 << 20, 16 << 20
FOUND = ("struct<n_words:bigint,n_hit:bigint,"
         "matches:array<struct<item:string,item_start:int,doc_start:int,n_words:int>>>")


def corpus_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and the number of each document's first word."""
    low = lower(buf)
    starts, ends, first = word_spans(low, offs, letters())
    return word_hashes(low, starts, ends), first


class SuffixArray:
    """Word suffixes of a shard in order; a document's end sorts before every word."""

    def __init__(self, words: np.ndarray, first: np.ndarray, depth: int = WINDOW):
        self.vocabulary, rank = np.unique(words, return_inverse=True)
        self.words = rank = rank.astype(np.int64) + 1
        n = len(words)
        self.end = np.repeat(first[1:], np.diff(first))
        place, length = np.arange(n), 1
        while length < depth:
            m = int(rank.max(initial=0)) + 1
            key, step = rank, 3 if m < 1 << 21 else 2
            for k in range(1, step):
                at = place + k * length
                key = key * m + np.where(at < self.end, rank[np.minimum(at, max(n - 1, 0))], 0)
            length *= step
            order = np.argsort(key, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate([[1], (np.diff(key[order]) != 0).astype(np.int64)]))[:n]
            rank = new
        self.order = order if depth > 1 else np.argsort(rank, kind="stable")

    def translate(self, words: np.ndarray) -> np.ndarray:
        """The shard's rank of each word, 0 for a word that it lacks."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)

    def bound(self, queries: np.ndarray, start: np.ndarray, length: np.ndarray, after: bool) -> np.ndarray:
        """Binary search: how many suffixes sort before (or, ``after``, not after) each prefix."""
        n = len(self.order)
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), n, np.int64)
        for _ in range(int(n).bit_length()):
            open_ = lo < hi
            mid = (lo + hi) >> 1
            pos = self.order[np.minimum(mid, n - 1)]
            end = self.end[pos]
            sign = np.zeros(len(start), np.int64)
            live = np.flatnonzero(open_)
            for j in range(int(length.max(initial=0))):
                live = live[length[live] > j]
                if not len(live):
                    break
                p = pos[live] + j
                mine = np.where(p < end[live], self.words[np.minimum(p, n - 1)], 0)
                sign[live] = np.sign(mine - queries[start[live] + j])
                live = live[sign[live] == 0]
            right = open_ & ((sign < 0) | (after & (sign == 0)))
            lo = np.where(right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)
        return lo


class Tests:
    """A block of benchmark items: their words and the windows to look up."""

    def __init__(self, texts: pa.Array, window: int = WINDOW):
        self.words, self.first = corpus_words(*buffer(texts))
        n = np.diff(self.first)
        count = np.where(n == 0, 0, np.maximum(n - window + 1, 1))
        self.item = np.repeat(np.arange(len(n)), count)
        self.start = ranges(self.first[:-1], count)
        self.length = np.minimum(n, window)[self.item]

    def occurrences(self, shard: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place in the shard) of all verbatim matches."""
        q = shard.translate(self.words)
        lacks = np.concatenate([[0], np.cumsum(q == 0)])
        ask = np.flatnonzero(lacks[self.start + self.length] == lacks[self.start])
        if not len(ask):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lo = shard.bound(q, self.start[ask], self.length[ask], False)
        hi = shard.bound(q, self.start[ask], self.length[ask], True)
        return np.repeat(ask, hi - lo), shard.order[ranges(lo, hi - lo)]


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list:
    """The benchmark as broadcasts of (item ids, texts), ``block_bytes`` of text or one item each."""
    sc, out, ids, texts, size = benchmark.sparkSession.sparkContext, [], [], [], 0
    rows = benchmark.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    for r in rows.toLocalIterator():
        if texts and size + len(r["text"]) > block_bytes:
            out.append(sc.broadcast((ids, texts)))
            ids, texts, size = [], [], 0
        ids.append(r["item"])
        texts.append(r["text"])
        size += len(r["text"])
    if texts:
        out.append(sc.broadcast((ids, texts)))
    return out


def shard_size(benchmark: DataFrame) -> int:
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(size, SHARD_BYTES), LARGEST_SHARD)


def finder(test_blocks: list, window: int = WINDOW, shard_bytes: int = SHARD_BYTES):
    """A column function: a text's words, its words inside any window, and its longest matches."""

    def searched(text: pa.Array, one: tuple | None) -> pa.Array:
        buf, offs = buffer(text)
        shards = list(slices(offs, shard_bytes))
        n_words, n_hit, counts, cols = [], [], [], []
        for i, j in shards:
            words, first = corpus_words(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            shard = SuffixArray(words, first, window)
            edge = np.zeros(len(words) + 1, np.int64)
            found = []
            for block in test_blocks if len(words) else []:
                if one:
                    ids, tests = one
                else:
                    ids, texts = load(block)
                    tests = Tests(pa.array(texts, pa.large_string()), window)
                win, place = tests.occurrences(shard)
                if not len(win):
                    continue
                item = tests.item[win]
                order = np.lexsort((place, place - tests.start[win], item))
                win, place, item = win[order], place[order], item[order]
                doc = np.searchsorted(first, place, "right") - 1
                diagonal = place - tests.start[win]
                new = np.ones(len(win), bool)
                new[1:] = (np.diff(item) != 0) | (np.diff(diagonal) != 0) | (np.diff(place) != 1) | (np.diff(doc) != 0)
                at = np.flatnonzero(new)
                last = np.append(at[1:], len(win)) - 1
                stop = place[last] + tests.length[win[last]]
                np.add.at(edge, place[at], 1)
                np.add.at(edge, stop, -1)
                found.append((doc[at], np.array(ids, object)[item[at]], tests.start[win[at]] - tests.first[item[at]],
                              place[at] - first[doc[at]], stop - place[at]))
            hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
            n_words.append(np.diff(first))
            n_hit.append(np.diff(hit[first]))
            m = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 5
            order = np.lexsort((m[3], m[0]))
            counts.append(np.bincount(m[0].astype(np.int64), minlength=j - i))
            cols.append([x[order] for x in m[1:]])
        cat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        item, item_start, doc_start, length = (cat([c[k] for c in cols]) for k in range(4))
        rows = pa.StructArray.from_arrays(
            [pa.array(item.tolist(), pa.string()), *[pa.array(x.astype(np.int32), pa.int32())
                                                     for x in (item_start, doc_start, length)]],
            ["item", "item_start", "doc_start", "n_words"])
        return pa.StructArray.from_arrays(
            [pa.array(cat(n_words).astype(np.int64)), pa.array(cat(n_hit).astype(np.int64)),
             list_array(rows, cat(counts).astype(np.int64))], ["n_words", "n_hit", "matches"])

    @arrow_udf(FOUND)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = None
        if len(test_blocks) == 1:
            ids, texts = load(test_blocks[0])
            one = ids, Tests(pa.array(texts, pa.large_string()), window)
        held, size = [], 0
        for batch in batches:
            held.append(batch.cast(pa.large_string()))
            size += held[-1].nbytes
            if size >= shard_bytes:
                yield searched(pa.concat_arrays(held), one)
                held, size = [], 0
        if held:
            yield searched(pa.concat_arrays(held), one)

    return find


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
               block_bytes: int = BLOCK_BYTES, shard_bytes: int | None = None) -> DataFrame:
    """``docs`` with a column ``found`` (see ``FOUND``); a column of that name is replaced."""
    find = finder(blocks(benchmark, block_bytes), window, shard_bytes or shard_size(benchmark))
    return docs.withColumn("found", find(F.col(text)))


def op10_suffix_arrays(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = find_leaks(docs, read(spark, sf_dir, "benchmark")).select("doc_id", "found")
    items = F.array_sort(F.array_distinct(F.col("found.matches.item")))
    return leaks.select(
        "doc_id", "found.n_words", "found.n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
        F.coalesce(F.array_max("found.matches.n_words"), F.lit(0)).alias("longest_match"))


def drop_leaks(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that hold no window of the benchmark."""
    benchmark = read(spark, sf_dir, "benchmark")
    find = finder(blocks(benchmark), shard_bytes=shard_size(benchmark))
    return docs.where(find("text")["n_hit"] == 0)
