"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form is its most
frequent near word, if that is ``RATIO`` times as frequent; following forms leads to its root.

1. Words are counted: per text, per task (in bounded tables) and per word, each before it moves.
2. Near words are brought together. Let m be the length of the longer word of a pair (so a word is in classes m =
   its length and its length + 1) and i the length of the pair's common prefix. The words share their first i and their last m - 1 - i
   code points. A list (m, p, s) holds the words that share p code points in front and s behind and is charged with the pairs whose i lies in
   p .. m - 1 - s. A class starts with two lists a word: its first half (i in the upper half) and its second.
3. A list longer than ``LIST`` words (a common ending) is split at the middle of its range of i: its words go on with more
   shared code points, either in front or behind, until each list is short or i is known; then the list can hold no more words than the
   alphabet has letters, and all are near. No list is cut, and each pair is in exactly one list that is charged with it.
4. In a list the unshared middles are scanned in sorted order. Every word of length m is compared with the
   list by an edit matrix of which only the band of three cells a row is kept (one edit cannot leave it). Going from
   one entry to the next, the rows of their common prefix (LCP) are reused; where all three
   cells of a row exceed one edit, the scan jumps over the range of entries that share that prefix. All words of
   a block of lists are scanned side by side as array steps, one row a step.
5. Pairs are pre-aggregated to the number of near words and the most frequent one; forms are followed by
   pointer doubling, of which the rounds are the logarithm of the longest chain (at most log10 of the largest count).

Spark: lists are shuffled by a hash of (m, p, s, shared code points) and sorted within partitions; words are compared before a
pair is given out, so colliding hashes do no harm. A task holds ``BLOCK`` words of whole lists, and lists are bounded.
Lists that are too long are found by a pre-aggregated count of hashes. Every step between checkpoints can be run again.

Results in special cases: null and empty texts have no words; a null id misspells nothing; repeated rows count twice; a word
without near words has n_near 0, no form, and is its own root; ties between near words go to the smallest in code-point
order; an empty table gives an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popcenter.llm.common import read
from popcenter.session import checkpoint

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
#: Words of a list, of a block of lists, and of a task's table of counts.
LIST, BLOCK, TABLE = 1024, 1 << 16, 200_000
#: Every 31st (text, word) by CRC-32 loses a letter in the registered query.
MISSPELLED = 31
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


# ---------------------------------------------------------------- words

def _counter(min_length: int, every: int | None):
    """For mapInArrow over (doc_id string, text): partial counts of the words of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % min_length).finditer
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                              ["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                start = None if every is None or name is None else zlib.crc32(f"{name}:".encode())
                for word, n in Counter(map(itemgetter(0), find(text))).items():
                    word = word.lower() if word.isascii() else word.translate(_LOWER)
                    if start is not None and (h := zlib.crc32(word.encode(), start)) % every == 0:
                        word = word[:h % len(word)] + word[h % len(word) + 1:]
                        if len(word) < min_length:
                            continue
                    counts[word] += n
                if len(counts) >= TABLE:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return run


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, misspelled: int | None = None) -> DataFrame:
    """(word, n): runs of letters (ASCII and Latin-1), A-Z in lower case, of ``min_length`` code points that occur
    ``min_count`` times. ``misspelled`` = k takes a letter out of those words of a text for which k divides the
    CRC-32 of ``<doc_id>:<word>`` (a test corpus with known variants)."""
    found = docs.select(F.col(doc_id).cast("string"), F.col(text).alias("text")).mapInArrow(
        _counter(min_length, misspelled), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- lists

def _placed(words: DataFrame) -> DataFrame:
    """Rows (word, n, m, p, s) with the hash of their list, the unshared middle, and the first shared code point behind it."""
    w, p, s = F.col("word"), F.col("p"), F.col("s")
    size = F.length("word")
    front, behind = F.substring(w, F.lit(1), p), F.substring(w, size - s + 1, s)
    return words.select("word", "n", "m", "p", "s", F.xxhash64("m", "p", "s", front, behind).alias("list"),
                        F.substring(w, p + 1, size - p - s).alias("middle"),
                        F.when(s > 0, F.ascii(behind)).otherwise(-1).alias("after"))


def _halves(words: DataFrame, p, s) -> DataFrame:
    """Each (word, n, m) twice: its range of i = p .. m - 1 - s cut in the middle."""
    m = F.col("m")
    cut = p + F.ceil((m - p - s) / 2).cast("int")
    return words.select("word", "n", "m", F.explode(F.array(
        F.struct(cut.alias("p"), s.alias("s")), F.struct(p.alias("p"), (m - cut).alias("s")))).alias("r")).select(
        "word", "n", "m", "r.p", "r.s")


def short_lists(vocabulary: DataFrame, limit: int = LIST) -> DataFrame:
    """All words of (word, n) in lists of at most ``limit`` words (or of one letter's difference)."""
    none = F.lit(0)
    classes = vocabulary.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("m"))
    rows, done = _placed(_halves(classes, none, none)), None
    while True:
        divisible = rows.where(F.col("m") - 1 - F.col("p") - F.col("s") > 0)
        long = checkpoint(divisible.groupBy("list").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > limit).select("list"))
        if long.isEmpty():
            return rows if done is None else done.unionByName(rows)
        short = rows.join(long, "list", "left_anti").select(rows.columns)
        done = short if done is None else done.unionByName(short)
        rows = checkpoint(_placed(_halves(rows.join(long, "list", "left_semi"), F.col("p"), F.col("s"))))


# ---------------------------------------------------------------- scan

def _prefixes(chars: np.ndarray, at: np.ndarray, size: np.ndarray, new: np.ndarray) -> np.ndarray:
    """LCP of each entry with the one before; -1 at the start of a list and behind the end."""
    lcp = np.zeros(len(size) + 1, np.int64)
    rows = np.flatnonzero(~new)
    rows = rows[rows > 0]
    d = 0
    while len(rows):
        rows = rows[np.minimum(size[rows], size[rows - 1]) > d]
        rows = rows[chars[at[rows] + d] == chars[at[rows - 1] + d]]
        d += 1
        lcp[rows] = d
    lcp[:-1][new] = -1
    lcp[-1] = -1
    return lcp


def _next_smaller(lcp: np.ndarray) -> np.ndarray:
    """For each entry the next one with a smaller LCP."""
    out, stack, values = [0] * len(lcp), [], lcp.tolist()
    for j, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            out[stack.pop()] = j
        stack.append(j)
    for j in stack:
        out[j] = len(lcp) - 1
    return np.array(out)


def scan(chars: np.ndarray, at: np.ndarray, size: np.ndarray, new: np.ndarray,
         queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, entry) pairs of distance one within each list. Entries are strings ``chars[at:at + size]``,
    sorted within lists that start where ``new`` is true; ``queries`` are entries that are no shorter than any
    other of their list and longer by one at most."""
    lcp = _prefixes(chars, at, size, new)
    jump = _next_smaller(lcp)
    heads = np.flatnonzero(new)
    chars = np.r_[chars, np.zeros(2, chars.dtype)]
    number = queries
    base = np.r_[0, np.cumsum(size[number] + 3)][:-1]
    cells = np.zeros((3, int((size[number] + 3).sum())), np.int8)  # the matrix cells (d, d-1), (d, d), (d, d+1)
    cells[0, base], cells[1, base], cells[2, base] = 2, 0, np.where(size[number] > 0, 1, 2)
    pos = heads[np.searchsorted(heads, number, "right") - 1]
    depth = np.zeros(len(number), np.int64)
    got_q, got_t = [], []
    while len(number):
        m, n, row = size[number], size[pos], base + depth
        end = depth == n
        if end.any():
            e = np.flatnonzero(end)
            value = np.where(n[e] == m[e], cells[1, row[e]], cells[2, row[e]])
            hit = e[(value == 1) & (m[e] - n[e] <= 1) & (m[e] >= n[e])]
            got_q.append(number[hit])
            got_t.append(pos[hit])
        # one more row for the others
        x, y = at[number] + depth, chars[at[pos] + np.minimum(depth, n - 1).clip(0)]
        a0, b0, c0 = cells[0, row], cells[1, row], cells[2, row]
        a = np.minimum(a0 + (chars[np.maximum(x - 1, 0)] != y), b0 + 1)
        a[depth > m] = 2
        b = np.minimum(np.minimum(b0 + (chars[np.minimum(x, len(chars) - 1)] != y), c0 + 1), a + 1)
        b[depth + 1 > m] = 2
        c = np.minimum(c0 + (chars[np.minimum(x + 1, len(chars) - 1)] != y), b + 1)
        c[depth + 2 > m] = 2
        alive = ~end & (np.minimum(np.minimum(a, b), c) < 2)
        k = np.flatnonzero(alive)
        cells[0, row[k] + 1] = np.minimum(a[k], 2)
        cells[1, row[k] + 1] = np.minimum(b[k], 2)
        cells[2, row[k] + 1] = np.minimum(c[k], 2)
        depth[k] += 1
        # the next entry: behind the one that ended, or behind all that share the dead prefix
        k = np.flatnonzero(~alive)
        to, bound = pos[k] + 1, np.where(end[k], np.iinfo(np.int64).max, depth[k] + 1)
        far = np.flatnonzero(lcp[to] >= bound)
        while len(far):
            to[far] = jump[to[far]]
            far = far[lcp[to[far]] >= bound[far]]
        pos[k], depth[k] = to, lcp[to]
        stay = depth >= 0
        if not stay.all():
            number, base, pos, depth = number[stay], base[stay], pos[stay], depth[stay]
    none = np.empty(0, np.int64)
    return (np.concatenate(got_q), np.concatenate(got_t)) if got_q else (none, none)


_PLACED = ("list", "middle", "word", "n", "m", "p", "s", "after")


def _near_in_block(block: pa.Table) -> pa.RecordBatch:
    """Pairs (word, near, near_n), in both directions, of a block of whole lists."""
    lists, n, m, p, s, after = (block.column(c).to_numpy() for c in ("list", "n", "m", "p", "s", "after"))
    middles, words = block.column("middle").to_pylist(), block.column("word").to_pylist()
    chars = np.frombuffer("".join(middles).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, middles), np.int64, len(middles))
    at = np.cumsum(size) - size
    new = np.r_[True, lists[1:] != lists[:-1]]
    q, t = scan(chars, at, size, new, np.flatnonzero(size == m - p - s))
    # a middle that only lacks its last code point, which is also the next one: the pair's i lies further on
    shorter = size[t] < size[q]
    rows = np.flatnonzero(shorter)
    rows = rows[[middles[i].startswith(middles[j]) for i, j in zip(q[rows], t[rows])]] if len(rows) else rows
    later = np.zeros(len(q), bool)
    later[rows] = chars[at[q[rows]] + size[q[rows]] - 1] == after[q[rows]]
    one = (m[q] == m[t]) & (p[q] == p[t]) & (s[q] == s[t]) & ~later
    out = []
    for i, j in zip(q[one].tolist(), t[one].tolist()):
        a, b = words[i], words[j]
        if a[:p[i]] == b[:p[i]] and (not s[i] or a[-s[i]:] == b[-s[i]:]):  # the same list, not only the same hash
            out.append((a, b, n[j]))
            if len(a) > len(b):
                out.append((b, a, n[i]))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()),
                                       pa.array([r[2] for r in out], pa.int64())], ["word", "near", "near_n"])


def _scanner(limit: int):
    """For mapInArrow over rows sorted by (list, middle): blocks of whole lists of about ``limit`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < limit:
                continue
            block = pa.Table.from_batches(held).combine_chunks()
            ids = block.column("list").to_numpy()
            last = int(np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])[-1])  # it may go on in the next batch
            if last:
                yield _near_in_block(block.slice(0, last))
                block = block.slice(last)
            held = block.to_batches()
        if held:
            yield _near_in_block(pa.Table.from_batches(held))

    return run


def near_words(vocabulary: DataFrame, limit: int = LIST, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n) for every ordered pair of words of (word, n) that are one edit apart."""
    lists = short_lists(vocabulary, limit).select(*_PLACED)
    ordered = lists.repartition("list").sortWithinPartitions("list", "middle")
    return ordered.mapInArrow(_scanner(block), "word string, near string, near_n long")


# ---------------------------------------------------------------- forms

def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): pointers are doubled until none leads on. Forms are more frequent
    than their words, so there is no cycle."""
    paths = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        on = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = checkpoint(paths.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        paths = step.select("word", "root")
        if step.where("moved").isEmpty():
            return paths


def spelling_variants(vocabulary: DataFrame, ratio: int = RATIO, limit: int = LIST, block: int = BLOCK) -> DataFrame:
    """One row per word of (word, n; distinct words): word, form, root, n, n_near, form_n."""
    words = checkpoint(vocabulary.select("word", F.col("n").cast("long").alias("n")))
    # the smallest (-n, word) is the most frequent near word, in code-point order among equals
    near = near_words(words, limit, block).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("top"))
    known = F.col("top").isNotNull() & (-F.col("top.n") >= ratio * F.col("n"))
    judged = checkpoint(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(known, F.col("top.word")).alias("form"), F.when(known, -F.col("top.n")).alias("form_n")))
    roots = _roots(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(read(spark, sf_dir, "documents"), misspelled=MISSPELLED))
