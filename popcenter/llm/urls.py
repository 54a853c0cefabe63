"""URL filter: a sorted array of 64-bit xxhash digests, memory-mapped, probed by vectorised
binary search, each hit confirmed on the stored string.

A list entry is ``host/path`` with a verdict. It fits a URL whose host is the entry's or a
subdomain of it and whose path starts with the entry's; the longest entry wins (of equally long
ones a block, then the first by code point). A URL without a fitting entry has the verdict
``allow``: it is not on the list.

Entries have shapes (labels of the host, characters of the path). For each shape of the list a
URL has one string that could be an entry, so a URL is probed with as many digests as there are
shapes, however long the list is. Digests are Spark's ``xxhash64`` (XXH64, seed 42), computed in
the JVM. The sorted list is laid out in files in the shared checkpoint folder: the digests, the entries' bytes one after
the other with their offsets, and the verdicts. Spark copies them to each executor once (``addFile``), and all its workers map
them into memory: no worker holds the list, and only the pages of the files that a search touches are read.

How it scales: pages are read once, url alone, with no shuffle. The list is sorted by Spark and laid out in
parts of ``BLOCK_ENTRIES``, so the driver holds one part at a time. A URL asks one digest per shape of the list; shapes are
pairs of small numbers (labels of a host, characters of a path).

Results in special cases: null URLs and URLs without ``://`` have an empty host and path and are
allowed; null entries or entries without a slash are skipped; an entry given with two verdicts
blocks; an empty list allows all.
"""

from __future__ import annotations

import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from popcenter.llm.common import keep_columns, read
from popcenter.llm.text import ranges
from popcenter.session import scratch_folder

BLOCK_ENTRIES = 4_000_000
#: The rules of the registered query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def entries_of(rules: DataFrame) -> DataFrame:
    """entry, verdict, key, labels, chars of a list's usable rows, one row per entry."""
    e = rules.where(F.col("entry").contains("/")).groupBy("entry").agg(
        F.when(F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)) == 1, "block").otherwise("allow").alias("verdict"))
    h = F.substring_index("entry", "/", 1)
    return e.select("entry", "verdict", F.xxhash64("entry").alias("key"), F.size(F.split(h, r"\.", -1)).alias("labels"),
                    (F.length("entry") - F.length(h)).alias("chars"))


def list_files(entries: DataFrame, block_entries: int = BLOCK_ENTRIES) -> list[str]:
    """The names of the files (one per part) of a sorted list, as Spark hands them to the workers."""
    spark = entries.sparkSession
    folder, out, rows = scratch_folder(spark, "urls"), [], []

    def write():
        texts = [r[1].encode() for r in rows]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        head = np.array([len(rows)], np.int64)
        keys = np.array([r[0] for r in rows], np.int64)
        blocked = np.array([r[2] == "block" for r in rows], np.int64)
        name = f"{uuid.uuid4().hex}.urls"
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        file = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        for part in (head.tobytes(), keys.tobytes(), offsets.tobytes(), blocked.tobytes(), *texts):
            file.write(bytearray(part))
        file.close()
        spark.sparkContext.addFile(f"{folder}/{name}")
        out.append(name)
        rows.clear()

    for r in entries.select("key", "entry", "verdict").orderBy("key", "entry").toLocalIterator():
        rows.append(r)
        if len(rows) >= block_entries:
            write()
    if rows:
        write()
    return out


class MappedList:
    """One part of the list in a worker: arrays mapped from its file."""

    def __init__(self, name: str):
        path = SparkFiles.get(name)
        n = int(np.fromfile(path, np.int64, 1)[0])
        self.keys = np.memmap(path, np.int64, "r", 8, (n,))
        self.offsets = np.memmap(path, np.int64, "r", 8 * (1 + n), (n + 1,))
        self.blocked = np.memmap(path, np.int64, "r", 8 * (2 + 2 * n), (n,))
        self.bytes = np.memmap(path, np.uint8, "r", 8 * (2 + 3 * n), (int(self.offsets[-1]),))

    def search(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, question) of equal digests."""
        lo, hi = np.searchsorted(self.keys, asked, "left"), np.searchsorted(self.keys, asked, "right")
        hit = np.flatnonzero(hi > lo)
        return ranges(lo[hit], (hi - lo)[hit]), np.repeat(hit, (hi - lo)[hit])

    def entries(self, at: np.ndarray) -> pa.Array:
        """The stored strings, gathered without a Python object each."""
        begin, size = self.offsets[at], self.offsets[at + 1] - self.offsets[at]
        data = self.bytes[ranges(np.asarray(begin), np.asarray(size))]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.asarray(data).tobytes()))


def matcher(names: list[str]):
    """A column function of (candidate strings, their digests): the best entry and its verdict."""

    def matched(candidates: pa.Array, keys: pa.Array, parts: list[MappedList]) -> pa.Array:
        strings = candidates.flatten()
        asked = keys.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(keys)), keys.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        hits = []
        for part in parts:
            at, who = part.search(asked)
            stored = part.entries(at)
            same = pa.compute.equal(stored, strings.take(pa.array(who)).cast(pa.large_string())).to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(same.astype(bool))
            hits.append(pa.table({"row": row[who[keep]], "entry": stored.take(pa.array(keep)),
                                  "blocked": np.asarray(part.blocked[at[keep]])}))
        found = pa.concat_tables(hits) if hits else pa.table({"row": np.empty(0, np.int64), "entry": pa.array([], pa.large_string()),
                                                              "blocked": np.empty(0, np.int64)})
        # the longest entry, of equals a block, then the first by code point (UTF-8 order)
        size = pa.compute.utf8_length(found["entry"])
        order = pa.compute.sort_indices(found.append_column("size", size), [
            ("row", "ascending"), ("size", "descending"), ("blocked", "descending"), ("entry", "ascending")])
        found = found.take(order)
        who = found["row"].to_numpy()
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.empty(0, np.int64)
        take = np.full(len(keys), -1, np.int64)
        take[who[first]] = first
        index = pa.array(np.maximum(take, 0), mask=take < 0)
        rules = found["entry"].combine_chunks().take(index) if len(who) else pa.nulls(len(keys), pa.large_string())
        blocked = np.zeros(len(keys), bool)
        blocked[who[first]] = found["blocked"].to_numpy()[first] == 1
        verdicts = pa.array(np.where(blocked, "block", "allow"))
        rules = rules.combine_chunks() if isinstance(rules, pa.ChunkedArray) else rules
        return pa.StructArray.from_arrays([rules.cast(pa.string()), verdicts.cast(pa.string())], ["rule", "verdict"])

    @arrow_udf("struct<rule:string,verdict:string>")
    def match(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        parts = [MappedList(n) for n in names]
        for candidates, keys in batches:
            yield matched(candidates, keys, parts)

    return match


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names are replaced);
    ``rules`` has entry and verdict."""
    entries = entries_of(rules)
    shapes = [(r["labels"], r["chars"]) for r in entries.select("labels", "chars").distinct().orderBy("labels", "chars").collect()]
    kept = keep_columns(pages, "host", "path", "rule", "verdict")
    parts = pages.select(F.struct(*kept).alias("page"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    fits = [F.when((F.size(F.split("host", r"\.", -1)) >= n) & (F.length("path") >= k),
                   F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, k))) for n, k in shapes]
    strings = F.array_compact(F.array(*fits)) if fits else F.array().cast("array<string>")
    parts = parts.withColumn("candidates", strings)
    parts = parts.withColumn("keys", F.transform("candidates", lambda s: F.xxhash64(s)))
    out = parts.withColumn("m", matcher(list_files(entries, block_entries))("candidates", "keys"))
    return out.select("page.*", "host", "path", "m.rule", "m.verdict")


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{e}', '{v}')" for e, v in RULES) + " AS t(entry, verdict)")
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")
