"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

Sets: a text's distinct 5-word shingles (lower-cased words; a shorter text is one shingle).
Sketch (Dahlgaard, Knudsen, Thorup, "Fast Similarity Sketching"): T bins; in round i < T every
shingle is hashed to a bin and a value, in round T + j every shingle goes to bin j; a bin keeps
the smallest (round, value), and a set stops after the first round that leaves no bin empty. All
bins are filled after 2T rounds at most, and long sets need one or two rounds.

Steps, each over all documents:

1. Documents of equal sets become one class (128-bit digest of the set): groups of copies of
   any size meet in a pre-aggregated sum, not in one task.
2. BANDS bands of ROWS bins each; classes that share a band value are candidates. A pair at the
   threshold of 0.85 is missed with probability (1 - 0.85^8)^45, about 6e-7. No pairs are listed: every
   member of a band value is held against its smallest one, by their whole sketches (one byte a
   bin). A tie needs agreement of SLACK less than the threshold, which a pair at 0.85 fails with a
   probability of about 3e-7. Where the members of a band value then lie in several components, those
   outside its largest one are held against all its members, by sketches too, in blocks of
   SKETCH_BLOCK; of band values with the same members one is enough. The ties' connected components are the
   candidate clusters. So clusters hold together by pairs of about 0.75 and more: chains of weaker
   likeness, which band values alone would tie, fall apart.
3. Within a cluster every pair is decided on the full sets, so no candidate gets lost. The sets
   of a cluster are cut into blocks of about BLOCK_BYTES and one member, the hub, joins each
   block. A task links the members of one block and returns a spanning forest of the links
   (linear in the rows it read); components over these forests follow. In a cluster of several
   blocks the members outside its largest component are then compared with all its members, two
   blocks a task. So a cluster of copies of one text costs in proportion to its size, whatever
   that is, and only members that did not link are compared further. What is known of a cluster
   reaches its rows by (cluster, salt), SALTS salts a cluster, so none is one join key.
4. Connected components of the links, and the smallest doc_id of each.

Sets are compared as sets of 64-bit shingle hashes.

Results in special cases: null, empty and wordless texts have an empty set, link with nothing
and are their own component; rows with a null doc_id take part but never name a component (a
component of such rows alone has a null id, and all its rows stay); repeated rows get the same
answer; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from popcenter.llm.common import read
from popcenter.llm.graph import components
from popcenter.llm.text import (Grams, U, buffer, list_array, lower, mix, not_space, ranges, signed, slices,
                                word_hashes, word_spans)
from popcenter.session import checkpoint

SHINGLE = 5
BANDS, ROWS = 45, 8
LINK = (85, 100)
BLOCK_BYTES = 16 << 20
SLACK = 0.1
SKETCH_BLOCK = 4096
SALTS = 64
#: The pipeline stage: its threshold, and 61 bands of 7, which miss a pair at 0.80 with probability
#: (1 - 0.8^7)^61, about 6e-7 (45 bands of 8 would miss 2.6e-4 of them).
STAGE_LINK, STAGE_BANDS, STAGE_ROWS = (80, 100), 61, 7


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's distinct shingles, sorted, document after document; offsets."""
    low = lower(buf)
    starts, ends, first = word_spans(low, offs, not_space())
    grams, n = Grams(word_hashes(low, starts, ends)), np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    h = grams.at(ranges(first[:-1], count), np.repeat(np.minimum(n, k), count))
    at = np.concatenate([[0], np.cumsum(count)])
    sets = [np.unique(h[at[d]:at[d + 1]]) for d in range(len(n))]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, U)), np.concatenate([[0], np.cumsum(sizes)])


def sketches(shingles: np.ndarray, at: np.ndarray, bins: int) -> np.ndarray:
    """One row of ``bins`` values for every set; none may be empty."""
    n_sets = len(at) - 1
    out = np.full(n_sets * bins, np.iinfo(U).max, U)
    size = np.diff(at)
    live = np.arange(n_sets)
    x, own = shingles, np.repeat(live, size)
    for r in range(2 * bins):
        h = mix(x ^ mix(np.array([r + 1], U)))
        place = own * bins + ((h >> U(32)) % U(bins)).astype(np.int64) if r < bins else own * bins + (r - bins)
        np.minimum.at(out, place, (U(r) << U(32)) | (h & U(0xFFFFFFFF)))
        empty = (out.reshape(n_sets, bins)[live] == np.iinfo(U).max).any(axis=1)
        if not empty.all():
            live = live[empty]
            if not len(live):
                break
            x, own = shingles[ranges(at[live], size[live])], np.repeat(live, size[live])
    return out.reshape(n_sets, bins)


def signer(bands: int = BANDS, rows: int = ROWS):
    """A column function: size and digest of a text's shingle set, its band values, and its sketch
    with one byte a bin."""

    @arrow_udf("struct<n:bigint,hi:bigint,lo:bigint,bands:array<bigint>,sketch:binary>")
    def sign(text: pa.Array) -> pa.Array:
        buf, offs = buffer(text)
        n, hi, lo, keys, marks = [], [], [], [], []
        for i, j in slices(offs):
            x, at = shingle_sets(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            size = np.diff(at)
            n.append(size)
            for out, seed in ((hi, 1), (lo, 2)):
                sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(x + U(seed)), dtype=U)])
                out.append(mix(sums[at[1:]] - sums[at[:-1]] + size.astype(U)))
            full = np.flatnonzero(size)
            s = sketches(x, np.concatenate([[0], np.cumsum(size[full])]), bands * rows).reshape(-1, bands, rows)
            key = np.broadcast_to(mix(np.arange(bands, dtype=U)), s.shape[:2]).copy()
            for r in range(rows):
                key = mix(key ^ s[:, :, r])
            keys.append(key.reshape(-1))
            mark = iter((s & U(0xFF)).astype(np.uint8).reshape(len(full), bands * rows))
            marks += [next(mark).tobytes() if z else b"" for z in size.tolist()]
        cat = lambda v: np.concatenate(v) if v else np.empty(0, U)
        sizes = cat(n).astype(np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(sizes), signed(cat(hi)), signed(cat(lo)),
             list_array(signed(cat(keys)), np.where(sizes > 0, bands, 0)), pa.array(marks, pa.binary())],
            ["n", "hi", "lo", "bands", "sketch"])

    return sign


def shingle_bytes(text: pa.Array) -> pa.Array:
    """Each text's shingle set as sorted 64-bit hashes."""
    buf, offs = buffer(text)
    out = []
    for i, j in slices(offs):
        x, at = shingle_sets(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        out += [x[at[d]:at[d + 1]].tobytes() for d in range(j - i)]
    return pa.array(out, pa.binary())


def forest(sets: list[np.ndarray], side: np.ndarray, link: tuple[int, int] = LINK) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``; with two sides, of those between them."""
    root = list(range(len(sets)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    size = np.array([len(s) for s in sets])
    out, parts = [], len(sets)
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(right)), size[right])
    of_right = ids[ranges(at[right], size[right])]
    order = np.argsort(of_right, kind="stable")
    posting = owner[order]
    begin = np.searchsorted(of_right[order], np.arange(ids.max(initial=-1) + 2))
    for i in left:
        mine = ids[at[i]:at[i + 1]]
        both = np.bincount(posting[ranges(begin[mine], begin[mine + 1] - begin[mine])], minlength=len(right))
        linked = right[link[1] * both >= link[0] * (size[i] + size[right] - both)]
        for j in linked.tolist():
            a, b = find(int(i)), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(i), j))
                parts -= 1
        if parts == 1:
            break
    return out


def linker(link: tuple[int, int] = LINK):
    """For mapInArrow over rows (cluster, p, q, side, name, set) sorted by the first three: links
    as (a, b) of class names, within a group or, if it has two sides, between them."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {"key": None, "names": [], "sets": [], "side": []}

        def done() -> list[tuple[str, str]]:
            if len(held["sets"]) < 2:
                return []
            names = held["names"]
            return [(names[i], names[j]) for i, j in forest(held["sets"], np.array(held["side"]), link)]

        for batch in batches:
            found = []
            cols = [batch.column(k).to_pylist() for k in range(6)]  # keys and bytes objects, no words
            for cluster, p, q, side, name, raw in zip(*cols):
                if (cluster, p, q) != held["key"]:
                    found += done()
                    held = {"key": (cluster, p, q), "names": [], "sets": [], "side": []}
                held["names"].append(name)
                held["sets"].append(np.frombuffer(raw, U))
                held["side"].append(side)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], ["a", "b"])
        if found := done():
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], ["a", "b"])

    return links


def agreement(a: pa.Array, b: pa.Array) -> pa.Array:
    """The number of bins in which two sketches agree."""
    return pa.array([int((np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)).sum())
                     for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int32())


def tier(need: int):
    """For applyInArrow over rows (hi, root, side, sketch): ties (hi, hub) between members of side 0 and
    members of side 1 that agree in ``need`` bins, a spanning forest over the roots."""
    def ties(table: pa.Table) -> pa.Table:
        hi, side = table["hi"].to_numpy(), table["side"].to_numpy()
        _, part = np.unique(table["root"].to_numpy(), return_inverse=True)
        sketch = np.stack([np.frombuffer(x, np.uint8) for x in table["sketch"].to_pylist()])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        out: list[tuple[int, int]] = []
        for i in left:
            other = right[part[right] != part[i]]
            for j in other[(sketch[other] == sketch[i]).sum(axis=1) >= need]:
                if part[j] != part[i]:
                    out.append((hi[i], hi[j]))
                    part[part == part[j]] = part[i]
        return pa.table({"hi": pa.array([x for x, _ in out], pa.int64()), "hub": pa.array([y for _, y in out], pa.int64())})

    return ties


def candidate_ties(full: DataFrame, need: int, block: int = SKETCH_BLOCK) -> DataFrame:
    """hi, hub: ties that join all classes which share a band value and agree in ``need`` bins of their sketches
    (hi, lo, bands, sketch), and no others."""
    classes = full.groupBy("hi", "lo").agg(F.first("bands").alias("bands"))
    keyed = classes.select("hi", F.explode("bands").alias("band"))
    hubs = keyed.groupBy("band").agg(F.min("hi").alias("hub"), F.max("hi").alias("top")).where(F.col("hub") != F.col("top"))
    shared = checkpoint(keyed.join(hubs.drop("top"), "band"))
    pairs = shared.where(F.col("hi") != F.col("hub")).select("hi", "hub").distinct()
    nodes = shared.select("hi").distinct()
    sketch = checkpoint(full.join(nodes, "hi", "left_semi").groupBy("hi").agg(F.first("sketch").alias("sketch")))
    of_hub = sketch.select(F.col("hi").alias("hub"), F.col("sketch").alias("of_hub"))
    near = checkpoint(pairs.join(of_hub, "hub").join(sketch, "hi").where(arrow_udf(agreement, "int")("sketch", "of_hub") >= need).select("hi", "hub"))

    # band values whose members still lie in several components; a pair alone has been decided
    roots = components(near, "hi", "hub").select(F.col("node").alias("hi"), "root")
    member = shared.select("band", "hi").join(roots, "hi", "left").withColumn("root", F.coalesce("root", "hi"))
    per_root = member.groupBy("band", "root").agg(F.count("*").alias("c"), F.sum(F.xxhash64("hi").cast("decimal(38,0)")).alias("s"))
    open_ = per_root.groupBy("band").agg(F.max_by("root", F.struct("c", "root")).alias("largest"), F.max("c").alias("most"),
                                         F.sum("c").alias("n"), F.sum("s").alias("s")).where("n > 2 and most < n")
    chosen = open_.groupBy("n", "s").agg(F.min(F.struct("band", "largest", "most")).alias("one")).select("one.*", "n")
    rows = checkpoint(member.join(chosen, "band"))
    if rows.isEmpty():
        return near
    blocks = lambda size: F.ceil(size / block).cast("int")
    own = lambda n: F.array(F.pmod(F.xxhash64("hi"), n).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    n_left, n_right = blocks(F.col("n") - F.col("most")), blocks(F.col("n"))
    left = rows.where(F.col("root") != F.col("largest")).select("band", "hi", "root", F.lit(0).alias("side"), own(n_left).alias("p"), every(n_right).alias("q"))
    right = rows.select("band", "hi", "root", F.lit(1).alias("side"), every(n_left).alias("p"), own(n_right).alias("q"))
    work = left.unionByName(right).join(sketch, "hi").withColumn("p", F.explode("p")).withColumn("q", F.explode("q"))
    more = work.groupBy("band", "p", "q").applyInArrow(tier(need), "hi bigint, hub bigint")
    return near.unionByName(checkpoint(more))


def with_facts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` (cluster, name, ...) joined with one row of facts a cluster, by (cluster, salt)."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)))
    salts = salted.select("cluster", "salt").distinct().join(facts, "cluster")
    return salted.join(salts, ["cluster", "salt"]).drop("salt")


def near_duplicates(docs: DataFrame, link: tuple[int, int] = LINK, bands: int = BANDS, rows: int = ROWS,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, component and kept for every row of ``docs``
    (doc_id, text). ``component`` names a component whatever the ids in it (null: no words)."""
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    sig = checkpoint(base.withColumn("s", signer(bands, rows)("text")).select("doc_id", "text_hash", "s.*"))
    name = F.concat_ws(".", "hi", "lo").alias("name")
    full = sig.where(F.col("n") > 0)

    ties = candidate_ties(full, math.ceil((link[0] / link[1] - SLACK) * bands * rows))
    clusters = checkpoint(components(ties, "hi", "hub").select(F.col("node").alias("hi"), F.col("root").alias("cluster")))

    # one row a class, summed up before the shuffle: a class may hold a third of all rows
    reps = full.groupBy("hi", "lo").agg(F.first("n").alias("n"), F.min("doc_id").alias("least"),
                                        F.min(F.struct("doc_id", "text_hash")).alias("one"))
    members = reps.join(clusters, "hi").select("*", name)
    weight = F.sum(F.col("n") * 8)
    blocks = members.groupBy("cluster").agg(F.ceil(weight / block_bytes).cast("int").alias("n_blocks"), F.min("name").alias("hub"))
    members = with_facts(members, blocks).select(
        F.col("one.doc_id").alias("m_id"), F.col("one.text_hash").alias("m_hash"), "cluster", "n_blocks", "hub", "name", "n",
        F.pmod(F.xxhash64("name"), F.col("n_blocks")).cast("int").alias("block"))
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash"))
    sets = base.join(members, same).groupBy("cluster", "n_blocks", "hub", "block", "name", "n").agg(F.first("text").alias("text"))
    sets = checkpoint(sets.withColumn("set", arrow_udf(shingle_bytes, "binary")("text")).drop("text"))

    def linked(rows: DataFrame) -> DataFrame:
        rows = rows.select("cluster", "p", "q", "side", "name", "set").repartition("cluster", "p", "q")
        return rows.sortWithinPartitions("cluster", "p", "q").mapInArrow(linker(link), "a string, b string")

    every = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    own = F.when(F.col("name") == F.col("hub"), every).otherwise(F.array("block"))
    links = checkpoint(linked(sets.withColumn("p", F.explode(own)).withColumn("q", F.col("p")).withColumn("side", F.lit(0))))
    several = sets.where(F.col("n_blocks") > 1)
    if not several.isEmpty():
        parts = several.join(components(links), F.col("name") == F.col("node"), "left").withColumn("root", F.coalesce("root", "name"))
        sizes = parts.groupBy("cluster", "root").agg(F.count("*").alias("c"))
        largest = sizes.groupBy("cluster").agg(F.max_by("root", F.struct("c", "root")).alias("largest"))
        rest = with_facts(parts, largest).where(F.col("root") != F.col("largest"))
        n_rest = rest.groupBy("cluster").agg(F.ceil(weight / block_bytes).cast("int").alias("n_rest"))
        left = with_facts(rest, n_rest).withColumn("p", F.pmod(F.xxhash64("name"), F.col("n_rest")).cast("int")) \
            .withColumn("q", F.explode(every)).withColumn("side", F.lit(0))
        right = with_facts(several, n_rest).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("n_rest") - 1))) \
            .withColumn("q", F.col("block")).withColumn("side", F.lit(1))
        cols = ("cluster", "p", "q", "side", "name", "set")
        links = links.unionByName(checkpoint(linked(left.select(*cols).unionByName(right.select(*cols)))))
    roots = components(links)

    named = reps.select("hi", "lo", "least", name).join(roots, F.col("name") == F.col("node"), "left").withColumn("root", F.coalesce("root", "name"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = named.join(ids, "root").select(F.col("hi").alias("c_hi"), F.col("lo").alias("c_lo"), "component_id", F.col("root").alias("component"))
    out = sig.join(answer, (F.col("n") > 0) & (F.col("hi") == F.col("c_hi")) & (F.col("lo") == F.col("c_lo")), "left")
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "component") \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each component of pairs at 0.80 and above, that of the smallest (doc_id, text
    hash), ids that are not null first. Of repeated rows one stays, and of copies without an id one; texts without words
    have no component and all stay."""
    judged = near_duplicates(docs, STAGE_LINK, STAGE_BANDS, STAGE_ROWS)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one")
    stay = judged.groupBy("component").agg(first).where(F.col("component").isNotNull()).select("one.doc_id", "one.text_hash")
    rows = judged.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"), F.first("component").alias("component"))
    named = checkpoint(rows.select(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"), "n", "component").join(
        stay.withColumn("stays", F.lit(True)), F.col("r_id").eqNullSafe(F.col("doc_id")) & (F.col("r_hash") == F.col("text_hash")), "left"
    ).where(F.col("component").isNull() | F.col("stays")).select(
        F.col("r_id").alias("__id"), F.col("r_hash").alias("__hash"), ((F.col("n") > 1) & F.col("component").isNotNull()).alias("repeated")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    once = docs.join(named.where(~F.col("repeated")), same, "left_semi")
    again = docs.join(named.where("repeated"), same, "left_semi")  # few: only these rows are grouped
    if named.where("repeated").isEmpty():
        return once
    return once.unionByName(again.withColumn("__hash", F.xxhash64("text")).dropDuplicates(["doc_id", "__hash"]).drop("__hash"))
