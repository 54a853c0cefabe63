"""Secret scan: patterns propose candidates, a random forest drops the false positives.

Candidates in a text are values given to a name that speaks of a credential, and runs of
``RUN`` or more letters, digits and ``+/_=-``. Features of a candidate: its length; the shares of
its character pairs by class (lower case, upper case, digit, other, and changes between them); how
unusual its letter transitions are (mean surprise, in bits, under the transitions of the corpus's
words); the share of it that dictionary words cover (longest word first, from the left); the path
(depth, and names such as test or example in it); and the neighbouring words (credential names,
an assignment, words such as example or dummy, words that name a digest or a revision). The
dictionary is the words found in at least ``DICTIONARY_SHARE`` of all documents; words and
transitions are counted over all of them. The forest is Spark's ``RandomForestClassifier``.

Labelled findings (candidate, before, after, path, label) come from the caller. The registered
query has two sources of its own. First, findings of its documents that speak for themselves: a
value in a format of a known issuer (``KNOWN``), or of hex digits (``HEX``) given to the name of a
credential, is a secret; a placeholder is not, nor are letters alone that no such name precedes.
Letters given to such a name, and hex without one, are left unlabelled. Second, ``CONTEXTS``:
surroundings labelled by hand, with strings of the shapes that are met in them (``labelled_contexts``),
which is where commit ids, checksums, serial numbers and letter-only passwords are taught. Up to
about ``MAX_ROWS`` of all these, picked by a hash of the candidate, train the forest; candidates
whose hash mod 5 is 0 are never among them, so accuracy can be held out.

How it scales: texts are read twice (candidates, word counts) and never shuffled or sent whole;
the candidates are written to the checkpoint folder; word counts are distinct words a document,
pre-aggregated before the shuffle, and written out once; the dictionary has at most
(mean distinct words a document) / DICTIONARY_SHARE words, whatever the corpus's size, and is
broadcast; transitions are a table of 27 x 27. Training
rows are bounded and in one task on purpose, so that the forest is the same on every cluster.

Results in special cases: null and empty texts have no candidates; a null path is an empty one;
a run that overlaps an assignment is cut at its borders, and each piece of ``RUN`` bytes is a candidate; without labels of both
kinds every candidate counts as a secret (score 1): nothing is dropped unjudged; repeated rows
have the same findings; an empty table gives no findings.
"""

from __future__ import annotations

import base64
import hashlib
import re
import string
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from popcenter.llm.common import read, unit
from popcenter.llm.text import buffer, list_array, slices, word_spans
from popcenter.session import checkpoint

RUN = 16
MAX_ROWS = 4000
DICTIONARY_SHARE = 0.002
TREES, DEPTH, SEED = 40, 8, 5
#: Names of credentials, words of placeholders, formats of issued credentials.
NAMES = "password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer"
FAKE = "example|dummy|placeholder|changeme|sample|test|fake|your|xxxx|redacted"
KNOWN = (r"^AKIA[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36,}$", r"^xox[abprs]-[A-Za-z0-9-]{10,}$",
         r"^sk_live_[A-Za-z0-9]{16,}$", r"^AIza[0-9A-Za-z_-]{35}$")
HEX = r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,}$"
#: Words that name a digest, a revision or a serial number.
DIGEST = r"\b(?:commit|revision|changeset|sha-?\d*|md5(?:sum)?|crc|checksum|digest|hash|etag|integrity|fingerprint|uuid|build|blob|tree)\b"
#: Surroundings labelled by hand (before, after, label, shapes met there).
CONTEXTS = (
    ("fixed in commit ", " by the team", 0.0, "hex40"), ("see revision ", " for the reason", 0.0, "hex40"),
    ("merge changeset ", ".", 0.0, "hex40 hex20"), ("bisected to ", ", which broke the build", 0.0, "hex40"),
    ("reverts ", " and its tests", 0.0, "hex40"), ("md5sum ", "  release.tar.gz", 0.0, "hex32"),
    ("sha256: ", "", 0.0, "hex64"), ("checksum = ", " ok", 0.0, "hex32 hex64"), ("\"integrity\": \"sha512-", "\"", 0.0, "base44"),
    ("ETag: \"", "\"", 0.0, "hex32"), ("digest ", " of the image", 0.0, "hex64"), ("git tree ", "", 0.0, "hex40"),
    ("blob ", " 100644", 0.0, "hex40"), ("the file hashes to ", " on disk", 0.0, "hex32 hex40"), ("fingerprint ", "", 0.0, "hex40"),
    ("build ", " passed", 0.0, "hex20"), ("the value ", " was seen in the log", 0.0, "hex32 hex40"), ("id ", " of the row", 0.0, "hex32 digits16"),
    ("order number ", " was sent", 0.0, "digits16"), ("call ", " today", 0.0, "digits16"), ("uuid=", " in the table", 0.0, "uuid"),
    ("request ", " failed", 0.0, "uuid"), ("| ", " | total", 0.0, "digits16 hex32"),
    ("password=", "", 1.0, "letters12 mixed16"), ("passwd: ", " # root", 1.0, "letters12 mixed16"), ("pwd = '", "'", 1.0, "letters12 mixed16"),
    ("\"secret\": \"", "\",", 1.0, "hex32 mixed24 base44"), ("api_key=", "&user=1", 1.0, "hex32 hex40 mixed24"),
    ("API-KEY: ", " in the header", 1.0, "hex40 mixed24"), ("token = \"", "\"", 1.0, "hex40 mixed24 letters12"),
    ("export ACCESS_KEY=", "", 1.0, "mixed24 base44"), ("auth: ", "", 1.0, "mixed24 hex64"), ("bearer: ", "", 1.0, "mixed24 base44"),
    ("passphrase: \"", "\"", 1.0, "letters12 mixed24"), ("credential=", " # do not share", 1.0, "mixed16 hex32"),
    ("client_secret=", "", 1.0, "mixed24 hex64"),
)
CONTEXT_COPIES = 6
#: Text that ends where the value of a credential's name begins.
GIVEN = rf"(?i)(?:{NAMES})[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?\z"
NAME = re.compile(rf"(?:{NAMES})[\"']?\s{{0,3}}\Z", re.IGNORECASE)
VALUE = re.compile(r"[:=]\s{0,3}[\"']?([^\s\"',;]{6,})")
AROUND = 48
FEATURES = ("length", "lower_lower", "upper_upper", "digit_digit", "changes", "other", "surprise", "covered", "depth",
            "path_fake", "named", "assigned", "near_fake", "near_digest")


def run_bytes() -> np.ndarray:
    """For each byte: is it a letter or digit of ASCII or one of ``+/_=-``?"""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = True
    table[[0x2B, 0x2D, 0x2F, 0x3D, 0x5F]] = True
    return table


def places(buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int]]:
    """(document, first byte, end) of all candidates of a slice, in order. Byte classes find the
    long runs and the signs ``:`` and ``=``; only what is around a sign is matched as text."""
    text, out = buf.tobytes(), []
    signs = np.flatnonzero((buf == 0x3A) | (buf == 0x3D))
    docs = np.searchsorted(offs, signs, "right") - 1
    taken: list[tuple[int, int]] = []
    for at, d in zip(signs.tolist(), docs.tolist()):
        lo, hi = int(offs[d]), int(offs[d + 1])
        name = NAME.search(text[max(lo, at - 40):at].decode("utf-8", "ignore"))
        if not name or taken and at < taken[-1][1]:
            continue
        # a value goes on to its first separator, whatever its length
        size = 256
        while True:
            value = VALUE.match(text[at:min(hi, at + size)].decode("utf-8", "ignore"))
            if at + size >= hi or value is None or at + len(value[0].encode()) < at + size - 8:
                break
            size *= 4
        if value:
            first = at + len(value[0][:value.start(1)].encode())
            end = first + len(value[1].encode())
            taken.append((at - len(name[0].encode()), end))
            out.append((d, first, end))
    starts, ends, first = word_spans(buf, offs, run_bytes())
    long = np.flatnonzero(ends - starts >= RUN)
    begin = np.array([t[0] for t in taken], np.int64)
    letter = run_bytes()
    letter[[0x2B, 0x2D, 0x2F, 0x3D, 0x5F]] = False
    for lo, hi, d in zip(starts[long].tolist(), ends[long].tolist(), (np.searchsorted(first, long, "right") - 1).tolist()):
        # what the assignments leave of a run, without the signs at the cuts
        k, to = int(np.searchsorted(begin, hi)) - 1, hi
        pieces = []
        while k >= 0 and taken[k][1] > lo:
            pieces.append((taken[k][1], to))
            to = taken[k][0]
            k -= 1
        pieces.append((lo, to))
        for x, y in pieces:
            while x < y and x != lo and not letter[buf[x]]:
                x += 1
            while x < y and y != hi and not letter[buf[y - 1]]:
                y -= 1
            if y - x >= RUN:
                out.append((d, x, y))
    return sorted(out)


def proposer():
    """A column function: the candidates of a text with their places and surroundings."""

    @arrow_udf("array<struct<start:int,candidate:string,before:string,after:string>>")
    def propose(text: pa.Array) -> pa.Array:
        buf, offs = buffer(text)
        rows, counts = [], np.zeros(len(text), np.int64)
        for i, j in slices(offs):
            b, o = buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            found = places(b, o)
            if not found:
                continue
            counts[i:j] = np.bincount([f[0] for f in found], minlength=j - i)
            chars = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
            data = b.tobytes()
            for d, lo, hi in found:
                cut = lambda x, y: data[x:y].decode("utf-8", "ignore")
                rows.append((int(chars[lo] - chars[o[d]]), cut(lo, hi), cut(max(int(o[d]), lo - AROUND), lo),
                             cut(hi, min(int(o[d + 1]), hi + AROUND))))
        values = pa.StructArray.from_arrays(
            [pa.array([r[k] for r in rows], pa.string() if k else pa.int32()) for k in range(4)],
            ["start", "candidate", "before", "after"])
        return list_array(values, counts)

    return propose


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, path, start, candidate, before, after, one row per candidate."""
    return docs.select("doc_id", F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
                       F.explode(proposer()(F.col("text"))).alias("c")).select("doc_id", "path", "c.*")


class Language(NamedTuple):
    """What features take from the corpus: dictionary words, their first three letters, the longest
    word's length, and the surprise (bits) of each letter after each letter (a to z, other letters)."""

    words: frozenset
    heads: frozenset
    longest: int
    surprise: np.ndarray


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> Language:
    """Words (letters only, lower case) of many documents, and the letter transitions of all words,
    each word counted once per document."""
    n = docs.count()
    each = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    counted = checkpoint(docs.select(F.explode(each).alias("w")).groupBy("w").agg(F.count("*").alias("c")))
    common = counted.where((F.col("c") >= share * n) & (F.col("c") >= 3) & F.length("w").between(3, 30)).select("w")
    words = frozenset(r["w"] for r in common.collect())
    letters = F.regexp_replace("w", "[^a-z]", "~")
    pairs = F.transform(F.sequence(F.lit(1), F.length(letters) - 1), lambda i: F.substring(letters, i, F.lit(2)))
    seen = counted.where(F.length("w") >= 2).select("c", F.explode(pairs).alias("pair")).groupBy("pair").agg(F.sum("c").alias("c"))
    times = np.ones((27, 27))
    for r in seen.collect():  # 27 x 27 rows at most
        a, b = (min(ord(x) - 97, 26) for x in r["pair"])
        times[a, b] += r["c"]
    surprise = -np.log2(times / times.sum(axis=1, keepdims=True))
    return Language(words, frozenset(w[:3] for w in words), max(map(len, words), default=0), surprise)


def coverage(s: str, language: Language) -> float:
    """The share of ``s`` that words cover, taken from the left, the longest word first."""
    low, i, hit = s.lower(), 0, 0
    while i + 3 <= len(low):
        step = 0
        if low[i:i + 3] in language.heads:
            step = next((n for n in range(min(language.longest, len(low) - i), 2, -1) if low[i:i + n] in language.words), 0)
        hit += step
        i += max(step, 1)
    return hit / max(1, len(low))


def mean_surprise(s: str, language: Language) -> float:
    """The mean surprise of the letter pairs of ``s``; 0 if it has none."""
    x = np.frombuffer(s.lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    x = np.where((x >= 97) & (x <= 122), x - 97, np.where(x > 127, 26, -1))
    both = (x[:-1] >= 0) & (x[1:] >= 0)
    return float(language.surprise[x[:-1][both], x[1:][both]].mean()) if both.any() else 0.0


def with_features(found: DataFrame, language: Language) -> DataFrame:
    """The findings with one column per name in FEATURES."""
    c = F.col("candidate")
    pairs = F.greatest(F.length(c) - 1, F.lit(1))
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / pairs
    shared = found.sparkSession.sparkContext.broadcast(language)

    @arrow_udf("struct<covered:double,surprise:double>")
    def letters(strings: pa.Array) -> pa.Array:
        known, values = shared.value, strings.to_pylist()
        return pa.StructArray.from_arrays([pa.array([f(s, known) for s in values], pa.float64()) for f in (coverage, mean_surprise)],
                                          ["covered", "surprise"])

    fake, names = rf"(?i)({FAKE})", rf"(?i)({NAMES})"
    return found.withColumn("of_letters", letters("candidate")).select(
        *found.columns, F.log1p(F.length(c)).alias("length"), share("(?=[a-z][a-z]).").alias("lower_lower"),
        share("(?=[A-Z][A-Z]).").alias("upper_upper"), share("(?=[0-9][0-9]).").alias("digit_digit"),
        share("(?=[a-z][A-Z0-9]|[A-Z][a-z0-9]|[0-9][A-Za-z]).").alias("changes"), share("[^A-Za-z0-9]").alias("other"),
        F.col("of_letters.surprise"), F.col("of_letters.covered"), (F.size(F.split("path", "/")) - 1).cast("double").alias("depth"),
        F.col("path").rlike(fake).cast("double").alias("path_fake"), F.col("before").rlike(names).cast("double").alias("named"),
        F.col("before").rlike(r"[:=]\s*[\"']?$").cast("double").alias("assigned"),
        F.concat_ws(" ", "before", "candidate", "after").rlike(fake).cast("double").alias("near_fake"),
        F.col("before").rlike(rf"(?i){DIGEST}\W{{0,4}}$").cast("double").alias("near_digest"))


def self_evident(found: DataFrame) -> DataFrame:
    """The findings that speak for themselves, with ``label`` 1.0 or 0.0."""
    c = F.col("candidate")
    fake = c.rlike(rf"(?i)({FAKE})") | (F.size(F.array_distinct(F.split(c, ""))) <= 3)
    known = F.lit(False)
    for p in KNOWN:
        known = known | c.rlike(p)
    given = F.col("before").rlike(GIVEN)
    label = F.when(fake | (c.rlike(r"^[A-Za-z]+$") & ~given), F.lit(0.0)).when(known | (c.rlike(HEX) & given), F.lit(1.0))
    return found.withColumn("label", label).where(F.col("label").isNotNull())


def labelled_contexts(spark) -> DataFrame:
    """The findings of CONTEXTS: CONTEXT_COPIES strings of each shape in each surrounding. The strings are
    digits of SHA-256 sums, cut or written out in the shape's alphabet."""
    rows = []
    for before, after, label, shapes in CONTEXTS:
        for shape in shapes.split():
            for k in range(CONTEXT_COPIES):
                raw = hashlib.sha256(f"{before}|{shape}|{k}".encode()).digest()
                kind, size = re.match(r"([a-z]+)(\d*)", shape).groups()
                if kind == "uuid":
                    candidate = str(uuid.UUID(bytes=raw[:16]))
                elif kind == "base":
                    candidate = base64.b64encode(raw).decode()[:int(size)]
                else:
                    letters = {"hex": "0123456789abcdef", "digits": string.digits, "letters": string.ascii_letters,
                               "mixed": string.ascii_letters + string.digits}[kind]
                    candidate = "".join(letters[b % len(letters)] for b in raw + hashlib.sha256(raw).digest())[:int(size)]
                rows.append((candidate, before, after, f"src/{k}" if k % 2 else "", label))
    return spark.createDataFrame(rows, "candidate string, before string, after string, path string, label double")


def usable(labelled: DataFrame) -> DataFrame:
    """The caller's findings with a candidate and a label of 0 or 1; null surroundings and paths are empty."""
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("before", "after", "path")]
    return labelled.where(F.col("candidate").isNotNull()).select(
        "candidate", *empty, F.col("label").cast("double").alias("label")).where(F.col("label").isin(0.0, 1.0))


def fit(labelled: DataFrame, language: Language, max_rows: int = MAX_ROWS):
    """The forest, or None without labels of both kinds. About ``max_rows`` rows train it, half of
    them of each label where there are as many."""
    pool = labelled.where(F.pmod(F.crc32(F.col("candidate").cast("binary")), F.lit(5)) != 0)
    n = {r["label"]: r["n"] for r in pool.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(n) != {0.0, 1.0}:
        return None
    chance = F.when(F.col("label") == 1, max_rows / 2 / n[1.0]).otherwise(max_rows / 2 / n[0.0])
    sample = with_features(pool.where(unit(SEED, F.col("candidate"), F.col("before")) < chance), language)
    rows = sample.select("label", "candidate", "before", *FEATURES).repartition(1).sortWithinPartitions(
        "candidate", "before", "label", *FEATURES)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label").fit(data)


def judge(found: DataFrame, forest, language: Language) -> DataFrame:
    """The findings with ``score``, the forest's probability of a secret."""
    if forest is None:
        return found.withColumn("score", F.lit(1.0))
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_features(found, language))
    return forest.transform(data).withColumn("score", vector_to_array("probability")[1]).select(*found.columns, "score")


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source",
                 added: DataFrame | None = None) -> DataFrame:
    """doc_id, path, start, candidate, before, after, score and is_secret of every candidate. ``labelled`` has
    candidate, before, after, path and label (1 a secret, 0 a false positive); rows without a candidate or a
    label teach nothing. Without it, the findings that speak for themselves are the labels. ``added`` are further
    labelled findings of the same form."""
    found = checkpoint(candidates(docs, path))
    language = dictionary(docs)
    labelled = usable(self_evident(found) if labelled is None else labelled)
    forest = fit(labelled if added is None else labelled.unionByName(usable(added)), language)
    return judge(found, forest, language).withColumn("is_secret", F.col("score") >= 0.5)


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    """All findings; the secrets themselves are given by their SHA-256 alone."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return scan_secrets(docs, added=labelled_contexts(spark)).select(
        "doc_id", "start", F.length("candidate").alias("length"), F.sha2(F.col("candidate").cast("binary"), 256).alias("sha256"),
        F.round("score", 6).alias("score"), "is_secret")
