"""Plain Python versions of the training-data operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def near_duplicates(rows, percent=85):
    """[(doc_id, n_shingles, component_id, kept)] of [(doc_id, text)], in order."""
    sets = []
    for _, t in rows:
        w = SPACE_WORD.findall(lower(t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return out


def substrings(rows, window=35):
    """[(doc_id, n_words, n_removed, sha256)]"""
    docs = [SPACE_WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, docs):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def leaks(rows, items, window=10):
    """[(doc_id, n_words, n_hit, n_items, sha256, contaminated)]"""
    wanted = defaultdict(set)
    for item, t in items:
        w = LETTER_WORD.findall(lower(t or ""))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wanted[tuple(w[i:i + window])].add("" if item is None else str(item))
    lengths = {len(k) for k in wanted}
    out = []
    for d, t in rows:
        w = LETTER_WORD.findall(lower(t or ""))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if names := wanted.get(tuple(w[i:i + n])):
                    found |= names
                    hit.update(range(i, i + n))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def base_rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = SPACE_WORD.findall(text)
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {p for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def lost_words(rows, min_docs, max_share):
    """Words of each (doc_id, source, text) row in lines above the limit. Rows without an id are told apart
    by their text."""
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower()
    docs = defaultdict(set)
    holds = defaultdict(set)
    for d, s, t in rows:
        name = ("id", d) if d is not None else ("text", t or "")
        docs[s].add(name)
        for x in (t or "").split("\n"):
            if norm(x):
                holds[s, norm(x)].add(name)
    frequent = {k for k, v in holds.items() if len(v) > min_docs and len(v) > max_share * len(docs[k[0]])}
    return [sum(len(norm(x).split(" ")) for x in (t or "").split("\n") if (s, norm(x)) in frequent) for _, s, t in rows]


def targets(sizes, weights=(3, 1, 2)):
    """Exact targets of {source: size}, by repeated sharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = Fraction(3, 2) * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not full:
            out |= {s: level * w[s] for s in free}
            break
        for s in full:
            out[s] = Fraction(2 * sizes[s])
            left -= out[s]
        free -= full
    return out


def url_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host, path = lower(m[1]), m[2]
    fit = [(r, v) for r, v in rules
           if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith(r[r.index("/"):])]
    if not fit:
        return host, path, None, "allow"
    r, v = max(fit, key=lambda x: len(x[0]))
    return host, path, r, v


def crc(text):
    return None if text is None else zlib.crc32(text.encode())


def license_findings(text, templates, k=5, least=0.8):
    """[(template, start, end, containment)]: the text's places of a template's shingles, cut where the template's order
    falls back; a piece that holds enough of it is a finding, others are gathered until they do, what is left over counts
    to the last finding if it adds to it."""
    w, out = LETTER_WORD.findall(lower(text or "")), []
    for name, t in templates:
        tw = LETTER_WORD.findall(lower(t))
        size = min(k, len(tw))
        if not size:
            continue
        own = defaultdict(list)
        for i in range(len(tw) - size + 1):
            own[tuple(tw[i:i + size])].append(i)
        pieces, last = [], -1
        for i in range(len(w) - size + 1):
            at = own.get(tuple(w[i:i + size]))
            if at is None:
                continue
            ahead = [a for a in at if a > last]
            if not ahead or not pieces:
                pieces.append([])
                ahead = at
            last = ahead[0]
            pieces[-1].append(i)
        found, held = [], []
        for p in pieces:
            alone = len({tuple(w[i:i + size]) for i in p}) >= least * len(own)
            held = p if alone else held + p
            if len({tuple(w[i:i + size]) for i in held}) >= least * len(own):
                found.append(held)
                held = []
        seen = lambda rows: {tuple(w[i:i + size]) for i in rows}
        if held and found and not seen(held) <= seen(found[-1]):
            found[-1] = found[-1] + held
        out += [(name, f[0], f[-1] + size, round(len(seen(f)) / len(own), 9)) for f in found]
    return out


def shards(rows, n_shards, seed=7):
    """[(key, shard, slot)] of [(key, doc_id, text, source)]: each source in the order of a hash, all rows by their fractional
    rank in it (ties: by source, null last), cut into runs of even lengths."""
    def place(doc_id, text):
        parts = [str(seed), *[str(v) for v in (doc_id, text) if v is not None]]
        return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:13], 16)

    by = defaultdict(list)
    for key, d, t, s in rows:
        by[s].append((place(d, t), d is not None, d or 0, t is not None, t or "", key))
    order = []
    for s, members in by.items():
        for r, m in enumerate(sorted(members, key=lambda m: m[:5])):
            order.append((Fraction(2 * r + 1, 2 * len(members)), s is None, s or "", m[5]))
    out, total = [], len(rows)
    for i, (_, _, _, key) in enumerate(sorted(order, key=lambda o: o[:3])):
        shard = i * n_shards // total
        out.append((key, shard, i - -(-shard * total // n_shards)))
    return out


def quality_scores(train, texts, epochs, alpha, beta, l1, l2):
    """Scores of ``texts`` by a regression fitted to [(text, label)], row after row: FTRL-proximal with one weight per
    n-gram (no hashing) and a bias."""
    def grams(text):
        words = re.findall(r"[!-/:-@\[-`{-~]|[^\x00-\x20!-/:-@\[-`{-~\x7f]+", text or "")
        count = Counter(("word", w) for w in words)
        count.update(("twice",) if a == b else ("pair", a, b) for a, b in zip(words, words[1:]))
        total = max(1, sum(count.values()))
        return {**{g: c / math.sqrt(total) for g, c in count.items()}, ("bias",): 1.0}

    z, n = Counter(), Counter()

    def weight(g):
        if abs(z[g]) <= l1:
            return 0.0
        return (math.copysign(l1, z[g]) - z[g]) / ((beta + math.sqrt(n[g])) / alpha + l2)

    def score(x):
        return 1 / (1 + math.exp(-sum(weight(g) * v for g, v in x.items())))

    rows = [(grams(t), y) for t, y in train]
    for _ in range(epochs):
        for x, y in rows:
            error = score(x) - y
            old = {g: weight(g) for g in x}
            for g, v in x.items():
                step = error * v
                z[g] += step - (math.sqrt(n[g] + step * step) - math.sqrt(n[g])) / alpha * old[g]
                n[g] += step * step
    return [score(grams(t)) for t in texts]
