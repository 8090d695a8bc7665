"""Plain Python versions of the contracts, row by row, to test the queries against."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha256(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def fold(doc_id, folds):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def lm_base(docs):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score."""
    tokens = [SPACE_WORD.findall((t or "").translate(AZ)) + [None] for _, t in docs]
    counts = Counter()
    for (i, _), words in zip(docs, tokens):
        if fold(i, 7) != 2:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return [
        (
            i,
            fold(i, 7) == 2,
            len(words),
            sum(counts[w] > 0 for w in words),
            n,
            sum(log10((counts[w] + 1) / (n + v + 1)) for w in words),
        )
        for (i, _), words in zip(docs, tokens)
    ]


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = FOLD_WORD.findall((text or "").translate(AZ))
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i : i + 10])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        words = FOLD_WORD.findall((text or "").translate(AZ))
        hit, found = set(), set()
        for n in lengths:
            for at in range(len(words) - n + 1):
                if tuple(words[at : at + n]) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[tuple(words[at : at + n])]
        out.append((i, len(words), len(hit), len(found), sha256(",".join(sorted(found))), bool(hit)))
    return out


ASSIGN = re.compile(
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(docs):
    out = []
    for i, text in docs:
        text = text or ""
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
        kinds = Counter(k for _, k, _ in spans)
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        out.append((i, kinds[0], kinds[1], kinds[2], sha256(listed)))
    return out


def quality(docs):
    out = []
    for i, text in docs:
        text = text or ""
        words = SPACE_WORD.findall(text)
        lines, seen, dup = [x for x in text.split("\n") if SPACE_WORD.search(x)], set(), 0
        for line in lines:
            dup += line in seen
            seen.add(line)
        at = defaultdict(list)
        for k in range(len(words) - 4):
            at[tuple(words[k : k + 5])].append(k)
        covered = {k + j for starts in at.values() if len(starts) > 1 for k in starts for j in range(5)}
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text)
        out.append((i, len(words), sum(map(len, words)), symbols, dup, len(covered), failed))
    return out


def fingerprint(text):
    words = (text or "").translate(AZ)
    words = SPACE_WORD.findall(words)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(docs):
    """doc_id, fingerprint, component_id."""
    prints = [fingerprint(t) for _, t in docs]
    a = np.array(prints, dtype=np.uint64)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4):
            root[find(int(j))] = find(i)
    least = {}
    for k, (i, _) in enumerate(docs):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, f"{prints[k]:016x}", least[find(k)]) for k, (i, _) in enumerate(docs)]


def targets(rows):
    """source -> (size, target) of (source, text) rows."""
    size = defaultdict(int)
    for source, text in rows:
        size[source] += len(SPACE_WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    held, total = set(), 1.5 * sum(size.values())
    while True:
        left = total - sum(2 * size[s] for s in held)
        level = left / max(1e-300, sum(w for s, w in weight.items() if s not in held))
        over = {s for s in size if s not in held and level * weight[s] > 2 * size[s] + 1e-9}
        if not over:
            return {s: (size[s], 2.0 * size[s] if s in held else level * weight[s]) for s in size}
        held |= over


def repeats(docs, n=50):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    first = {}
    for i, text in docs:
        b = (text or "").encode()
        rank = (i is None, i or 0)
        for k in range(len(b) - n + 1):
            w = b[k : k + n]
            if w not in first or rank < first[w]:
                first[w] = rank
    out = []
    for i, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - n + 1):
            if first[b[k : k + n]] < (i is None, i or 0):
                gone[k : k + n] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        starts = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(b), int(gone.sum()), starts, sha256(kept)))
    return out


def similar(p, q):
    """Whether two passages of 50 words are near-duplicates: Jaccard 0.8 or more over five-word shingles."""
    a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (p, q))
    return 5 * len(a & b) >= 4 * len(a | b)


def passages(docs, n=50):
    """doc_id -> (words in a passage with a near-duplicate in a smaller document, smallest id of the class)."""
    words = {i: SPACE_WORD.findall((t or "").translate(AZ)) for i, t in docs}
    root = {i: i for i in words}

    def find(x):
        return x if root[x] == x else find(root[x])

    out = {i: set() for i in words}
    for late in words:
        for early in (i for i in words if i < late):
            at = defaultdict(list)
            for k in range(len(words[early]) - 4):
                at[tuple(words[early][k : k + 5])].append(k)
            shared = [at[tuple(words[late][k : k + 5])] for k in range(len(words[late]) - 4)]
            for f in range(len(words[late]) - n + 1):
                if sum(map(bool, shared[f : f + n - 4])) < 9:
                    continue
                starts = {g for js in shared[f : f + n - 4] for j in js for g in range(j - n + 5, j + 1)}
                p = words[late][f : f + n]
                if any(0 <= g <= len(words[early]) - n and similar(p, words[early][g : g + n]) for g in sorted(starts)):
                    out[late].update(range(f, f + n))
                    a, b = sorted((find(late), find(early)))
                    root[b] = a
    return {i: (out[i], find(i)) for i in words}


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(docs, min_docs=10, top=10):
    """Rows ``(lang, source, part, item, value, rank)`` of documents ``(text, lang, source)``."""
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        words = TERM.findall((text or "").translate(AZ))
        seen[lang or ""].update(set(words))
        counts[lang or "", source or ""].update(words)
    out = []
    for lang in {each for each, _ in counts}:
        kept = sorted((t for t, n in seen[lang].items() if n >= min_docs), key=str.encode)

        def shares(count):
            n = sum(count[t] for t in kept)
            return [1 + 10**9 * (count[t] + 2) // (n + 2 * len(kept)) for t in kept]

        def far(p, q):
            return (p - q) ** 2 // (p + q)

        groups = {s: c for (each, s), c in counts.items() if each == lang}
        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pair = [(-sum(map(far, p[s], p[o])), o.encode()) for o in groups if o != s]
            term = [(-far(a, b), t.encode()) for t, a, b in zip(kept, p[s], q) if groups[s][t] and a > b]
            for part, rows, most in (("pair", pair, None), ("term", term, top)):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(sorted(rows)[:most], 1)]
    return out


def near_duplicates(docs, n=4):
    """Rows ``(doc_id, n_shingles, component_id)`` of documents ``(doc_id, text)``, all pairs that share a shingle."""
    sets = []
    for _, text in docs:
        words = SPACE_WORD.findall((text or "").translate(AZ))
        sets.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    parent = list(range(len(docs)))

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    holders = defaultdict(list)
    for i, grams in enumerate(sets):
        common = Counter(j for g in grams for j in holders[g])
        for g in grams:
            holders[g].append(i)
        for j, c in common.items():
            if 100 * c >= 80 * (len(grams) + len(sets[j]) - c):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def whiten(rows, top=4):
    """``{(vec_id, component): [(n, deviation, whitened, explained), ...]}`` by a dense eigenvector solver."""
    kept = [
        (i, np.floor(256 * np.array(v, dtype=float)).astype(int))
        for i, v in rows
        if v and all(c is not None and np.isfinite(c) for c in v)
    ]
    fit = np.array(sorted({tuple(int(c) for c in x) for _, x in kept}))
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    e, vectors = e[::-1], vectors[:, ::-1]
    m = min(top, int((e > 1e-12 * e.sum()).sum()))
    out = defaultdict(list)
    for i, x in kept:
        w = (x - s / n) @ vectors[:, :m] / np.sqrt(e[:m])
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s))
        for k in range(m):
            out[i, k + 1].append((n, deviation, w[k], e[k] / e.sum()))
    return out
