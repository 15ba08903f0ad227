"""Plain versions of what the operators compute, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict


def near_duplicates(rows, shingle, percent):
    """{row: (n_shingles, component_id)} by comparing the sets of all rows that share a shingle."""
    sets = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        n = len(words)
        sets.append({tuple(words[i : i + shingle]) for i in range(n - shingle + 1)} if n >= shingle else {tuple(words)} if n else set())
    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for s in own:
            holders[s].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s] if j < i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    return [(doc_id, len(sets[i]), min(ids[find(i)], default=None) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]


def _grams(text):
    """The 300 most frequent n-grams of one to three letters in words, a mark before and after each word; ties by code points."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    counts = Counter()
    for w in words:
        marked = [1, *(ord(c) + 2 for c in w), 1]
        counts.update((c,) for c in marked[1:-1])
        counts.update(zip(marked, marked[1:]))
        counts.update(zip(marked, marked[1:], marked[2:]))
    # a mark between two words ends one and begins the next
    code = lambda g: sum(c << 21 * i for i, c in enumerate(reversed(g)))
    return counts, lambda: [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:300]]


def languages(rows, is_held_out):
    """[(doc_id, lang_pred, score)] by out-of-place distance, from (doc_id, text, lang)."""
    total = defaultdict(Counter)
    for doc_id, text, lang in rows:
        if lang is not None and doc_id is not None and not is_held_out(doc_id):
            total[lang] += _grams(text)[0]
    code = lambda g: sum(c << 21 * i for i, c in enumerate(reversed(g)))
    ranks = {lang: {g: i for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:300])} for lang, c in total.items() if c}
    out = []
    for doc_id, text, _ in rows:
        own = _grams(text)[1]()
        if not own or not ranks:
            out.append((doc_id, "und", 0.0))
            continue
        off = {lang: sum(abs(r[g] - i) if g in r else 300 for i, g in enumerate(own)) for lang, r in ranks.items()}
        best = min(sorted(off), key=off.get)
        out.append((doc_id, best, 1 - off[best] / (300 * len(own))))
    return out


def removals(rows, length, keep_first):
    """[(doc_id, n_bytes, n_removed, n_spans, sha256)] from a dictionary of all strings of ``length`` bytes."""
    data = [(text or "").encode("utf-8", "surrogatepass") for _, text in rows]
    last = (1, 0)
    order = sorted(range(len(rows)), key=lambda i: (last if rows[i][0] is None else (0, rows[i][0])))
    places = defaultdict(list)
    for i in order:
        for s in range(len(data[i]) - length + 1):
            places[data[i][s : s + length]].append((i, s))
    covered = [bytearray(len(d)) for d in data]
    for found in places.values():
        if len(found) > 1:
            for i, s in found[1:] if keep_first else found:
                covered[i][s : s + length] = b"\1" * length
    out = []
    for i, (doc_id, _) in enumerate(rows):
        spans = len(re.findall(b"\1+", bytes(covered[i])))
        left = bytes(b for b, gone in zip(data[i], covered[i]) if not gone)
        out.append((doc_id, len(data[i]), sum(covered[i]), spans, hashlib.sha256(left).hexdigest()))
    return out
