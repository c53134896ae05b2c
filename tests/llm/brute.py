"""Plain Python versions of the operators, on lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def lower(text: str) -> str:
    return text.encode().lower().decode()


def crc(doc_id, n: int) -> int:
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % n


def key(row):
    return tuple((x is not None, x) for x in row)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def line_dedup(docs, min_words):
    """doc index → deleted line numbers; rows equal in id and text are one."""
    first, gone = {}, defaultdict(set)
    seqs = {}
    for doc_id, text in docs:
        lines = [(p, x) for p, x in enumerate((text or "").split("\n")) if re.search(r"[^ \t\n\x0b\f\r]", x)]
        seqs[doc_id, text or ""] = lines
    for doc in sorted(seqs, key=lambda d: (d[0] is not None, d[0] or 0, hash_order(d[1]))):
        lines = seqs[doc]
        sizes = [len(re.findall(r"[^ \t\n\x0b\f\r]+", x)) for _, x in lines]
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(sizes[a:b]) >= min_words:
                    run = tuple(x for _, x in lines[a:b])
                    if first.setdefault(run, (doc, a)) != (doc, a):
                        gone[doc].update(p for p, _ in lines[a:b])
    return gone


def hash_order(text):
    """Only ties of ids need the text's own order; tests avoid such ties."""
    return text


def contamination(docs, items, width=10):
    def tokens(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))

    wins = defaultdict(set)
    for item, text in items:
        ws = tokens(text)
        for i in range(max(1, len(ws) - width + 1) if ws else 0):
            wins[tuple(ws[i: i + width])].update([] if item is None else [str(item)])
    out = []
    for doc_id, text in docs:
        ws, hit, found = tokens(text), set(), set()
        for size in {len(w) for w in wins}:
            for i in range(len(ws) - size + 1):
                if (w := tuple(ws[i: i + size])) in wins:
                    hit.update(range(i, i + size))
                    found |= wins[w]
        names = ",".join(sorted(found))
        out.append((doc_id, len(ws), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def shingles(text, size):
    ws = words(text)
    return {tuple(ws[i: i + size]) for i in range(len(ws) - size + 1)} if len(ws) >= size else {tuple(ws)} if ws else set()


def jaccard(docs):
    sets = [shingles(t, 4) for _, t in docs]
    group = list(range(len(docs)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                group[top(i)] = top(j)
    low = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            low[top(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        found = low[top(i)]
        out.append((doc_id, len(sets[i]), (min(found) if found else None) if sets[i] else doc_id))
    return out


def language_model(docs, mu):
    def tokens(text):
        return [*words(text), ""]

    one, two, before = Counter(), Counter(), Counter()
    for doc_id, text in docs:
        if crc(doc_id, 10):
            ts = tokens(text)
            one.update(ts)
            for a, b in zip([None, *ts[:-1]], ts, strict=True):
                two[a, b] += 1
                before[a] += 1
    n, v = sum(one.values()), len(one)

    def p(w):
        return (one[w] + 0.1) / (n + 0.1 * (v + 1))

    out = []
    for doc_id, text in docs:
        ts = tokens(text)
        score = sum(math.log10((two[a, b] + mu * p(b)) / (before[a] + mu)) for a, b in zip([None, *ts[:-1]], ts, strict=True))
        out.append((doc_id, crc(doc_id, 10) == 0, len(ts), sum(one[w] > 0 for w in ts), n, sum(math.log10(p(w)) for w in ts), score))
    return out


def encoded(docs, tokenizer, end=1):
    found = tokenizer.encode_batch([t or "" for _, t in docs], add_special_tokens=False)
    return [[*x.ids, end] for x in found]


def id_crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def collocations(docs, threshold=30, limit=2000):
    """docs: (doc_id, text, lang); rows of (lang, rank, phrase, a, l, r, n, score)."""
    count, total = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            ws = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(ws)
            for size in range(1, 5):
                count[lang].update(ws[i: i + size] for i in range(len(ws) - size + 1))
    out = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if a >= threshold and len(p) > 1}
        kept = []
        for p, a in candidates.items():
            inside = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= 80 * a for b in inside):
                score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return out


def hard_negatives(rows, every=100):
    """rows: (vec_id, embedding, label); rows of the query's result."""
    good = set()
    for vec_id, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
            good.add((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    order = sorted(good, key=lambda r: (r[0] is None, r[0], r[1], r[2]) if r[0] is not None else (True, 0, r[1], r[2]))

    def ranked(anchor, same):
        found = [(-sum(a * b for a, b in zip(anchor[2], r[2], strict=False)), i, r) for i, r in enumerate(order) if r != anchor and (r[1] == anchor[1]) == same]
        return [(-s, r[0]) for s, _, r in sorted(found, key=lambda x: x[:2])]

    out = []
    for anchor in order:
        if anchor[0] is not None and anchor[0] % every == 0:
            others = ranked(anchor, False)
            for score, positive in ranked(anchor, True)[:5]:
                window = [(s, i) for s, i in others if 30 * score <= 100 * s <= 90 * score][:10]
                out += [(anchor[0], positive, k, i, score, s) for k, (s, i) in enumerate(window, 1)]
    return out


def ftrl(rows, labels, passes, alpha, beta, l1, l2):
    """FTRL-proximal logistic regression on rows of {place: value}, one
    coordinate at a time; {place: weight}."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(passes):
        for row, y in zip(rows, labels, strict=True):
            w = {i: weight(i) for i in row}
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(w[i] * x for i, x in row.items())))))
            for i, x in row.items():
                g = (p - y) * x
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def quality_grams(text):
    """The n-grams that the classifier counts, as tuples: words, word forms with
    the distance of a word's last occurrence among the four before, and runs."""
    ws = re.split(r"[ \t\n\x0b\f\r]+", text)
    lowered = [w.lower() for w in ws]
    forms = []
    for i, w in enumerate(ws):
        form = re.sub(r"[0-9]+", "0", re.sub(r"[a-zß-öø-ÿ]+", "a", re.sub(r"[A-ZÀ-ÖØ-Þ]+", "A", w)))
        forms.append((form, *(back for back in (1, 2, 3, 4) if i >= back and lowered[i - back] == lowered[i])))
    out = []
    for i in range(len(ws)):
        out += [("word", lowered[i]), ("form", forms[i])]
        out += [("words", *lowered[max(0, i - 1): i + 1]), ("forms 2", *forms[max(0, i - 1): i + 1]), ("forms 3", *forms[max(0, i - 2): i + 1])]
    return out
