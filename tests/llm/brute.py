"""Slow, plain versions of the operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def classes(nodes, links):
    """Smallest node reachable from each."""
    of = {n: n for n in nodes}

    def root(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        of[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(docs, k, percent):
    """{doc_id: (n_shingles, component_id)} of documents with distinct ids."""
    sets = {i: shingles(t, k) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    links = []
    for i, s in sets.items():
        for j, shared in Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * shared >= percent * (len(s) + len(sets[j]) - shared):
                links.append((i, j))
    of = classes(sets, links)
    return {i: (len(s), of[i]) for i, s in sets.items()}


def leaks(docs, items, k, least):
    sets = [(i, shingles(t, k)) for i, t in items if len(words(t)) >= k]
    out = set()
    for doc_id, text in docs:
        have = shingles(text, k) if len(words(text)) >= k else set()
        out |= {(doc_id, i) for i, s in sets if len(s & have) >= least * len(s) - 1e-9}
    return out


def removed(docs, length):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256)}; ids are distinct."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        cut = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                cut[p : p + length] = b"\1" * length
            else:
                seen.add(data[p : p + length])
        kept = bytes(c for c, x in zip(data, cut, strict=True) if not x)
        spans = sum(1 for p, x in enumerate(cut) if x and (p == 0 or not cut[p - 1]))
        out[doc_id] = (len(data), sum(cut), spans, hashlib.sha256(kept).hexdigest())
    return out


def near_vectors(rows, cosine):
    """{vec_id: (n_links, component_id)} from (vec_id, vector, label)."""
    fine = [(i, np.array(v, float), k) for i, v, k in rows if v and k is not None and None not in v]
    fine = [(i, v / np.linalg.norm(v), k) for i, v, k in fine if np.isfinite(v).all() and v.any()]
    links = []
    for n, (i, v, k) in enumerate(fine):
        links += [(i, j) for j, w, m in fine[:n] if m == k and len(w) == len(v) and v @ w >= cosine]
    of, n = classes([r[0] for r in rows], links), Counter(x for pair in links for x in pair)
    return {r[0]: (n[r[0]], of[r[0]]) for r in rows}


def targets(sizes, weights=(5, 2, 1)):
    """{source: target} from {source: words}; null (None) comes last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        share = (total - sum(capped.values())) / max(1, sum(weight[s] for s in open_))
        over = [s for s in open_ if share * weight[s] > 2 * sizes[s]]
        if not over:
            return {**capped, **{s: share * weight[s] for s in open_}}
        capped.update({s: 2 * sizes[s] for s in over})


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        twice = int(c) * (1 + i % 2)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def personal(text):
    t = text or ""
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]


ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(text):
    t, kinds = text or "", ("assign", "access", "hex")
    out = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


def spelled(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
