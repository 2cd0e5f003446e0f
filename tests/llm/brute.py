"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def find(parent, x):
    while parent.setdefault(x, x) != x:
        x = parent[x]
    return x


def join(parent, x, y):
    x, y = find(parent, x), find(parent, y)
    if x != y:
        parent[max(x, y)] = min(x, y)


def alnum(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def lines(pages, ratio, least):
    """pages: [(host, text)]; the cleaned text, lines, and dropped lines of each."""
    total, holding = {}, {}
    for host, text in pages:
        total[host] = total.get(host, 0) + 1
        for line in set((text or "").split("\n")) if text is not None else ():
            if SPACED.search(line):
                holding[host, line] = holding.get((host, line), 0) + 1
    bad = {k for k, n in holding.items() if n >= least and n > ratio * total[k[0]]}
    out = []
    for host, text in pages:
        if text is None:
            out.append((None, 0, 0))
            continue
        rows = text.split("\n")
        kept = [r for r in rows if (host, r) not in bad]
        out.append(("\n".join(kept), len(rows), len(rows) - len(kept)))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    text = text or ""
    w = SPACED.findall(text)
    n = len(w)
    places = {}
    for i in range(n - 2):
        places.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + d for p in places.values() if len(p) > 1 for i in p for d in range(3)}
    rows = [r for r in text.split("\n") if SPACED.search(r)]
    dup, sym, chars = len(rows) - len(set(rows)), sum(c in "#*$%&|<>" for c in text), sum(map(len, w))
    base = n < 50 or 100 * len(covered) > 50 * n
    shouted = sum(bool(re.fullmatch(r"[A-Z][A-Z!.,?;:]{2,}", x)) for x in w)
    fails = base or sym > 0.1 * n or dup > 0.4 * len(rows) or chars < 3 * n or chars > 10 * n or shouted > 0.3 * n
    return n, chars, sym, dup, len(covered), base, not fails


def fingerprint(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = SPACED.findall(w)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, bits=4):
    """rows: [(id, fp)]; the smallest id that each fingerprint reaches."""
    parent, by_id = {}, {}
    fps = sorted({f for _, f in rows})
    for i, a in enumerate(fps):
        for b in fps[i:]:
            if (a ^ b).bit_count() <= bits:
                join(parent, a, b)
    for i, f in rows:
        if i is not None:
            join(parent, by_id.setdefault(i, f), f)
    low = {}
    for i, f in rows:
        if i is not None:
            low[find(parent, f)] = min(i, low.get(find(parent, f), i))
    return [low.get(find(parent, f)) for _, f in rows]


def contamination(text, items):
    """items: [(id, text)]; n_words, n_hit, n_items, sha256, contaminated."""
    w, hit, found, n_items = alnum(text), set(), set(), 0
    for item, passage in items:
        p = alnum(passage)
        m = min(13, len(p))
        windows = {tuple(p[i : i + m]) for i in range(len(p) - m + 1)} if m else set()
        own = [i for i in range(len(w) - m + 1) if m and tuple(w[i : i + m]) in windows]
        hit.update(j for i in own for j in range(i, i + m))
        if own and item is not None:
            found.add(str(item))
    sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)


def passages(docs, match=100):
    """docs: [(key, text)] with keys in order; (n_bytes, n_removed, n_spans, sha256) by key."""
    seen, out = set(), {}
    for key, text in docs:
        if key in out:
            continue
        b = (text or "").encode()
        mask = bytearray(len(b))
        for p in range(len(b) - match + 1):
            w = b[p : p + match]
            if w in seen:
                mask[p : p + match] = b"\1" * match
            seen.add(w)
        kept = bytes(x for x, m in zip(b, mask) if not m)
        runs = sum(mask[j] and (j == 0 or not mask[j - 1]) for j in range(len(mask)))
        out[key] = (len(b), sum(mask), runs, hashlib.sha256(kept).hexdigest())
    return out


def licences(text, phrases, templates, least=0.8):
    """n_words, n_base, first, last, base labels, labels, score."""
    w = alnum(text)
    places = [(label, i) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    found, best = set(), 0.0
    step = max((len(t.split()) for _, t in templates), default=1)
    for start in range(0, len(w), step):
        block = set(w[start : start + 2 * step])
        for label, t in templates:
            t = set(t.split())
            share = len(block & t) / len(t)
            if share >= least:
                found.add(label)
                best = max(best, share)
    base, at = {x for x, _ in places}, [i for _, i in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if at else best


def near_items(text, items, slop=10, share=0.5, size=3):
    """Number of items of whose terms a share stands in the text at shifts of two neighbouring bins."""
    w, found = alnum(text), 0
    for item in items:
        t = alnum(item)
        k = min(size, len(t))
        places = [t[i : i + k] for i in range(len(t) - k + 1)] if t else []
        bins = {}
        for place, term in enumerate(places):
            for at in range(len(w) - k + 1):
                if w[at : at + k] == term:
                    low = (at - place) // (slop + 1)
                    bins.setdefault(low, set()).add(place)
                    bins.setdefault(low - 1, set()).add(place)
        found += any(len(b) >= share * len(places) for b in bins.values())
    return found
