"""Plain Python versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(_LOWER) if lower else text)


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def remainder(doc_id, divisor):
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % divisor


def exact(rows):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    groups = defaultdict(list)
    for (doc_id, _), text in zip(rows, normal):
        groups[text].append(doc_id)
    out = []
    for (doc_id, _), text in zip(rows, normal):
        ids = [i for i in groups[text] if i is not None]
        keep = min(ids) if ids else None
        out.append((doc_id, keep, len(groups[text]), doc_id == keep, sha(text)))
    return out


def near(rows):
    sets = []
    for _, text in rows:
        w = words(text, lower=True)
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    label = {doc_id: doc_id for doc_id, _ in rows if doc_id is not None}
    links = [
        (a[0], b[0])
        for i, a in enumerate(rows) for j, b in enumerate(rows)
        if i < j and a[0] is not None and b[0] is not None and sets[i]
        and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return [
        (d, len(s), None if d is None else label[d], d is None or label[d] == d)
        for (d, _), s in zip(rows, sets)
    ]


def substrings(rows, window=20):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for doc_id, text in ordered:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def lines(rows, least=8, letters=16):
    """For rows with distinct ids."""
    places = defaultdict(list)
    for doc_id, text in rows:
        if doc_id is not None and text is not None:
            for at, line in enumerate(text.split("\n")):
                w = tuple(x for x in re.split("[ \t\x0b\x0c\r]+", line) if x)
                if w:
                    places[w].append((doc_id, at))
    first = {w: min(p) for w, p in places.items()}
    gone, copies, close = defaultdict(set), Counter(), Counter()
    # Many words are compared by words, few by characters, too few characters not at all.
    wordy = [w for w in first if len(w) >= least]
    lettered = {w: list(" ".join(w)) for w in first if len(w) < least and len(" ".join(w)) >= letters}
    for w, found in places.items():
        near = any(first[v] < first[w] and _one_edit(list(v), list(w)) for v in wordy) if len(w) >= least else (
            w in lettered and any(first[v] < first[w] and _one_edit(u, lettered[w]) for v, u in lettered.items())
        )
        for place in found:
            if place > first[w]:
                copies[place[0]] += 1
            elif near:
                close[place[0]] += 1
            else:
                continue
            gone[place[0]].add(place[1])
    out = []
    for doc_id, text in rows:
        if text is None:
            out.append((doc_id, None, 0, 0, 0))
            continue
        own = text.split("\n")
        kept = "\n".join(x for i, x in enumerate(own) if i not in gone[doc_id])
        out.append((doc_id, kept, len(own), copies[doc_id], close[doc_id]))
    return out


def katz(rows, training, words_model, pairs_model):
    """Scores by the given discounts, and the model's probability as a function."""
    import numpy as np

    tokens = [[*words(text, lower=True), None] for _, text in rows]
    uni, pair, context = Counter(), Counter(), Counter()
    for own, train in zip(tokens, training):
        if train:
            before = "<begin>"
            for w in own:
                uni[w] += 1
                pair[before, w] += 1
                context[before] += 1
                before = w

    def counted(c):
        return [sum(v == r for v in c.values()) for r in range(1, 7)] + [len(c), sum(c.values())]

    ones, twos = words_model(counted(uni)), pairs_model(counted(pair))
    share = lambda w: float(ones.share(np.array([uni[w]]))[0])
    after = lambda c: float(twos.of(np.array([c]))[0])
    following = defaultdict(list)
    for (v, w), c in pair.items():
        following[v].append((w, c))
    back = {
        v: (1 - sum(after(c) for _, c in own) / context[v]) / (1 - sum(share(w) for w, _ in own))
        for v, own in following.items()
    }

    def probability(v, w):
        c = pair[v, w]
        return after(c) / context[v] if c else back.get(v, 1.0) * share(w)

    n, types = sum(uni.values()), len(uni)
    out = []
    for (doc_id, _), own in zip(rows, tokens):
        score, base, before = 0.0, 0.0, "<begin>"
        for w in own:
            score += math.log10(probability(before, w))
            base += math.log10((uni[w] + 0.5) / (n + 0.5 * (types + 1)))
            before = w
        out.append((doc_id, len(own), sum(uni[w] > 0 for w in own), n, base, score))
    return out, probability, following, uni


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(_LOWER))


def search(rows, items, top=20):
    """Scores every document for every item."""
    docs = [(doc_id, Counter(terms(text))) for doc_id, text in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item_id, text in items:
        asked = Counter(terms(text))
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in asked}
        found = []
        for doc_id, c, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(k * weight[t] * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, k in asked.items())
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(found)[:top], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return out


def trie(turns):
    """The nodes of the trie of rebuilt conversations, by lists of turns."""
    own = defaultdict(list)
    for conv_id, turn, role, text in sorted(
        (t for t in turns if t[0] is not None),
        key=lambda t: (t[0], t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""),
    ):
        own[conv_id].append((role or "", text or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        line = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + said[h:])  # the remainder has the sign of c
        for depth in range(len(line) + 1):
            members[line[:depth]].append(c)
        ends[line].append(c)
    children = defaultdict(list)
    for line in members:
        if line:
            children[line[:-1]].append(line)

    def below(line):
        leaves = 0 if children[line] else 1
        saved = (len(members[line]) - 1) * len(line[-1][1]) if line else 0
        for child in children[line]:
            more = below(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    return [
        (min(m), len(line), min(members[line[:-1]]) if line else None, len(m), len(children[line]), *below(line),
         sha(",".join(map(str, sorted(ends[line])))))
        for line, m in members.items()
    ]
