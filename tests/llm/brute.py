"""Plain-Python versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def components(docs, percent=75):
    """{row number: smallest doc_id of its component} for (doc_id, text) rows."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(docs)):
        members[find(i)].append(i)
    out = {}
    for group in members.values():
        ids = [docs[i][0] for i in group if docs[i][0] is not None]
        for i in group:
            out[i] = docs[i][0] if not sets[i] else min(ids, default=None)
    return sets, out


def without_repeats(texts, width=35):
    """(words, removed, kept) of each text."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        stay = [True] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                stay[i:i + width] = [False] * width
        kept = [x for x, s in zip(w, stay) if s]
        out.append((len(w), len(w) - len(kept), " ".join(kept)))
    return out


def cut_lines(docs, min_sites):
    """(lines, removed, text) of each (doc_id, source, text) row."""
    sites, holder = defaultdict(set), {}
    for doc, site, text in docs:
        for line in (text or "").split("\n"):
            line = line.strip(" \t\x0b\x0c\r")
            if line:
                sites[line].add(site)
                if doc is not None:
                    holder[line] = min(doc, holder.get(line, doc))
    out = []
    for doc, _, text in docs:
        if text is None:
            out.append((0, 0, None))
            continue
        lines = text.split("\n")
        bare = [x.strip(" \t\x0b\x0c\r") for x in lines]
        cut = [bool(b) and len(sites[b]) >= min_sites and (doc is None or holder.get(b) != doc) for b in bare]
        out.append((sum(map(bool, bare)), sum(cut), "\n".join(x for x, c in zip(lines, cut) if not c)))
    return out
