"""Plain Python versions of the operators' definitions, and hand-made documents."""

import random
import re
from collections import defaultdict

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, spans string, key string, "
          "h long, p long, n long, root long, start long, block long, epoch int, doc string, tk long, t string, w string, item_id long")

_rng = random.Random(7)
VOCABULARY = ["".join(_rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(_rng.randint(2, 9))) for _ in range(400)]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def row(doc_id, text, source="a", lang="en"):
    """A document with further columns, whose names the operators use inside."""
    return (doc_id, text, lang, source, None if text is None else len(text), 1, False, "x", "k", 1, 2, 3, 4, 5, 6, 7, "d", 8, "t", "w", 9)


def edge_rows():
    long_text = prose(20_000, 1)
    return [
        row(1, None), row(2, ""), row(3, " \n\t "), row(4, "word"), row(5, prose(120, 2)), row(6, prose(120, 2)), row(6, prose(120, 2)),
        row(7, long_text, None, None), row(8, long_text + " end", "b", None), row(None, prose(60, 3), "a"), row(None, None, None),
        row(9, prose(40, 4) + "\n" + prose(40, 4) + " é ß 日本 😀", "z"), row(6, prose(90, 5)),
        row(10, "".join(VOCABULARY) * 3, "b"),
    ]


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_components(docs):
    """doc_id -> smallest doc_id reachable, over all pairs; docs: {doc_id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    holders, common = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        for k, b in enumerate(ids):
            for a in ids[:k]:
                common[a, b] += 1
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in docs}, {i: len(s) for i, s in sets.items()}


def removed_bytes(texts, length):
    """Per text, a mask of the bytes that a string starting elsewhere too covers."""
    first, starts = {}, defaultdict(set)
    for k, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            s = t[p:p + length]
            if s in first:
                starts[first[s][0]].add(first[s][1])
                starts[k].add(p)
            else:
                first[s] = (k, p)
    masks = []
    for k, t in enumerate(texts):
        m = bytearray(len(t))
        for p in starts[k]:
            m[p:p + length] = b"\1" * length
        masks.append(bytes(m))
    return masks


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in sorted(out))
