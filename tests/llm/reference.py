"""Plain single-process versions of the operators, for small tables."""
import hashlib
import itertools
import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k):
    words = WORD.findall((text or "").translate(UPPER_TO_LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def near_duplicates(docs, k, percent):
    """{doc_id: (n_shingles, component)}"""
    sets = {d: shingles(t, k) for d, t in docs}
    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    links = set()
    for a, b in {p for ds in by.values() for p in itertools.combinations(sorted(ds), 2)}:
        n = len(sets[a] & sets[b])
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            links.add((a, b))
    comp = components(sets, links)
    return {d: (len(s), comp[d]) for d, s in sets.items()}


def exact_groups(docs):
    """{doc_id: (keep_id, group_size, kept, sha)}"""
    groups = {}
    for d, t in docs:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(d)
    return {d: (min(g), len(g), d == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base_spans(text):
    """(start, kind number, end), ordered"""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(out)


def as_text(spans, kinds):
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)
