"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        after, cut = texts[(i + 1) % len(texts)], len(t) // 4
        out.append(t[:len(t) - cut] + after[:cut])
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text, w = text or "", words(text)
    grams = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1
               for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(text.count(s) for s in "#*$%&|<>"), again, len(covered))


PATTERNS = (
    ("assign", re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*"""
                          r"""["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 1, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def secrets(text):
    found = [(m.start(), k, m.end(), name) for k, (name, p, group, least) in enumerate(PATTERNS)
             for m in p.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f"{name}:{start}:{end}" for start, _, end, name in sorted(found))


def base_scores(docs, held_out):
    """doc_id: (n_tokens, n_known, train_tokens, base_score); docs are (doc_id, text)."""
    tokens = {d: words((t or "").translate(SMALL)) + ["\n"] for d, t in docs}
    counts = collections.Counter(w for d, ws in tokens.items() if not held_out(d) for w in ws)
    total = sum(counts.values())
    return {d: (len(ws), sum(w in counts for w in ws), total,
                sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws))
            for d, ws in tokens.items()}


def remainder(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


class Groups(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def shingles(text):
    w = words((text or "").translate(SMALL))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def alike(a, b, percent=75):
    both = len(a & b)
    return bool(a and b) and 100 * both >= percent * (len(a) + len(b) - both)


def near_groups(docs):
    """doc_id: (n_shingles, component_id)"""
    sets = {d: shingles(t) for d, t in docs}
    groups, ids = Groups(), sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if alike(sets[a], sets[b]):
                groups.join(a, b)
    return {d: (len(sets[d]), groups.root(d)) for d in ids}


def left_lines(docs, shingles_of, least):
    """doc_id: the text without repeated lines; docs in order, texts not null."""
    first, places = {}, []
    for d, t in docs:
        for i, line in enumerate(t.split("\n")):
            if len(line.encode()) >= least:
                first.setdefault(line, (d, i))
                places.append((d, i, line))
    order = sorted(first, key=first.get)
    sets, groups = [shingles_of(x) for x in order], Groups()
    for i, a in enumerate(sets):
        for j in range(i):
            if alike(a, sets[j]):
                groups.join(i, j)
    number = {x: i for i, x in enumerate(order)}
    gone = {(d, i) for d, i, x in places if (d, i) != first[order[groups.root(number[x])]]}
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)
            for d, t in docs}


def prefix_nodes(turns):
    """Nodes as (conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, ends);
    turns are (conv_id, turn, role, text)."""
    own = collections.defaultdict(list)
    for c, n, role, text in turns:
        if c is not None:
            own[c].append((n is not None, n or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
    members, below = collections.defaultdict(list), collections.defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            below[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        n = len(members[path])
        leaves[path] = sum(leaves[k] for k in below[path]) or 1
        saved[path] = sum(saved[k] for k in below[path]) + (
            (n - 1) * len(words(path[-1][1])) if path else 0)
        ends = ",".join(str(c) for c in sorted(members[path]) if len(whole[c]) == len(path))
        out.append((min(members[path]), len(path), min(members[path[:-1]]) if path else None, n,
                    len(below[path]), leaves[path], saved[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def aligned(docs, encode_a, encode_b):
    """Rows of the alignment; the encoders give (id, bytes) of each token of a text."""
    found = []
    for _, text in docs:
        text = text or ""
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        whole = (" " + text).encode()
        if not text or not b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
            found.append(None)
            continue
        spans = []
        for tokens in (a, b):
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        both = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        ends = [{e: k + 1 for k, (_, _, e) in enumerate(side)} for side in spans]
        groups, done = [], (0, 0)
        for high in both:
            to = ends[0][high], ends[1][high]
            groups.append("|".join(",".join(str(i) for i, _, _ in side[x:y])
                                   for side, x, y in zip(spans, done, to)))
            done = to
        links, j = [], 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        found.append((len(a), len(b), len(both), links, ";".join(groups)))
    counts = collections.Counter(p for f in found if f for p in set(f[3]))
    best = collections.Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [(d, 0, 0, 0, 0, 0, 0, "") if f is None else
            (d, *f[:3], len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]),
             sum(counts[p] for p in f[3]), hashlib.sha256(f[4].encode()).hexdigest())
            for (d, _), f in zip(docs, found)]
