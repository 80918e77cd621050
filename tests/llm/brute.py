"""Plain versions of what the queries return, over rows of (doc_id, text); for tests only."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=WORDS):
    return pattern.findall((text or "").translate(UP))


def lm_base(rows):
    """doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)."""
    toks = [(i, [*words(t), None]) for i, t in rows]
    crc = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10
    c = Counter(w for i, ws in toks if crc(i) != 0 for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (crc(i) == 0, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in toks}


def lm_scores(rows, order=3, rounds=12, powers=48):
    """doc_id: log10 probability by deleted interpolation; weights by the same rule, from dictionaries of counts."""
    crc = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10
    toks = [(i, crc(i), ["<s>"] * (order - 1) + words(t) + [None]) for i, t in rows]
    grams = lambda ws, k: [tuple(ws[p - k + 1 : p + 1]) for p in range(order - 1, len(ws))]
    every, without = ([Counter(g for _, c, ws in toks if c not in skip for g in grams(ws, k)) for k in range(1, order + 1)] for skip in ((0,), (0, 1)))
    types = len(every[0])

    def contexts(counts):
        out = [Counter() for _ in counts]
        for k, c in enumerate(counts):
            for g, n in c.items():
                out[k][g[:-1]] += n
        return out

    def model(counts):
        behind = contexts(counts)

        def tokens(ws):
            for p in range(order - 1, len(ws)):
                f, bucket = [1 / (types + 1), 0, *[0] * (order - 1)], (0, 0)
                for k in range(1, order + 1):
                    g = tuple(ws[p - k + 1 : p + 1])
                    if n := behind[k - 1][g[:-1]]:
                        f[k], bucket = counts[k - 1][g] / n, (k, min(n.bit_length() - 1, powers - 1) if k > 1 else 0)
                yield f, bucket

        return tokens

    share = lambda x: [v / sum(x) for v in x]
    equal = {j: share([float(k <= j) for k in range(order + 1)]) for j in range(order + 1)}
    weights = {(j, p): equal[j] for j in range(order + 1) for p in range(powers)}
    held = [x for _, c, ws in toks if c == 1 for x in model(without)(ws)]
    for _ in range(rounds):
        used = {b: [0.0] * (order + 1) for b in weights}
        for f, b in held:
            mixed = [x * w for x, w in zip(f, weights[b])]
            for k, x in enumerate(mixed):
                used[b][k] += x / sum(mixed)
        new = {}
        for j in equal:
            of_j = [b for b in used if b[0] == j]
            prior = share([sum(used[b][k] for b in of_j) + 1e-6 * equal[j][k] for k in range(order + 1)])
            for b in of_j:
                new[b] = share([x + p for x, p in zip(used[b], prior)])
        done = max(abs(x - y) for b in new for x, y in zip(new[b], weights[b])) < 1e-3
        weights = new
        if done:
            break
    return {i: sum(math.log10(sum(x * w for x, w in zip(f, weights[b]))) for f, b in model(every)(ws)) for i, _, ws in toks}


def shingles(text, n):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def jaccard(rows, n=4, percent=85):
    """doc_id: (set size, component)."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holds = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holds[x].append(k)
    for k, (i, s) in enumerate(sets):
        shared = Counter(j for x in s for j in holds[x] if j < k)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                a, b = sorted((root(i), root(sets[j][0])))
                up[b] = a
    return {i: (len(s), root(i)) for i, s in sets}


def line_dedup(rows, least=10):
    """doc_id: (lines, dropped, sha256 of what stays)."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UP)
    owners = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                owners[key(x)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < least or len(owners[key(x)]) < 2 or min(owners[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest())
    return out


def contamination(rows, items, span=13):
    """doc_id: (words, hit, items, sha256 of the items, contaminated)."""
    windows = defaultdict(set)
    for i, t in items:
        w = words(t, BENCH_WORDS)
        for k in range(max(1, len(w) - span + 1) if w else 0):
            windows[tuple(w[k : k + span])].add(i)
    out = {}
    for i, t in rows:
        w, hit, found = words(t, BENCH_WORDS), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def sentencepiece(rows, path):
    import sentencepiece as sp

    m = sp.SentencePieceProcessor(model_file=path)
    out = {}
    for i, t in rows:
        ids = m.encode(t or "")
        out[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(m.decode(ids).encode()).hexdigest())
    return out


def token_counts(rows, path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    n = [len(t.encode(x or "", add_special_tokens=False).ids) for _, x in rows]
    return {i: (len((x or "").encode()), k, k > 2048) for (i, x), k in zip(rows, n)}


def token_files(rows, path):
    import numpy as np
    from tokenizers import Tokenizer

    t, at, out = Tokenizer.from_file(path), 0, {}
    for i, x in sorted(rows):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        out[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    return out


def media(rows):
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        p = b + b" " * (-len(b) % 192 if b else 192)
        out[i] = (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
    return out


CHAT_ROLES = ("system", "user", "assistant")


def chat_cost(roles, model):
    """The least cost of a repair, by trying every way over all states (model: the operator's cost constants)."""
    after = {None: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
    cost = {None: 0}
    for r in roles:
        new = {}
        for s, c in cost.items():
            for k, name in enumerate(CHAT_ROLES):
                change = 0 if r == name else model.UNKNOWN[name] if r not in CHAT_ROLES else model.RELABEL[r, name]
                ways = [model.MERGE] if s == k else []
                ways += [0] if k in after[s] else []
                ways += [model.INSERT for m in after[s] if m != 0 and k in after[m]]
                for w in ways:
                    new[k] = min(new.get(k, 10**9), c + change + w)
        cost = new
    end = {None: 2, 0: 2, 1: 1, 2: 0}
    return min(c + model.INSERT * end[s] for s, c in cost.items())
