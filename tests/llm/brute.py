"""Plain versions of the corpus operators over small dictionaries of texts."""

import collections
import hashlib
import math
import re
import zlib

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


def sha(b):
    return hashlib.sha256(b).hexdigest()


def bpe(docs, ranks, pattern):
    import tiktoken
    e = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    out = {}
    for k, t in docs.items():
        ids = e.encode_ordinary(t or "")
        out[k] = (len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha((t or "").encode()))
    return out


def contamination(docs, items):
    wins = {}
    for i, t in items:
        w = ITEM_WORDS.findall(low(t))
        for p in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[p:p + 13]), set()).add(i)
    out = {}
    for k, t in docs.items():
        w = ITEM_WORDS.findall(low(t))
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in wins}:
            for p in range(len(w) - n + 1):
                if (x := tuple(w[p:p + n])) in wins:
                    found |= wins[x]
                    hit[p:p + n] = [True] * n
        h = sum(hit)
        out[k] = (len(w), h, len(found), sha(",".join(sorted(map(str, found))).encode()), h > 0 and 20 * h >= len(w))
    return out


def classes(docs, n=4, percent=85):
    s = {}
    for k, t in docs.items():
        w = SPACE_WORDS.findall(low(t))
        m = min(n, len(w))
        s[k] = {tuple(w[i:i + m]) for i in range(len(w) - m + 1)} if w else set()
    parent = {k: k for k in s}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    keys = sorted(s)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(s[a] & s[b])
            if both and 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: (len(s[k]), find(k)) for k in s}


def repeats(docs, length=200):
    data = {k: (t or "").encode() for k, t in docs.items()}
    seen = collections.Counter(b[i:i + length] for b in data.values() for i in range(len(b) - length + 1))
    out = {}
    for k, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[k] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def base_scores(docs):
    words = {k: SPACE_WORDS.findall(low(t)) + [""] for k, t in docs.items()}
    c = collections.Counter(w for k, x in words.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in x)
    total, kinds = sum(c.values()), len(c)
    return {k: (len(x), sum(c[w] > 0 for w in x), total, sum(math.log10((c[w] + 1) / (total + kinds + 1)) for w in x)) for k, x in words.items()}


def scores(docs, share=0.6):
    """Scores with exact word and pair counts, quantised as the filter quantises them."""
    words = {k: SPACE_WORDS.findall(low(t)) + [""] for k, t in docs.items()}
    train = [x for k, x in words.items() if zlib.crc32(str(k).encode()) % 7 != 2]
    one, two = collections.Counter(w for x in train for w in x), collections.Counter(p for x in train for p in zip([""] + x, x))
    top = sum(one.values()) + len(one) + 1

    def q(n):
        return n if n < 2 else 1.5 * 2 ** (n.bit_length() - 1)
    return {k: sum(math.log10(min(1, share * min(1, q(two[p]) / max(1, q(one[p[0]]))) + (1 - share) * (q(one[p[1]]) + 1) / top))
                   for p in zip([""] + x, x)) for k, x in words.items()}


def base_secrets(docs):
    kinds = [("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", 8), ("access", r"(AKIA[A-Z0-9]+)", 16), ("hex", r"([0-9a-f]+)", 32)]
    out = {}
    for key, t in docs.items():
        sp = sorted((m.start(), k, m.end()) for k, (name, p, least) in enumerate(kinds) for m in re.finditer(p, low(t) if name == "assign" else t or "") if len(m[1]) >= least)
        out[key] = (*[sum(x[1] == k for x in sp) for k in range(3)], sha(",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sp).encode()))
    return out


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(int(c) * 2, 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def personal(docs):
    def digits(s):
        return re.sub("[^0-9]", "", s)
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15)]
    out = {}
    for key, t in docs.items():
        sp = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, t or "") if ok(m[0]))
        out[key] = (*[sum(x[1] == k for x in sp) for k in range(4)], sha(",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sp).encode()))
    return out


def audit(docs, labels):
    """``docs``: (id, text, lang) rows; every order applied filter by filter."""
    import itertools
    said = {}
    for i, q, x in (r for r in labels if r[0] is not None):
        g = said.setdefault(i, [False, False])
        g[0] |= q == 1
        g[1] |= x == 1
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts = {}
    for i, t, lang in docs:
        t = t or ""
        w = SPACE_WORDS.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": re.search("[#$%&*|]", t) is not None, "E": i is not None and first[t] < i}
        parts.setdefault(lang or "", []).append((fails, *said.get(i, (False, False))))
    out = {}
    for part, rows in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = rows
            for k, f in enumerate(order, 1):
                gone, left = [r for r in left if r[0][f]], [r for r in left if not r[0][f]]
                total[f] += len(gone)
                out[part, "".join(order), k] = [len(left), len(gone), sum(r[0][f] for r in rows) - len(gone), sum(r[0][f] and sum(r[0].values()) == 1 for r in rows),
                                                sum(r[1] for r in gone), sum(r[2] for r in gone), f]
        for key, row in out.items():
            if key[0] == part:
                row[6] = total[row[6]]
    return {k: tuple(v) for k, v in out.items()}


def simhash(text):
    import xxhash
    w = low(text).encode().split()
    s = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def hamming_classes(fps):
    """Smallest key reachable over links of at most three bits."""
    parent = {k: k for k in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in fps}


def repaired(conversations):
    """``conversations``: (conv, turn, role, text) rows; the cheapest edits by plain recursion from the end."""
    import functools
    convs = {}
    for conv, turn, role, text in conversations:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        rows.extend([(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1))
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in rows if t is not None}
        fault, seen = [], set()
        for _, role, text in rows:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))

        @functools.cache
        def best(i, state, inserted=0):
            """(cost, edits, lines) from row i on; state is what the roles so far end with."""
            ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
            after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            name = "assistant" if after == "a" else "user"

            def way(cost, edit, line, *to):
                rest = best(*to)
                if rest is not None:
                    ways.append((cost + rest[0], edit + rest[1], (*line, *rest[2])))
            if inserted < 3:
                way(5, "I", [f"{name}:"], i, name[0], inserted + 1)
            if i < len(rows):
                _, role, text = rows[i]
                way(2, "D", [], i + 1, state)
                if fault[i] not in ("blank", "duplicate"):
                    more = 5 if fault[i] else 0
                    if role[:1] and role[:1] in after:
                        way(more, "K", [f"{role}:{text}"], i + 1, role[0])
                    way(more + 1, "R", [f"{name}:{text}"], i + 1, name[0])
            return min(ways, default=None)
        cost, edits, lines = best(0, "")
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[fault.count(x) for x in ("blank", "duplicate", "truncated")],
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, edits, sha("\n".join(lines).encode()))
    return out
