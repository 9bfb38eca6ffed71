"""Plain versions of the operators, and tables with everything that can go wrong in them."""

import collections
import hashlib
import re
import zlib

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def covered(sequences, window):
    """A flag per item: inside a window that also starts anywhere else."""
    seen = collections.Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append(gone)
    return out


def bytes_removed(texts, window):
    data = [(t or "").encode() for t in texts]
    rows = []
    for b, gone in zip(data, covered(data, window), strict=True):
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        rows.append((len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return rows


def words_removed(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    rows = []
    for w, gone in zip(words, covered(words, window), strict=True):
        rows.append((len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return rows


def gram_set(text, size):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(folded)
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def similar(rows, size=4, percent=85):
    """(id, set size, smallest id reachable) of every row."""
    sets = [gram_set(t, size) for _, t in rows]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets, strict=True)]


def one_space(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def equal_groups(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[one_space(t)].append(i)
    out = []
    for i, t in rows:
        own = groups[one_space(t)]
        keep = min((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), keep == i, sha(one_space(t))))
    return out


def hostile(df):
    """The same rows with further columns whose names the operators use themselves."""
    for name in ("_id", "_hash", "_text", "n", "key", "ids", "score", "lo", "digest", "token", "part", "block", "word", "keep_id", "component"):
        df = df.withColumn(name, F.lit("x"))
    return df


def same(got, expected):
    return sorted(map(tuple, got), key=repr) == sorted(map(tuple, expected), key=repr)


def damaged(rows):
    """Rows (conv, turn, role, text) after damage, in order: by turn, then role, then text."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, audit, lines) over all edits, by trying them: rows are (role, text, fault or None)."""
    best = {"": (0, "", [])}

    def inserted(ways):
        ways = dict(ways)
        for _ in range(3):
            for state, (cost, audit, lines) in list(ways.items()):
                to = NEXT[state]
                new = (cost + 5, audit + "I", [*lines, {"u": "user:", "a": "assistant:"}[to]])
                ways[to] = min(ways.get(to, new), new, key=lambda x: x[:2])
        return ways

    for role, text, fault in rows:
        best = inserted(best)
        after = {}

        def put(state, way, after=after):
            after[state] = min(after.get(state, way), way, key=lambda x: x[:2])

        for state, (cost, audit, lines) in best.items():
            put(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            kept = state if role == "" else STEPS.get((state, role[:1]))
            if kept is not None:
                put(kept, (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            to = NEXT[state]
            put(to, (cost + more + 1, audit + "R", [*lines, {"u": "user", "a": "assistant"}[to] + ":" + text]))
        best = after
    return min((way for state, way in inserted(best).items() if state in ("", "a")), key=lambda x: x[:2])


def mended(rows, ids=None):
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of every conversation."""
    out = []
    for conv in dict.fromkeys(r[0] for r in (ids or rows)):
        own = sorted(((t is not None, t or 0, r, x, t) for c, t, r, x in rows if c == conv), key=lambda v: v[:4])
        seen, judged = set(), []
        for *_, role, text, _turn in own:
            core = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = {r[4] for r in own} - {None}
        counts = [sum(f == name for *_, f in judged) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
        cost, audit, lines = cheapest(judged)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, sha("\n".join(lines))))
    return out
