"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import unicodedata

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def targets(sizes, weights=(1, 2, 3), cap=3):
    """source -> target by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {s: 0.0 for s in order if sizes[s] == 0}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: w[s] * rest / sum(w[f] for f in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(cap * sizes[s]) for s in over}


def line_dedup(docs, min_words):
    """doc_id -> kept text; docs: list of (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        lines = (text or "").split("\n")
        full = [(j, x) for j, x in enumerate(lines) if x.strip(SPACE)]
        n = [len(words(x)) for _, x in full]
        gone = set()
        for i in range(len(full)):
            total = m = 0
            while i + m < len(full) and total < min_words:
                total += n[i + m]
                m += 1
            if total < min_words:
                continue
            key = tuple(x for _, x in full[i : i + m])
            if key in seen:
                gone |= {full[j][0] for j in range(i, i + m)}
            seen.add(key)
        out[doc] = None if text is None else "\n".join(x for j, x in enumerate(lines) if j not in gone)
    return out


def maximal_runs(docs, min_words):
    """doc_id -> kept text: every start's longest common stretch with any earlier start goes if it has ``min_words`` words."""
    full = {d: [(j, x) for j, x in enumerate((t or "").split("\n")) if x.strip(SPACE)] for d, t in docs}
    places = [(d, i) for d in sorted(full) for i in range(len(full[d]))]
    gone = {d: set() for d in full}
    for n, (d, i) in enumerate(places):
        for e, k in places[:n]:
            m = 0
            while i + m < len(full[d]) and k + m < len(full[e]) and full[d][i + m][1] == full[e][k + m][1]:
                m += 1
            run = full[d][i : i + m]
            if sum(len(words(x)) for _, x in run) >= min_words:
                gone[d] |= {j for j, _ in run}
    return {d: None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[d]) for d, t in docs}


def shingles(text, k):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(docs, k, percent):
    """doc_id -> (set size, smallest id reachable)."""
    sets = {d: shingles(t, k) for d, t in docs}
    parent = {d: d for d in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


def substring_dedup(docs, length):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256)."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode("utf-8", "surrogatepass")
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(piece)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


UNIT_WORDS = set(
    "mm cm m km mg g kg ml l s sec min h hr hrs inch inches ft feet yard yards mile miles lb lbs oz pound pounds second seconds minute minutes hour hours "
    "day days week weeks month months year years meter meters metre metres gram grams litre litres liter liters dollar dollars cent cents euro euros percent degrees mph kmh kw kwh hz".split()
)
NUMBER_WORDS = set(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)


def typed_words(text):
    """(word, kind) by a walk over the characters: kinds are number, unit, name, start (a name or not) and word."""
    text = (text or "").replace("\x01", " ").replace("\x02", " ")
    alnum = lambda c: unicodedata.category(c)[0] in "LN"
    out, i, n = [], 0, len(text)
    while i < n:
        if not alnum(text[i]):
            i += 1
            continue
        j = i
        while j < n and (alnum(text[j]) or (text[j] in ".," and text[j - 1] in "0123456789" and j + 1 < n and text[j + 1] in "0123456789")):
            j += 1
        word = text[i:j].lower() if text[i] not in "0123456789" else text[i:j].lower()
        word = "".join(c for k, c in enumerate(word) if c not in ".,")
        capital = j - i >= 2 and unicodedata.category(text[i]) == "Lu" and unicodedata.category(text[i + 1]) == "Ll"
        inside = i >= 2 and text[i - 1] in " \t\n\x0b\x0c\r" and (alnum(text[i - 2]) or text[i - 2] in ",;")
        if word in NUMBER_WORDS or (not capital and word[0] in "0123456789"):
            kind = "number"
        elif capital and inside:
            kind = "name"
        elif word in UNIT_WORDS:
            kind = "unit"
        else:
            kind = "start" if capital else "word"
        if not (kind == "number" and word[0] not in "0123456789" and out and out[-1][1] == "number"):
            out.append((word, kind))
        i = j
    return out


def template_windows(ws, window, plain):
    """[(template window, narrow window there, place, number of the template)]: narrow ones, then others that differ."""
    lists = []
    for names in ({"name"}, {"name", "start"}, set())[: 3 if plain else 2]:
        t = [f"<{k}>" if k in ("number", "unit") else "<name>" if k in names else w for w, k in ws]
        lists.append([tuple(t[p : p + window]) for p in range(len(t) - window + 1)] if len(t) >= window else [("short", *t)] if t else [])
    return [(h, lists[0][p], p, n) for n, one in enumerate(lists) for p, h in enumerate(one) if n == 0 or h != lists[0][p]]


def leaks(docs, items, window=5, share=0.8, consistent=0.8):
    """{(doc, item): (n_windows, n_matched, n_slots, n_consistent)} of rows (id, text)."""
    found = {}
    for item, item_text in items:
        iws = typed_words(item_text)
        iw = template_windows(iws, window, True)
        n_windows = len({x[1] for x in iw})
        least = math.ceil(n_windows * share - 1e-9)
        firsts = {}
        for h, key, q, m in iw:
            firsts[h, key] = min(firsts.get((h, key), (q, m)), (q, m))
        for doc, text in docs:
            ws = typed_words(text)
            hits = [(h, p, n) for h, _, p, n in template_windows(ws, window, False)]
            rows = [(p - q, key, p, q, n, m) for h, p, n in hits for (ih, key), (q, m) in firsts.items() if ih == h]
            if not n_windows or len({r[1] for r in rows}) < least:
                continue
            here = {s: len({r[1] for r in rows if r[0] == s}) for s in {r[0] for r in rows}}
            taken, total = set(), 0
            for s in sorted(here, key=lambda s: (-here[s], s))[: 1 + math.floor(n_windows * (1 - share) / (window - 1) + 1e-9)]:
                if total < least:
                    taken.add(s)
                total += here[s]
            keys = collections.defaultdict(lambda: True)
            pairs = collections.defaultdict(lambda: collections.defaultdict(lambda: True))
            for s, key, p, q, n, m in rows:
                if s not in taken:
                    continue
                keys[key] &= n > 0 or m > 0
                for k in range(window):
                    if q + k < len(iws) and p + k < len(ws):
                        names = ({"name"}, {"name", "start"}, set())[n]
                        if ws[p + k][1] in {"number", "unit"} | names:
                            pairs[iws[q + k][0]][ws[p + k][0]] &= n > 0 or m > 0
            for narrow in (True, False):
                matched = sum(not wide for wide in keys.values()) if narrow else len(keys)
                values = [sum(not wide for wide in v.values()) if narrow else len(v) for v in pairs.values()]
                slots, good = sum(v > 0 for v in values), sum(v == 1 for v in values)
                if matched >= least and good >= math.ceil(slots * consistent - 1e-9):
                    found[(doc, item)] = (n_windows, matched, slots, good)
                    break
    return found


def ranker_features(text, odd_marks):
    text = text or ""
    w = words(text)
    n, solid = max(len(w), 1), max(sum(map(len, w)), 1)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    share = lambda pattern: len(re.findall(pattern, text)) / solid
    distinct = len(set(w)) / n
    return [
        math.log1p(len(w)), solid / n, share("[A-Z]"), share(odd_marks), share("!"), share("[|]"), share("[.,;:]"), share("[0-9]"), distinct,
        math.log(distinct + 0.01), (len(lines) - len(set(lines))) / max(len(lines), 1), sum(a == b for a, b in zip(w, w[1:])) / n, float(len(w) < 20),
    ]
