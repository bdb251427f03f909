"""Plain versions of the operators, one document after the other, to compare with."""

import base64
import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def removed_lines(rows, percent=80):
    """{doc_id: (lines, removed line numbers)}; rows have different doc_ids."""
    lines, first = [], {}
    for doc, text in sorted(r for r in rows if r[0] is not None):
        for number, line in enumerate((text or "").split("\n")):
            tokens = frozenset(re.split(r"[ \t\x0B\f\r]+", line)) - {""}
            if tokens:
                lines.append((doc, number, tokens))
                first.setdefault(tokens, (doc, number))
    best = {
        a: min(p for b, p in first.items() if 100 * len(a & b) >= percent * len(a | b)) for a in first
    }
    out = {doc: (0, []) for doc, _ in rows}
    for doc, number, tokens in lines:
        n, gone = out[doc]
        out[doc] = (n + 1, gone + [number] * (best[tokens] < (doc, number)))
    return out


def near_groups(rows, size=5, percent=80):
    """{doc_id: (shingles, component)}."""
    sets = {}
    for doc, text in rows:
        w = words((text or "").translate(_LOWER))
        sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    label = {doc: doc for doc in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                label[high] = low
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


def without_repeats(rows, size):
    """{doc_id: items left}, for rows of (doc_id, sequence)."""
    seen, out = set(), {}
    for doc, items in sorted(rows, key=lambda r: r[0]):
        gone = set()
        for i in range(len(items) - size + 1):
            window = tuple(items[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        out[doc] = [x for i, x in enumerate(items) if i not in gone]
        out[doc, "spans"] = sum(i - 1 not in gone for i in gone)
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(t - 9 if t > 9 else t for t in twice) % 10 == 0


def personal(text):
    """[(kind, start, end)]."""
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and _luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }
            if fine[kind]:
                found.append((kind, m.start(), m.end()))
    return found


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = collections.Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def payload_digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def accepted_patterns(rows, min_confidence=0.8, min_seeds=5, unknown=0.5):
    """The bootstrap of the personal data over (pattern, token, label, doc_id), with dictionaries."""
    edges = {}
    for pattern, token, label, doc in rows:
        held = edges.setdefault(pattern, {})
        held[token, label] = min(doc, held.get((token, label), doc))
    good, belief = {}, {}
    while True:
        found = {}
        for pattern, held in edges.items():
            if pattern in good:
                continue
            kinds = {label or belief.get(token, (0, None))[1] for token, label in held} - {None, "none"}
            total = sum(1 if label or token in belief else unknown for token, label in held)
            for kind in kinds:
                mine = [(t, lb) for t, lb in held if (lb or belief.get(t, (0, None))[1]) == kind]
                confidence = sum(1 if lb else belief[t][0] for t, lb in mine) / (total + 1)
                enough = min(len(mine), len({held[key] for key in mine})) >= min_seeds
                if enough and confidence >= min_confidence:
                    found[pattern] = (confidence, kind)
        if not found:
            return {(kind, pattern): confidence for pattern, (confidence, kind) in good.items()}
        good.update(found)
        for pattern in good:
            for token, label in edges[pattern]:
                if label is None:
                    belief[token] = max(belief.get(token, (0, "")), good[pattern])
