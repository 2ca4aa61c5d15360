"""Plain versions of the corpus operators' contracts, for small tables in memory."""

from __future__ import annotations

import hashlib
import re
import zlib

LOWER = {i: i + 32 for i in range(65, 91)}
SPACE = " \t\n\v\f\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# ---- near duplicates -----------------------------------------------------------------


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_duplicates(rows):
    """``{doc_id: (n_shingles, component_id)}`` of ``(doc_id, text)`` rows."""
    sets = {doc: shingles(text) for doc, text in rows}
    holders = {}
    for doc, found in sets.items():
        for shingle in found:
            holders.setdefault(shingle, []).append(doc)
    shared = {}
    for docs in holders.values():
        for i, a in enumerate(docs):
            for b in docs[i + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), both in shared.items():
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {doc: (len(found), root(doc)) for doc, found in sets.items()}


# ---- decontamination -----------------------------------------------------------------


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items):
    """``(n_words, n_hit, n_items, items_sha256)`` of a text against ``(item_id, text)``."""
    words = bench_words(text)
    hit, found = set(), set()
    for item, item_text in items:
        own = bench_words(item_text)
        width = min(10, len(own))
        for start in range(len(own) - width + 1 if own else 0):
            window = own[start : start + width]
            for at in range(len(words) - width + 1):
                if words[at] == window[0] and words[at : at + width] == window:
                    hit.update(range(at, at + width))
                    found.add(item)
    return len(words), len(hit), len(found), sha(",".join(sorted(map(str, found))))


# ---- line dedup ----------------------------------------------------------------------


def line_dedup(rows):
    """``{doc_id: (n_lines, n_dropped, kept text)}``."""
    def key(line):
        return line.strip(SPACE).translate(LOWER)

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(doc)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(key(x), ())) < 5 or max(h) == doc]
        out[doc] = len(lines), len(lines) - len(kept), "\n".join(kept)
    return out


# ---- personal data -------------------------------------------------------------------


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    """``(kind, start, end)`` of all valid pattern matches, by kind and place."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def spans_text(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
