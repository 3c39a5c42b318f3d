"""Plain readings of what the operators compute, without their methods."""

from __future__ import annotations

import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rules(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": n < 20 or 100 * len(covered) > 30 * n,
    }


def shingles(text, width=5):
    words = WORDS.findall(text or "")
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def groups(rows):
    """For each row (id, text): number of links and the smallest id of its group."""
    sets = [shingles(t) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                common = len(a & b)
                if 5 * common >= 4 * (len(a) + len(b) - common):
                    links[i] += 1
                    links[j] += 1
                    root[top(j)] = top(i)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[top(i)] = min(key, smallest.get(top(i), key))
    return [(key, smallest.get(top(i)) if sets[i] else key, links[i]) for i, (key, _) in enumerate(rows)]


def luhn(digits):
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if place % 2 else d
        total += d if d < 10 else d - 9
    return total % 10 == 0


def personal(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out
