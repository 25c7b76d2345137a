"""Brute-force versions of pipeline stages."""

import os
import sys

sys.path.insert(0, os.path.dirname(__file__))


def brute_kept(rows):
    """Ids that stay: the smallest of each SimHash component."""
    from test_simhash_pivots import brute
    return sorted({x[2] for x in brute(rows)})


def brute_clean(text, items, width=10):
    """text without the characters from the first to the last word of each merged hit."""
    import re
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    raw = text.encode()
    found = list(word.finditer(raw.lower()))
    words = [m.group() for m in found]
    wins = set()
    for _, t in items:
        w = word.findall((t or "").encode().lower())
        for a in range(max(1, len(w) - width + 1)) if w else ():
            wins.add(tuple(w[a:a + width]))
    hit = [False] * len(words)
    for n in {len(w) for w in wins}:
        for a in range(len(words) - n + 1):
            if tuple(words[a:a + n]) in wins:
                hit[a:a + n] = [True] * n
    out, at, k = b"", 0, 0
    while k < len(words):
        if hit[k]:
            out += raw[at:found[k].start()]
            while k < len(words) and hit[k]:
                at = found[k].end()
                k += 1
        else:
            k += 1
    return (out + raw[at:]).decode()
