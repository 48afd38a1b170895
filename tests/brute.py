"""Plain Python answers to compare with."""

from __future__ import annotations

import random

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(text):
    return text.translate(FOLD)


def matches(pairs, prefix, case_sensitive=True):
    if case_sensitive:
        return [(t, w) for t, w in pairs if t.startswith(prefix)]
    return [(t, w) for t, w in pairs if fold(t).startswith(fold(prefix))]


def best(pairs, prefix, k, case_sensitive=True):
    key = (lambda t: t) if case_sensitive else fold
    found = matches(pairs, prefix, case_sensitive)
    return sorted(found, key=lambda p: (p[1], key(p[0]).encode(), p[0].encode()), reverse=True)[:k]


def scan_best(pairs, prefix, k):
    """One pass over the sorted entries; a later one must be strictly heavier to enter."""
    kept = []
    for position, (text, weight) in enumerate(sorted(pairs, key=lambda p: p[0].encode())):
        if not text.startswith(prefix):
            continue
        if len(kept) == k:
            lightest = min(kept)
            if weight <= lightest[0]:
                continue
            kept.remove(lightest)
        kept.append((weight, position, text))
    return [(text, weight) for weight, _, text in sorted(kept, reverse=True)]


def random_pairs(seed, size=60, alphabet="abc", top_weight=6, longest=5):
    rng = random.Random(seed)
    texts = {"".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(size)}
    return [(text, rng.randint(1, top_weight)) for text in sorted(texts)]


def random_prefixes(seed, size=25, alphabet="abc", longest=6):
    rng = random.Random(seed + 1000)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(size)]
