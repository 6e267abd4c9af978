"""Plain restatements of what operators compute, one text at a time."""

import base64
import itertools
import re
from fractions import Fraction

import public_tokenizers
import tiktoken

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(text):
    return (text or "").translate(ASCII_LOWER)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    own = words(normal(text))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4)))


def links(texts):
    """Pairs (a, b) of linked ids, a before b, for {id: text}, by comparing all pairs."""
    sets = {k: shingles(t) for k, t in texts.items()}
    found = set()
    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            found.add((a, b))
    return found


def components(texts):
    """Smallest id in reach for {id: text}, by comparing all pairs."""
    smallest = {k: k for k in texts}

    def root(k):
        while smallest[k] != k:
            k = smallest[k]
        return k

    for a, b in links(texts):
        x, y = sorted((root(a), root(b)))
        smallest[y] = x
    return {k: root(k) for k in texts}


def targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), limit=2):
    """Target per source by sharing out again and again; {source: size}, null as None."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full = share * sum(sizes.values()), {}
    while True:
        open_sources = [s for s in order if s not in full]
        total = sum(weight[s] for s in open_sources)
        now = {s: left * weight[s] / total for s in open_sources}
        above = [s for s in open_sources if now[s] > limit * sizes[s]]
        if not above:
            return {**full, **now}
        for s in above:
            full[s] = Fraction(limit * sizes[s])
            left -= full[s]


def tokenizer():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
