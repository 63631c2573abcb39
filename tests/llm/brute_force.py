"""Invented texts, and near copies by comparing all pairs that share a part."""

import random
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(words, seed, alphabet="abcdefgh"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(alphabet) for _ in range(draw.randint(2, 7))) for _ in range(words))


def parts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def least_reachable(texts):
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    holders, sets = defaultdict(list), [parts(t) for t in texts]
    for k, own in enumerate(sets):
        for other, n in Counter(j for part in own for j in holders[part]).items():
            if 100 * n >= 75 * (len(own) + len(sets[other]) - n):
                low, high = sorted((find(k), find(other)))
                root[high] = low
        for part in own:
            holders[part].append(k)
    return [find(k) for k in range(len(texts))], [len(s) for s in sets]
