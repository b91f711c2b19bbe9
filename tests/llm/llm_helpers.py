"""Texts and digests for the tests."""

import hashlib
import random


def prose(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ka", "lo", "mi", "ré", "tu", "na"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
