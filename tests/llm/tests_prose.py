"""Seeded nonsense for the tests."""

import random


def prose(seed, n, words=None):
    draw = random.Random(seed)
    parts = words or ["an", "er", "tion", "st", "ing", "re", "the", "ha", "on", "ly"]
    return [draw.choice(parts) + draw.choice(parts) for _ in range(n)]
