from __future__ import annotations

import random


def prose(rng: random.Random, words: int) -> str:
    """Words that hardly ever repeat."""
    return " ".join("".join(rng.choice("abcdefgiou") for _ in range(rng.randint(2, 9))) for _ in range(words))
