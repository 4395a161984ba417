from __future__ import annotations

import random


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(n))
