"""Made-up text for the tests."""

import random


def invented(seed, n, parts=("ra", "to", "mi", "lek", "os", "un", "dar", "pi", "sol", "ven")):
    """n made-up words, the same for the same seed."""
    r = random.Random(seed)
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n))
