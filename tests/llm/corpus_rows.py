"""Row layout and made-up words for the corpus tests."""

from __future__ import annotations

import random

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(rng.randint(2, 7))) for _ in range(n))
