import numpy as np
import pytest


@pytest.fixture
def docs(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, source) rows, with columns whose names clash."""

    def make(rows, lang="en"):
        full = [(r[0], r[1], lang, r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None, "x", 1, 2) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, h string, size int, id int")

    return make


def invented(rng: np.random.Generator, n: int, letters: str = "abcdefg") -> str:
    """Prose of n words with full stops and line breaks."""
    words = ["".join(rng.choice(list(letters), rng.integers(2, 7))) for _ in range(n)]
    return "".join(w + (".\n" if i % 17 == 16 else ". " if i % 9 == 8 else " ") for i, w in enumerate(words)).strip()


ODD = [
    (None, None),
    (None, "no id here at all, but a text"),
    (50, ""),
    (51, " \n\t\n "),
    (52, "one"),
    (53, "déjà vu ß İ 日本語 \U0001f600 ſ"),
    (54, "a\x1cb c\x85d <|endoftext|> l'été I'LL"),
    (55, "word " * 30000),
    (56, "same row"),
    (56, "same row"),
]
