import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id long, keys string"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns that clash with the operators' own names."""

    def make(rows):
        full = [(i, t, "en", None, None if t is None else len(t), "k", 7, "z") for i, t in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULL ids and texts, empty and one-word texts, repeats, a very long text."""
    rng = random.Random(5)
    base = words(rng, 120)
    near = base[:60] + ["changed"] + base[61:]
    long_text = " ".join(words(rng, 30_000, 20_000))
    return [
        (1, " ".join(base)),
        (2, " ".join(near)),
        (3, " ".join(base)),
        (3, " ".join(base)),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (7, "one"),
        (8, "ONE"),
        (9, "two words"),
        (10, " ".join(words(rng, 120))),
        (11, long_text),
        (12, long_text + " tail"),
        (None, " ".join(base)),
        (None, None),
        (13, "déjà vu çа 漢字 𝄞 ▁ <|endoftext|> İΣς ŉ é"),
        (-14, "negative id"),
        (2**53 + 1, "large id"),
    ]
