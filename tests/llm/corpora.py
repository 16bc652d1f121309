"""Small tables for the corpus operators and brute-force versions of what they compute."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile("[^\x20\x09-\x0D]+")
# Columns named like the operators' own, which must be ignored or passed through.
CLASHING = "uid long, raw string, part int, digest string, size long, row string, key long, mark long, copies long"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def word(rng: random.Random) -> str:
    return "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))


def prose(rng: random.Random, count: int) -> str:
    return " ".join(word(rng) for _ in range(count))


def frame(spark, texts, sources=None, ids=None):
    """A documents table with clashing extra columns."""
    rows = [
        (ids[i] if ids else i, text, "en", sources[i] if sources else "s", len(text or ""), 7, "x", 1, "d", 5, "r", 3, 2, 9)
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def odd_texts(rng: random.Random) -> list[str | None]:
    """Null, empty, blank, short, very long, repeated and non-ASCII texts."""
    base = prose(rng, 60)
    return [None, "", " \t\n\x0b\x0c\r", "one", "one two three four", "one two three four", base, base, base.replace(" ", "  "),
            base.upper(), "été   \U0001F600 " + base, prose(rng, 9000), " ", None]


def near_copies(rng: random.Random, text: str, count: int, edits: int) -> list[str]:
    out = []
    for _ in range(count):
        words = text.split(" ")
        for _ in range(edits):
            words[rng.randrange(len(words))] = word(rng)
        out.append(" ".join(words))
    return out


def components(count: int, linked) -> list[int]:
    parent = list(range(count))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in linked:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
