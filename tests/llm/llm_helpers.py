"""Small frames and brute-force versions for the corpus operators."""

import random
import re

BLANK = "[\\x20\\x09-\\x0D]"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("fp string, kept string, base string, score string, matches string, _id string, _row string, keys string, "
            "tokens string, component_id string, licenses string")


def documents(spark, texts, schema=SCHEMA):
    """(id, text) pairs or texts as a documents table."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 5}", len(t or "")) for i, t in rows], schema)


def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and extra columns."""
    long_text = " ".join(f"w{i * 7919 % 5000}" for i in range(150_000))
    texts = [(1, "some plain words of a text that is repeated"), (1, "some plain words of a text that is repeated"),
             (2, "some plain words of a text that is repeated"), (3, None), (4, ""), (5, " \t\n "), (None, "no identifier"),
             (None, "no identifier"), (None, None), (6, long_text), (7, long_text), (8, "x" * 200_000), (9, "\n" * 50_000),
             (10, "one"), (11, "une ligne assez longue pour compter\nété \U0001f600 ß")]
    rows = [(i, t, None if i == 3 else "en", None if i in (2, 4) else "src0", None) for i, t in texts]
    columns = CLASHING.split(", ")
    return spark.createDataFrame([(*r, *["x"] * len(columns)) for r in rows], f"{SCHEMA}, {CLASHING}")


def words(text):
    return re.findall("[^\\x20\\x09-\\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"word{rng.randrange(vocabulary)}" for _ in range(n))


class Groups:
    """Union-find with the smallest member as root."""

    def __init__(self, members):
        self.parent = {m: m for m in members}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
