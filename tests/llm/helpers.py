"""Fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import random

# words in a few scripts, with marks, symbols and white space of all kinds
VOCABULARY = ("the of and Thing thing, over. under! café naïve straße Привет мир 你好 a1b2 x--y $$$ ### <tag> e=mc2 "
              "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi").split()
CLASHES = {"row": "r", "d": 1, "t": 2, "_d": 3, "_t": 4, "_gone": "g", "words": "w", "lines": "l", "f": 5, "n": 6, "kind": "k",
           "score": 0.5, "label": 7, "bucket": 8, "n_words": -1, "kept": None, "fingerprint": "old", "h1": 9, "item": "i"}


def random_text(rng: random.Random, words: int, lines: bool = True) -> str:
    out = []
    for _ in range(words):
        out.append(rng.choice(VOCABULARY))
        out.append(rng.choice([" ", " ", " ", "  ", "\t", "\n" if lines else " ", ". "]))
    return "".join(out)


def edge_texts() -> list[str | None]:
    """Null, empty, blank, one word, a very long text and repeated ones."""
    long_text = "\n".join(f"line {i % 700} of a very long text, with words {i % 13} {i % 17}." for i in range(3000))
    return [None, "", " \n\t ", "one", "One", long_text, "a b c\nd e f\ng h i\nj k l", "a b c\nd e f\ng h i\nj k l",
            "\n\n\n", "é\né\né\né\né", "no end \x00 mark \x1f here", "x " * 50, "…"]


def documents(spark, texts, ids=None, clashes: bool = False):
    ids = list(range(len(texts))) if ids is None else ids
    rows, schema = [(i, t) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string"
    if clashes:
        rows = [(*r, *CLASHES.values()) for r in rows]
        types = {str: "string", int: "long", float: "double", type(None): "string"}
        schema += "".join(f", {c} {types[type(v)]}" for c, v in CLASHES.items())
    return spark.createDataFrame(rows, schema)
