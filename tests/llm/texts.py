"""Small tables for the corpus tests."""

from __future__ import annotations

import random

# Columns that share names with those the operators make or use inside.
CLASHES = ("row", "ident", "keep", "kept", "n", "label", "score", "kind", "x", "start", "item", "words", "node", "host", "document", "gone")


def frame(spark, rows, clashes=True):
    """doc_id, text and columns with names that clash."""
    schema = "doc_id bigint, text string"
    if clashes:
        schema += "".join(f", {name} string" for name in CLASHES)
        rows = [(*row, *["?"] * len(CLASHES)) for row in rows]
    return spark.createDataFrame(rows, schema)


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}{'.' if rng.random() < 0.1 else ''}" for _ in range(words))


def awkward(rng: random.Random) -> list[tuple[int | None, str | None]]:
    """Nulls, empties, blanks, a long text, repeated rows and texts that share passages."""
    passage = prose(rng, 60)
    base = prose(rng, 120)
    rows = [
        (None, None), (None, "lone words here"), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "two words"),
        (6, base), (7, base), (7, base), (8, base.replace(" ", "  ")), (9, base.upper()),
        (10, f"{prose(rng, 30)} {passage} {prose(rng, 30)}"), (11, f"{prose(rng, 10)} {passage}"),
        (12, f"{passage} {passage}"), (13, "ab " * 200), (14, "é ß 漢字 \U0001f600 " * 20),
        (15, prose(rng, 20_000, 9_000)), (16, "x" * 5_000), (17, "x" * 4_000),
    ]
    words = base.split()
    for i in range(12):
        changed = list(words)
        for _ in range(i // 3):
            changed[rng.randrange(len(changed))] = f"c{i}"
        rows.append((100 + i, " ".join(changed)))
    return rows
