"""Documents the operator tests share: awkward rows, copies and near copies, and columns with clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CLASHING = SCHEMA + ", row STRING, id STRING, kept BOOLEAN, keep_id STRING, norm STRING, fp STRING, failed BIGINT, epoch INT, digest STRING"
SYLLABLES = "ta re mo ni shu la ve ko".split()


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    out = []
    for i, word in enumerate(words):
        out.append(word + ("." if i % 9 == 8 else ""))
        out.append("\n" if i % 17 == 16 else " ")
    return "".join(out)


def documents(seed: int = 0, n: int = 40) -> list[tuple]:
    """Rows of the documents table: prose, exact and near copies, and rows that are empty, null, long or odd."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 200)) for _ in range(n)]
    for i in range(0, n, 4):
        texts.append(texts[i])
        words = texts[i].split(" ")
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [None, "", " \t\n", "one", "two words", "é ü \U0001f600 x", "a\x0bb\x0cc\rd", "<|endoftext|> in <|ENDOFTEXT|>"]
    texts.append("lorem ipsum\n" * 4000)
    texts.append("x" * 50_000)
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{i % 5}" if i % 7 else None, 0) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5], "en", "src1", None), (None, None, None, None, None), (None, "lone " * 80, None, "", None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def clashing(spark, rows):
    """The same rows with columns named like those operators make."""
    return spark.createDataFrame([(*r, "r", "i", False, "k", "n", "f", 9, 9, "d") for r in rows], CLASHING)


def groups(links, nodes) -> dict:
    """Smallest node reachable from each node."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
