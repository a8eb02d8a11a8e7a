import random

import pytest


@pytest.fixture(scope="session")
def texts():
    """Small texts with copies, near copies, shared passages, repeats, odd white space and nothing at all."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(120)] + ["the", "of", "é", "Über", "THE", "x" * 300]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, out = words(40), []
    for i in range(60):
        w = words(rng.randint(1, 90))
        if i % 4 == 0:
            p = rng.randint(0, len(w))
            w[p:p] = passage[rng.randint(0, 12) :]
        if i % 7 == 0:
            w += w[:20] * 3
        out.append(rng.choice([" ", "\n", " \t", "\x0b", "\r\n"]).join(w))
    for i in range(12):
        out.append(out[i])
        near = out[i + 12].split(" ")
        near[len(near) // 2] = "changed"
        out.append(" ".join(near))
    return [*out, None, "", " \n ", "one", "one", "a b c d", "A b C d", "no break here", "z " * 500, "\u0001\u001f x"]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """doc_id, text and columns whose names clash with the operators' own; the last rows are repeated, and one has no id."""
    rows = [(i * 3 + 1, t, "x", i, f"s{i % 3}") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "null id " * 20, "x", 1, "s"), (None, texts[0], "x", 1, "s")], "doc_id long, text string, chunk string, row int, score string")
