from __future__ import annotations

import random

import pytest

COLUMNS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, size STRING, sig INT, node INT, key INT, block INT, row STRING, n_lines INT, position INT"


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice("the of and tion ing er es ed on re an or".split()) + rng.choice(["", "x", "yé", "zz"]) + str(rng.randint(0, 30)) for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w + ("." if i % 9 == 8 else "") + ("\n" if i % 17 == 16 else " "))
    return "".join(out)


def cases() -> list[tuple]:
    """Documents with every awkward case: nulls, empty, white space, very long, ties, repeated rows, copies."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(24)]
    line = "This Line is found in very many documents "
    passage = prose(rng, 70).replace("\n", " ")
    texts[1] = texts[0]
    texts[2] = texts[0].replace("the", "THE", 1)
    for i in range(3, 9):
        texts[i] += f"\n  {line if i % 2 else line.upper()}\t\n" + texts[i][:30]
    for i in (10, 12, 14):
        texts[i] = texts[i][:100] + passage + texts[i][100:]
    texts += ["", None, " \t\n\x0b\f\r", "a", "one two three four", "ab" * 400, "word " * 300, "a<|endoftext|>b <|ENDOFTEXT|>  x　y It's don't 'S é ΑΣ İI", "\n\n\n", "x" * 60_000, prose(rng, 20_000), "#" * 30 + " ok " * 60]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4], len(t or ""), "s", 1, 2, 3, 4, "r", 5, 6) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[3], None, None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(cases(), COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
