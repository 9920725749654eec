"""Repeated passages are found wherever a copy stands and however it is set."""

from __future__ import annotations

import random

import pytest
from ledgerloom.llm import passages


def words(rng: random.Random, n: int) -> list[str]:
    return [f"w{rng.randint(0, 2000)}" for _ in range(n)]


def clauses(rng: random.Random, n: int, low: int, high: int) -> str:
    out: list[str] = []
    while len(out) < n:
        part = words(rng, rng.randint(low, high))
        out += [*part[:-1], part[-1] + rng.choice(",;.")]
    return " ".join(out[:n])


def short_lines(rng: random.Random) -> str:
    w = words(rng, 84)
    return "\n" + "\n".join(" ".join(w[i : i + 7]) for i in range(0, 84, 7)) + "\n"


KINDS = {"five-word clauses": lambda r: clauses(r, 70, 5, 5), "short clauses": lambda r: clauses(r, 60, 4, 7), "short lines": short_lines, "running text": lambda r: " ".join(words(r, 70))}


@pytest.mark.parametrize("kind", KINDS)
def test_copies_share_units(kind):
    rng, shares = random.Random(7), []
    for _ in range(200):
        passage = KINDS[kind](rng)
        found = []
        for _ in range(2):
            text = f"{clauses(rng, rng.randint(20, 80), 3, 12)} {passage} {clauses(rng, rng.randint(20, 80), 3, 12)}"
            found.append({" ".join(text[a:b].lower().split()) for a, b in passages.units(text, "run", 8)})
        shared = [u.split() for u in found[0] & found[1]]
        assert shared
        shares.append(sum(map(len, shared)) / len(passage.split()))
    assert sum(shares) / len(shares) > 0.6


@pytest.mark.parametrize("text", ["", "a b", "word " * 1000, "one two\nthree, four. five six seven\n\neight nine ten eleven", "　x\x85y " * 9])
def test_units_hold_every_word_once(text):
    spans = list(passages.units(text, "run", 8))
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
    assert all(8 <= len(text[a:b].split()) < 24 for a, b in spans)
    n = len(text.split())
    assert [w for a, b in spans for w in text[a:b].split()] == (text.split() if n >= 8 else [])


def test_a_passage_in_running_text_is_removed(spark):
    rng = random.Random(9)
    passage = " ".join(words(rng, 70))
    texts = [" ".join([*words(rng, 40), passage, *words(rng, 40)]) for _ in range(2)]
    got = {r.doc_id: r for r in passages.dedup_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")).collect()}
    assert got[0].text == texts[0] and not got[0].removed
    assert got[1].removed and all(texts[1][s.start : s.stop].strip() in passage for s in got[1].removed)


def lines_of(rng: random.Random, n: int) -> list[str]:
    return [" ".join(words(rng, rng.randint(9, 14))) for _ in range(n)]


def test_short_repeats_stay_and_a_frequent_passage_goes(spark):
    """A 12-word line in all texts is no passage; of a 90-word passage in all texts one copy stays."""
    rng = random.Random(11)
    line, passage = " ".join(words(rng, 12)), " ".join(words(rng, 90))
    texts = ["\n".join([*lines_of(rng, 3), line, *lines_of(rng, 3), *([passage] if i % 2 else []), *lines_of(rng, 3)]) for i in range(40)]
    got = {r.doc_id: r for r in passages.dedup_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(5)).collect()}
    for i, text in enumerate(texts):
        gone = " ".join(text[s.start : s.stop] for s in got[i].removed)
        assert line in got[i].text and (not gone) == (i % 2 == 0 or i == 1)
        assert sum(w in passage for w in gone.split()) >= 0.95 * len(gone.split()) and (not gone or len(gone.split()) > 45)


@pytest.mark.parametrize("kind", ["line", "paragraph"])
def test_lines_and_paragraphs(spark, kind):
    text = "one two three\nfour five six\n\nseven eight nine\n"
    spans = [text[a:b].strip("\n") for a, b in passages.units(text, kind)]
    assert spans == (["one two three", "four five six", "seven eight nine"] if kind == "line" else ["one two three\nfour five six", "seven eight nine"])
    rows = [(3, text), (1, text.upper()), (2, "seven eight\tnine\nten eleven twelve"), (None, "other words here\n"), (4, "")]
    got = {r.doc_id: r.text for r in passages.dedup_passages(spark.createDataFrame(rows, "doc_id LONG, text STRING"), kind=kind, min_words=3, min_run=0).collect()}
    assert got[1] == text.upper() and got[3].strip() == "" and got[None] == "other words here\n" and got[4] == ""
    assert got[2] == ("\nten eleven twelve" if kind == "line" else rows[2][1])
