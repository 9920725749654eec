"""Fences move with their groups, and only then is a document judged by its own group."""

from __future__ import annotations

import random

from ledgerloom.llm import quality


def text(rng: random.Random, n: int, size: int, symbols: float, again: float) -> str:
    out = []
    for i in range(n):
        w = "".join(rng.choice("abcdefghij") for _ in range(max(1, size + rng.randint(-1, 1))))
        out.append(w + ("%" if rng.random() < symbols else "") + ("\\n" if i % 12 == 11 else " "))
        if rng.random() < again:
            out += out[-4:-1]
    return "".join(out)


def rows(rng: random.Random) -> list[tuple]:
    """Prose in short words without symbols, and tables in long words with many; three documents each that belong to the other."""
    kinds = {"prose": (5, 0.0, 0.0), "tables": (11, 0.5, 0.06)}
    out = [(len(kinds) * i + k, text(rng, 120, *kinds[name]), "en", name) for i in range(250) for k, name in enumerate(kinds)]
    swapped = {"prose": "tables", "tables": "prose"}
    return out + [(1000 + 2 * i + k, text(rng, 120, *kinds[swapped[name]]), "en", name) for i in range(3) for k, name in enumerate(kinds)]


def test_fences_move_with_the_group(spark):
    docs = spark.createDataFrame(rows(random.Random(2)), "doc_id LONG, text STRING, lang STRING, source STRING")
    scored = quality.measured(docs, "text").select("row.lang", "row.source", *quality.MEASURES)
    limits = {r.source: r.asDict() for r in quality.thresholds(scored).collect()}
    for name in quality._limits():
        if name != "dup_lines_high":  # no lines repeat here
            assert limits["tables"][name] > limits["prose"][name], name
    assert limits["tables"]["symbols_high"] > 400 > limits["prose"]["symbols_high"] == quality.CLOSEST
    kept = {r.doc_id: r.kept for r in quality.quality_report(docs).collect()}
    assert all(kept[i] for i in range(500)) and not any(kept[i] for i in range(1000, 1006))


def test_small_groups_use_the_languages_fences(spark):
    data = rows(random.Random(3))
    few = [(5000 + i, t, "en", "few") for i, (_, t, _, s) in enumerate(x for x in data if x[3] == "prose") if i < 20]
    docs = spark.createDataFrame(data + few, "doc_id LONG, text STRING, lang STRING, source STRING")
    scored = quality.measured(docs, "text").select("row.lang", "row.source", *quality.MEASURES)
    limits = {r.source: tuple(r)[2:] for r in quality.thresholds(scored).collect()}
    assert limits["few"] not in (limits["prose"], limits["tables"])


def test_short_documents_by_parameter(spark):
    rng = random.Random(5)
    data = [(i, text(rng, 100, 5, 0.0, 0.0), "en", "a") for i in range(210)] + [(900, "only a few words here", "en", "a"), (901, "%%% ### |||| &&&& ****", "en", "a"), (902, "", "en", "a")]
    docs = spark.createDataFrame(data, "doc_id LONG, text STRING, lang STRING, source STRING")
    assert quality.quality_filter(docs).where("doc_id >= 900").count() == 0
    assert [r.doc_id for r in quality.quality_filter(docs, min_words=1).where("doc_id >= 900").collect()] == [900]
