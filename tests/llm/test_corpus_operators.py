"""The corpus operators against brute force, on documents with every awkward case."""

from __future__ import annotations

import hashlib
import os
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import line_dedup, mixing, near_dup, packing, passages, quality, sharding, suffix_dedup, token_counts, topk
from ledgerloom.llm._gsaca import suffix_array

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_token_counts(docs, rows, none, library):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs, PATH, block_bytes=5000).collect())
    assert got == sorted((str(r.doc_id), len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in rows)
    assert token_counts.token_counts(none, PATH).count() == 0


def test_token_counts_with_a_small_memory(docs, rows, library, monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN", 10)
    got = sorted((str(r.doc_id), r.n_tokens) for r in token_counts.token_counts(docs, PATH, n_buckets=3, block_bytes=3000).collect())
    assert got == sorted((str(r.doc_id), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in rows)


def test_a_block_that_is_not_whole_is_an_error():
    meta = struct.pack("<q", 2) + bytes(17)
    table = pa.table({"block": [1, 1], "is_meta": [True, False], "payload": [meta, b""]})
    with pytest.raises(ValueError, match="isn't whole"):
        token_counts._sum_block(table)


def test_other_tokenizers_are_refused():
    from ledgerloom.llm import _tokens

    with pytest.raises(ValueError, match="its ids depend"):
        _tokens.UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list(" \n.,;:!?'aZéÀß<|>")))))
def test_units_give_the_librarys_ids(text):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(PATH) if not hasattr(test_units_give_the_librarys_ids, "t") else test_units_give_the_librarys_ids.t
    test_units_give_the_librarys_ids.t = own
    ids, _ = packing.token_ids(pa.array([text], pa.large_string()), PATH, 1)
    assert ids.tolist() == [*own.encode(text, add_special_tokens=False).ids, 1]


def test_pack(docs, rows, none, library):
    got = packing.pack(docs, PATH).collect()
    want, have = Counter(), defaultdict(list)
    for r in rows:
        want[(r.doc_id, tuple([*library.encode(r.text or "", add_special_tokens=False).ids, 1]))] += 1
    texts = defaultdict(set)
    for (i, ids), _n in want.items():
        texts[i].add(ids)
    for p in got:
        assert any(len(t) == p.doc_tokens and zlib.crc32(np.array(t[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for t in texts[p.doc_id])
        have[p.sequence_id].append(p)
    assert sum(p.length for p in got) == sum(len(ids) * n for (_, ids), n in want.items())
    padding = 0
    for ps in have.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 2048 + 0.03 * sum(p.length for p in got)
    assert packing.pack(none, PATH).count() == 0


def test_pack_along_an_order(spark, tmp_path, monkeypatch):
    """Sequences follow the order of the written table up to the ranges that share a bin; every piece is there once."""
    monkeypatch.setattr(packing, "PER_WORKER", 40)
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.choice([30, 300, 700, 1500, 5000])))) for i in range(600)]
    spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(5).orderBy("doc_id").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    got = packing.pack(table, PATH, order=packing.file_order(20)).collect()
    plain = packing.pack(table, PATH).collect()
    key = lambda p: (p.doc_id, p.start, p.length, p.ids_crc32)
    assert sorted(map(key, got)) == sorted(map(key, plain))
    for found in (got, plain):
        by = defaultdict(list)
        for p in found:
            by[p.sequence_id].append(p)
        for ps in by.values():
            ps.sort(key=lambda p: p.offset)
            assert [p.offset for p in ps] == [sum(q.length for q in ps[:i]) for i in range(len(ps))] and sum(p.length for p in ps) <= 2048
    whole = [(p.sequence_id, p.doc_id) for p in sorted(got, key=lambda p: (p.sequence_id, p.offset)) if p.length == 2048]
    assert all(b - a > -21 for (_, a), (_, b) in zip(whole, whole[1:], strict=False))
    early = [p.doc_id for p in got if p.sequence_id < sorted(q.sequence_id for q in got)[len(got) // 4]]
    assert sum(i < 300 for i in early) > 0.9 * len(early)


@given(st.integers(0, 10_000))
def test_cuts(n):
    out = packing.cuts(n, 2048)
    assert sum(out) == n and all(0 < x <= 2048 for x in out) and len(out) <= n // 2048 + 8


def measures(text):
    w = WORD.findall(text or "")
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, rows, none):
    got = quality.quality_report(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted((str(r.doc_id), *(m := measures(r.text)), m[0] < 50 or 100 * m[4] > 50 * m[0]) for r in rows)
    assert not any(r.kept and r.base_failed for r in got)
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert Counter(str(r.doc_id) for r in kept.collect()) == Counter(str(r.doc_id) for r in got if r.kept)
    assert quality.quality_report(none).count() == quality.quality_filter(none).count() == 0


def test_sketches_merge(spark, docs):
    scored = quality.measured(docs.select("text", "lang", "source"), "text").select("row.lang", "row.source", *quality.MEASURES)
    whole = quality.sketches(scored, ["lang"])
    merged = quality.merged(quality.sketches(scored, ["lang", "source"]), ["lang"])
    assert sorted(map(str, whole.collect())) == sorted(map(str, merged.select(whole.columns).collect()))


def brute_classes(rows, similarity=0.8):
    """The smallest id of the class of each (id, text)."""
    sets, root = {}, {}
    for r in rows:
        w = WORD.findall(r.text or "")
        if r.doc_id is not None:
            root[r.doc_id, r.text or ""] = (r.doc_id, r.text or "")
            if w:
                sets[r.doc_id, r.text] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and (both := sum((sets[a] & sets[b]).values())) >= similarity * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i)[0] for i in root}


def test_near_duplicates(docs, rows, none):
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == {i: c for (i, _), c in brute_classes(rows).items()}
    assert near_dup.near_duplicates(none).count() == 0
    kept = near_dup.drop_near_duplicates(docs)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*map(str, {r.class_id for r in got if r.doc_id is not None}), "None"])


def test_links_past_the_smallest_id(spark):
    """A chain of edits: neighbours are alike, ends are not; all are one class."""
    rng = random.Random(3)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    out = []
    for i in range(12):
        out.append((11 - i, " ".join(words)))
        for _ in range(6):
            words[rng.randrange(400)] = f"n{rng.randint(0, 10**6)}"
    df = spark.createDataFrame(out, "doc_id LONG, text STRING")
    assert {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()} == {i: c for (i, _), c in brute_classes(df.collect()).items()}


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(1)
    a = [f"w{rng.randint(0, 300)}" for _ in range(3000)]
    b = a[:2400] + [f"v{rng.randint(0, 300)}" for _ in range(600)]
    texts = pa.array([" ".join(a), " ".join(b)], pa.large_string())
    row, h, weight = near_dup.elements(texts, 1)
    sig = near_dup.dart_signatures(row, h, weight, 2, 2000)
    ca, cb = Counter(a), Counter(b)
    true = sum((ca & cb).values()) / sum((ca | cb).values())
    assert abs((sig[0] == sig[1]).mean() - true) < 0.04


def brute_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for n, r in enumerate(rows):
        for k in {key(x) for x in (r.text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].add((r.doc_id, n if r.doc_id is None else 0))
    last = {k: max([i for i, _ in v if i is not None], default=None) for k, v in holders.items() if len(v) >= 3}
    out = []
    for r in rows:
        lines = (r.text or "").split("\n")
        stay = [x for x in lines if key(x) not in last or last[key(x)] is None or last[key(x)] == r.doc_id]
        out.append((str(r.doc_id), len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def test_lines(docs, rows, none):
    for batches, fanout in ((1, 4), (5, 2), (4, 3)):
        out = line_dedup.dedup_lines(docs, n_batches=batches, fanout=fanout)
        assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in out.collect()) == brute_lines(rows)
    assert line_dedup.dedup_lines(none).count() == 0


def test_passages(docs, rows, none):
    first, found = {}, {}
    place = lambda r, a: (r.doc_id is not None, r.doc_id or 0, r.text or "", a)
    for r in rows:
        own = [(n, a, b, w) for n, (a, b) in enumerate(passages.units(r.text or "", "run", 8)) if len(w := (r.text or "")[a:b].lower().split()) >= 8]
        found[place(r, 0)] = own
        for _, a, _, w in own:
            k = " ".join(w)
            first[k] = min(first.get(k, place(r, a)), place(r, a))
    by = lambda r: (str(r.doc_id), r.text or "")
    for r, got in zip(sorted(rows, key=by), sorted(passages.dedup_passages(docs).collect(), key=lambda r: (str(r.doc_id), r.text or "")), strict=True):
        assert r.doc_id == got.doc_id
        again = [(n, a, b, len(w)) for n, a, b, w in found[place(r, 0)] if first[" ".join(w)] != place(r, a)]
        runs = []
        for x in again:
            if runs and runs[-1][-1][0] + 1 == x[0]:
                runs[-1].append(x)
            else:
                runs.append([x])
        cut = [(a, b) for run in runs if sum(x[3] for x in run) >= passages.MIN_RUN for _, a, b, _ in run]
        assert [(s.start, s.stop) for s in got.removed or []] == cut
    assert passages.dedup_passages(none).count() == 0


@given(st.text())
def test_units_cover_whole_texts(text):
    for kind in ("run", "line"):
        spans = list(passages.units(text, kind))
        assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
        assert sum(b - a for a, b in spans) == len(text) - text.count("\n")


def test_shards(docs, rows, none):
    out = sharding.place(sharding.shard_documents(docs, sharding.even_tree(8)), sharding.even_tree(9), "doc_id", "grown")
    got = out.collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.grown in (r.shard, 8)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert sharding.shard_documents(none, sharding.even_tree(8)).count() == 0


def test_moves_stay_in_changed_subtrees(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = [(0, 0, 0, 1.0), (0, 0, 1, 1.0), (0, 1, 2, 1.0), (1, 2, 3, 2.0), (1, 2, 4, 1.0)]
    heavier = [x if x[2] != 4 else (1, 2, 4, 3.0) for x in tree]
    both = sharding.place(sharding.place(ids, tree, out="a"), heavier, out="b")
    n = both.groupBy("a").count().collect()
    assert {r.a: round(r["count"] / 20_000 * 6) for r in n} == {0: 1, 1: 1, 2: 1, 3: 2, 4: 1}
    moved = both.where("a <> b").select("a", "b").distinct().collect()
    assert all(r.b in (3, 4) for r in moved) and all(r.b == 4 for r in moved if r.a == 3)


def test_mix(docs, rows, none):
    got = mixing.plan_mix(docs).collect()
    sizes, words = Counter(), {}
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            break
        capped |= {s: 3.0 * sizes[s] for s in over}
    target |= capped
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in order) and len(got) == len(rows) and not words
    again = sorted(map(str, mixing.plan_mix(docs.repartition(5)).collect()))
    assert again == sorted(map(str, got))
    assert mixing.plan_mix(none).count() == 0


def test_mixed_documents(docs):
    plan = mixing.plan_mix(docs)
    copies = mixing.mixed_order(plan).collect()
    assert [c.position for c in copies] == sorted(c.position for c in copies) and all(-1e-9 <= c.position < 1 for c in copies)
    each = [r.positions for r in plan.withColumn("positions", mixing.positions()).collect()]
    assert all(p == sorted(p) for p in each) and Counter(x for p in each for x in p) == Counter(c.position for c in copies)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    got = Counter((str(r.doc_id), len(WORD.findall(r.text or ""))) for r in out.collect())
    assert got == Counter((str(c.doc_id), c.words) for c in copies)


def brute_repeats(rows, width=100):
    seen, out = set(), []
    texts = {(r.doc_id is not None, r.doc_id or 0, (r.text or "").encode()) for r in rows}
    for has, i, b in sorted(texts):
        mask, end = bytearray(len(b)), 0
        for q in range(len(b) - width + 1):
            if b[q : q + width] in seen:
                s = max(q, end)
                mask[s : q + width] = b"\x01" * (q + width - s)
                end = q + width
            else:
                seen.add(b[q : q + width])
        out.append((has, i, len(b), sum(mask), len(re.findall(rb"\x01+", bytes(mask))), hashlib.sha256(bytes(c for c, m in zip(b, mask, strict=True) if not m)).hexdigest()))
    return out


def test_repeats(docs, rows, none):
    got = {(r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, len(r.removed), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == set(brute_repeats(rows))
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_crowded_anchors(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", 2)
    monkeypatch.setattr(suffix_dedup, "BIN_BYTES", 1000)
    got = {(r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, len(r.removed), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == set(brute_repeats(rows))


def test_anchors_by_piece(rows, monkeypatch):
    """Each window has the same anchor however texts are cut, and a text's anchors are numbered alike in any block."""
    texts = pa.array([r.text or "" for r in rows], pa.large_string())

    def windows(found):
        return {(r, lo + w, lo + off) for r, lo, n, off in zip(*(x.tolist() for x in found[:4]), strict=True) for w in range(n)}

    whole = windows(suffix_dedup.anchors(texts, 100))
    monkeypatch.setattr(suffix_dedup, "_PIECE", 700)
    found = suffix_dedup.anchors(texts, 100)
    assert windows(found) == whole and len(whole) == sum(max(0, len(t.encode()) - 99) for t in texts.to_pylist())
    for i in range(len(texts)):
        alone = suffix_dedup.anchors(texts.slice(i, 1), 100)
        assert all((x[found[0] == i] == y).all() for x, y in zip(found[1:], alone[1:], strict=True))


def test_narrowed_anchors(spark, monkeypatch):
    # one line stands between other words everywhere; some of these come again nearer to it or farther from it
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=9))
    line, few = "the line that all of them hold, word for word", [word() for _ in range(2)]
    some = lambda: " ".join(rng.choice(few) for _ in range(3))
    texts = [f"{word()} {some()} {line} {some()} {word()}" for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", 4)
    halves, narrowed = suffix_dedup._halves, []
    monkeypatch.setattr(suffix_dedup, "_halves", lambda *x: narrowed.append(x) or halves(*x))
    marks, sizes = suffix_dedup._different_contexts, []

    def seen(several, width):
        sizes.extend(r["count"] for r in several.where("near < far").groupBy("h").count().collect())
        return marks(several, width)

    monkeypatch.setattr(suffix_dedup, "_different_contexts", seen)
    got = {(True, r.doc_id, r.n_bytes, r.n_removed, len(r.removed), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == set(brute_repeats(docs.collect()))
    assert sum(x[3] > 0 for x in got) > 5 and 2 <= len(narrowed) <= 7 and max(sizes) <= 4


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.text("ab", max_size=80).map(str.encode)))
def test_suffix_array(data):
    assert suffix_array(data) == sorted(range(len(data)), key=lambda i: data[i:])


VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>, shard INT, q INT"


def test_top_k(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.choice([-1.0, 0.5, 0.25, rng.random()])) for _ in range(8)], 1, 2) for i in range(300)]
    rows[7] = (7, rows[8][1], 1, 2)
    rows += [(400, None, 1, 2), (420, [1.0, None], 1, 2), (440, [float("nan")] * 8, 1, 2), (460, [float("inf")] * 8, 1, 2), (None, [1.0] * 8, 1, 2), (480, [1.0, 2.0], 1, 2), (500, [], 1, 2), rows[40]]
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 20, 64, shard_rows=64, group_rows=5, block=16).collect()
    good = [(i, [int(np.floor(64 * np.float64(np.float32(x)))) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for i, v in {i: v for i, v in good if i % 20 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in good if j != i)[:20]
        want |= {(i, k, j, -s) for k, (s, j) in enumerate(scores, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want
    assert topk.top_k(spark.createDataFrame([], VECTORS), F.col("vec_id") % 20 == 0).count() == 0


def test_huge_components(spark):
    df = spark.createDataFrame([(0, [2.0e6, -3.0e6]), (1, [2.0e6, 1.0]), (2, [-1.0, 5.0e6])], "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(df, F.col("vec_id") == 0).collect()}
    assert got == {(0, 1): 4096 * (2_000_000**2 - 3_000_000), (0, 2): 4096 * (-2_000_000 - 15_000_000_000_000)}


def test_sums_beyond_doubles(spark):
    big = 2.0**33
    df = spark.createDataFrame([(0, [big, 1 / 64]), (1, [big / 2, 3.0]), (2, [big / 2, 2.0]), (3, [-big, 1.0])], "vec_id LONG, embedding ARRAY<DOUBLE>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(df, F.col("vec_id") == 0).collect()
    small = df.withColumn("embedding", F.transform("embedding", lambda x: x / 256))
    got = [(r.vec_id, r.score) for r in topk.top_k(small, F.col("vec_id") == 0, 2).orderBy("rank").collect()]
    assert got == [(1, 2**31 * 2**30), (2, 2**31 * 2**30)]
    with pytest.raises(Exception, match="beyond 2\\^62"):
        topk.top_k(df.withColumn("embedding", F.transform("embedding", lambda x: x * 1e30)), F.col("vec_id") == 0).collect()


def test_ties_of_a_very_common_vector(spark):
    """Most vectors are equal: the smallest ids win, whichever shard gave the first k-th score."""
    rows = [(i, [1.0, 2.0] if i % 5 else [float(i % 3), 1.0]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>").repartition(7)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 10, shard_rows=16, group_rows=3, block=4).collect()}
    m = np.floor(64 * np.array([v for _, v in rows])).astype(int)
    want = {(q, r): (j, -s) for q in range(0, 400, 20) for r, (s, j) in enumerate(sorted((-int(x), i) for i, x in enumerate(m @ m[q]) if i != q)[:10], 1)}
    assert got == want


def test_waves_of_shards(spark, monkeypatch):
    """The k-th scores rise from wave to wave; ties and repeated rows come out as from one look at all vectors."""
    assert [topk._waves(n) for n in (0, 1, 16, 17, 80, 81)] == [1, 1, 1, 2, 2, 3]
    monkeypatch.setattr(topk, "FIRST_WAVE", 1)
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(600)]
    rows += rows[30:60] + [(i, rows[7][1]) for i in range(600, 640)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>").repartition(5)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 10, shard_rows=8, group_rows=7, block=4).collect()
    ids, m = np.array([i for i, _ in rows]), 64 * np.array([v for _, v in rows]).astype(int)
    want = [(q, j, -s) for q in range(0, 640, 20) for s, j in sorted((-int(x), int(i)) for i, x in zip(ids, m @ m[ids == q][0], strict=True) if i != q)[:10]]
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == sorted(want)
    assert all(r["rank"] in range(1, 11) for r in got)


def test_bounds_keep_vectors_back(spark):
    """Vectors in clusters by id: most pairs of a query and a shard are never scored, and no result is lost."""
    rng = np.random.default_rng(3)
    centers = 40 * np.eye(20)
    rows = [(i, (centers[i // 50] + rng.random(20)).tolist()) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 5, shard_rows=25, group_rows=1, block=8)
    m = np.floor(64 * np.array([v for _, v in rows])).astype(int)
    want = {(q, r, j, s) for q in range(0, 1000, 20) for r, (s, j) in enumerate(sorted(((-int(x), i) for i, x in enumerate(m @ m[q]) if i != q))[:5], 1)}
    assert {(r.query_id, r["rank"], r.vec_id, -r.score) for r in got.collect()} == want
    shards = [m[a : a + 25] for a in range(0, 1000, 25)]
    bounds = pa.table({"shard": list(range(40)), "high": [x.max(axis=0).tobytes() for x in shards], "low": [x.min(axis=0).tobytes() for x in shards]})
    kth = sorted((m @ m[60]).tolist())[-6]
    group = pa.table({"grp": [0], "m": [m[60].tobytes()], "kth": [[{"i": 0, "kth": kth, "held": 0}]]})
    assert topk._bounded(20, True)(group, bounds)["shard"].to_pylist() in ([2], [3])
    assert topk._bounded(20, False)(group, bounds)["shard"].to_pylist() == [2, 3]


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    names = docs.columns
    now, frames = docs, []
    for k, (_name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        frames.append(now)
        if k < 4:
            assert now.columns == names
    kept, lines, near, mixed, packed = (f.collect() for f in frames)
    assert all((m := measures(r.text))[0] >= 1 and 100 * m[4] <= 50 * m[0] for r in kept)
    assert sorted((str(r.doc_id), r.text) for r in lines) == sorted((i, t) for i, _, _, t in brute_lines(kept))
    classes = brute_classes(lines)
    assert sorted(r.doc_id for r in near if r.doc_id is not None) == sorted(set(classes.values()))
    assert sum(len(WORD.findall(r.text)) for r in mixed) == pytest.approx(sum(len(WORD.findall(r.text)) for r in near), abs=10)
    assert {str(p.doc_id) for p in packed} == {str(r.doc_id) for r in mixed}
    from ledgerloom.llm import _shared

    before = list(_shared._written)
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert not any("stage0" in x or "line-run" in x for x in _shared._written if x not in before)
    assert run.columns == frames[-1].columns and run.count() == len(packed)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_sql(spark):
    import duckdb

    from ledgerloom.llm import queries

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        ours, theirs = queries.queries()[name](spark, "/root/testdata/sf0.001").toPandas(), con.sql(sql).df()
        cols = sorted(ours.columns)
        assert cols == sorted(theirs.columns), name
        assert sorted(map(tuple, ours[cols].astype(str).values)) == sorted(map(tuple, theirs[cols].astype(str).values)), name


def test_written_tables_are_cleared(spark):
    from ledgerloom.llm import _shared

    df = _shared.written(spark.range(3).toDF("doc_id"), "x")
    path = _shared._written[-1].removeprefix("file://")
    assert df.count() == 3 and os.path.isdir(path)
    _shared.clear_written(spark)
    assert not os.path.isdir(path) and not _shared._written
