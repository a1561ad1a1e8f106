"""Operators 1, 4 and 6 and the pipeline against brute force, and on odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pytest

import corpus_pipeline
from cohortflow.llm import lines, linking, mixing, near, toxicity, words as W
from cohortflow.llm.common import read
from tests.llm.fixtures import documents, odd_rows, plain, words

SF001 = "/root/testdata/sf0.001"


class Sets:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(k, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def expected_near(rows, k):
    """Rows of one id with different sets are different documents."""
    docs = sorted({(i, shingles(t, k)) for i, t in rows if i is not None}, key=lambda d: (d[0], sorted(d[1])))
    groups = Sets(range(len(docs)))
    for x, (_, a) in enumerate(docs):
        for y in range(x + 1, len(docs)):
            b = docs[y][1]
            both = len(a & b)
            if a and b and 100 * both >= 80 * (len(a) + len(b) - both):
                groups.join(x, y)
    comp = {d: docs[groups.find(x)][0] for x, d in enumerate(docs)}  # the first of a group has its least id
    out = Counter()
    for i, t in rows:
        s = shingles(t, k)
        out[i, len(s), comp.get((i, s)), i is None or comp[i, s] == i] += 1
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_of_odd_rows(spark, k):
    rows = [(i, t) for i, t, *_ in odd_rows()]
    got = near.near_duplicates(documents(spark), k).collect()
    assert Counter(map(tuple, got)) == expected_near(rows, k)
    assert near.near_duplicates(documents(spark, [])).count() == 0


def test_near_duplicates_of_a_table(spark):
    docs = read(spark, SF001, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert Counter(map(tuple, near.near_duplicates(docs, 2).collect())) == expected_near(rows, 2)


@pytest.mark.parametrize("small", [256, 2])
def test_chains_and_large_groups(spark, monkeypatch, small):
    monkeypatch.setattr(near, "linked", partial(linking.linked, small=small, block=7))
    # a hub whose copies differ from one another more than from it, and a chain
    rng = random.Random(7)
    hub = words(rng, 100).split()
    texts = [" ".join(hub)]
    for i in range(60):
        copy = list(hub)
        for at in rng.sample(range(100), 5):
            copy[at] = f"x{i}y{at}"
        texts.append(" ".join(copy))
    link = words(rng, 120).split()
    for i in range(12):
        link = link[5:] + words(rng, 5).split()
        texts.append(" ".join(link))
    assert Counter(map(tuple, near.near_duplicates(plain(spark, texts), 2).collect())) == expected_near(list(enumerate(texts)), 2)


def test_one_of_each_keeps_one_row(spark):
    got = near.one_of_each(documents(spark), 5).collect()
    ids = Counter(r["doc_id"] for r in got)
    assert ids[1] == 1 and ids[2] == ids[4] == 0 and ids[14] == 2 and ids[None] == 2 and ids[15] == 1 and ids[16] == 0
    assert {r["size"] for r in got} == {-1} and ids[5] == ids[6] == ids[7] == 1


def test_texts_of_one_id_are_kept_apart(spark):
    rng = random.Random(9)
    a, b, c = (words(rng, 60) for _ in "abc")
    near_c = c.replace(c.split(" ")[0], "other")
    rows = [(5, a), (3, b), (5, b), (7, a), (5, b), (9, c), (9, near_c), (9, c), (2, ""), (2, ""), (None, a)]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, row int")
    assert Counter(map(tuple, near.near_duplicates(docs, 2).collect())) == expected_near(rows, 2)
    got = Counter((r["doc_id"], r["text"]) for r in near.one_of_each(docs, 2).collect())
    assert (got.pop((9, c), 0), got.pop((9, near_c), 0)) in ((1, 0), (0, 1))
    assert got == Counter({(5, a): 1, (3, b): 1, (2, ""): 2, (None, a): 1})


def test_odd_sketches_tell_high_similarity():
    rng = np.random.default_rng(3)
    for j in (1.0, 0.9, 0.8, 0.4, 0.1):
        n = 2000
        same = int(2 * n * j / (1 + j))
        numbers = lambda k: rng.integers(0, 2**63, k).astype(np.uint64)
        both = numbers(same)
        a, b = (np.unique(np.concatenate([both, numbers(n - same)])) for _ in "ab")
        x, y = (near.odd_sketch(near.samples(s)) for s in (a, b))
        bits = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        estimate = 1 + near.BITS / (4 * near.BANDS * near.ROWS) * np.log(max(1e-9, 1 - 2 * bits / near.BITS))
        assert (bits <= near.MOST_BITS) == (j >= 0.8) and (abs(estimate - j) < 0.12 or j < 0.5)


def test_word_hashes_follow_words():
    a, b = W.word_hashes("Ab cd e \x0b ab AB É é"), W.word_hashes("ab")
    assert len(a) == 6 and a[0] == a[2] == a[3] == b[0] and a[4] != a[5]
    assert len(W.word_hashes(" \t")) == len(W.word_hashes("")) == 0


def test_components(spark):
    edges = [(5, 9), (9, 12), (1, 2), (2, 3), (3, 4), (20, 21)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["id"]: r["comp"] for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = Sets({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    assert got == {x: groups.find(x) for x in groups.up}


def test_only_shared_buckets_stay(spark):
    rows = [(b, i) for b in range(50) for i in range(b % 4)] + [(7, 1), (1, 0), (99, 5), (99, 5)]
    got = Counter(map(tuple, linking.shared_only(spark.createDataFrame(rows, "bucket long, id long").repartition(3)).collect()))
    assert set(got) == {(b, i) for b, i in rows if len({j for c, j in rows if c == b}) > 1}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        again = linking.shared_only(spark.createDataFrame(rows, "bucket long, id long").repartition(3)).collect()
        assert set(map(tuple, again)) == set(got)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, edits, letters="abcdé"):
    b = list(text)
    for _ in range(edits):
        i, how = rng.randrange(len(b) + 1), rng.randrange(3)
        if how == 0:
            b.insert(i, rng.choice(letters))
        elif b and how == 1:
            b.pop(min(i, len(b) - 1))
        elif b:
            b[min(i, len(b) - 1)] = rng.choice(letters)
    return "".join(b)


def test_within_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 12)))
        b = edited(rng, a, rng.randrange(0, 4), "abc")
        for t in range(4):
            assert lines.within(a, b, t) == (distance(a, b) <= t)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines_within_the_edits_share_a_key(edits):
    rng = random.Random(edits)
    for _ in range(400):
        a = "".join(rng.choice("abcdefé漢") for _ in range(rng.randrange(lines.PER_EDIT, 60)))
        b = edited(rng, a, edits)
        if not lines.within(a, b, int(lines.allowed(min(len(a), len(b)), edits))):
            continue
        assert set(lines.keys([a], [1], edits)[0].tolist()) & set(lines.keys(["other line", b], [2, 3], edits)[0].tolist())


def expected_lines(rows):
    """Of each row (id, text): the numbers of the lines that go."""
    some = lambda x: re.search(r"[^\x20\x09-\x0D]", x)
    seen = [(i is None, i or 0, k, x) for i, t in rows for k, x in enumerate((t or "").split("\n")) if some(x)]
    groups = Sets({x for *_, x in seen})
    long = sorted((x for x in groups.up if len(x) >= 10), key=len)
    for n, a in enumerate(long):
        most = min(lines.EDITS, len(a) // 10)
        for b in long[n + 1:]:
            if len(b) - len(a) > most:
                break
            if lines.within(a, b, most):
                groups.join(a, b)
    first = {}
    for *at, x in sorted(seen):
        first.setdefault(groups.find(x), at)
    return [[k for k, x in enumerate((t or "").split("\n")) if some(x) and first[groups.find(x)] != [i is None, i or 0, k]] for i, t in rows]


@pytest.mark.parametrize("small", [256, 1])
def test_variants_of_a_line(spark, monkeypatch, small):
    monkeypatch.setattr(lines, "linked", partial(linking.linked, small=small, block=5))
    rng = random.Random(9)
    base = words(rng, 12)
    texts = [base, *(edited(rng, base, k % 7) for k in range(60))]
    got = {r["doc_id"]: r["n_dropped"] for r in lines.line_dedup(plain(spark, texts)).collect()}
    assert got == {i: len(x) for i, x in enumerate(expected_lines(list(enumerate(texts))))}


def test_lines_of_every_length(spark):
    rng = random.Random(12)
    some = ["".join(rng.choice("abc d") for _ in range(n)) for n in range(1, 45) for _ in range(3)]
    some += [edited(rng, x, rng.randrange(0, 3), "abc") for x in some] + [" ", "\t", "a", "a", "é", ".", "."]
    rng.shuffle(some)
    texts = ["\n".join(some[k::9]) for k in range(9)]
    got = {r["doc_id"]: r["text"] for r in lines.line_dedup(plain(spark, texts)).collect()}
    want = expected_lines(list(enumerate(texts)))
    assert got == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(want[i])) for i, t in enumerate(texts)}
    assert sum(map(len, want)) > 60


def test_line_dedup_of_odd_rows(spark):
    rng = random.Random(8)
    base = words(rng, 12)
    extra = [(30, f"{base}\nshort\n{base}x", "en", "a"), (31, edited(rng, base, 2) + "\n\n" + words(rng, 9), "en", "a"),
             (32, "short\n" + base + "\nBoiler plate", "en", "a"), (33, "Boiler plate", "en", "a"), (34, "Boiler plat", "en", "a")]
    rows = [*odd_rows(), *[(*r, len(r[1]), -1, "x", "y", "z", "w") for r in extra]]
    got = lines.line_dedup(documents(spark, rows))
    assert got.columns == [*documents(spark).columns, "n_lines", "n_dropped"]
    want = Counter()
    for r, gone in zip(rows, expected_lines([r[:2] for r in rows]), strict=True):
        split = (r[1] or "").split("\n")
        want[r[0], "\n".join(x for k, x in enumerate(split) if k not in set(gone)) if r[1] is not None else None, len(split), len(gone)] += 1
    assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()) == want
    assert lines.line_dedup(documents(spark, [])).count() == 0


def test_targets_share_out_the_rest():
    assert mixing.targets([100, 100, 100], [3, 1, 2]) == pytest.approx([200, 250 / 3, 500 / 3])
    assert mixing.targets([10, 1000], [3, 1]) == [20.0, 1495.0]
    assert mixing.targets([10, 0, 5], [1, 1, 1]) == [12.5, 0.0, 10.0] or sum(mixing.targets([10, 0, 5], [1, 1, 1])) == 22.5
    assert mixing.targets([], []) == [] and mixing.targets([0], [3]) == [0.0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_permutations(n):
    at = np.arange(n, dtype=np.uint64)
    a, b = (mixing.permuted(at, np.full(n, n, np.uint64), np.full(n, key, np.uint64)) for key in (1, 2))
    assert sorted(a.tolist()) == list(range(n)) and (n < 64 or a.tolist() != b.tolist())


def test_draws_add_up():
    got = mixing.draws([1000, 10, 0, 333], 7, 1)
    assert got.sum(axis=0).tolist() == [1000, 10, 0, 333] and got.sum(axis=1).max() - got.sum(axis=1).min() <= 7
    assert len({tuple(x) for x in got.tolist()}) > 1 and mixing.draws([], 3, 1).shape == (3, 0)


def test_mix_of_odd_rows(spark):
    rows = odd_rows()
    got = mixing.mixed(documents(spark)).collect()
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, n(t)) for i, t, *_ in rows)
    total = defaultdict(int)
    for _, t, _, s, *_ in rows:
        total[s] += n(t)
    due = mixing.targets([total[s] for s in ("a", "b", "c", None)], [3, 1, 2, 3])
    for s, t in zip(("a", "b", "c", None), due, strict=True):
        mine = [r for r in got if r["source_size"] == total[s]]
        assert all(abs(r["target"] - t) < 1e-6 and r["taken"] <= 2 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - t) <= mixing.BLOCK + 0.02 * t
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mixed(documents(spark).repartition(5)).collect()))
    assert mixing.mixed(documents(spark, [])).count() == mixing.mixed_documents(documents(spark, [])).count() == 0


def test_mixed_texts_hold_what_is_taken(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, words(rng, rng.randrange(0, 400)), "en", rng.choice("ab")) for i in range(60)], "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", docs.doc_id)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixed(docs).collect()}
    texts = defaultdict(list)
    for r in mixing.mixed_documents(docs).collect():
        texts[r["doc_id"]].append(r["text"])
        assert r["n_chars"] == len(r["text"]) > 0
    assert {i: sum(len(t.split()) for t in x) for i, x in texts.items()} == {i: n for i, n in taken.items() if n}
    source = {r["doc_id"]: set(r["text"].split()) for r in docs.collect()}
    assert all(set(t.split()) <= source[i] for i, x in texts.items() for t in x)


def test_slots_follow_the_draws(spark):
    docs = plain(spark, [words(random.Random(i), 300) for i in range(40)])
    _, sources = mixing.placed(docs.select("doc_id", "source", "text"))
    got = mixing.slots(sources, 8).collect()
    due, blocks = sources.select("__due", "__blocks").first()
    assert len(got) == due and Counter(r["shard"] for r in got).most_common()[0][1] - min(Counter(r["shard"] for r in got).values()) <= 1
    for shard in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    assert max(Counter(r["block"] for r in got).values()) - min(Counter(r["block"] for r in got).values()) <= 1 and {r["block"] for r in got} == set(range(blocks))


def test_pipeline(spark):
    docs = read(spark, SF001, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    state = docs
    out = []
    for name, stage in corpus_pipeline.STAGES:
        state = corpus_pipeline.stored(stage(spark, state, SF001))
        out.append((name, state.collect()))
        if name != "tokens":
            assert state.columns == corpus_pipeline.COLUMNS
    by = dict(out)
    toxic = {r["doc_id"] for r in read(spark, SF001, "labels").where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in by["toxicity"]}
    # recall is measured on held-out rows of a larger table (test_texts); here the decisions take effect
    predicted = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, read(spark, SF001, "labels")).collect()}
    assert clean == {i for i, p in predicted.items() if not p} and len(clean - toxic) > 0.95 * (len(rows) - len(toxic))
    first = [tuple(r)[:2] for r in by["toxicity"]]
    gone = expected_lines(first)
    assert {(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(g))) for (i, t), g in zip(first, gone, strict=True)} == {
        (r["doc_id"], r["text"]) for r in by["line dedup"]}
    second = [tuple(r)[:2] for r in by["line dedup"]]
    assert {i for (i, _, _, kept) in expected_near(second, 5) if kept} == {r["doc_id"] for r in by["near-dedup"]}
    assert all(n <= 2 for n in Counter(r["doc_id"] for r in by["mixing"]).values())
    assert len(by["tokens"]) == len(by["mixing"]) and all(r["n_tokens"] > 0 for r in by["tokens"])


def test_pipeline_of_odd_and_no_rows(spark):
    for rows in (odd_rows(), []):
        state, before = documents(spark, rows), None
        for name, stage in corpus_pipeline.STAGES:
            before, state = state, corpus_pipeline.stored(stage(spark, state, SF001))
            if name != "tokens":
                assert state.columns == corpus_pipeline.COLUMNS
            if name == "near-dedup":
                texts = [r["text"] for r in state.collect()]
                assert all(texts.count(t) == 1 for t in set(texts) if t and t.strip() and "tie" not in t) or not rows
        assert state.count() == before.count() and (state.count() > 0) == bool(rows)
        assert state.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
