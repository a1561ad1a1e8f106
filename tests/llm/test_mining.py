"""Collocations, manifest and quality rules against plain Python over small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortflow.llm import collocations as C
from cohortflow.llm import merkle, quality, registry
from cohortflow.llm.common import read
from tests.conftest import SF001
from tests.llm.fixtures import documents, odd_rows, plain

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER = str.maketrans(UP, LOW)


# ---- collocations

def phrase_rows():
    """Documents with frequent phrases across separators, hot passages, null language, repeated rows, one long text."""
    rng = random.Random(1)
    stock = ["the", "of", "House", "HOUSE", "of", "cards", "new", "york", "city", "é", "ß", "x1"]
    texts = []
    for i in range(120):
        words = [rng.choice(stock) for _ in range(rng.randint(0, 30))]
        texts.append("".join(w + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " \x0b", " ", " ", " "]) for w in words))
    texts += ["New York City is not new york; city"] * 40 + ["a b c d e f"] * 29 + [None, "", " \t", ".,;", "one"]
    texts.append("deep learning " * 3000 + "x" * 5000 + " deep learning")
    return [(i % 90 if i % 7 else None, t, (None, "en", "en", "de", "en")[i % 5] if i < 200 else "en") for i, t in enumerate(texts)]


def grams_of(rows):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    return f, n


def mined(rows, least, most):
    f, n = grams_of(rows)
    f = {k: v for k, v in f.items() if v >= least}
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        inside = lambda q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(g == lang and len(q) > len(p) and inside(q) and 100 * b >= 80 * a for (g, q), b in f.items()):
            continue
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out.sort()
    rank, got = Counter(), set()
    for lang, score, a, p, l, r in out:
        rank[lang] += 1
        if rank[lang] <= most:
            got.add((lang, rank[lang], p.decode(), -a, l, r, n[lang], -score))
    return got


@pytest.mark.parametrize("sample", [{}, {"part": 3, "sample_least": 1}, {"part": 1000, "sample_least": 2}, {"words": 1}])
def test_collocations_equal_brute_force_whatever_the_sample(spark, sample):
    rows = phrase_rows()
    df = spark.createDataFrame([(i, t, g, 7, "y") for i, t, g in rows], "doc_id long, text string, lang string, n int, phrase string").repartition(3)
    got = [tuple(r) for r in C.collocations(df, 6, 12, **sample).collect()]
    assert len(got) == len(set(got)) and set(got) == mined(rows, 6, 12)
    assert len(got) > 15


def test_stretches_lose_no_phrase(monkeypatch):
    rng = random.Random(2)
    data = "".join(rng.choice(["ab", "c", "dé", " ", " ", ". ", "\n"]) for _ in range(600)).encode()
    for size in (1, 7, 64, 10**6):
        got = Counter()
        for part, own in C.stretches(data, size):
            g = C.Grams(part, own, 3)
            for n in range(1, 5):
                if g.count < n:
                    break
                if n > 1:
                    g.longer()
                at = g.valid().nonzero()[0]
                if len(at):
                    first, f = g.counted(g.ids(), at)
                    got.update(dict(zip(g.phrases(first).to_pylist(), f.tolist(), strict=True)))
        assert got == Counter({" ".join(p): v for (_, p), v in grams_of([(1, data.decode(), "x")])[0].items()})


def test_a_task_holds_and_sends_each_phrase_once():
    of, want = C.Phrases("en"), Counter()
    for k in range(50):
        text = f"a b a c{k % 5}"
        g = C.Grams(text.encode(), len(text), 5)
        for n in (1, 2):
            if n > 1:
                g.longer()
            of.add(g, g.ids(), g.valid().nonzero()[0])
        of.settle()
        want.update({" ".join(p): f for (_, p), f in grams_of([(1, text, "en")])[0].items() if len(p) < 3})
        assert len(of.id) <= 14  # different phrases, however often they are met
    sent = [(r["phrase"], r["f"]) for b in of.rest() for r in b.to_pylist()]
    assert len(sent) == len(want) == 14 and dict(sent) == want
    assert not len(of.id) and list(of.rest()) == []


def test_names_are_added_up_and_tell_the_words(spark, monkeypatch):
    monkeypatch.setattr(C, "HELD", 8)
    monkeypatch.setattr(C, "SENT", 3)
    g, held, got = C.Grams(b"a b a c a b d", 13, 5, False), C.Held(), Counter()
    batches = []
    for n in range(1, 5):
        if n > 1:
            g.longer()
        batches += held.add(g.ids())
    batches += held.rest()
    for b in batches:
        assert 0 < b.num_rows <= 3
        got.update({r["id"]: r["f"] for r in b.to_pylist()})
    names = spark.createDataFrame(list(got.items()), "id long, f long").select(C._words_of().alias("n"), "f").collect()
    by = Counter()
    for r in names:
        by[r["n"]] += r["f"]
    assert by == {1: 7, 2: 6, 3: 5, 4: 4} and sum(r["n"] == 1 for r in names) == 4


def test_phrases_of_one_name_stay_apart(monkeypatch):
    g = C.Grams(b"a b a c a b", 11, 0)
    ids = g.ids()
    ids[:] = 1  # as if all words had one hash
    at, f = g.counted(ids, g.valid().nonzero()[0])
    assert dict(zip(g.phrases(at).to_pylist(), f.tolist(), strict=True)) == {"a": 3, "b": 2, "c": 1}


def test_collocations_of_odd_and_no_rows(spark):
    assert {tuple(r) for r in C.collocations(documents(spark), 30, 50).collect()} == mined([(r[0], r[1], r[2]) for r in odd_rows()], 30, 50)
    assert C.collocations(documents(spark, [])).collect() == []


def test_ranking_is_by_bytes_and_exact():
    assert sorted(["é", "z", "\U0001f600", "￿"], key=str.encode) == ["z", "é", "￿", "\U0001f600"]


# ---- manifest

def h(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(level):
    """Levels of a tree, from the leaves to the root."""
    out = [level]
    while len(level) > 1:
        level = [h("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
        out.append(level)
    return out


def manifest(rows):
    leaf = lambda i, s, g, n, t: h("".join(map(field, (i, s, g, n, t))))
    langs: dict = {}
    for i, text, lang, source, n in rows:
        change = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        own = leaf(i, source, lang, n, text)
        langs.setdefault(lang, []).append((i is None, i or 0, own, leaf(i, source, lang, n, text.translate(LOWER) if text else text) if change else own, i))
    order = sorted(langs, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        langs[g].sort(key=lambda r: r[:3])
    trees = {g: tree([r[2] for r in langs[g]]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for k, (_, _, own, tampered, i) in enumerate(langs[g]):
            proof, folded = "", tampered
            for levels, p in ((trees[g], k), (top, at)):
                for level in levels[:-1]:
                    run, place = level[p // 8 * 8:p // 8 * 8 + 8], p % 8
                    left, right = "".join(run[:place]), "".join(run[place + 1:])
                    proof, folded, p = proof + left + right, h(left + folded + right), p // 8
            out.append((i, own, trees[g][-1][0], top[-1][0], h(proof), folded, folded == top[-1][0]))
    return out


def manifest_rows(n, langs, seed=0):
    rng = random.Random(seed)
    return [(rng.randint(0, n), rng.choice(["Ab c", "ab c", None, "", "ÀB", "x" * 3000]), langs[rng.randint(0, len(langs) - 1)],
             rng.choice([None, "a", "12:b"]), rng.choice([None, 3])) for _ in range(n)]


@pytest.mark.parametrize("rows", [
    manifest_rows(700, ["en"] * 6 + ["de", None, ""]), manifest_rows(90, [f"l{k}" for k in range(75)]), manifest_rows(1, ["en"]),
    [(i, "T", None, None, 1) for i in range(9)], [(i, "T", "en", None, 1) for i in range(8)] + [(1, "U", "de", "s", 2)], [(None, None, None, None, None)] * 3,
], ids=["several levels", "many languages", "one row", "a run of one", "a lone leaf", "nulls and equal rows"])
def test_manifest_equals_plain_python(spark, rows):
    df = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, tree int, leaf string").repartition(4)
    got = sorted((tuple(r) for r in merkle.manifest(df).collect()), key=str)
    assert got == sorted(manifest(rows), key=str)


def test_manifest_of_odd_and_no_rows(spark):
    rows = odd_rows()
    got = sorted((tuple(r) for r in merkle.manifest(documents(spark)).collect()), key=str)
    assert got == sorted(manifest([r[:5] for r in rows]), key=str)
    assert merkle.manifest(documents(spark, [])).collect() == []


def test_a_changed_text_is_the_only_thing_that_fails(spark):
    got = registry.op12_merkle_manifest(spark, SF001).join(read(spark, SF001, "documents"), "doc_id")
    lower = F.translate("text", UP, LOW)
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0) & F.coalesce(lower != F.col("text"), F.lit(False))
    assert got.where(F.col("verified") == tampered).isEmpty() and got.where("verified").count() > 50 and got.where("NOT verified").count() > 20


# ---- quality rules

def base_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines, dup = Counter(), 0
    for x in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += lines[x] > 0
            lines[x] += 1
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again), len(words) < 50 or 100 * len(again) > 50 * len(words)


def buckets_of(text, n):
    p = r"!-/:-@\[-`{-~"
    c = [zlib.crc32(t.encode()) for t in re.findall(rf"[{p}]+|[^{p}\x20\x09-\x0D]+", text or "")]
    return [x % n for x in c] + [(31 * x + y) % n for x, y in zip(c, c[1:], strict=False)]


def judged(rows, trusted, n, threshold):
    raw, target = Counter(), Counter()
    for i, text, *_ in rows:
        raw.update(buckets_of(text, n))
        if i in trusted:
            target.update(buckets_of(text, n))
    nr, nt = sum(raw.values()), sum(target.values())
    w = [round((math.log((target[b] + 1) / (nt + n)) - math.log((raw[b] + 1) / (nr + n))) * 1e6) if nt else 0 for b in range(n)]
    out = []
    for i, text, *_ in rows:
        *base, failed = base_rules(text)
        g = buckets_of(text, n)
        total = sum(w[b] for b in g)
        out.append((i, *base, failed, len(g), total, not failed and total >= threshold * len(g)))
    return out


def quality_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    good = [(i, " ".join(word() for _ in range(rng.randint(60, 120))) + ".\nEnd é.") for i in range(30)]
    bad = [(100 + i, " ".join(word().upper() + "!!" for _ in range(70)) + "\n| * # <>") for i in range(20)]
    loop = [(200, "go on and " * 80), (201, "a b c\n" * 3 + " ".join(word() for _ in range(60)) + "\n \n \n"), (202, "x y z x y z"), (203, " ".join(["same"] * 60))]
    return good + bad + loop + [r[:2] for r in odd_rows()]


@pytest.mark.parametrize("buckets", [1 << 14, 64])
def test_quality_equals_plain_python(spark, buckets):
    rows, trusted = quality_rows(), [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None, 14]
    df = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, n_words int, kept boolean").repartition(3)
    ids = spark.createDataFrame([(i,) for i in trusted * 2], "doc_id long")
    got = sorted((tuple(r) for r in quality.quality(df, ids, buckets, -100_000).collect()), key=str)
    assert got == sorted(judged(rows, set(trusted) - {None}, buckets, -100_000), key=str)
    if buckets > 64:  # enough room to tell the two kinds apart
        assert all(r[-1] == (r[0] < 100) for r in got if r[0] is not None and (30 > r[0] >= 19 or 100 <= r[0] < 120))


def test_quality_without_trusted_or_any_documents(spark):
    none = spark.createDataFrame([], "doc_id long")
    rows = quality_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r["kept"] != r["base_failed"] and r["llr_sum"] == 0 for r in quality.quality(df, none).collect())
    assert quality.quality(df.limit(0), none).collect() == []


def test_no_python_worker_and_no_moved_text(spark):
    plan = registry.op13_quality_rules(spark, SF001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    top = plan[plan.index("== Physical Plan =="):].split("Subquery")[0]
    assert "Exchange" not in top  # all of a document is computed in its row


def test_quality_separates_labelled_documents(spark):
    labels = read(spark, SF001.replace("0.001", "0.01"), "labels")
    got = registry.op13_quality_rules(spark, SF001.replace("0.001", "0.01")).join(labels, "doc_id").where("NOT base_failed")
    share = {r["quality"]: r["k"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert share[1] >= 0.99 and share[0] <= 0.05
