"""Whitening against numpy's own eigenvectors, and the filter audit against plain loops."""

from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np
import pytest

from presswork.llm import audit, whitening
from presswork.llm.frames import prepare
from tests.llm.samples import documents, prose


# --- Whitening --------------------------------------------------------------------------------
@pytest.mark.parametrize("size", [1, 2, 7, 40])
@pytest.mark.parametrize("kind", ["full", "equal", "close", "rank one", "zero"])
def test_spectrum_equals_numpy(size, kind):
    rng = np.random.default_rng(size)
    a = rng.standard_normal((size, size))
    a = a @ a.T
    if kind == "equal":
        a = np.diag([4.0] * min(size, 3) + [1.0] * (size - min(size, 3)))
    elif kind == "close":
        q, _ = np.linalg.qr(a)
        a = q @ np.diag([7.0 + 1e-9 * k for k in range(size)]) @ q.T
        a = (a + a.T) / 2
    elif kind == "rank one":
        v = rng.standard_normal((size, 1))
        a = v @ v.T
    elif kind == "zero":
        a = np.zeros((size, size))
    exact = np.linalg.eigvalsh(a)
    for shift in rng.uniform(exact[0] - 1, exact[-1] + 1, 20):
        assert whitening.above(a, shift) == (exact > shift).sum()
    values, vectors = whitening.leading(a, 4)
    assert len(values) == {"rank one": 1, "zero": 0}.get(kind, min(size, 4))
    if len(values):
        assert np.allclose(values, exact[::-1][: len(values)], rtol=1e-12)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
        assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * exact[-1]


def vectors(seed: int, n: int, size: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    spread = rng.standard_normal((n, size)) * np.linspace(2, 0.1, size)
    rows = [(k, v.tolist()) for k, v in enumerate(spread)]
    rows += [(n, rows[0][1]), (0, rows[0][1]), (None, rows[1][1])]
    nan, inf = float("nan"), float("inf")
    rows += [(n + 1, None), (n + 2, []), (n + 3, [nan] * size), (n + 4, [1.0] * (size - 1) + [inf])]
    rows += [(n + 5, [None] + [1.0] * (size - 1)), (n + 6, [1.0] * (size + 1)), (n + 7, [1e300] * size)]
    return rows


def test_whitening_equals_brute_force(spark):
    prepare(spark)
    rows, size = vectors(3, 300, 12), 12
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    df = df.selectExpr("vec_id", "embedding", "vec_id as component", "'x' as whitened", "1 as n")
    found = whitening.whiten(df, whitening.fit_whitening(df)).collect()
    usable = [(k, np.floor(256 * np.array(v)).astype(int)) for k, v in rows[:303]]
    fit = np.array(sorted({tuple(x.tolist()) for _, x in usable}))
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    expected = []
    for key, x in usable:
        white = ((x - sums / n) @ basis[:, :4]) / np.sqrt(values[:4])
        deviation = int(((n * x.astype(object) - sums) ** 2).sum())
        expected += [(key, c + 1, n, deviation, white[c], values[c] / values.sum()) for c in range(4)]
    assert len(found) == len(expected)
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    signs = {}
    for got, want in zip(sorted(found, key=order), sorted(expected, key=order), strict=True):
        assert tuple(got)[:4] == want[:4]
        sign = signs.setdefault(want[1], np.sign(got["whitened"] * want[4]))
        assert got["whitened"] == pytest.approx(sign * want[4], abs=1e-9)
        assert got["explained"] == pytest.approx(want[5], rel=1e-9)
        assert got["identity_error"] < 1e-9


def test_whitening_of_rough_tables(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = spark.createDataFrame(rows, schema)
        assert whitening.whiten(df, whitening.fit_whitening(df)).count() == 0
    line = spark.createDataFrame([(k, [float(k), 2.0 * k]) for k in range(9)], schema)
    model = whitening.fit_whitening(line)
    assert len(model.values) == 1 and whitening.whiten(line, model).count() == 9
    large = spark.createDataFrame([(k, [k * 1e15, 1.0]) for k in range(5)], "vec_id long, embedding array<double>")
    found = whitening.whiten(large, whitening.fit_whitening(large)).collect()
    middle = [r["deviation"] for r in found if r["vec_id"] == 2]
    assert middle == [0] and all(r["deviation"] is None for r in found if r["vec_id"] != 2)


# --- Filter audit -----------------------------------------------------------------------------
def brute_masks(rows):
    out = []
    for key, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        mask = len(words) < 50
        mask += 2 * (100 * len(set(words)) < 65 * len(words))
        mask += 4 * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text))
        mask += 8 * bool(re.search(r"[#$%&*|]", text))
        again = key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows)
        out.append((key, part or "", mask + 16 * again))
    return out


def brute_audit(rows, labels):
    masks, table = brute_masks(rows), {}
    good = {k for k, q, _ in labels if k is not None and q == 1}
    toxic = {k for k, _, t in labels if k is not None and t == 1}
    parts = {p for _, p, _ in masks}
    for part in parts:
        own = [(k, {"ABCDE"[b] for b in range(5) if m >> b & 1}) for k, p, m in masks if p == part]
        removed_in_all = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [k for k, f in left if letter in f]
                left = [(k, f) for k, f in left if letter not in f]
                removed_in_all[letter] += len(gone)
                redundant = sum(letter in f for _, f in own) - len(gone)
                unique = sum(f == {letter} for _, f in own)
                table[part, "".join(order), step] = [
                    len(left), len(gone), redundant, unique, sum(k in good for k in gone),
                    sum(k in toxic for k in gone),
                ]
        for (p, order, step), row in table.items():
            if p == part:
                row.append(removed_in_all[order[step - 1]])
    return sorted((*k, *v) for k, v in table.items())


def audit_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    pool = [prose(rng, n) for n in (3, 49, 50, 51, 80, 200)]
    pool += ["", " \t\n", "a " * 60, "A" * 5 + "a" * 95, "A" * 6 + "a" * 94, "é" * 95 + "B" * 5]
    pool += ["x # y", "50 % of it", " ".join(["w"] * 60), pool[4] + " ", pool[4][:-1], pool[4].upper()]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *pool]), rng.choice(["s", "t", None, ""])) for _ in range(300)]
    shared = prose(rng, 300)
    rows += [(100 + k, shared + rng.choice(["", f" {k % 7}"]), "near") for k in range(60)]
    return rows


COLUMNS = "doc_id long, text string, source string"


@pytest.mark.parametrize("window", [None, 3])
def test_audit_equals_brute_force(spark, monkeypatch, window):
    prepare(spark)
    if window:
        monkeypatch.setattr(audit, "WINDOW_ROWS", window)
    rows = audit_rows(4)
    labels = [(k % 50, k % 2, k % 3 == 0) for k in range(70)] + [(None, 1, True), (3, None, None)]
    labels = [(k, q, None if t is None else int(t)) for k, q, t in labels]
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'m' as mask", "doc_id as `key`", "1 as `group`")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.interactions(df.repartition(6), marks)
    names = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert sorted(tuple(r) for r in found.select(*names).collect()) == brute_audit(rows, labels)


def test_audit_of_rough_tables(spark):
    df = documents(spark)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    order = lambda t: tuple((x is None, x or 0) if i == 0 else x for i, x in enumerate(t))
    found = [tuple(r) for r in audit.masked(df).collect()]
    assert sorted(found, key=order) == sorted(brute_masks(rows), key=order)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(df.limit(0), labels).count() == 0
    assert audit.interactions(df, labels).agg({"good_lost": "sum"}).first()[0] == 0


def test_prefixes_grow_with_weight(spark):
    texts = [("same beginning " * 40 + str(k % 500), k, k) for k in range(2000)] + [("z", 1, 9000)]
    df = spark.createDataFrame(texts, "text string, least long, `group` long")
    dealt = audit._by_prefix(df)
    sizes = [len(p) for p in dealt.rdd.glom().collect()]
    assert sum(sizes) == 2001 and max(sizes) < 1500
    found = {r["group"] for r in dealt.mapInArrow(audit._by_trie, "group long").collect()}
    assert found == set(range(500, 2000))


def test_trie_holds_any_texts():
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab é") for _ in range(rng.randrange(12))) for _ in range(3000)]
    trie = audit.RadixTrie()
    for k, text in enumerate(texts):
        trie.insert(text, k, k)
    first = {}
    for k, text in enumerate(texts):
        first.setdefault(text, k)
    assert set(trie.beaten()) == {k for k, t in enumerate(texts) if first[t] < k}
