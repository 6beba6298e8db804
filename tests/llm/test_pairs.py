"""Near duplicates of vectors and documents against brute force, with odd rows."""

import numpy as np
import pytest

from seqloom.llm import embeddings, minhash


def least(links, ids):
    """The smallest member of each id's component."""
    at = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(at[a], at[b])
            moved |= at[a] != low or at[b] != low
            at[a] = at[b] = low
    return at


def test_vectors(spark):
    rng = np.random.default_rng(3)
    seeds = rng.normal(size=(40, 24))
    rows = [seeds[i % 40] + rng.normal(size=24) * rng.choice([0.05, 0.3, 0.45]) * (i % 3 > 0) for i in range(700)]
    data = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows)] + [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] * 24), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (None, [1.0, 2.0])]
    data += [(1000 + i, data[5][1]) for i in range(300)]
    table = spark.createDataFrame([(*d, "x") for d in data], "vec_id long, embedding array<float>, node string")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(table).collect()}
    assert len(got) == len(data)
    good = [(i, np.array(v)) for i, v in data if i is not None and (i < 900 or i >= 905)]
    links = [(a, b) for k, (a, x) in enumerate(good) for b, y in good[:k] if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9]
    count = dict.fromkeys(got, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert all(r["n_links"] <= count[i] for i, r in got.items())
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * sum(count.values())
    at = least(links, [i for i in got if i is not None])
    wrong = [i for i in at if got[i]["component_id"] != at[i]]
    assert len(wrong) <= 0.01 * len(at)
    assert got[None]["kept"] and got[900]["kept"] and got[905]["n_links"] == 1


def test_other_vectors_under_one_id(spark):
    data = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [0.0, 1.0]), (7, [1.0, 0.01])]
    got = embeddings.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == [(5, 1, 5, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 5, False)]


@pytest.mark.parametrize("block", [7, 2048])
def test_vector_blocks(spark, block, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    table = spark.createDataFrame([(i, [float(x) for x in base + rng.normal(size=16) * 0.02]) for i in range(60)], "vec_id long, embedding array<double>")
    got = embeddings.near_duplicates(table).collect()
    assert all(r["n_links"] == 59 and r["component_id"] == 0 for r in got)


def brute(docs, width):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        n = min(width, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    ids = list(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, least(links, ids)


@pytest.mark.parametrize("width,small", [(2, 8), (5, 8), (2, 0)])
def test_documents(spark, width, small, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "ROUNDS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(width)
    words = [f"w{i}" for i in range(400)]
    bases = [[words[k] for k in rng.integers(0, 400, 60)] for _ in range(6)]
    docs = []
    for i in range(260):
        w = list(bases[i % 6])
        for _ in range(rng.integers(0, 7)):
            w[rng.integers(0, 60)] = words[rng.integers(0, 400)]
        docs.append((i, " ".join(w)))
    docs += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "a b"), (506, "A  b"), (507, "a b c"), (508, "z " * 20_000), (509, "Z\t" * 30_000), (510, docs[3][1]), (511, "é É"), (512, "é é")]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs] + [(None, "one", "x", 1)], "doc_id long, text string, node string, sig int")
    got = {r["doc_id"]: r for r in minhash.near_duplicates(table, width).collect()}
    sizes, at = brute(docs, width)
    assert {i: r["n_shingles"] for i, r in got.items() if i is not None} == sizes
    assert {i: r["component_id"] for i, r in got.items() if i is not None} == at
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items() if i is not None)
    clash = minhash.one_each(table.selectExpr("*", "'k' AS _kept", "1 AS kept", "2 AS id", "3 AS row", "4 AS component_id"), width)
    assert {tuple(r)[4:] for r in clash.collect()} == {("k", 1, 2, 3, 4)}
    stay = minhash.one_each(table, width)
    assert stay.columns == table.columns and sorted(str(r[0]) for r in stay.collect()) == sorted([*(str(i) for i in at if at[i] == i), "None"])


def test_nothing(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
