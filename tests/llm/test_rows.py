"""Exact dedup, mixing, lattice scores and the pipeline: odd rows, and brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from seqloom.llm import exact_dedup, lattice, mixing
from seqloom.llm.queries import PIECE_FILE

ODD = [(0, None), (1, ""), (2, " \n"), (3, "a b"), (4, "ab"), (5, "a  b"), (6, "ab"), (6, "ab"), (7, "é x"), (8, "éx "), (9, "z" * 200_000), (10, "z " * 200_000), (None, "ab  \t "), (None, "only")]


def test_exact_dedup(spark):
    table = spark.createDataFrame([(*r, 1) for r in ODD], "doc_id long, text string, key int")
    got = exact_dedup.exact_dedup(table).collect()
    groups = {}
    for d, t in ODD:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((d, t or ""))
    want = []
    for bare, rows in groups.items():
        keep = min(rows, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        want += [(d, keep, len(rows), d == keep, hashlib.sha256(bare.encode()).hexdigest()) for d, _ in rows]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    kept = exact_dedup.keep_first(table)
    assert kept.columns == table.columns and kept.count() == len(groups)
    clash = table.selectExpr("*", "'mine' AS _id", "doc_id AS _sha", "1 AS sha", "2 AS id", "3 AS row", "4 AS `a.b`")
    kept = exact_dedup.keep_first(clash)
    assert kept.columns == clash.columns and {(r["_id"], r["sha"], r["id"], r["row"]) for r in kept.collect()} == {("mine", 1, 2, 3)}
    assert all(r["_sha"] == r["doc_id"] for r in kept.collect())
    assert exact_dedup.exact_dedup(table.limit(0)).count() == 0


def test_extendible_index():
    rng = random.Random(1)
    index, plain = exact_dedup.ExtendibleIndex(4), {}
    for _ in range(3000):
        k = rng.randrange(-(1 << 63), 1 << 63) if rng.random() < 0.8 else rng.randrange(-3, 3)
        entry = [k, rng.randrange(100), False, 1, 1, b"x"]
        index.chain(k).append(entry)
        plain.setdefault(k, []).append(entry)
    data = b"".join(index.pages())
    for k, rows in plain.items():
        assert [e["keep"] for e in exact_dedup.look_up(data, k)] == [r[1] for r in rows]
    assert not len(exact_dedup.look_up(data, 12345))
    assert all(len(held) <= 4 for _, held in index.slots)


@pytest.mark.parametrize("n", [0, 1, 400])
def test_mixing(spark, n):
    rng = random.Random(n)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(0, 60))), rng.choice(["b", "a", None, "é", "hot", "hot"])) for i in range(n)] + [(0, None, "a"), (None, "x y", "b"), (None, "x y", "b")] * (n > 1)
    table = spark.createDataFrame([(*r, 2) for r in rows], "doc_id long, text string, source string, hash int")
    got = mixing.mix(table).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target, open_, left = {}, set(size), 1.5 * sum(size.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in full} if full else {s: level * weight[s] for s in open_}
        left -= sum(2 * size[s] for s in full)
        open_ = open_ - full if full else set()
    taken = Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target[r["source"]]) and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in size)
    assert sorted(map(str, mixing.mix(table.repartition(3)).collect())) == sorted(map(str, got))
    clash = table.selectExpr("*", "doc_id AS _id", "7 AS _n", "8 AS _copy", "9 AS copy", "1 AS limit", "2 AS target", "'k' AS key", "3 AS row")
    assert all(r["_id"] == r["doc_id"] and (r["_n"], r["_copy"], r["copy"], r["limit"], r["target"], r["key"], r["row"]) == (7, 8, 9, 1, 2, "k", 3) for r in mixing.mixed(clash).collect())
    mixed = mixing.mixed(table)
    assert mixed.columns == table.columns and Counter(r["doc_id"] for r in mixed.collect()) == sum((Counter({r["doc_id"]: r["copies"]}) for r in got if r["copies"]), Counter())


def brute(p, weight, word):
    """Log of the sum over all spellings, by plain recursion."""
    total = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            w = weight[p.ids[word[i:j]]] if word[i:j] in p.ids else sum(weight[p.byte[b]] for b in word[i].encode()) if j - i == 1 else None
            if w is not None:
                total[j] = np.logaddexp(total[j], total[i] + w)
    return total[-1]


def test_spell():
    p = lattice.pieces(PIECE_FILE)
    words = [lattice.MARK + w for w in ("the", "a", "unbelievable", "日本", "x" * 70, "é🙂z", "and")]
    for g in lattice.by_length(words):
        z, used = lattice.spell(p, p.start, [words[k] for k in g], np.ones(len(g)))
        assert np.allclose(z, [brute(p, p.start, words[k]) for k in g])
        assert used.sum() > 0
    # the expected uses spell the word: letters add up
    z, used = lattice.spell(p, p.start, [lattice.MARK + "cat"], np.ones(1))
    assert sum(u * len(p.text[i]) for i, u in enumerate(used)) == pytest.approx(4)


def test_lattice(spark, monkeypatch):
    monkeypatch.setattr(lattice, "TOP", 30)
    rng = random.Random(2)
    words = ["".join(rng.choice(["an", "the", "ör", "x", "ION"]) for _ in range(rng.randrange(1, 4))) for _ in range(90)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30))), rng.choice(["en", "de", None])) for i in range(150)]
    rows += [(500, None, "en"), (501, "", None), (3, rows[3][1], "en"), (3, rows[3][1], "en"), (None, "the", "en"), (502, "q" * 3000 + " the", "de")]
    got = lattice.score(spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, lang string, score double"), PIECE_FILE).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c, ends = Counter(), 0
    for d, t, _ in rows:
        if not held(d):
            c.update((t or "").encode().lower().split())
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    want = []
    for d, t, _ in rows:
        w = (t or "").encode().lower().split()
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        want.append((str(d), held(d), len(w) + 1, sum(c[x] > 0 for x in w) + 1, n, round(base, 6)))
    assert sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in got) == sorted(want)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    some = spark.createDataFrame([(500, "a b"), (501, None)], "doc_id long, text string")
    assert all(math.isfinite(r["score"]) for r in lattice.score(some, PIECE_FILE).collect())
    assert lattice.score(some.limit(0), PIECE_FILE).count() == 0


def test_scores_by_brute_force(spark, monkeypatch):
    """score and lattice_score of every text by plain loops over all spellings, from plain counts."""
    monkeypatch.setattr(lattice, "TOP", 20)
    rng = random.Random(12)
    words = ["".join(rng.choice(["an", "the", "ör", "x", "ion"]) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 20))), rng.choice(["en", "de", None])) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, _ = lattice.learn(docs, PIECE_FILE)
    p = lattice.pieces(PIECE_FILE)
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    kinds = [None, *sorted({g for _, _, g in rows if g}, key=lambda g: (-sum(1 for d, _, x in rows if x == g and not held(d)), g))]
    count = {k: Counter() for k in kinds}
    ends = Counter()
    for d, t, g in rows:
        if not held(d):
            count[g].update(t.split())
            ends[g] += 1
    z = {w: [math.exp(brute(p, weight, lattice.MARK + w)) for weight in (model.weight, p.start)] for w in {x for _, t, _ in rows for x in t.split()}}
    tokens = sum(map(sum, (c.values() for c in count.values()))) + sum(ends.values())

    def word(w, k):
        c = count[k]
        once, twice, n = (sum(v == m for v in c.values()) for m in (1, 2)), None, sum(c.values()) + ends[k]
        once, twice = once
        d = min(max(once / max(once + 2 * twice, 1) if once + twice else 0.5, 0.1), 0.9)
        return max(c[w] - d, 0) / max(n, 1) + (d * len(c) / max(n, 1) if c else 0.5) * z[w][0]

    for r in lattice.score(docs, PIECE_FILE).collect():
        t = rows[r["doc_id"]][1].split()
        total = 0.0
        for k in kinds:
            n = sum(count[k].values()) + ends[k]
            total += (ends[k] + 1 / len(kinds)) / (sum(ends.values()) + 1) * max(ends[k], 1 / len(kinds)) / max(n, 1) * math.prod(word(w, k) for w in t)
        assert r["score"] == pytest.approx(math.log10(total), rel=1e-6)
        stop = sum(ends.values()) / tokens
        assert r["lattice_score"] == pytest.approx(sum(math.log10(z[w][1] * (1 - stop)) for w in t) + math.log10(stop), rel=1e-6)


def test_probabilities_sum_to_one_at_most():
    """Over all words of up to two letters of a small alphabet, spellings and the end take no more than everything."""
    p = lattice.pieces(PIECE_FILE)
    letters = "abcdefgh"
    words = [lattice.MARK + a + b for a in letters for b in ["", *letters]]
    total = 0.0
    for g in lattice.by_length(words):
        total += np.exp(lattice.spell(p, p.start, [words[k] for k in g])[0]).sum()
    assert total < 1


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(6)
    calm = ["".join(rng.choice(["ta", "ne", "lo", "ri"]) for _ in range(4)) for _ in range(300)]
    rows, marks = [], []
    for i in range(300):
        words = [rng.choice(calm) for _ in range(60)]
        if i % 5 == 0:
            words[::12] = ["moron"] * len(words[::12])
        rows.append((i, " ".join(words), "en", f"s{i % 3}", 0))
        marks.append((i, 1, int(i % 5 == 0)))
    rows += [(1000, rows[1][1].replace(" ", "  "), "en", "s0", 0), (1001, rows[2][1] + " more", "en", "s1", 0), (1002, None, "en", None, 0), (1003, "", None, "s0", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left.append([r["doc_id"] for r in docs.collect()])
    clean = {i for i in range(300) if i % 5} | {1000, 1001, 1002, 1003}
    assert len(clean.symmetric_difference(left[0])) <= 3
    assert set(left[1]) == set(left[0]) - {1} - {1003} and len(left[1]) == len(set(left[1]))
    assert set(left[1]) - set(left[2]) == {1001}
    assert Counter(left[4]) == Counter(left[3]) and max(Counter(left[3]).values()) <= 2 and set(left[3]) <= set(left[2])


@pytest.mark.parametrize("odd", [False, True])
def test_pipeline_stages_on_odd_tables(spark, tmp_path, odd):
    """An empty table, and null, empty, long and repeated rows with further columns whose names clash."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, key int, hash long, size long, limit long, target double, copy int"
    more = (0.5, "r", 1, 2, 3, 4, 0.5, 6)
    texts = [(1, None), (2, ""), (3, " \n"), (4, "one two three"), (4, "one two three"), (5, "x" * 200_000), (6, "word " * 50_000), (None, "no id here"), (None, None), (7, "one  two three")]
    docs = spark.createDataFrame([(d, t, None, None if i % 2 else "s", 0, *more) for i, (d, t) in enumerate(texts)] if odd else [], schema)
    marks = [(4, 1, 0), (5, 1, 0), (None, 1, 1), (7, None, None)] if odd else []
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == "bpe" or out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left[name] = [r["doc_id"] for r in docs.collect()]
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if not odd:
        assert not any(left.values())
        return
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    stay = [t for d, t in texts if d in set(left["toxicity"])]
    assert len(left["toxicity"]) == len(stay) and len(left["exact_dedup"]) == len({bare(t) for t in stay})
    assert sorted(map(str, left["near_dedup"])) == sorted(map(str, left["exact_dedup"]))
    assert Counter(left["bpe"]) == Counter(left["mixing"]) and set(left["mixing"]) <= set(left["near_dedup"])
