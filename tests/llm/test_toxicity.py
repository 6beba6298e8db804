"""Held-out accuracy of the toxicity scores, and odd rows."""

import random

from seqloom.llm import toxicity

MEAN = ["idiot", "scum", "moron", "pathetic"]


def docs_of(spark, n=900, seed=4):
    rng = random.Random(seed)
    calm = ["".join(rng.choice(["ta", "ne", "lo", "ri", "su", "ka"]) for _ in range(rng.randrange(1, 5))) for _ in range(500)]
    rows, marks = [], []
    for i in range(n):
        words = [rng.choice(calm) for _ in range(rng.randrange(20, 120))]
        bad = i % 4 == 0
        if bad:
            for _ in range(1 + len(words) // 20):
                w = rng.choice(MEAN)
                words.insert(rng.randrange(len(words)), w if rng.random() < 0.8 else w + rng.choice("sxyz"))
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int"), dict(marks)


def test_held_out_accuracy(spark):
    docs, labels, truth = docs_of(spark)
    got = toxicity.toxicity(docs, labels).where("held_out").collect()
    assert len(got) > 100
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in got) / len(got) > 0.95
    kept = toxicity.without_toxic(docs.selectExpr("doc_id", "text", "'a' AS score", "1 AS row"), labels)
    assert kept.columns == ["doc_id", "text", "score", "row"]
    left = [truth[r[0]] for r in kept.collect()]
    assert left.count(0) > 0.97 * 675 and left.count(1) < 0.05 * 225


def test_odd_rows(spark):
    _, labels, _ = docs_of(spark, 80)
    odd = spark.createDataFrame([(0, None), (1, ""), (None, "no id"), (2, "..."), (3, "idiot " * 30_000), (3, "idiot"), (4, "a" * 100_000)], "doc_id long, text string")
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert [r["score"] for r in none] == [0.0] * 7
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0


def test_scores_by_a_plain_forward_pass(spark):
    import math

    import xxhash

    docs, labels, _ = docs_of(spark, 300)
    model = toxicity.train(docs, labels)
    weight, bias = model
    for r in toxicity.score(docs.limit(40), model).collect():
        rows = []
        for w in r["text"].lower().split():
            m = f"<{w.strip(toxicity.MARKS.decode()) or w}>"
            grams = {m} | {m[i : i + n] for n in (3, 4, 5) for i in range(len(m) - n + 1)}
            rows += [xxhash.xxh3_64_intdigest(g) % toxicity.BUCKETS for g in grams]
        z = toxicity.SCALE * sum(float(weight[i]) for i in rows) / len(rows) + bias
        assert r["score"] == __import__("pytest").approx(1 / (1 + math.exp(-z)), rel=1e-4)


def test_unseen_misspellings(spark):
    """Spellings that no learned text holds are told by the n-grams that they share."""
    docs, labels, _ = docs_of(spark)
    model = toxicity.train(docs, labels)
    rng = random.Random(30)
    seen = {w for r in docs.collect() for w in r["text"].split()}
    calm = [w for w in sorted(seen) if not any(m in w for m in MEAN)]
    rows = []
    for i in range(200):
        words = [rng.choice(calm) for _ in range(40)]
        rows.append((1000 + i, " ".join(words)))
        for _ in range(4):
            w = rng.choice(MEAN)
            at = rng.randrange(2, len(w))
            new = w[:at] + rng.choice("qjz") + w[at:]
            assert new not in seen
            words.insert(rng.randrange(len(words)), new)
        rows.append((i, " ".join(words)))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    clean = sorted(scores[1000 + i] for i in range(200))
    assert clean[-1] < 0.5 and all(scores[i] > scores[1000 + i] for i in range(200))
    assert sum(scores[i] > clean[190] for i in range(200)) >= 190
