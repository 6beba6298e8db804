"""Spelling variants, whitening and archives: brute force, plain linear algebra, and files of hand."""

import gzip
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqloom.llm import archives, queries, spelling, whitening


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(count, ratio=10):
    """word: (form, root, n, n_near, form_n), by comparing all words."""
    near = {w: [o for o in count if one_apart(w, o)] for w in count}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda o: (-count[o], o), default=None)
        form[w] = top if top is not None and count[top] >= ratio * count[w] else None
    out = {}
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, count[w], len(near[w]), count.get(form[w]))
    return out


def test_spelling_of_documents(spark, tmp_path):
    rng = random.Random(3)
    base = ["".join(rng.choice(["an", "the", "ör", "ÿx", "ion", "aa"]) for _ in range(rng.randrange(2, 6))) for _ in range(60)]
    words = base + [w[: rng.randrange(len(w))] + rng.choice("abxyé") + w[rng.randrange(len(w)) :] for w in base]
    rows = [(i, " ".join(rng.choice(words if rng.random() < 0.3 else base[:9]).title() for _ in range(rng.randrange(200)))) for i in range(60)]
    rows += [(None, "abcdefgh abcdefgi abcdefgh-abcdefgi"), (70, None), (71, ""), (72, "1 2, " * 100), (73, "a" * 30_000 + " " + "a" * 30_001), (74, "a" * 30_000 + " " + "a" * 30_001), (3, rows[3][1]), (3, rows[3][1])]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, word int").write.parquet(f"{tmp_path}/documents.parquet")
    count = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            count[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w] += 1
    want = grouped({w: n for w, n in count.items() if len(w) >= 7 and n >= 2})
    got = queries.op11_spelling(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {r["word"]: tuple(r)[1:] for r in got} == want
    assert sum(f is not None for f, *_ in want.values()) > 5


@pytest.mark.parametrize("seed", range(3))
def test_pivots_find_every_near_word(spark, seed):
    """Words of few letters repeat their bigrams, so that kinds have many places."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("ab" if seed else "abc") for _ in range(rng.randrange(4, 12))) for _ in range(400)} | {"a" * n for n in range(4, 40)}
    got = spelling.near(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    want = {(a, b) for a, b in itertools.permutations(words, 2) if one_apart(a, b)}
    assert len(got) == len(want) and {(r["word"], r["other"]) for r in got} == want


def test_forms_follow_to_the_root(spark):
    table = spark.createDataFrame([("letters", 100_000), ("lettersx", 9_000), ("lettersxy", 800), ("lettersxyz", 70), ("lettersxyzw", 6), ("abc", 5), ("abd", 500)], "word string, n long")
    got = {r["word"]: r for r in spelling.variants(table).collect()}
    assert all(got["letters" + x]["root"] == "letters" for x in ("", "x", "xy", "xyz", "xyzw"))
    assert got["lettersxyzw"]["form"] == "lettersxyz" and got["abc"]["n_near"] == 0
    assert spelling.variants(table.limit(0)).count() == 0


def plain_whitening(x, k):
    fit = np.unique(x, axis=0).astype(float)
    z = fit - fit.mean(axis=0)
    e, v = np.linalg.eigh(z.T @ z / len(fit))
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return fit, e, (x - fit.mean(axis=0)) @ v / np.sqrt(e), e / np.trace(z.T @ z / len(fit))


def test_whitening(spark, tmp_path):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(400, 24)) * np.linspace(1, 3, 24)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, vectors[0]) for i in range(50)] + [(None, vectors[1]), (7, vectors[7])]
    odd = [(2000, None), (2001, [float("nan")] * 24), (2002, [float("inf")] + [0.0] * 23), (2003, [None] + [0.0] * 23), (2004, [1.0]), (2005, []), (2006, [1e30] * 24)]
    spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<float>, component int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_whitening(spark, str(tmp_path)).collect()
    assert len(got) == 16 * len(rows) and {r["vec_id"] for r in got} == {i for i, _ in rows}
    x = np.floor(64 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 1_000_000
    fit, e, white, share = plain_whitening(x, 16)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    assert {r["n"] for r in got} == {400} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10
    deviation = {i: sum((n * int(a) - s) ** 2 for a, s in zip(v, sums, strict=True)) for (i, _), v in zip(rows, x, strict=True)}
    of = {}
    for r in got:
        of.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
        assert r["deviation"] == deviation[r["vec_id"]] and r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-10)
    for c in range(16):
        mine = np.array([of[c + 1][i] for i, _ in rows])
        assert np.allclose(mine, white[:, c], atol=1e-8) or np.allclose(mine, -white[:, c], atol=1e-8)


def test_whitening_of_little(spark):
    kind = "vec_id long, embedding array<double>"
    make = lambda rows: whitening.whitened(spark.createDataFrame(rows, kind))
    assert make([]).count() == 0 and make([(1, [1.0, 2.0])] * 3).count() == 0 and make([(1, []), (2, None)]).count() == 0
    # a plane in five dimensions has two components; constants and copies of columns add none
    rng = np.random.default_rng(2)
    flat = [(i, [a, b, 1.0, a, a]) for i, (a, b) in enumerate(rng.integers(-9, 9, (40, 2)).astype(float).tolist())]
    got = make(flat).collect()
    assert {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] < 1e-10
    assert sum({r["component"]: r["explained"] for r in got}.values()) == pytest.approx(1)
    # whole numbers beyond 64 bits stay exact
    far = [(i, [v * 4e8, -v * 5e8]) for i, v in enumerate([1.0, -1.0, 0.5, 1.25])]
    x = [[int(np.floor(64 * c)) for c in v] for _, v in far]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert {r["vec_id"]: int(r["deviation"]) for r in make(far).collect()} == {i: sum((4 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}


def test_factor_and_rotations():
    rng = np.random.default_rng(5)
    for d, r in ((1, 1), (7, 7), (12, 5), (33, 33)):
        m = rng.normal(size=(d, r)) * np.logspace(0, -6, r)
        c = m @ m.T
        low = whitening.cholesky(c)
        norms, unit = whitening.jacobi(low)
        assert np.allclose(low @ low.T, c, atol=1e-14 * np.trace(c)) and low.shape[1] <= r
        e = np.linalg.eigvalsh(c)[::-1][: len(norms)]
        assert np.allclose(norms, e, atol=1e-13 * e[0]) and np.allclose(unit.T @ unit, np.eye(len(norms)), atol=1e-10)


def page_rows():
    big, other = "<p>" + "é" * 600, "x" * 1000
    return [(1, "http://a/b c", big), (9, None, big), (5, "http://a", big), (9, None, big), (2, "u", None), (3, "", ""), (4, "\n", "y" * 999), (6, "w", "y" * 999), (7, "h", other), (8, "h", other), (None, "n", other), (None, "n", "z" * 2000), (None, "n", "z" * 2000), (10, "r", "\r\n\r\nHTTP/1.0 500\r\nX-Page-Id: 3\r\n\r\n"), (11, "l", "q\0" * 100_000)]


@pytest.mark.parametrize("parts", [1, 4])
def test_archives(spark, tmp_path, parts):
    spark.createDataFrame([(*r, 1) for r in page_rows()], "page_id long, url string, html string, number int").repartition(parts).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op13_archives(spark, str(tmp_path)).collect()
    want = Counter((p, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for p, _, h in page_rows())
    assert Counter(tuple(r)[:3] for r in got) == want
    again = [(r["page_id"], r["refers_to"]) for r in got if r["record_type"] == "revisit"]
    assert sorted(again, key=str) == sorted([(1, 9), (5, 9), (9, 9), (7, 8), (None, 8), (None, None)], key=str)
    assert all(r["refers_to"] is None for r in got if r["record_type"] == "response")


def test_archives_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op13_archives(spark, str(tmp_path)).count() == 0


def old_file(version, docs, block_version=None):
    about = f"{version} 0 someone\n{archives.ARC_NAMES[version]}\n\n".encode()
    lines = [archives.arc_header(block_version or version, url="filedesc://old.arc", ip="0.0.0.0", date="19960923142103", kind="text/plain", code=200, checksum="-", location="-", offset=0, filename="old", length=len(about)) + about]
    for url, date, kind, body in docs:
        lines.append(b"\n" + archives.arc_header(version, url=url, ip="1.2.3.4", date=date, kind=kind, code=200, checksum="-", location="-", offset=0, filename="old", length=len(body)) + body)
    return lines


DOCS = [
    ("http://a/one two", "199609231421", "text/html", b"HTTP/1.0 200 OK\nX-Page-Id: -4\n\nhello\n\nhello"),
    ("dns:a", "19960923", "text/dns", b"a. 1 IN A 1.2.3.4\n"),
    ("ftp://a/f", "soon", "image/gif", b"GIF\n\n"),
    ("http://a/", "19960923142104", "text/html", b"HTTP/1.0 204 No Content"),
]


@pytest.mark.parametrize("version, packed, block", [(1, 0, None), (2, 0, None), (2, 1, 1), (1, 2, None)])
def test_conversion_of_old_files(spark, tmp_path, version, packed, block):
    """Plain, one gzip member a record, or all in one; the version block's first line may be of version 1."""
    parts = old_file(version, DOCS, block)
    path = f"{tmp_path}/old.arc"
    with open(path, "wb") as f:
        f.write(gzip.compress(b"".join(parts)) if packed == 2 else b"".join(gzip.compress(p) if packed else p for p in parts))
    manifest = spark.createDataFrame([(0, path, "old.arc")], "shard int, arc string, name string")
    files = archives.convert(manifest)
    got = sorted(archives.read_warc(files, payloads=True).collect(), key=lambda r: str(r["uri"]))
    assert [(r["record_type"], r["uri"], r["moment"], r["page_id"], bytes(r["payload"])) for r in got] == [
        ("response", "dns:a", "1996-09-23T00:00:00Z", None, b"a. 1 IN A 1.2.3.4\n"),
        ("resource", "ftp://a/f", "1996-09-23T14:21:03Z", None, b"GIF\n\n"),
        ("response", "http://a/", "1996-09-23T14:21:04Z", None, b""),
        ("response", "http://a/one two", "1996-09-23T14:21:00Z", -4, b"hello\n\nhello"),
    ]
    with open(files.first()["warc"], "rb") as f:
        named, block = next(archives.warc_records(pa.py_buffer(f.read())))
    assert named["warc-type"] == "warcinfo" and named["warc-date"] == "1996-09-23T14:21:03Z" and b"converted-from: old.arc" in block


@pytest.mark.parametrize("cut", [b"", b"nothing", old_file(1, DOCS)[0][:-3], b"".join(old_file(1, DOCS))[:-2], b"".join(old_file(2, DOCS)).replace(b"text/dns 200 - - 0 old 18", b"text/dns 200 - - 0 old x")])
def test_broken_files_are_errors(cut):
    if cut == b"":
        assert list(archives.arc_records(pa.py_buffer(cut))) == []
        return
    with pytest.raises(ValueError):
        list(archives.arc_records(pa.py_buffer(cut)))


def test_slips(spark):
    words = spark.createDataFrame([(i, w) for i in (None, 1, 2**40) for w in ("abcdefgh", "éa" * 20, "a")] + [(i, "sometimes") for i in range(200)], "doc_id long, word string")
    for r in words.select("doc_id", "word", spelling.slipped(F.col("doc_id"), F.col("word"), 3).alias("got")).collect():
        w, h = r["word"], zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{r['word']}".encode())
        assert r["got"] == (w if h % 3 else w[: h % len(w)] + w[h % len(w) + 1 :])
