"""Sequence functions and tables, with values traced by hand."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators import sequences as Q


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(column).first()[0]


@pytest.mark.parametrize("column,want,value", [
    (lambda: S.fold_case("s"), "ACGTnN", "acgtnN"), (lambda: S.reverse_complement_cased("s"), "nacgtNACGT", "ACGTNacgtn"), (lambda: S.checksum("s"), "01c3a491aeb18ad068fe653d1abf8f98", "ACGT"),
    (lambda: S.translate_codons("s"), "MK*", "ATGAAATAAC"), (lambda: S.protein_self_score("s"), 11, "ATGAAATAA"), (lambda: S.trim_n("s"), "ACNGT", "NN|ACNGTn"), (lambda: S.pad_n("s", 2), "NNACNN", "AC"),
    (lambda: S.nucleotide_self_score("s"), 200, "A" * 100), (lambda: S.attribute("s", "taxId"), "7", "a;b;taxId=7;x=1"), (lambda: S.attribute("s", "size"), None, "a;taxId=7"),
    (lambda: S.accession("s"), "AB1.1", "gi|NEWDB|gb|AB1.1|x;taxId=1"), (lambda: S.accession("s"), "12", "contig_12;src=x"), (lambda: S.sanitised("s"), "a.b.c", "a  b--c"), (lambda: S.clean_bases("s"), "ACGTNN", "  1 acg t\nry"),
    (lambda: S.safe_year("s"), 2014, "LOCUS  X 100 bp DNA VRL 03-JAN-2014"), (lambda: S.safe_year("s"), None, "LOCUS X"), (lambda: S.kmers("s", 3), ["ACG"], "ACGT"), (lambda: S.kmers("s", 3), [], "AC"),
])
def test_functions(spark, column, want, value):
    assert one(spark, column(), s=value) == want


def test_bits(spark):
    assert one(spark, S.raw_to_bits("s"), s=200) == pytest.approx(181.623184, abs=1e-5)
    assert one(spark, S.raw_to_bits("s", True), s=11) == pytest.approx(8.845428 - 0.0, abs=1e-5)
    assert one(spark, S.bits_per_base("s", F.lit(100)), s=181.623184) == pytest.approx(1.8033688, abs=1e-6)
    assert one(spark, S.bits_to_raw(S.raw_to_bits("s")), s=200) == pytest.approx(200)


def test_cigar(spark):
    assert [tuple(x) for x in one(spark, S.cigar_steps("s"), s="3M1D4M2S")] == [("M", 3), ("D", 1), ("M", 4), ("S", 2)]


@pytest.mark.parametrize("seq,want", [("ACGTACGT", 1.921928), ("AAAAAAAA", 0.0), ("ACGTNNTTGA", 2.321928), ("ACNG", None), ("", None)])
def test_entropy(spark, seq, want):
    got = Q.entropy(spark.createDataFrame([(1, seq)], "def int, seq string")).first()["entropy"]
    assert got is None if want is None else got == pytest.approx(want, abs=1e-6)


def test_islands_and_tiles(spark):
    table = spark.createDataFrame([("a", "N" * 7 + "A" * 700 + "NN" + "C" * 49 + "N"), ("b", "nnA" + "n" + "C" * 120 + "n")], "def string, seq string")
    found = Q.islands(table)
    assert sorted((r["def"], r["start"], len(r["seq"])) for r in found.collect()) == [("a", 7, 700), ("b", 2, 122)]
    assert [r["seq"][:3] for r in found.where("def = 'b'").collect()] == ["ANC"]
    tiles = lambda size: sorted((r["start"], len(r["seq"])) for r in Q.tiles(found.where("def = 'a'"), size).collect())
    assert tiles(300) == [(7, 300), (157, 300), (307, 400)]
    assert tiles(0) == [(7, 700)]
    short = Q.islands(spark.createDataFrame([("c", "G" * 250)], "def string, seq string"))
    assert sorted((r["start"], len(r["seq"])) for r in Q.tiles(short, 100).collect()) == [(0, 100), (50, 100), (100, 150)]


def test_dereplicate(spark):
    table = spark.createDataFrame([("b", "ACCA"), ("a", "TGGT"), ("c", "acca"), ("d", "GGGG")], "def string, seq string")
    assert sorted(map(tuple, Q.dereplicate(table).collect())) == [("a", "ACCA", 3), ("d", "CCCC", 1)]
    assert sorted(r["def"] for r in Q.both_strands(table).collect()) == ["a", "a;rev=1", "b", "b;rev=1", "c", "c;rev=1", "d", "d;rev=1"]


def test_windows_of_a_long_row(spark):
    """Cutting takes a time in proportion to the letters, and rows of one name are apart."""
    table = spark.createDataFrame([("a", "ACGT" * 500_000), ("a", "NN" + "G" * 60), ("b", None)], "def string, seq string")
    found = Q.islands(table)
    assert sorted((r["start"], len(r["seq"])) for r in found.collect()) == [(0, 2_000_000), (2, 60)]
    began = time.time()
    got = Q.tiles(found, 12, 8).groupBy("def").agg(F.count("*").alias("n"), F.max("start").alias("last")).collect()
    assert [tuple(r) for r in got] == [("a", 2 * 166_666 - 1 + 9, 12 * 166_665)] and time.time() - began < 60


def test_words_move_once(spark, tmp_path):
    """Of words, one shuffle; of counts a sequence, another. A name on two rows counts its words once."""
    spark.createDataFrame([(1, "ACGTACC"), (2, "ACGTTTT"), (2, "ACGTAAA"), (3, None)], "def long, seq string").write.parquet(str(tmp_path / "s"))
    told = Q.earlier_overlap(spark.read.parquet(str(tmp_path / "s")), 4)
    words = lambda *texts: {t[i : i + 4] for t in texts for i in range(len(t) - 4)}
    one, two = words("ACGTACC"), words("ACGTTTT", "ACGTAAA")
    assert sorted(map(tuple, told.collect())) == [(1, len(one), 0), (2, len(two), len(one & two))]
    assert told._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 2


def test_kept_words_are_kept_by_what_holds_them():
    rng = random.Random(17)
    for n in (32, 33, 60, 400):
        inner = "".join(rng.choice("ACGTN") for _ in range(n))
        outer = "".join(rng.choice("ACGTN") for _ in range(90)) + inner + "".join(rng.choice("ACGTN") for _ in range(50))
        flipped = outer[::-1].translate(str.maketrans("ACGT", "TGCA"))
        few = set(Q.kept_words(inner, 24, 32, part=64).tolist())
        assert few and all(few <= set(Q.kept_words(t, 24, 32).tolist()) for t in (outer, flipped))
        assert len(Q.kept_words(outer, 24, 32)) < len(outer) / 2
    assert len(Q.kept_words("ACGTN" * 6, 24, 32)) == 0 and len(Q.kept_words(None, 24, 32)) == 0
    for k in (1, 5, 31):
        words = [inner[i : i + k] for i in range(len(inner) - k + 1)]
        hashes = Q.word_hashes(Q.code_points(inner), k).tolist()
        assert len(hashes) == len(words) and len(set(zip(words, hashes, strict=True))) == len(set(words)) == len(set(hashes))


def test_lettered_is_translate(spark):
    from seqloom.plans import views as V

    texts = ["Hello, World\n\tNn 12", "", None, "\u00e9\u4e2d\U0001f600 xyz\r", "".join(map(chr, range(1, 300)))]
    slow = F.translate(F.regexp_replace("t", "[^a-zA-Z\n]", "N"), V.LETTERS + "\n", V.BASES + "n")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(slow.alias("want"), S.lettered("t").alias("got"), F.upper(slow).alias("up"))
    assert all(r["want"] == r["got"] for r in rows.collect())
    flipped = rows.select(S.reverse_complement("up").alias("want"), S.other_strand("up").alias("got")).collect()
    assert all(r["want"] == r["got"] for r in flipped)


def test_words_move_as_pieces_of_text(spark, monkeypatch):
    """Words move as pieces of text, two letters a byte: all words at all starts but the last, in any alphabet, of long and
    repeated texts and of names that are null or come twice, in one pass or in several."""
    rng = random.Random(3)
    dna = "".join(rng.choice("ACGTacgtN") for _ in range(3000))
    wide = "".join(chr(200 + rng.randrange(40)) for _ in range(300))
    seqs = [(1, dna), (2, dna[500:900]), (2, dna[880:950]), (3, wide), (4, wide[100:] + dna[:50]), (5, "A" * 700), (6, None), (7, "AC"), (None, dna[:200]), (8, "A" * 22)]
    words = [(d, s[i : i + 21]) for d, s in seqs if s for i in range(len(s) - 21)]
    uses, first = Counter(w for _, w in words), {}
    for d, w in words:
        if d is not None:
            first[w] = min(first.get(w, d), d)
    own = {d: {w for e, w in words if e == d} for d, _ in words}
    shared = {d: (len(ws), 0 if d is None else sum(first[w] < d for w in ws)) for d, ws in own.items()}
    depth = {d: sorted(uses[w] for e, w in words if e == d)[(sum(e == d for e, _ in words) - 1) // 2] for d in own}
    table = spark.createDataFrame(seqs, "def long, seq string").coalesce(2)
    for taken in (Q.TAKEN, 500):
        monkeypatch.setattr(Q, "TAKEN", taken)
        assert {r["def"]: (r["kmers"], r["shared"]) for r in Q.earlier_overlap(table, 21).collect()} == shared
        assert {r["def"]: r["depth"] for r in Q.normalised(table, 21).collect()} == depth
    pieces = Q.dealt_pieces(table, 21, 3)
    assert pieces.agg(F.sum(F.length("size"))).first()[0] < len(words) / 2  # a row a word before
