"""Alignments, hits, taxonomy, covers, merging and files, with values traced by hand or by plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import alignments as A
from seqloom.operators import assembly, cover, decide, hits, hsps, merge, pileup, proteins, taxonomy
from seqloom.sources import flat_files


@pytest.fixture
def stage(tmp_path):
    count = iter(range(10_000))

    def write(df):
        path = f"{tmp_path}/stage-{next(count)}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return write


TREE = [(101, 50), (102, 60), (103, 50), (50, 10239), (60, 10239), (10239, 1), (1, 1)]


@pytest.mark.parametrize("reps,want", [
    ({101: 3.0, 103: 1.0}, (101, "")), ({101: 2.4, 103: 1.6}, (101, "noSupermajority")), ({101: 2.0, 103: 2.0}, (50, "")), ({101: 2.0, 102: 2.0}, (101, "noMajority")),
])
def test_lca(spark, reps, want):
    tree = spark.createDataFrame([(*t, "species" if t[0] > 100 else "genus", str(t[0])) for t in TREE], "taxid long, parent long, rank string, name string")
    got = taxonomy.weighted_lca(spark.createDataFrame([("q", t, r) for t, r in reps.items()], "query string, taxid long, rep double"), taxonomy.closure(tree), stop=10239).first()
    assert (got["taxid"], got["flag"]) == want


def test_closure_of_a_chain(spark):
    chain = spark.createDataFrame([(i, max(1, i - 1), "", "") for i in range(1, 40)], "taxid long, parent long, rank string, name string")
    got = {(r["taxid"], r["ancestor"]): r["hops"] for r in taxonomy.closure(chain).collect()}
    assert got == {(i, j): i - j for i in range(2, 40) for j in range(2, i + 1)}


def test_segments_are_positions(spark):
    rng = random.Random(1)
    rows = []
    for q in range(30):
        for _ in range(rng.randrange(1, 8)):
            s = rng.randrange(1, 30)
            rows.append((q, rng.randrange(1, 5), s, s + rng.randrange(0, 20), float(rng.randrange(1, 50))))
    table = spark.createDataFrame(rows, "query int, taxon int, qstart int, qend int, bits double")
    got = {(r["query"], r["taxon"]): r["score"] for r in hits.taxon_scores(hits.covered(table)).collect()}
    want = {}
    for q in range(30):
        mine = [r for r in rows if r[0] == q]
        best = {}
        for _, t, s, e, b in mine:
            for p in range(s, e + 1):
                best[p, t] = max(best.get((p, t), 0), b / (e - s + 1))
        top = {p: max(v for (x, _), v in best.items() if x == p) for p, _ in best}
        good = {t for (p, t), v in best.items() if v >= 0.9 * top[p]}
        for (_, t), v in best.items():
            if t in good:
                want[q, t] = want.get((q, t), 0) + v
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_votes_and_consensus(spark):
    placed = spark.createDataFrame([("R", 5, "A", 2), ("R", 6, "C", 2), ("R", 6, "T", 2), ("R", 9, "D", 3), ("R", 10, "G", 1)], "reference string, pos long, base string, size long")
    assert tuple(A.consensus(A.votes(placed)).first()) == ("R", 5, "AnNNNG")


def test_solo_and_order(spark):
    a = spark.createDataFrame([("x", "R", 1, 0, 1), ("x", "S", 1, 1, 1), ("y", "R", 1, 2, 1), ("y", "S", 1, 2, 1), ("z", "S", 1, 5, 1)], "read string, reference string, pos long, mismatch int, size long")
    assert dict(map(tuple, A.solo_reads(a).collect())) == {"R": 1, "S": 1}
    assert [r["reference"] for r in A.centroid_order(a).orderBy("priority").collect()] == ["S", "R"]


PILE = "id int, reference string, pos long, cigar string, seq string, size long"


@pytest.mark.parametrize("rows,want", [
    ([(1, "r", 1, "8M", "ACGTACGT", 3), (2, "r", 1, "8M", "ACGAACGT", 3)], ("ACGnACGT", 8)), ([(1, "r", 1, "8M", "ACGTACGT", 3), (2, "r", 1, "3M1D4M", "ACGACGT", 5)], ("ACGACGT", 7)),
    ([(1, "r", 1, "4M2I4M", "ACGTGGACGT", 3)], ("ACGTGGACGT", 10)),
    # soft clips count where nothing else is, and before the first position like any letter, in lower case
    ([(1, "r", 3, "2S4M2S", "TTGTACCC", 1)], ("TTGTACCC", 8)), ([(1, "r", 1, "2S6M", "GGACGTAC", 1)], ("ggACGTAC", 8)), ([(1, "r", 3, "2S4M", "TTGTAC", 1), (2, "r", 1, "6M", "ACGTAC", 1)], ("ACGTAC", 6)),
    # positions without reads are N; a read of more than its half in one deletion shows its heavier side alone
    ([(1, "r", 1, "2M", "AC", 1), (2, "r", 6, "2M", "CG", 1)], ("ACNNNCG", 7)), ([(1, "r", 1, "4M4D2M", "ACGTGT", 1)], ("ACGT", 4)),
])
def test_pileup(spark, rows, want):
    scaffolds = spark.createDataFrame([("r", "ACGTACGT"), ("unread", "ACGT")], "reference string, seq string")
    got = pileup.rebuilt(spark.createDataFrame(rows, PILE), scaffolds).collect()
    assert [(r["seq"], r["length"]) for r in got] == [want]
    assert pileup.quantified(spark.createDataFrame([*rows, rows[0]], PILE), scaffolds).first()["size"] == sum(r[5] for r in rows)


def plain_cover(rows):
    sets, n = {}, {}
    for read, ref in rows:
        sets.setdefault(ref, set()).add(read)
        n[ref] = n.get(ref, 0) + 1
    white, black, out = set(), set(), {}
    for ref in sorted(sets, key=lambda r: (-len(sets[r]), -n[r], r)):
        free = sets[ref] - black
        if not free:
            continue
        radius = 0.97 - math.log((len(white) or len(free)) / len(free)) * math.e / 100
        if max(len(free & white) / len(free), len(sets[ref] & black) / len(sets[ref])) > radius:
            out[ref] = False
            black |= sets[ref] - white
        else:
            out[ref] = True
            white |= sets[ref]
    return out


@pytest.mark.parametrize("block", [3, 12])
def test_greedy_centroids(spark, stage, block):
    rng = random.Random(block)
    base = {r: set(rng.sample(range(60), rng.randrange(1, 40))) for r in range(6)}
    rows = [(read, ref) for ref in range(14) for read in (base[ref % 6] if ref < 6 else {*base[ref % 6]} ^ set(rng.sample(range(60), 1)))]
    table = spark.createDataFrame([(*r, 0, 0, 1) for r in rows], "read int, reference int, pos long, mismatch int, size long")
    assert dict(map(tuple, cover.greedy_centroids(table, stage, block).collect())) == plain_cover(rows)


def test_greedy_centroids_in_few_rounds(spark):
    """Reads on several of many references: what claims count decides some, and the rounds do not grow with the references."""
    from seqloom.plans.stages import stage

    rng, turns = random.Random(5), []
    rows = [(read, ref) for read in range(4000) for ref in rng.sample(range(300), rng.randrange(1, 8))]
    table = spark.createDataFrame([(*r, 0, 0, 1) for r in rows], "read int, reference int, pos long, mismatch int, size long")
    got = dict(map(tuple, cover.greedy_centroids(table, lambda df: turns.append(df) or stage(df)).collect()))
    assert got == plain_cover(rows) and 50 < sum(got.values()) < 250
    assert len(turns) < 24


def test_leaders(spark, stage):
    nodes = spark.createDataFrame([(i, 9 - i) for i in range(10)], "node int, rank int")
    edges = spark.createDataFrame([(9, 8), (8, 7), (7, 6), (2, 3), (0, 9), (0, 2)], "a int, b int")
    assert dict(map(tuple, cover.leaders(nodes, edges, stage).collect())) == {9: 9, 8: 9, 7: 7, 6: 7, 5: 5, 4: 4, 3: 3, 2: 3, 1: 1, 0: 9}

def clusters_by_hand(seqs, k, radius=0.99, sizes=0.10):
    """The walk itself: word tables in plain dictionaries."""
    flip = lambda w: w[::-1].translate(str.maketrans("ACGT", "TGCA"))
    known, size = {}, {}
    for name, seq in seqs:
        for i in range(0, len(seq) - k, 3):
            w = seq[i : i + k]
            known[w], known[flip(w)] = flip(w), w
            size[name] = size.get(name, 0) + 1
    accepted, out, text = {}, {n: n for n, _ in seqs}, dict(seqs)
    for name in sorted((n for n in size if size[n] > 0.98), key=lambda n: (-size[n], n)):
        places = [text[name][j : j + k] for j in range(len(text[name]) - k)]
        places = [w for w in places if w in known]
        seen = set(places) | {known[w] for w in places}
        common = {}
        if sum(w in accepted for w in places) / len(places) > radius:
            for w in seen:
                for other in accepted.get(w, ()):
                    common[other] = common.get(other, 0) + 1
        top = min(common, key=lambda o: (-common[o], -size[o], o)) if common else None
        if top and size[top] < (1 + sizes) * size[name]:
            out[name] = top
        else:
            for w in seen:
                accepted.setdefault(w, set()).add(name)
    return out


@pytest.mark.parametrize("seed,radius", [(0, 0.99), (1, 0.85)])
def test_clustered_is_the_walk(spark, stage, seed, radius):
    """Copies, strands, cuts, variants and joined ones: rounds give what the walk gives."""
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    flip = lambda w: w[::-1].translate(str.maketrans("ACGT", "TGCA"))
    roots, seqs = [make(rng.randrange(60, 400)) for _ in range(5)], []
    for i in range(40):
        one = rng.choice(roots)
        kind = rng.choice([0, 0, 1, 1, 2, 2, 3, 5])
        if i in (7, 19):
            kind = 4
        if kind == 1:
            one = flip(one)
        elif kind == 2:
            at = rng.randrange(len(one))
            one = one[:at] + make(1) + one[at + 1 :]
        elif kind == 3:
            one = one[rng.randrange(30) : len(one) - rng.randrange(30)]
        elif kind == 4:
            one = roots[0] + roots[i % 4 + 1]
        elif kind == 5 and i % 2:
            one = make(rng.randrange(0, 50))
        seqs.append((f"{'contig' if i % 3 else 'ref'}_{i}", one))
    k = 11
    want = clusters_by_hand(seqs, k, radius)
    rows = cover.clustered(spark.createDataFrame(seqs, "def string, seq string"), stage, k=k, radius=radius).collect()
    assert {r["def"]: r["leader"] for r in rows} == want and len(rows) == len(seqs)
    assert len(set(want.values())) < len(seqs) - 8
    for r in rows:
        others = sorted(n for n in want if want[n] == r["leader"] and not n.startswith("contig"))
        assert r["name"] == (others[-1] if r["leader"].startswith("contig") and others else r["leader"])


def test_words_of_long_sequences(spark):
    """Cutting into pieces loses no word and doubles none."""
    rng = random.Random(5)
    seq = "".join(rng.choice("ACGT") for _ in range(25_000))
    for n in (7, 8, 10_006, 10_007, 25_000):
        for step in (1, 3):
            got = cover.words_of(spark.createDataFrame([("a", seq[:n])], "def string, seq string"), 7, step).count()
            assert got == len(range(0, n - 7, step))


def test_shared_words(spark):
    words = [("a", k) for k in range(200)] + [("b", k) for k in range(1, 201)] + [("c", k) for k in range(100, 300)] + [("d", k) for k in range(200, 203)]
    got = cover.shared_words(spark.createDataFrame(words, "node string, kmer int")).collect()
    assert sorted(tuple(sorted(r)) for r in got) == [("a", "b"), ("a", "b")]


def plain_unitigs(seqs, k):
    flip = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    nodes = {s[i : i + k] for q in seqs for s in (q, flip(q)) for i in range(len(s) - k + 1)}
    after = {w: [w[1:] + c for c in "ACGT" if w[1:] + c in nodes] for w in nodes}
    before = {w: [c + w[:-1] for c in "ACGT" if c + w[:-1] in nodes] for w in nodes}
    follows = {w: after[w][0] for w in nodes if len(after[w]) == 1 and len(before[after[w][0]]) == 1}
    heads = [w for w in nodes if w not in follows.values()]
    out, seen = set(), set()
    for w in [*sorted(heads), *sorted(nodes)]:
        if w in seen:
            continue
        s, at = w, w
        seen.add(w)
        while (n := follows.get(at)) and n not in seen:
            s, at = s + n[-1], n
            seen.add(n)
        out.add(min(s, flip(s)))
    return out


def test_unitigs(spark, stage):
    rng = random.Random(8)
    whole = "".join(rng.choice("ACGT") for _ in range(200))
    ring = "".join(rng.choice("ACGT") for _ in range(40))
    seqs = [whole[:120], whole[80:], whole[:60] + "".join(rng.choice("ACGT") for _ in range(60)), ring * 2, "ACGTN" * 5]
    table = spark.createDataFrame([(str(i), s) for i, s in enumerate(seqs)], "def string, seq string")
    got = assembly.unitigs(table, 15, stage).collect()
    want = plain_unitigs([p for s in seqs for p in s.split("N")], 15)
    lines = {r["seq"] for r in got if not r["circular"]}
    assert lines == {w for w in want if len(w) != 54}
    rings = [r["seq"] for r in got if r["circular"]]
    assert rings and all(len(r) == 54 for r in rings) and assembly.unitigs(table.limit(0), 15, stage).count() == 0


def test_slim_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nr1\t0\tR\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:0\nr2\t16\tR\t7\t60\t2M\t*\t0\t0\tA\"\tII\n")
    assert [tuple(r) for r in flat_files.sam_slim(spark, str(tmp_path / "a.sam")).collect()] == [("r1", "R", 5, "4M", "ACGT"), ("r2", "R", 7, "2M", 'A"')]


def test_overlay_keeps_genomes_in_their_rows(spark):
    g = spark.createDataFrame([("g", "ACNnTAC"), ("bare", "ACGT"), ("empty", ""), ("none", None)], "def string, seq string")
    parts = spark.createDataFrame([("g", 1, 2, "TTTN"), ("g", 2, 1, "G"), ("g", 6, 1, "cAAA"), ("g", -1, 1, "AA"), ("lost", 0, 1, "A"), ("empty", 0, 1, "A")], "parent string, start int, priority int, seq string")
    laid = merge.overlaid(g, parts)
    assert dict(map(tuple, laid.collect())) == {"g": "AcGTTAC", "bare": "ACGT", "empty": ""}
    plan = laid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode") == 1  # the parts' letters, not the genomes'


def test_overlay_and_mask(spark):
    g = spark.createDataFrame([("g", "ACGNNTAC"), ("h", "AAAAAAAAAA")], "def string, seq string")
    parts = spark.createDataFrame([("g", 2, 1, "GTCA"), ("g", 3, 2, "A")], "parent string, start int, priority int, seq string")
    assert dict(map(tuple, merge.overlaid(g, parts).collect()))["g"] == "ACGTCtAC"
    windows = spark.createDataFrame([("h", 2, 2), ("h", 3, 2)], "def string, start int, length int")
    assert dict(map(tuple, merge.masked(g, windows).collect())) == {"g": "ACGNNTAC", "h": "AANNNAAAAA"}


def test_contained_and_renamed(spark):
    rng = random.Random(3)
    s = "".join(rng.choice("ACGT") for _ in range(200))
    t = spark.createDataFrame([("big multi=12.3456", s), ("cut", s[20:120]), ("same", s), ("other", "".join(rng.choice("ACGT") for _ in range(90)))], "def string, seq string")
    assert sorted(r["def"] for r in merge.contained(t).collect()) == ["big multi=12.3456", "other"]
    names = [r["def"] for r in merge.renamed_contigs(t, "megahit").collect()]
    assert sorted(n.split(";")[0] for n in names) == [f"contig_{i}" for i in range(4)] and any("length=200;cov=12.3;" in n for n in names)


def test_files(spark, tmp_path):
    import bz2

    (tmp_path / "a.fa").write_text(">x one <1..>20\n" + "ACGT\n" * 13 + ">y\n" + "A" * 49 + "\n")
    got = {r["def"]: r["seq"] for r in flat_files.fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert got == {"x one <1..>20": "ACGT" * 13, "y": "A" * 49}
    (tmp_path / "b.fq.bz2").write_bytes(bz2.compress(b"".join(b"@r%d x\n%s\n+\n%s\n" % (i, b"A" * (48 + i), b"@" * (48 + i)) for i in range(3))))
    reads = flat_files.inputs(spark, fastq_paths=[str(tmp_path / "b.fq.bz2")] * 2, fasta_paths=[str(tmp_path / "a.fa")])
    assert sorted((r["name"], len(r["seq"])) for r in reads.collect()) == [("1.r1.x", 49), ("1.r2.x", 50), ("2.x.one.<1..>20", 52)]
    (tmp_path / "c.sam").write_text("@HD\nq\t16\tR\t5\t40\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:2\tZR:i:90\tZI:f:98.5\n")
    r = flat_files.sam(spark, str(tmp_path / "c.sam")).first()
    assert (r["flag"], r["pos"], r["nm"], r["zr"], r["zi"], r["zf"]) == (16, 5, 2, 90, 98.5, None)
    (tmp_path / "d.tsv").write_text("c;coords=30\ts;taxId=9\t99\t10\t0\t0\t1\t10\t1\t10\t1e-5\t20.5\n")
    r = flat_files.blast6(spark, str(tmp_path / "d.tsv")).first()
    assert (r["taxon"], r["base"], r["coords"]) == (9, "c", 30)
    out = str(tmp_path / "out")
    flat_files.write_fasta(spark.createDataFrame([("b", "A"), ("a", "C")], "def string, seq string"), out)
    assert [r[0] for r in spark.read.text(out).coalesce(1).collect()] == [">a", "C", ">b", "A"]


GENBANK = """LOCUS       AB1   100 bp DNA VRL 03-JAN-2014
DEFINITION  Some virus,
            complete genome.
ACCESSION   AB1
FEATURES             Location/Qualifiers
     source          1..100
                     /db_xref="taxon:77"
     CDS             join(1..30,
                     <40..>99)
                     /codon_start=2
                     /product="coat
                     protein"
                     /protein_id="P1.1"
                     /translation="MKVLAAGIVGLCAKAYNNGLS
                     MKVLAAGIVGLC"
     CDS             5..20
                     /translation="MK"
ORIGIN
        1 acgtacgtac gtacgtacgt acgtacgtac gtacgtacgt acgtacgtac gtacgtacgt
       61 acgtacgtac gtacgtryac
//
"""


def test_genbank(spark, tmp_path):
    (tmp_path / "x.gb").write_text(GENBANK + GENBANK.replace("AB1", "CD2").replace("2014", "2020"))
    n = flat_files.genbank_nucleotides(spark, str(tmp_path / "x.gb"), year=2015).collect()
    assert [(r["def"], len(r["seq"]), r["seq"].count("N")) for r in n] == [("gi|NEWDB|gb|AB1|Some.virus.complete.genome.;taxId=77", 80, 2)]
    p = flat_files.genbank_proteins(spark, str(tmp_path / "x.gb")).orderBy("def").collect()
    assert [r["def"] for r in p] == [f"GI|NEWPROTDB|{a}|P1.1|coat.protein|Some.virus.complete.genome.;pos=join(1..30,<40..>99);codonStart=2;taxId=77" for a in ("AB1", "CD2")]
    assert p[0]["seq"] == "MKVLAAGIVGLCAKAYNNGLSMKVLAAGIVGLC"


def test_streaming(spark, tmp_path):
    from seqloom.streaming import arrival

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.fa").write_text(">a\nACCA\n>b\nTGGT\n")
    q = arrival.dereplicated(arrival.arriving_fasta(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("derep").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [tuple(r) for r in spark.table("derep").collect()] == [("ACCA", 2, "a")]


def test_radius_and_pool(spark):
    t = spark.createDataFrame([(1000, 1100), (1000, 1000), (1, 1)], "best int, most int").select(hits.radius_bits("best", "most"), hits.radius_bits("best", "most", True))
    got = [tuple(r) for r in t.collect()]
    assert got[0][0] == pytest.approx(58.32458, abs=1e-4) and got[1][0] == pytest.approx(55.43740, abs=1e-4) and got[2] == (None, None)
    rows = [("q", "v", 1, 90.0, 90.0, 0.0), ("q", "v", 2, 80.0, 80.0, 0.0), ("q", "v", 3, 10.0, 10.0, 0.0), ("q", "w", 4, 55.0, 1.0, 0.0), ("q", "x", 5, 1.0, 1.0, 0.0), ("q", "s", 6, 95.0, 70.0, 9.0), ("q", "y", 7, 58.0, 0.0, 0.0)]
    table = spark.createDataFrame(rows, "query string, group string, taxon int, overall double, nuc double, aa double")
    bounds = spark.createDataFrame([("q", 50.0, 60.0, 0.0)], "query string, lower double, lower_nuc double, lower_aa double")
    # 4 is above the overall limit alone, with weak nuc; 5 is alone in its group but no candidate; 6 is a suppressor's
    assert sorted(r["taxon"] for r in decide.pool(table, bounds, ["s"]).collect()) == [1, 2, 4, 7]


def contest_of(spark, hits_, groups, seq="ACGT" * 25):
    table = spark.createDataFrame([("q", k, t, a, b, bits, i + 1) for i, (k, t, a, b, bits) in enumerate(hits_)], "query string, kind string, taxon int, qstart long, qend long, bits double, rn int")
    scaffolds = spark.createDataFrame([("q", seq)], "query string, seq string")
    named = spark.createDataFrame(list(groups.items()), "taxon int, group string")
    ev = decide.evidence(decide.supported(decide.covered(table)))
    return ev, named, scaffolds


def test_contest_traced_by_hand(spark):
    """100 letters; the virus has the first half, a suppressor is 1.5 % better on ten of these letters and cells 5 % better on ten."""
    groups = {1: "virus", 2: "others", 3: "cells"}
    rows = [("AA", 1, 1, 50, 50.0), ("AA", 2, 1, 10, 10.15), ("AA", 3, 11, 20, 10.5)]
    ev, named, scaffolds = contest_of(spark, rows, groups)
    got = decide.contest(ev, named, scaffolds, "virus", ["others"]).collect()[0]
    assert (got["total"], got["bad"], got["lost"], got["rescued"], got["unaligned"], got["status"]) == (100, 10, 10, 10, 50, "KEPT")
    power = lambda r: r**27 / 3
    virus = 10 * power(1 / 1.015) + 10 * power(1 / 1.05) + 30 * power(1)
    mean = (virus + 10 * power(1) + 10 * power(1)) / 50
    assert got["own_rep"] == pytest.approx((math.log10(virus) * 50 + mean * 50) / 100) and got["best_group"] == "virus"
    stats = {r["group"]: tuple(r)[2:] for r in decide.rescue_stats(ev, named, scaffolds, "virus", ["others"]).collect()}
    assert stats["others"] == (10, pytest.approx(1 / 1.015)) and stats["cells"] == (10, pytest.approx(1 / 1.05))
    # nothing of the target: filtered, whatever else is there
    ev, named, scaffolds = contest_of(spark, [("NUC", 3, 1, 100, 100.0)], groups)
    got = decide.contest(ev, named, scaffolds, "virus", ["others"]).collect()[0]
    assert (got["bad"], got["status"], got["best_group"]) == (100, "FILTERED", "cells")


def test_evidence_of_both_kinds(spark):
    """A nucleotide hit at .95 of the top counts .857375 beside protein hits, .083448 without."""
    rows = [("NUC", 1, 1, 20, 20.0), ("NUC", 2, 1, 20, 19.0), ("AA", 1, 1, 10, 10.0)]
    ev, _, _ = contest_of(spark, rows, {1: "virus", 2: "others"})
    got = {(r["start"], r["kind"], r["taxon"]): r["rep"] for r in ev.collect()}
    assert got[1, "NUC", 2] == pytest.approx(0.857375) and got[11, "NUC", 2] == pytest.approx(0.083448, abs=1e-6) and got[1, "AA", 1] == pytest.approx(1 / 3)
    both = sorted(tuple(r)[1:] for r in decide.both_kinds(decide.supported(decide.covered(spark.createDataFrame([("q", *r, i) for i, r in enumerate(rows)], "query string, kind string, taxon int, qstart long, qend long, bits double, rn int")))).collect())
    assert both == [(1, 10, 1.0, 1, 1.0, 2), (11, 10, None, None, 1.0, 2)]


def test_radius_has_a_least_width(spark):
    tops = spark.createDataFrame([("a", 30.0, 10.0, 20.0, 40.0, 12.0, 25.0), ("b", 1000.0, 0.0, 1000.0, 1100.0, 0.0, 1100.0)], "query string, top double, top_aa double, top_nuc double, self_all double, self_aa double, self_nuc double")
    got = {r["query"]: r for r in decide.limits(tops).collect()}
    assert got["a"]["radius"] == 50 and got["a"]["lower_nuc"] == pytest.approx(20 - 50 * 2 / 3) and got["a"]["lower_aa"] == pytest.approx(10 - 50 / 3)
    assert got["b"]["radius"] == pytest.approx(58.32458, abs=1e-4)


def test_large_deletions(spark):
    rows = spark.createDataFrame([("10M8D5M",), ("5M8D10M",), ("5M8D5M",), ("10M3D5M",)], "cigar string").select(pileup.placed("cigar").alias("s"))
    hidden = [[(x["op"], x["hidden"]) for x in r["s"]] for r in rows.collect()]
    assert hidden == [[("M", False), ("D", True), ("M", True)], [("M", True), ("D", True), ("M", False)], [("M", True), ("D", True), ("M", True)], [("M", False), ("D", False), ("M", False)]]


def test_codons(spark):
    reads = [("x", "R", 1, "3M", 1, 1, 2, "ACGTTTGGG"), ("y", "R", 2, "1M1D1M", 1, 1, 3, "TTTCCC"), ("z", "R", 1, "2M", -1, 6, 1, "AAACGT"), ("w", "R", 5, "1M", 1, 2, 1, "GACG")]
    table = spark.createDataFrame(reads, "read string, reference string, pos long, cigar string, frame int, dna long, size long, seq string")
    votes = {(r["pos"], r["codon"]): r["votes"] for r in proteins.codon_votes(table).collect()}
    # z reads backwards from its sixth letter: ACG TTT
    assert votes == {(0, "ACG"): 3, (1, "TTT"): 6, (2, "GGG"): 2, (3, "CCC"): 3, (4, "ACG"): 1}
    assert tuple(proteins.codon_consensus(proteins.codon_votes(table)).first()) == ("R", 5, "ACGTTTGGGCCCACG")
    tied = spark.createDataFrame([("R", 1, "AAA", 2), ("R", 1, "CCC", 2), ("R", 2, "DDD", 5), ("R", 2, "AAA", 1)], "reference string, pos long, codon string, votes long")
    assert proteins.codon_consensus(tied).first()["seq"] == "NNNnnnNNN"


def test_first_best_and_parents(spark):
    a = spark.createDataFrame([("r", "A", 2, 1), ("r", "B", 1, 2), ("r", "C", 1, 3), ("s", "A", 0, 4)], "read string, reference string, mismatch int, place int")
    assert sorted((r["read"], r["reference"]) for r in proteins.first_best(a).collect()) == [("r", "B"), ("s", "A")]
    parents = spark.createDataFrame([("p1", "one")], "accession string, name string")
    children = lambda x: spark.createDataFrame([(x, 1)], "accession string, k int")
    assert proteins.with_children(parents, children("p1")).first()["name"] == "one"
    with pytest.raises(Exception, match="has no parent"):
        proteins.with_children(parents, children("p2")).collect()


def test_locations(spark):
    rows = [("3..20",), ("complement(join(3..20,<40..>99))",), ("join(7,9..12)",)]
    t = spark.createDataFrame(rows, "location string").withColumn("r", proteins.S.location_ranges("location"))
    got = [[tuple(x) for x in r["r"]] for r in t.collect()]
    assert got == [[(3, 20, False)], [(3, 20, True), (40, 99, True)], [(7, 7, False), (9, 12, False)]]
    moved = [[tuple(x)[:2] for x in r[0]] for r in t.select(proteins.S.shifted_ranges("r", F.lit(3))).collect()]
    assert moved == [[(5, 20)], [(3, 20), (40, 97)], [(9, 7), (9, 12)]]
    assert proteins.S.damerau_distance("ca", "abc") == 2 and proteins.S.damerau_distance("", "ab") == 2 and proteins.S.damerau_distance("abcd", "acbd") == 1


def test_hsps(spark):
    kinds = "query string, subject string, pident double, length long, mismatches long, gaps long, qstart long, qend long, sstart long, send long, bits double"
    rows = [("contig_1;length=100", "ref", 99.5, 100, 0, 0, 1, 100, 11, 110, 180.0), ("contig_2;length=100", "ref", 98.0, 100, 2, 0, 1, 100, 11, 110, 170.0), ("a", "a;rev=1", 100.0, 50, 0, 0, 1, 50, 1, 50, 90.0), ("a", "b", 90.0, 60, 6, 1, 1, 60, 80, 21, 70.0), ("a", "b", 90.0, 60, 6, 1, 5, 64, 21, 80, 60.0)]
    t = spark.createDataFrame(rows, kinds)
    assert sorted((r["query"], r["subject"]) for r in hsps.forward(t).collect()) == [("a", "b"), ("contig_1;length=100", "ref"), ("contig_2;length=100", "ref")]
    assert [tuple(r) for r in hsps.absorbed(t).collect()] == [("contig_1;length=100", "ref")]
    both = hsps.mirrored(t, spark.createDataFrame([("b",)], "name string"))
    assert both.count() == 7 and hsps.reciprocal(both).count() == 4
    lengths = spark.createDataFrame([("a", 100), ("b", 90)], "name string, length long")
    assert hsps.distances(t.where("subject = 'b'"), lengths).first()["distance"] == 100 + 90 - 2 * 108 + 2
    jobs = hsps.jobs(spark.createDataFrame([("q", "x", 5.0), ("q", "y", 9.0), ("p", "z;rev=1", 99.0), ("p", "x", 1.0)], "query string, subject string, bits double"))
    assert [(r["query"], r["subject"]) for r in jobs.orderBy("job").collect()] == [("q", "y"), ("p", "z;rev=1"), ("q", "x"), ("p", "x")]


def test_lists(spark, tmp_path):
    (tmp_path / "list").write_text("Parent:gi|1|gb|ACC1|virus one\nChild:gb|p|ACC1|coat\nChild:gb|q|ACC1|tail\n")
    parents, children = flat_files.centroids(spark, str(tmp_path / "list"))
    assert [r["accession"] for r in parents.collect()] == ["ACC1"] and sorted(r["name"] for r in children.collect()) == ["gb|p|ACC1|coat", "gb|q|ACC1|tail"]
    flat_files.write_centroids(parents, children, str(tmp_path / "out"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()] == (tmp_path / "list").read_text().split("\n")[:3]
    (tmp_path / "taxa").write_text("11 one\n 12\nnone\n11\n")
    assert sorted(r[0] for r in flat_files.listed_taxa(spark, str(tmp_path / "taxa")).collect()) == [11, 12]
    (tmp_path / "div").write_text("VRL\nphg\nvrl\n")
    assert sorted(r[0] for r in flat_files.divisions(spark, str(tmp_path / "div"), ["vrl", "phg"]).collect()) == ["phg", "vrl"]
    with pytest.raises(Exception, match="no such division"):
        flat_files.divisions(spark, str(tmp_path / "div"), ["vrl"]).collect()
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "name string, k int")
    assert [r["k"] for r in flat_files.without(rows, "name", spark.createDataFrame([("a",)], "name string")).collect()] == [2]
    flat_files.to_all(rows, [str(tmp_path / "x"), str(tmp_path / "y")])
    assert spark.read.parquet(str(tmp_path / "y")).count() == 2
    assert [r["k"] for r in flat_files.shuffled(rows, "name", 3).collect()] == [r["k"] for r in flat_files.shuffled(rows.repartition(3), "name", 3).collect()]


def test_closure_scans_each_turn_once(spark):
    depth = 40
    tree = spark.createDataFrame([(1, 1)] + [(i, i - 1) for i in range(2, depth + 2)], "taxid long, parent long")
    closed = taxonomy.closure(tree)
    assert closed.count() == depth * (depth + 1) // 2
    assert closed._jdf.queryExecution().executedPlan().toString().count("Scan") <= 12


def test_hits_move_once(spark, tmp_path):
    """Segments, near-top taxa, support, representation and sums all stay with the query: one shuffle, of the hits."""
    rows = [(q, k, t, a, a + n, 10.0 * t + a, i) for q in range(5) for i, (k, t, a, n) in enumerate([("AA", 1, 1, 9), ("NUC", 2, 3, 4), ("AA", 2, 5, 9), ("NUC", 1, 4, 0)])]
    spark.createDataFrame([*rows, (9, "AA", 1, 5, 3, 1.0, 0)], "query long, kind string, taxon int, qstart long, qend long, bits double, rn int").write.parquet(str(tmp_path / "h"))
    table = spark.read.parquet(str(tmp_path / "h"))
    for told in (decide.densities(decide.evidence(decide.supported(decide.covered(hits.by_query(table))))), decide.both_kinds(decide.supported(decide.covered(hits.by_query(table)))), hits.taxon_scores(hits.covered(hits.by_query(table)))):
        assert {r["query"] for r in told.collect()} == {0, 1, 2, 3, 4}
        assert told._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_reads_meet_by_reference_before_their_votes(spark):
    """What leaves a task is a row a position and letter: reads are dealt out by reference first, and Spark may split them."""
    reads = spark.createDataFrame([(r, 1, "4M", "ACGT", 1) for r in range(3) for _ in range(5)], "reference long, pos long, cigar string, seq string, size long")
    scaffolds = spark.createDataFrame([(r, "ACGTAC") for r in range(3)], "reference long, seq string")
    voted = pileup.votes(reads, scaffolds)
    assert sorted(map(tuple, voted.collect())) == [(r, i + 1, c, 5) for r in range(3) for i, c in enumerate("ACGT")]
    coded = proteins.codon_votes(reads.selectExpr("*", "1 AS frame", "1 AS dna").withColumn("cigar", F.lit("1M")))
    assert sorted(map(tuple, coded.collect())) == [(r, 0, "ACG", 5) for r in range(3)]
    for table in (voted, coded):
        assert "REBALANCE_PARTITIONS_BY_COL" in table._jdf.queryExecution().executedPlan().toString()


def test_words_of_depths_move_once(spark):
    from seqloom.operators import sequences

    seqs = spark.createDataFrame([("a", "ACGTACGTA"), ("b", "ACGTACGTA"), ("c", "ACGTTTTTTT"), ("d", "AC"), ("e", None)], "def string, seq string")
    found = sequences.normalised(seqs, k=4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("explode") == 1
    assert {r["def"]: r["depth"] for r in found.collect()} == {"a": 2, "b": 2, "c": 3}


@pytest.mark.parametrize("apart", [False, True])
def test_words_of_clusters_move_as_pieces(spark, monkeypatch, apart):
    """The words that count, which several sequences have, and how many of its own each has: in one pass and in several."""
    from seqloom.operators import sequences

    rng = random.Random(8)
    root = "".join(rng.choice("ACGTN") for _ in range(900))
    flip = lambda w: w[::-1].translate(str.maketrans("ACGT", "TGCA"))
    seqs = [("a", root), ("b", flip(root[100:700])), ("b", root[50:90]), ("c", root[300:340].lower() + "GAATTC" * 20), ("d", "GAATTC" * 9), ("e", None), ("f", "AC")]
    parts = [("a", root[:401]), ("b", root[200:650]), ("c", "TGAATTC" * 9)] if apart else seqs
    k = 20
    low = lambda s, step: [min(w, flip(w)) for w in (s.upper()[i : i + k] for i in range(0, len(s) - k, step))] if s else []
    known = {w for _, s in parts for w in low(s, 3)}
    found = {}
    for name, s in seqs:
        for w in low(s, 1):
            if w in known:
                found.setdefault(w, {}).setdefault(name, 0)
                found[w][name] += 1
    want, alone = [], {}
    for w, names in found.items():
        for name, n in names.items():
            if len(names) > 1:
                want.append((name, 1 if w == flip(w) else 2, n))
            else:
                alone[name] = alone.get(name, 0) + n
    table, segments = (spark.createDataFrame(t, "def string, seq string").coalesce(2) for t in (seqs, parts))
    for taken in (sequences.TAKEN, 300):
        monkeypatch.setattr(sequences, "TAKEN", taken)
        rows = cover.counted_words(table, k, segments if apart else None).collect()
        assert sorted((r["def"], r["weight"], r["n"]) for r in rows if r["a"] is not None) == sorted(want) and len(want) > 200
        sums = {}
        for r in rows:
            if r["a"] is None:
                sums[r["def"]] = sums.get(r["def"], 0) + r["n"]
        assert sums == alone
