"""Registered queries of alignments between sequences, reads on protein references and smaller steps.

The tables carry them as views: HSPs between the suppliers of neighbouring lines of an order, protein alignments of an
order's scaffold on a line's supplier, and locations made of a line's numbers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from seqloom.functions import seq as S
from seqloom.operators import hits as H
from seqloom.operators import hsps as P
from seqloom.operators import merge as M
from seqloom.operators import pileup as L
from seqloom.operators import proteins as R
from seqloom.operators import sequences as Q
from seqloom.operators import taxonomy as T
from seqloom.plans import views as V
from seqloom.plans.catalogue import CLOSED, GROUP_SQL, groups_of, query, six
from seqloom.plans.decisions import FULL, evidence_of, rounded
from seqloom.sources import flat_files as X

# HSPs

NAMES = """names AS (SELECT s_suppkey, 20 + s_nationkey AS length, CASE WHEN s_acctbal > 8000 THEN 'contig_' || s_suppkey || ';length=' || (20 + s_nationkey) || ';rev=1'
    WHEN s_acctbal > 4500 THEN 'contig_' || s_suppkey || ';length=' || (20 + s_nationkey) WHEN s_acctbal > 2000 THEN 'ref_' || s_suppkey ELSE 'ref_' || s_suppkey || ';rev=1' END AS name, s_acctbal > 7000 AS unchanged FROM supplier)"""
HSPS = f"""{NAMES}, hsps AS (SELECT x.name AS query, y.name AS subject, round(100 - 10 * a.l_discount, 2) AS pident, a.l_quantity::BIGINT AS length, round(a.l_tax * 100)::BIGINT AS mismatches, a.l_linenumber::BIGINT AS gaps,
    a.l_linenumber::BIGINT AS qstart, (a.l_linenumber + a.l_quantity - 1)::BIGINT AS qend,
    (b.l_linenumber + CASE WHEN a.l_returnflag = 'R' THEN a.l_quantity - 1 ELSE 0 END)::BIGINT AS sstart, (b.l_linenumber + CASE WHEN a.l_returnflag = 'R' THEN 0 ELSE a.l_quantity - 1 END)::BIGINT AS send,
    a.l_extendedprice / 1000 AS bits FROM lineitem a JOIN lineitem b ON b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 JOIN names x ON x.s_suppkey = a.l_suppkey JOIN names y ON y.s_suppkey = b.l_suppkey)"""
MIRRORED = """mirrored AS (SELECT * FROM hsps UNION ALL SELECT subject, query, pident, length, mismatches, gaps, sstart, send, qstart, qend, bits FROM hsps WHERE subject IN (SELECT name FROM names WHERE unchanged))"""
FORWARD = """fwd AS (SELECT * FROM mirrored WHERE regexp_replace(query, ';rev=1$', '') <> regexp_replace(subject, ';rev=1$', '') AND send >= sstart)"""


def names_of(spark, sf_dir):
    key, n = F.col("s_suppkey").cast("string"), (20 + F.col("s_nationkey")).cast("string")
    contig = F.concat(F.lit("contig_"), key, F.lit(";length="), n)
    name = F.when(F.col("s_acctbal") > 8000, F.concat(contig, F.lit(";rev=1"))).when(F.col("s_acctbal") > 4500, contig).when(F.col("s_acctbal") > 2000, F.concat(F.lit("ref_"), key)).otherwise(F.concat(F.lit("ref_"), key, F.lit(";rev=1")))
    return V.table(spark, sf_dir, "supplier").select("s_suppkey", (20 + F.col("s_nationkey")).alias("length"), name.alias("name"), (F.col("s_acctbal") > 7000).alias("unchanged"))


def hsps_of(spark, sf_dir):
    i = V.table(spark, sf_dir, "lineitem")
    b = i.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_linenumber").alias("next"), F.col("l_suppkey").alias("other"))
    n = names_of(spark, sf_dir)
    rows = i.join(b, ["l_orderkey", "l_linenumber"]).join(n.select(F.col("s_suppkey").alias("l_suppkey"), F.col("name").alias("query")), "l_suppkey").join(n.select(F.col("s_suppkey").alias("other"), F.col("name").alias("subject")), "other")
    more, back = F.col("l_quantity") - 1, F.col("l_returnflag") == "R"
    whole = lambda c: c.cast("long")
    return rows.select("query", "subject", F.round(100 - 10 * F.col("l_discount"), 2).alias("pident"), whole(F.col("l_quantity")).alias("length"), whole(F.round(F.col("l_tax") * 100)).alias("mismatches"), whole(F.col("l_linenumber")).alias("gaps"),
                       whole(F.col("l_linenumber")).alias("qstart"), whole(F.col("l_linenumber") + more).alias("qend"), whole(F.col("next") + F.when(back, more).otherwise(0)).alias("sstart"),
                       whole(F.col("next") + F.when(back, 0).otherwise(more)).alias("send"), (F.col("l_extendedprice") / 1000).alias("bits"))


def mirrored_of(spark, sf_dir):
    return P.mirrored(hsps_of(spark, sf_dir), names_of(spark, sf_dir).where("unchanged"))


@query(f"WITH {HSPS}, {MIRRORED} SELECT query, subject, pident, length, qstart, qend, sstart, send, bits FROM mirrored")
def hsp_mirrored(spark, sf_dir):
    return mirrored_of(spark, sf_dir).select("query", "subject", "pident", "length", "qstart", "qend", "sstart", "send", "bits")


@query(f"WITH {HSPS}, {MIRRORED}, {FORWARD} SELECT query, subject, length, qstart, qend, sstart, send, bits FROM fwd")
def hsp_forward(spark, sf_dir):
    return P.forward(mirrored_of(spark, sf_dir)).select("query", "subject", "length", "qstart", "qend", "sstart", "send", "bits")


@query(f"""WITH {HSPS}, {MIRRORED}, {FORWARD}, both_ AS (SELECT query AS one, subject AS other, pident, length, bits FROM fwd UNION ALL SELECT subject, query, pident, length, bits FROM fwd),
    f AS (SELECT regexp_replace(one, ';rev=1$', '') AS name, other AS into_, bits, nullif(regexp_extract(one, 'length=(\\d+)', 1), '')::BIGINT AS n, coalesce(nullif(regexp_extract(other, 'length=(\\d+)', 1), '')::BIGINT, 1099511627776) AS m, pident, length
          FROM both_ WHERE regexp_matches(one, '^contig.*length=\\d+') AND NOT ends_with(other, ';rev=1'))
    SELECT name, arg_max(into_, (bits, m, into_)) AS "into" FROM f WHERE pident > 99 AND length > 0.99::DOUBLE * n AND (m > n OR (m = n AND into_ < name)) GROUP BY name""")
def hsp_absorbed(spark, sf_dir):
    return P.absorbed(mirrored_of(spark, sf_dir))


@query(f"""WITH {HSPS}, {MIRRORED}, {FORWARD} SELECT query, subject, qstart, qend, sstart, send, bits FROM fwd x WHERE EXISTS
    (SELECT 1 FROM fwd y WHERE y.query = x.subject AND y.subject = x.query AND y.qstart = x.sstart AND y.sstart = x.qstart AND y.qend = x.send AND y.send = x.qend)""")
def hsp_reciprocal(spark, sf_dir):
    return P.reciprocal(P.forward(mirrored_of(spark, sf_dir))).select("query", "subject", "qstart", "qend", "sstart", "send", "bits")


@query(f"""WITH {HSPS}, {MIRRORED}, {FORWARD} SELECT query, subject, {rounded('sum(bits)', 'bits')}, min(qstart) AS "left",
    string_agg(qstart || '-' || qend || '-' || sstart || '-' || send, ',' ORDER BY qstart, qend, sstart, send) AS ranges FROM fwd GROUP BY query, subject""")
def hsp_sums(spark, sf_dir):
    told = P.sums(P.forward(mirrored_of(spark, sf_dir)))
    return told.select("query", "subject", six("bits"), "left", F.array_join(F.transform("ranges", lambda r: F.array_join(r.cast("array<string>"), "-")), ",").alias("ranges"))


@query(f"""WITH {HSPS}, {MIRRORED}, {FORWARD}, p AS (SELECT query, subject, floor(sum(bits) * 1e6 + 0.501) / 1e6 AS bits FROM fwd GROUP BY query, subject),
    t AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bits DESC, subject)::INT AS turn, ends_with(subject, ';rev=1')::INT AS back FROM p)
    SELECT query, subject, bits, turn, row_number() OVER (ORDER BY turn, back, bits DESC, query, subject)::BIGINT AS job FROM t""")
def merge_jobs(spark, sf_dir):
    return P.jobs(P.sums(P.forward(mirrored_of(spark, sf_dir))).select("query", "subject", six("bits")))


@query(f"""WITH {HSPS}, p AS (SELECT query, subject, sum(floor(pident / 100 * 2 * length)) AS agreed, sum(gaps) AS gaps FROM hsps GROUP BY query, subject)
    SELECT query, subject, (x.length + y.length - agreed + gaps)::BIGINT AS distance FROM p JOIN names x ON x.name = query JOIN names y ON y.name = subject""")
def alignment_distance(spark, sf_dir):
    return P.distances(hsps_of(spark, sf_dir), names_of(spark, sf_dir))


@query(f"""WITH r AS (SELECT l_linenumber AS cycle, round(l_discount * 100)::BIGINT AS distance, 20 * l_quantity AS length FROM lineitem)
    SELECT cycle, count(*) AS sequences, count(CASE WHEN distance = 0 OR (cycle > 2 AND distance / greatest(length, 1) < 0.005::DOUBLE) OR (cycle > 5 AND distance / greatest(length, 1) < 0.01::DOUBLE) THEN 1 END) AS settled,
           {rounded('avg(distance)', 'mean_distance')}, max(distance) AS most_distance FROM r GROUP BY cycle""")
def convergence_stats(spark, sf_dir):
    i = V.table(spark, sf_dir, "lineitem")
    rows = i.select(F.col("l_linenumber").alias("cycle"), F.round(F.col("l_discount") * 100).cast("long").alias("distance"), (20 * F.col("l_quantity")).alias("length"))
    return P.convergence(rows).select("cycle", "sequences", "settled", six("mean_distance"), "most_distance")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, floor((l_quantity * 10 + l_linenumber * l_suppkey) / greatest(l_quantity + l_linenumber - 1, 1))::BIGINT AS coverage FROM lineitem")
def merged_coverage(spark, sf_dir):
    rows = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("length"), F.lit(10).alias("cover"), F.col("l_linenumber").alias("length2"), F.col("l_suppkey").alias("cover2"), (F.col("l_quantity") + F.col("l_linenumber") - 1).alias("merged"))
    return P.merged_coverage(rows).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "coverage")


# reads on protein references

PROTEIN = f"""{V.SCAFFOLDS}, paa AS (SELECT l_orderkey AS read, l_suppkey AS reference, round(l_discount * 100)::BIGINT AS mismatch, l_extendedprice AS score, l_linenumber::BIGINT AS pos,
    CASE l_returnflag WHEN 'A' THEN '12M' WHEN 'N' THEN '4M2I5M' WHEN 'R' THEN CASE WHEN l_linestatus = 'F' THEN '5M1D6M' ELSE '2M9D4M' END END AS cigar,
    CASE WHEN l_linestatus = 'F' THEN -1 ELSE 1 END AS frame, l_linenumber::BIGINT AS dna, l_quantity::BIGINT AS size, l_partkey * 10 + l_linenumber AS place FROM lineitem)"""


def protein_of(spark, sf_dir):
    i = V.table(spark, sf_dir, "lineitem")
    closed = F.col("l_linestatus") == "F"
    cigar = F.when(F.col("l_returnflag") == "A", "12M").when(F.col("l_returnflag") == "N", "4M2I5M").when(F.col("l_returnflag") == "R", F.when(closed, "5M1D6M").otherwise("2M9D4M"))
    return i.select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("reference"), F.round(F.col("l_discount") * 100).cast("long").alias("mismatch"), F.col("l_extendedprice").alias("score"), F.col("l_linenumber").cast("long").alias("pos"), cigar.alias("cigar"),
                    F.when(closed, -1).otherwise(1).alias("frame"), F.col("l_linenumber").cast("long").alias("dna"), F.col("l_quantity").cast("long").alias("size"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("place"))


def reads_of(spark, sf_dir):
    return V.scaffolds(spark, sf_dir).withColumnRenamed("query", "read")


@query(f"WITH {PROTEIN} SELECT read, mismatch, place FROM (SELECT *, row_number() OVER (PARTITION BY read ORDER BY mismatch, place) AS rn FROM paa) WHERE rn = 1")
def aa_first_best(spark, sf_dir):
    return R.first_best(protein_of(spark, sf_dir)).select("read", "mismatch", "place")


@query(f"WITH {PROTEIN} SELECT read, reference, pos, cigar, seq FROM paa JOIN scaf ON query = read WHERE reference IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def reads_on_accepted(spark, sf_dir):
    accepted = V.table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("reference"))
    return R.on_accepted(protein_of(spark, sf_dir), accepted, reads_of(spark, sf_dir)).select("read", "reference", "pos", "cigar", "seq")


@query(f"WITH {PROTEIN} SELECT reference, sum(size)::BIGINT AS reads FROM (SELECT DISTINCT reference, read, size FROM paa) GROUP BY reference")
def weighted_reads(spark, sf_dir):
    return R.weighted_reads(protein_of(spark, sf_dir))


CODON_VOTES = f"""{PROTEIN}, st AS (SELECT p.*, CASE WHEN frame < 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS strand, CASE WHEN frame < 0 THEN length(seq) - dna + 1 ELSE dna END AS beg FROM paa p JOIN scaf ON query = read),
    cd AS (SELECT reference, pos, size, cigar, regexp_extract_all(substr(strand, beg), '(...)') AS c FROM st),
    ok AS (SELECT *, row_number() OVER () AS row, CASE cigar WHEN '5M1D6M' THEN 1 WHEN '2M9D4M' THEN 9 ELSE 0 END <= 0.3::DOUBLE * len(c) AS counts FROM cd WHERE len(c) > 0),
    steps(cigar, op, n, ahead, off) AS (VALUES ('12M', 'M', 12, 0, 0), ('4M2I5M', 'M', 4, 0, 0), ('4M2I5M', 'M', 5, 4, 6), ('5M1D6M', 'M', 5, 0, 0), ('5M1D6M', 'D', 1, 5, 5), ('5M1D6M', 'M', 6, 6, 5), ('2M9D4M', 'M', 2, 0, 0), ('2M9D4M', 'D', 9, 2, 2), ('2M9D4M', 'M', 4, 11, 2)),
    ea AS (SELECT reference, pos - 1 + ahead + i AS pos, CASE WHEN op = 'D' THEN 'DDD' ELSE c[off + i + 1] END AS codon, size FROM (SELECT *, unnest(range(0, n)) AS i FROM ok JOIN steps USING (cigar) WHERE op = 'M' OR counts)),
    cv AS (SELECT reference, pos::BIGINT AS pos, codon, sum(size)::BIGINT AS votes FROM ea WHERE codon IS NOT NULL AND pos >= 0 GROUP BY ALL)"""


def codon_votes_of(spark, sf_dir):
    p = protein_of(spark, sf_dir)
    return R.codon_votes(R.on_accepted(p, p, reads_of(spark, sf_dir)))


@query(f"WITH {CODON_VOTES} SELECT reference, pos, codon, votes FROM cv")
def codon_votes(spark, sf_dir):
    return codon_votes_of(spark, sf_dir)


@query(f"""WITH {CODON_VOTES}, b AS (SELECT reference, pos, max(votes) AS top FROM cv GROUP BY ALL),
    t AS (SELECT reference, pos, CASE WHEN count(*) > 1 THEN 'nnn' WHEN max(codon) = 'DDD' THEN 'NNN' ELSE max(codon) END AS codon FROM cv JOIN b USING (reference, pos) WHERE votes = top GROUP BY ALL),
    g AS (SELECT *, pos - coalesce(lag(pos) OVER (PARTITION BY reference ORDER BY pos) + 1, 0) AS gap FROM t)
    SELECT reference, max(pos) + 1 AS codons, string_agg(repeat('NNN', gap) || codon, '' ORDER BY pos) AS seq FROM g GROUP BY reference""")
def codon_consensus(spark, sf_dir):
    return R.codon_consensus(codon_votes_of(spark, sf_dir))


@query("SELECT l_suppkey AS accession, l_orderkey AS read, s_name AS name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey")
def parent_children(spark, sf_dir):
    parents = V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("accession"), F.col("s_name").alias("name"))
    return R.with_children(parents, V.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("accession"), F.col("l_orderkey").alias("read"))).select("accession", "read", "name")


LOCATIONS = """loc AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 1 + l_linenumber % 3 AS codon_start, l_partkey + 1 AS a, l_partkey + l_quantity::BIGINT + 3 AS b, l_partkey + 100 AS c, l_partkey + 100 + l_linenumber * 3 AS d,
    l_returnflag = 'R' AS rev FROM lineitem)"""


def locations_of(spark, sf_dir):
    i = V.table(spark, sf_dir, "lineitem")
    text = lambda c: c.cast("long").cast("string")
    p = F.col("l_partkey")
    inner = F.concat(F.lit("join("), text(p + 1), F.lit(".."), text(p + F.col("l_quantity") + 3), F.lit(",<"), text(p + 100), F.lit("..>"), text(p + 100 + F.col("l_linenumber") * 3), F.lit(")"))
    location = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("complement("), inner, F.lit(")"))).otherwise(inner)
    return i.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (1 + F.col("l_linenumber") % 3).alias("codon_start"), location.alias("location"))


@query(f"""WITH {LOCATIONS} SELECT l_orderkey, l_partkey, l_linenumber, 0 AS k, (a + CASE WHEN rev THEN 0 ELSE codon_start - 1 END)::BIGINT AS start, b::BIGINT AS stop, rev AS reverse FROM loc
    UNION ALL SELECT l_orderkey, l_partkey, l_linenumber, 1, c::BIGINT, (d - CASE WHEN rev THEN codon_start - 1 ELSE 0 END)::BIGINT, rev FROM loc""")
def location_ranges(spark, sf_dir):
    rows = locations_of(spark, sf_dir).withColumn("ranges", S.location_ranges("location"))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.posexplode(S.shifted_ranges("ranges", "codon_start")).alias("k", "r")).select("l_orderkey", "l_partkey", "l_linenumber", "k", "r.start", "r.stop", "r.reverse")


@query("SELECT l_suppkey AS parent, (min(l_partkey) + 1)::BIGINT AS first FROM lineitem GROUP BY 1")
def child_starts(spark, sf_dir):
    return R.child_starts(locations_of(spark, sf_dir).withColumnRenamed("l_suppkey", "parent"))


@query(f"WITH {V.SCAFFOLDS} SELECT query, l_linenumber, l_partkey, CASE WHEN l_linenumber IS NULL THEN seq ELSE substr(seq, 1, l_linenumber) || repeat('N', l_quantity::INT) || substr(seq, l_linenumber + 1) END AS seq FROM scaf LEFT JOIN lineitem ON l_orderkey = query")
def scaffold_children(spark, sf_dir):
    """Every scaffold with its children, each in a gap of its size; scaffolds without children stay."""
    i = V.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("query"), "l_linenumber", "l_partkey", "l_quantity")
    rows = V.scaffolds(spark, sf_dir).join(i, "query", "left")
    return rows.select("query", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber").isNull(), F.col("seq")).otherwise(S.with_gap("seq", "l_linenumber", "l_quantity")).alias("seq"))


# smaller steps


@query(f"WITH {V.HITS} SELECT query, taxon, qstart, qend, bits FROM hits WHERE evalue <= 0.1 AND query IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def hits_on_scaffolds(spark, sf_dir):
    known = V.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("query"))
    return H.usable(V.hits(spark, sf_dir)).join(known, "query", "left_semi").select("query", "taxon", "qstart", "qend", "bits")


@query(f"""WITH {V.SEQS}, c AS (SELECT def, md5(md5(seq) || sha1(seq)) AS checksum FROM seqs) SELECT def, checksum, count(*) OVER (PARTITION BY checksum) > 1 AS shared FROM c""")
def dup_key_split(spark, sf_dir):
    return Q.split_by_copies(V.seqs(spark, sf_dir)).select("def", "checksum", "shared")


CALLS = "calls AS (SELECT o_orderkey AS contig, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 100000 + o_custkey END AS taxid FROM orders)"


@query(f"""WITH RECURSIVE {CLOSED}, {GROUP_SQL}, {CALLS} SELECT contig, taxid FROM calls LEFT JOIN grp ON taxon = taxid WHERE taxid <= 1 OR "group" IN ('first', 'second')""")
def kraken_antifilter(spark, sf_dir):
    """Contigs without a call, or called to a kept group; a call that the taxonomy does not resolve is dropped."""
    level = F.col("o_orderpriority")
    calls = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("contig"), F.when(level == "1-URGENT", 0).when(level == "2-HIGH", 1).otherwise(100_000 + F.col("o_custkey")).cast("long").alias("taxid"))
    return T.without_calls(calls, groups_of(spark, sf_dir).withColumnRenamed("taxon", "taxid"), ["first", "second"])


@query(f"""WITH {V.SEQS}, k AS (SELECT def, substr(seq, i::BIGINT + 1, 31) AS w FROM (SELECT def, seq, unnest(range(0, greatest(length(seq) - 31, 0))) AS i FROM seqs)),
    u AS (SELECT w, count(*) AS n FROM k GROUP BY w), d AS (SELECT def, quantile_disc(n, 0.5) AS depth FROM k JOIN u USING (w) GROUP BY def)
    SELECT def, depth, depth <= 5 OR ('0x' || substr(md5(def::VARCHAR), 1, 8))::BIGINT / 4294967296 < 5 / depth AS kept FROM d""")
def depth_normalised(spark, sf_dir):
    return Q.normalised(V.seqs(spark, sf_dir))


@query(f"""{FULL}, lt AS (SELECT query, length(regexp_replace(seq, '[Nn]', '', 'g')) AS total FROM scaf)
    SELECT query, taxon, {rounded("sum(rep * len) / any_value(total)", "rep")} FROM ev JOIN lt USING (query) GROUP BY query, taxon""")
def taxon_rep_by_length(spark, sf_dir):
    total = V.scaffolds(spark, sf_dir).select("query", S.known_length("seq").alias("total"))
    sums = evidence_of(spark, sf_dir).groupBy("query", "taxon").agg(F.sum(F.col("rep") * F.col("length")).alias("rep")).join(total, "query")
    return sums.withColumn("rep", F.col("rep") / F.col("total")).select("query", "taxon", six("rep"))


@query("SELECT p_partkey, damerau_levenshtein(p_name, p_type)::BIGINT AS distance FROM part")
def damerau_pairs(spark, sf_dir):
    return V.table(spark, sf_dir, "part").select("p_partkey", damerau("p_name", "p_type").alias("distance"))


@F.pandas_udf(LongType())
def damerau(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edits and swaps of neighbours between short strings, a column of the table at a time."""
    return pd.Series([S.damerau_distance(x, y) if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="Int64")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def skip_listed(spark, sf_dir):
    skipped = V.table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("name"))
    return X.without(V.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", skipped)


@query(f"WITH {HSPS} SELECT query, subject, pident, length, bits FROM hsps WHERE pident >= 99.6 AND length >= 17")
def aligner_thresholds(spark, sf_dir):
    return P.strong(hsps_of(spark, sf_dir), 99.6, 17).select("query", "subject", "pident", "length", "bits")


# pileup

PILE = f"""{V.SCAFFOLDS}, sscaf AS (SELECT s_suppkey AS reference, substr(translate(repeat(md5(s_suppkey::VARCHAR), 3), '0123456789abcdef', 'ACGTACGTACGTACNa'), 1, 60) AS old FROM supplier),
    pile AS (SELECT l_suppkey AS reference, l_quantity::BIGINT + l_linenumber - 4 AS pos, CASE l_returnflag WHEN 'A' THEN '20M' WHEN 'N' THEN '3S8M2I7M' ELSE CASE WHEN l_linestatus = 'F' THEN '6M2D14M' ELSE '14M11D6M' END END AS cigar,
             substr(seq, 1, 20) AS seq, l_linenumber::BIGINT AS size FROM lineitem JOIN scaf ON query = l_orderkey),
    psteps(cigar, op, n, ahead, off) AS (VALUES ('20M', 'M', 20, 0, 0), ('3S8M2I7M', 'S', 3, -3, 0), ('3S8M2I7M', 'M', 8, 0, 3), ('3S8M2I7M', 'I', 2, 8, 11), ('3S8M2I7M', 'M', 7, 8, 13), ('6M2D14M', 'M', 6, 0, 0), ('6M2D14M', 'D', 2, 6, 6), ('6M2D14M', 'M', 14, 8, 6), ('14M11D6M', 'M', 14, 0, 0)),
    pe AS (SELECT reference, op, size, pos + ahead + i AS spot, CASE WHEN pos + ahead + i < 1 OR pos + ahead + i > 61 THEN lower(substr(seq, off + i + 1, 1)) ELSE substr(seq, off + i + 1, 1) END AS letter FROM (SELECT *, unnest(range(0, n))::INT AS i FROM pile JOIN psteps USING (cigar) WHERE op <> 'I')),
    pv AS (SELECT reference, spot::BIGINT AS pos, CASE WHEN op = 'D' THEN 'D' WHEN op = 'M' OR spot < 1 THEN letter ELSE 'S.' || letter END AS base, sum(size)::BIGINT AS votes FROM pe GROUP BY ALL),
    pi AS (SELECT reference, (pos + ahead)::BIGINT AS pos, CASE WHEN pos + ahead < 1 OR pos + ahead > 61 THEN lower(substr(seq, off + 1, n)) ELSE substr(seq, off + 1, n) END AS letters, sum(size)::BIGINT AS votes FROM pile JOIN psteps USING (cigar) WHERE op = 'I' GROUP BY ALL)"""


def pile_of(spark, sf_dir):
    i = V.table(spark, sf_dir, "lineitem").join(V.scaffolds(spark, sf_dir).withColumnRenamed("query", "l_orderkey"), "l_orderkey")
    cigar = F.when(F.col("l_returnflag") == "A", "20M").when(F.col("l_returnflag") == "N", "3S8M2I7M").otherwise(F.when(F.col("l_linestatus") == "F", "6M2D14M").otherwise("14M11D6M"))
    rows = i.select(F.col("l_suppkey").alias("reference"), (F.col("l_quantity").cast("long") + F.col("l_linenumber") - 4).alias("pos"), cigar.alias("cigar"), F.substring("seq", 1, 20).alias("seq"), F.col("l_linenumber").cast("long").alias("size"))
    hexes = F.md5(F.col("s_suppkey").cast("string").cast("binary"))
    old = V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("reference"), F.substring(F.translate(F.concat(hexes, hexes, hexes), "0123456789abcdef", "ACGTACGTACGTACNa"), 1, 60).alias("seq"))
    return rows, old


@query(f"WITH {PILE} SELECT reference, pos, base, votes FROM pv")
def pileup_votes(spark, sf_dir):
    return L.votes(*pile_of(spark, sf_dir))


@query(f"WITH {PILE} SELECT reference, pos, letters, votes FROM pi")
def pileup_insertions(spark, sf_dir):
    return L.insertions(*pile_of(spark, sf_dir))


@query(f"""WITH {PILE}, us AS (SELECT *, min(starts_with(base, 'S.')::INT) OVER (PARTITION BY reference, pos) AS alone FROM pv),
    uu AS (SELECT reference, pos, CASE WHEN starts_with(base, 'S.') THEN substr(base, 3) ELSE base END AS base, votes FROM us WHERE alone = 1 OR NOT starts_with(base, 'S.')),
    tops AS (SELECT reference, pos, max(base) AS base, any_value(votes) AS top, count(*) AS ties FROM (SELECT *, max(votes) OVER (PARTITION BY reference, pos) AS m FROM uu) WHERE votes = m GROUP BY ALL),
    ib AS (SELECT reference, pos, max(letters) AS letters, count(*) AS same, any_value(votes) AS most, any_value(total) AS total FROM (SELECT *, max(votes) OVER w AS m, sum(votes) OVER w AS total FROM pi WINDOW w AS (PARTITION BY reference, pos)) WHERE votes = m GROUP BY reference, pos),
    rng AS (SELECT reference, min(pos) AS lo, max(pos) AS hi FROM (SELECT reference, pos FROM tops UNION ALL SELECT reference, pos FROM ib) GROUP BY reference),
    j AS (SELECT *, CASE WHEN pos BETWEEN 1 AND length(old) THEN substr(old, pos, 1) WHEN pos = 0 THEN 'a' END AS was FROM (SELECT reference, unnest(range(lo, hi + 1)) AS pos FROM rng) LEFT JOIN tops USING (reference, pos) LEFT JOIN ib USING (reference, pos) JOIN sscaf USING (reference)),
    p AS (SELECT reference, pos, CASE WHEN top IS NULL AND most IS NULL THEN CASE WHEN was = 'n' THEN 'n' ELSE 'N' END ELSE
          CASE WHEN most IS NOT NULL AND (top IS NULL OR most >= top - total) THEN CASE WHEN same > 1 THEN repeat('n', length(letters)) WHEN coalesce(regexp_matches(was, '[acgt]'), false) THEN lower(letters) ELSE letters END ELSE '' END ||
          CASE WHEN top IS NULL OR (base = 'D' AND ties = 1) THEN '' WHEN ties > 1 THEN 'n' WHEN was IS NULL OR regexp_matches(was, '[acgt]') THEN lower(base) ELSE base END END AS part FROM j)
    SELECT reference, string_agg(part, '' ORDER BY pos) AS seq, sum(length(part))::INT AS length FROM p GROUP BY reference""")
def pileup_consensus(spark, sf_dir):
    return L.rebuilt(*pile_of(spark, sf_dir))


# masks and overlays of scaffolds


@query(f"""WITH {V.SCAFFOLDS}, m AS (SELECT query, seq, unnest(range(0, length(seq))) AS i FROM scaf), w AS (SELECT DISTINCT l_orderkey AS query, l_linenumber AS s, l_linenumber + l_quantity AS e FROM lineitem WHERE l_returnflag = 'R'),
    b AS (SELECT DISTINCT m.query, i FROM m JOIN w ON w.query = m.query AND i >= s AND i < e)
    SELECT m.query AS def, string_agg(CASE WHEN b.i IS NULL THEN substr(seq, m.i + 1, 1) ELSE 'N' END, '' ORDER BY m.i) AS seq FROM m LEFT JOIN b ON b.query = m.query AND b.i = m.i GROUP BY m.query""")
def hit_mask(spark, sf_dir):
    windows = V.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("def"), F.col("l_linenumber").alias("start"), F.col("l_quantity").alias("length"))
    return M.masked(V.scaffolds(spark, sf_dir).withColumnRenamed("query", "def"), windows).select("def", "seq")


@query(f"""WITH {V.SCAFFOLDS}, m AS (SELECT query, seq, unnest(range(0, length(seq))) AS i FROM scaf),
    q AS (SELECT l_orderkey AS query, l_linenumber AS s, l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS priority, substr(translate(md5(l_partkey::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACNa'), 1, 12) AS part FROM lineitem),
    e AS (SELECT query, s + k AS i, priority, substr(part, k + 1, 1) AS c FROM (SELECT *, unnest(range(0, 12)) AS k FROM q)),
    n AS (SELECT query, i, arg_min(c, priority) AS c FROM e WHERE upper(c) <> 'N' GROUP BY query, i)
    SELECT m.query AS def, string_agg(CASE WHEN n.c IS NULL THEN substr(seq, m.i + 1, 1) WHEN upper(substr(seq, m.i + 1, 1)) = 'N' THEN n.c WHEN upper(substr(seq, m.i + 1, 1)) = upper(n.c) THEN substr(seq, m.i + 1, 1) ELSE lower(substr(seq, m.i + 1, 1)) END, '' ORDER BY m.i) AS seq
    FROM m LEFT JOIN n ON n.query = m.query AND n.i = m.i GROUP BY m.query""")
def overlay_parts(spark, sf_dir):
    part = F.substring(F.translate(F.md5(F.col("l_partkey").cast("string").cast("binary")), "0123456789abcdef", "ACGTACGTACGTACNa"), 1, 12)
    priority = F.col("l_partkey") * 1_000_000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")
    parts = V.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("start"), priority.alias("priority"), part.alias("seq"))
    return M.overlaid(V.scaffolds(spark, sf_dir).withColumnRenamed("query", "def"), parts)
