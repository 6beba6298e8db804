"""The registered queries of the sequence engine, and the SQL that gives the same rows.

Every query runs over the driver's whole tables, seen as sequences, taxonomy, hits, alignments or abundance (views).
Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators import alignments as A
from seqloom.operators import cover as C
from seqloom.operators import hits as H
from seqloom.operators import sequences as Q
from seqloom.operators import taxonomy as T
from seqloom.plans import views as V
from seqloom.plans.stages import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def six(c: str):
    """Six places, by the same steps on both sides; the bound lies beside exact ties, which sums reach with some noise."""
    return (F.floor(F.col(c) * 1e6 + 0.501) / 1e6).alias(c)


W = "WITH "
UPPER_RC = "reverse(translate(upper(seq), 'ACGT', 'TGCA'))"
ENTROPY = f"""{V.SEQS}, bare AS (SELECT def, replace(upper(seq), 'N', '') AS s FROM seqs),
    kmers AS (SELECT def, substr(s, i::BIGINT + 1, 3) AS kmer FROM (SELECT def, s, unnest(range(0, greatest(length(s) - 3, 0))) AS i FROM bare)),
    counted AS (SELECT def, kmer, count(*) AS n FROM kmers GROUP BY ALL),
    ent AS (SELECT def, greatest(log2(sum(n)) - sum(n * log2(n)) / sum(n), 0) AS e FROM counted GROUP BY def)"""
HITS_OK = f"{V.HITS}, ok AS (SELECT * FROM hits WHERE evalue <= 0.1)"
COVER = f"""{HITS_OK}, top AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY {', '.join(V.HIT_ORDER)}) AS rn FROM ok QUALIFY rn <= 1000),
    cuts AS (SELECT query, qstart AS start FROM top UNION SELECT query, qend + 1 FROM top),
    seg AS (SELECT * FROM (SELECT query, start, lead(start) OVER (PARTITION BY query ORDER BY start) - 1 AS stop FROM cuts) WHERE stop IS NOT NULL),
    cover AS (SELECT h.*, start, stop, stop - start + 1 AS len, bits / (qend - qstart + 1) AS density
              FROM top h JOIN seg s ON s.query = h.query AND h.qstart <= s.start AND h.qend >= s.stop),
    b1 AS (SELECT query, start, stop, len, taxon, max(density) AS density FROM cover GROUP BY ALL),
    b2 AS (SELECT *, max(density) OVER (PARTITION BY query, start) AS top FROM b1),
    best AS (SELECT * FROM (SELECT *, max((density >= 0.9::DOUBLE * top)::INT) OVER (PARTITION BY query, taxon) AS near FROM b2) WHERE near = 1)"""
CLOSED = f"""{V.TAXONOMY}, closed(taxid, ancestor, hops) AS (
    SELECT taxid, taxid, 0 FROM taxonomy WHERE taxid <> 1
    UNION ALL SELECT c.taxid, t.parent, c.hops + 1 FROM closed c JOIN taxonomy t ON t.taxid = c.ancestor WHERE t.parent <> 1 AND t.taxid <> 1)"""
GROUPS = {10: "first", 11: "second", 12: "third"}
GROUP_SQL = "grp AS (SELECT taxid AS taxon, coalesce(max(CASE WHEN ancestor IN (10, 11, 12) THEN CASE ancestor WHEN 10 THEN 'first' WHEN 11 THEN 'second' ELSE 'third' END END), 'unknown') AS \"group\" FROM closed GROUP BY taxid)"


def cover_of(spark, sf_dir, most: int = 1000):
    """The ``most`` best hits of a query in their segments. A limit of hits is a feature of the analysis: 1,000 for the filter,
    100,000 to classify."""
    return H.covered(H.top_n(H.by_query(H.usable(V.hits(spark, sf_dir))), most, V.HIT_ORDER))


def groups_of(spark, sf_dir):
    return T.trace_to_group(T.closure(V.taxonomy(spark, sf_dir)), GROUPS).withColumnRenamed("taxid", "taxon")


# sequences


@query(f"WITH {V.SEQS} SELECT min(def) AS def, least(upper(seq), {UPPER_RC}) AS seq, count(*) AS size FROM seqs GROUP BY 2")
def derep_fulllength(spark, sf_dir):
    return Q.dereplicate(V.seqs(spark, sf_dir))


@query(f"WITH {V.SEQS} SELECT min(def) AS def, md5(md5(seq) || sha1(seq)) AS checksum FROM seqs GROUP BY 2")
def derep_keep_first(spark, sf_dir):
    return Q.keep_first(V.seqs(spark, sf_dir))


@query(f"WITH {V.SEQS} SELECT md5(md5(seq) || sha1(seq)) AS checksum, count(*) AS copies FROM seqs GROUP BY 1 HAVING count(*) > 1")
def dup_keys_having(spark, sf_dir):
    return Q.duplicate_keys(V.seqs(spark, sf_dir))


@query(f"WITH {V.SEQS} SELECT def, reverse(translate(seq, 'ACGT', 'TGCA')) AS seq FROM seqs")
def seq_reverse_complement(spark, sf_dir):
    return V.seqs(spark, sf_dir).select("def", S.reverse_complement("seq").alias("seq"))


@query(f"WITH {V.SEQS} SELECT def::VARCHAR AS def, seq FROM seqs UNION ALL SELECT def || ';rev=1', reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) FROM seqs")
def double_reverse(spark, sf_dir):
    return Q.both_strands(V.seqs(spark, sf_dir))


@query(f"WITH {V.SEQS} SELECT def, translate(seq, 'acgt', 'ACGT') AS folded, upper(seq) AS upper FROM seqs")
def case_fold(spark, sf_dir):
    return V.seqs(spark, sf_dir).select("def", S.fold_case("seq").alias("folded"), F.upper("seq").alias("upper"))


@query(f"WITH {V.SEQS} SELECT def, repeat('N', 30) || seq || repeat('N', 30) AS seq FROM seqs")
def pad_n(spark, sf_dir):
    return V.seqs(spark, sf_dir).select("def", S.pad_n("seq", 30).alias("seq"))


@query(f"WITH {V.SEQS} SELECT * FROM (SELECT def, regexp_replace(seq, '^[Nn|]+|[Nn|]+$', '', 'g') AS seq FROM seqs) WHERE seq <> ''")
def trim_n(spark, sf_dir):
    return V.seqs(spark, sf_dir).select("def", S.trim_n("seq").alias("seq")).where("seq <> ''")


@query(f"WITH {V.SEQS} SELECT def, floor((length(regexp_replace(seq, '[^GCgc]', '', 'g')) / length(seq)) * 1e6 + 0.501) / 1e6 AS gc FROM seqs WHERE seq <> ''")
def gc_fraction(spark, sf_dir):
    return V.seqs(spark, sf_dir).where("seq <> ''").select("def", S.gc_fraction("seq").alias("gc")).select("def", six("gc"))


@query(f"WITH {V.SEQS} SELECT def, length(seq) AS length, length(replace(replace(seq, 'N', ''), 'n', '')) AS known, floor((length(replace(replace(seq, 'N', ''), 'n', '')) / length(seq) * 100) * 1e6 + 0.501) / 1e6 AS occupancy FROM seqs WHERE seq <> ''")
def letter_occupancy(spark, sf_dir):
    s = V.seqs(spark, sf_dir).where("seq <> ''")
    return s.select("def", F.length("seq").cast("long").alias("length"), S.known_length("seq").cast("long").alias("known"), S.letter_occupancy("seq").alias("occupancy")).select("def", "length", "known", six("occupancy"))


@query(f"WITH {ENTROPY} SELECT def, kmer, n FROM counted")
def kmer_count(spark, sf_dir):
    return Q.kmer_counts(V.seqs(spark, sf_dir), 3)


@query(f"WITH {ENTROPY} SELECT s.def, floor((e) * 1e6 + 0.501) / 1e6 AS entropy FROM seqs s LEFT JOIN ent USING (def)")
def kmer_entropy(spark, sf_dir):
    return Q.entropy(V.seqs(spark, sf_dir)).select("def", six("entropy"))


@query(f"WITH {ENTROPY} SELECT s.def, seq FROM seqs s LEFT JOIN ent USING (def) WHERE e IS NULL OR e > 5")
def low_entropy_filter(spark, sf_dir):
    return Q.rich(V.seqs(spark, sf_dir))


ISLANDS = f"""{V.SEQS}, runs AS (SELECT def, unnest(regexp_extract_all(seq, '(N+|[^N]+)')) AS run, generate_subscripts(regexp_extract_all(seq, '(N+|[^N]+)'), 1) AS place FROM seqs),
    placed AS (SELECT *, coalesce(sum(length(run)) OVER (PARTITION BY def ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM runs),
    isl AS (SELECT def, (start + length(run) - length(ltrim(run, 'n')))::BIGINT AS start, replace(trim(run, 'n'), 'n', 'N') AS seq FROM placed WHERE NOT starts_with(run, 'N'))"""


@query(f"WITH {ISLANDS} SELECT * FROM isl WHERE length(seq) >= 8")
def n_free_islands(spark, sf_dir):
    return Q.islands(V.seqs(spark, sf_dir), 8)


@query(f"""WITH {ISLANDS}, w AS (SELECT *, greatest(length(seq) // 12, 1) AS whole FROM isl WHERE length(seq) >= 8),
    c AS (SELECT *, unnest(range(0, 2 * whole - 1)) AS i FROM w),
    t AS (SELECT def, start + 12 * (i // 2) + 6 * (i % 2) AS start, substr(seq, (12 * (i // 2) + 6 * (i % 2) + 1)::BIGINT, (CASE WHEN i = 2 * (whole - 1) THEN length(seq) ELSE 12 END)::BIGINT) AS seq FROM c)
    SELECT def, start::BIGINT AS start, seq FROM t WHERE length(seq) >= 8""")
def tile_windows(spark, sf_dir):
    found = Q.islands(V.seqs(spark, sf_dir), 8)
    return Q.tiles(found, 12, 8)


@query(f"WITH {V.SEQS} SELECT def, md5(md5(seq) || sha1(seq)) AS checksum FROM seqs")
def checksum(spark, sf_dir):
    return V.seqs(spark, sf_dir).select("def", S.checksum("seq").alias("checksum"))


CASE_AA = "CASE c " + " ".join(f"WHEN '{c}' THEN '{a}'" for c, a in S.CODON_TABLE.items()) + " ELSE 'X' END"
CASE_SELF = "CASE c " + " ".join(f"WHEN '{c}' THEN {S.BLOSUM_SELF[a]}" for c, a in S.CODON_TABLE.items()) + " ELSE -1 END"


@query(f"WITH {V.SEQS} SELECT def, array_to_string(list_transform(regexp_extract_all(upper(seq), '(...)'), lambda c: {CASE_AA}), '') AS protein FROM seqs")
def codon_translate(spark, sf_dir):
    return V.seqs(spark, sf_dir).select("def", S.translate_codons(F.upper("seq")).alias("protein"))


@query(f"WITH {V.SEQS} SELECT def, coalesce(list_sum(list_transform(regexp_extract_all(upper(seq), '(...)'), lambda c: {CASE_SELF})), 0)::BIGINT AS protein, (2 * length(replace(upper(seq), 'N', '')) - 2 * (length(seq) - length(replace(upper(seq), 'N', ''))))::BIGINT AS nucleotide FROM seqs")
def blosum_self_score(spark, sf_dir):
    return V.seqs(spark, sf_dir).select("def", S.protein_self_score(F.upper("seq")).cast("long").alias("protein"), S.nucleotide_self_score("seq").cast("long").alias("nucleotide"))


@query(f"""WITH {V.HITS} SELECT query, subject, taxon, bits, qstart, qend, floor(((0.625::DOUBLE * bits - ln(0.41::DOUBLE)) / 0.6931471805599453) * 1e6 + 0.501) / 1e6 AS nuc_bits, floor(((0.267::DOUBLE * bits - ln(0.041::DOUBLE)) / 0.6931471805599453) * 1e6 + 0.501) / 1e6 AS prot_bits,
    floor((least(bits / (qend - qstart + 1), 2 * 0.625::DOUBLE / 0.6931471805599453)) * 1e6 + 0.501) / 1e6 AS density FROM hits""")
def raw_to_bit(spark, sf_dir):
    h = V.hits(spark, sf_dir)
    out = h.select("query", "subject", "taxon", "bits", "qstart", "qend", S.raw_to_bits("bits").alias("nuc_bits"), S.raw_to_bits("bits", True).alias("prot_bits"), S.bits_per_base("bits", F.col("qend") - F.col("qstart") + 1).alias("density"))
    return out.select("query", "subject", "taxon", "bits", "qstart", "qend", six("nuc_bits"), six("prot_bits"), six("density"))


@query("SELECT p_partkey, levenshtein(p_name, p_type)::BIGINT AS distance FROM part")
def levenshtein_pairs(spark, sf_dir):
    return V.table(spark, sf_dir, "part").select("p_partkey", F.levenshtein("p_name", "p_type").cast("long").alias("distance"))


@query("SELECT a.s_suppkey, b.s_suppkey AS other, hamming(a.s_name, b.s_name)::BIGINT AS distance FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1 WHERE length(a.s_name) = length(b.s_name)")
def hamming_pairs(spark, sf_dir):
    a = V.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    b = a.select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("s_suppkey").alias("other"), F.col("s_name").alias("name"))
    return a.join(b, "s_suppkey").select("s_suppkey", "other", S.hamming("s_name", "name").cast("long").alias("distance")).where("distance IS NOT NULL")


@query(f"""WITH {V.SEQS}, k AS (SELECT DISTINCT def, substr(seq, i::BIGINT + 1, 31) AS kmer FROM (SELECT def, seq, unnest(range(0, greatest(length(seq) - 31, 0))) AS i FROM seqs)),
    f AS (SELECT kmer, min(def) AS first FROM k GROUP BY 1) SELECT def, count(*) AS kmers, count(CASE WHEN first < def THEN 1 END) AS shared FROM k JOIN f USING (kmer) GROUP BY def""")
def shared_kmer_overlap(spark, sf_dir):
    return Q.earlier_overlap(V.seqs(spark, sf_dir), 31)


# hits


@query(f"WITH {HITS_OK} SELECT query, taxon, qstart, qend, bits, pident, evalue, subject FROM ok")
def hit_predicates(spark, sf_dir):
    return H.usable(V.hits(spark, sf_dir)).select("query", "taxon", "qstart", "qend", "bits", "pident", "evalue", "subject")


@query(f"WITH {HITS_OK} SELECT * FROM (SELECT query, taxon, qstart, qend, bits, pident, row_number() OVER (PARTITION BY query ORDER BY {', '.join(V.HIT_ORDER)})::BIGINT AS rn FROM ok) WHERE rn <= 3")
def hits_topn(spark, sf_dir):
    return H.top_n(H.usable(V.hits(spark, sf_dir)), 3, V.HIT_ORDER).select("query", "taxon", "qstart", "qend", "bits", "pident", F.col("rn").cast("long").alias("rn"))


@query(f"WITH {COVER} SELECT query, start, stop, count(*) AS hits FROM cover GROUP BY ALL")
def segment_cover(spark, sf_dir):
    return cover_of(spark, sf_dir).groupBy("query", "start", "stop").agg(F.count("*").alias("hits"))


@query(f"WITH {COVER} SELECT query, start, taxon, floor((density) * 1e6 + 0.501) / 1e6 AS density, floor((top) * 1e6 + 0.501) / 1e6 AS top FROM best")
def top_within_90pct(spark, sf_dir):
    return H.top_taxa(cover_of(spark, sf_dir)).select("query", "start", "taxon", six("density"), six("top"))


@query(f"WITH {COVER} SELECT c.query, c.taxon, floor((sum(pow(c.density / b.top, 3.0) * c.len)) * 1e6 + 0.501) / 1e6 AS rep FROM cover c JOIN best b USING (query, start, taxon) GROUP BY ALL")
def rep_power_sum(spark, sf_dir):
    return H.representation(cover_of(spark, sf_dir)).select("query", "taxon", six("rep"))


@query(f"WITH {COVER} SELECT DISTINCT query, rn::BIGINT AS rn FROM (SELECT query, rn, density, max(density) OVER (PARTITION BY query, start ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM cover) WHERE density > coalesce(b, 0)")
def running_max_hits(spark, sf_dir):
    return H.running_max(cover_of(spark, sf_dir)).select("query", F.col("rn").cast("long").alias("rn"))


@query(f"WITH {COVER} SELECT query, taxon, floor((sum(density * len)) * 1e6 + 0.501) / 1e6 AS score, sum(len)::BIGINT AS positions FROM best GROUP BY ALL")
def taxon_score_sum(spark, sf_dir):
    return H.taxon_scores(cover_of(spark, sf_dir)).select("query", "taxon", six("score"), "positions")


@query(f"WITH RECURSIVE {CLOSED}, {GROUP_SQL}, {COVER}, g AS (SELECT query, start, len, \"group\", max(density) AS density FROM best JOIN grp USING (taxon) GROUP BY ALL) SELECT query, \"group\", floor((sum(density * len)) * 1e6 + 0.501) / 1e6 AS score FROM g GROUP BY ALL")
def group_best_sum(spark, sf_dir):
    return H.group_scores(cover_of(spark, sf_dir), groups_of(spark, sf_dir)).select("query", "group", six("score"))


# taxonomy


@query(f"WITH RECURSIVE {CLOSED} SELECT taxid, ancestor, hops FROM closed")
def ancestor_closure(spark, sf_dir):
    return T.closure(V.taxonomy(spark, sf_dir))


@query(f"WITH RECURSIVE {CLOSED}, {GROUP_SQL} SELECT taxon AS taxid, \"group\" FROM grp")
def trace_to_group(spark, sf_dir):
    return groups_of(spark, sf_dir).withColumnRenamed("taxon", "taxid")


@query(f"""WITH RECURSIVE {CLOSED}, m AS (SELECT c.taxid, r.hops AS room FROM closed c JOIN closed r ON r.taxid = c.taxid AND r.ancestor = 11 WHERE c.hops = 0),
    k AS (SELECT m.taxid, least(min(c.hops) + 1, any_value(room)) AS hops FROM m JOIN closed c USING (taxid) JOIN taxonomy t ON t.taxid = c.ancestor AND t.rank = 'species' GROUP BY m.taxid)
    SELECT DISTINCT c.taxid, coalesce(d.ancestor, c.taxid) AS target FROM closed c LEFT JOIN k ON k.taxid = c.taxid LEFT JOIN closed d ON d.taxid = c.taxid AND d.hops = k.hops""")
def collapse_to_species(spark, sf_dir):
    t = V.taxonomy(spark, sf_dir)
    return T.collapse(t, T.closure(t), {11: 1})


@query(f"""WITH {V.TAXONOMY}, wanted AS (SELECT l_partkey + 100000 AS taxid FROM lineitem UNION SELECT l_suppkey + 200000 FROM lineitem),
    merged AS (SELECT s_suppkey + 200000 AS old, s_suppkey + 100000 AS new FROM supplier WHERE s_acctbal >= 0), deleted AS (SELECT s_suppkey + 200000 AS taxid FROM supplier WHERE s_acctbal < 0)
    SELECT w.taxid, coalesce(m.new, w.taxid) AS resolved, CASE WHEN t.taxid IS NOT NULL THEN CASE WHEN m.new IS NOT NULL THEN 'merged' ELSE 'current' END WHEN d.taxid IS NOT NULL THEN 'deleted' ELSE 'missing' END AS status
    FROM wanted w LEFT JOIN merged m ON m.old = w.taxid LEFT JOIN taxonomy t ON t.taxid = coalesce(m.new, w.taxid) LEFT JOIN deleted d ON d.taxid = coalesce(m.new, w.taxid)""")
def taxid_repair(spark, sf_dir):
    s, i = V.table(spark, sf_dir, "supplier"), V.table(spark, sf_dir, "lineitem")
    wanted = i.select((F.col("l_partkey") + 100_000).alias("taxid")).union(i.select(F.col("l_suppkey") + 200_000))
    merged = s.where("s_acctbal >= 0").select((F.col("s_suppkey") + 200_000).alias("old"), (F.col("s_suppkey") + 100_000).alias("new"))
    deleted = s.where("s_acctbal < 0").select((F.col("s_suppkey") + 200_000).alias("taxid"))
    return T.repair(wanted, V.taxonomy(spark, sf_dir), merged, deleted)


@query(f"""WITH RECURSIVE {CLOSED}, {COVER.replace("rn <= 1000", "rn <= 100000")}, rep AS (SELECT c.query, c.taxon, sum(pow(c.density / b.top, 3.0) * c.len) AS rep FROM cover c JOIN best b USING (query, start, taxon) GROUP BY ALL),
    up AS (SELECT query, taxon, rep, sum(rep) OVER (PARTITION BY query) AS total FROM rep),
    depth AS (SELECT taxid, max(hops) AS depth FROM closed GROUP BY 1),
    n AS (SELECT query, ancestor, sum(rep) AS rep, max(total) AS total, any_value(depth) AS depth FROM up JOIN closed ON taxid = taxon JOIN depth d ON d.taxid = ancestor GROUP BY query, ancestor),
    w AS (SELECT *, rep > (0.5 + (2 / 3 - 0.5) / log2(greatest(total, 2.718281828459045::DOUBLE))) * total AND ancestor <> 10 AS wins FROM n),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY wins DESC, depth DESC, round(rep, 9) DESC, ancestor) AS first, row_number() OVER (PARTITION BY query ORDER BY round(rep, 9) DESC, depth DESC, ancestor) AS second,
                 bool_or(wins) OVER (PARTITION BY query) AS any, count(*) OVER (PARTITION BY query) AS n FROM w)
    SELECT query, ancestor AS taxid, floor((rep) * 1e6 + 0.501) / 1e6 AS rep, CASE WHEN NOT "any" THEN 'noMajority' WHEN rep < 2 / 3 * total THEN 'noSupermajority' ELSE '' END AS flag FROM r WHERE CASE WHEN "any" THEN first = 1 ELSE second = least(2, n) END""")
def weighted_lca(spark, sf_dir):
    reps = H.representation(cover_of(spark, sf_dir, 100_000)).withColumnRenamed("taxon", "taxid")
    return T.weighted_lca(reps, T.closure(V.taxonomy(spark, sf_dir)), stop=10).select("query", "taxid", six("rep"), "flag")


@query(f"WITH RECURSIVE {CLOSED}, {GROUP_SQL}, {V.HITS} SELECT query, taxon, subject, bits FROM hits h WHERE EXISTS (SELECT 1 FROM grp g WHERE g.taxon = h.taxon AND g.\"group\" IN ('first', 'second'))")
def nonviral_antijoin(spark, sf_dir):
    other = groups_of(spark, sf_dir).where("group NOT IN ('first', 'second')")
    return V.hits(spark, sf_dir).join(other, "taxon", "left_anti").select("query", "taxon", "subject", "bits")


# alignments


@query(f"WITH {V.ALIGNMENTS} SELECT read, reference, pos, mismatch, size FROM (SELECT *, min(mismatch) OVER (PARTITION BY read) AS low FROM alignments) WHERE mismatch = low")
def best_hit_ties(spark, sf_dir):
    return A.best_hits(V.alignments(spark, sf_dir))


@query(f"WITH {V.ALIGNMENTS} SELECT read, reference, pos, mismatch, size FROM (SELECT *, row_number() OVER (PARTITION BY read, reference ORDER BY mismatch, pos, size DESC) AS rn FROM alignments) WHERE rn = 1")
def best_hsp(spark, sf_dir):
    return A.best_per_reference(V.alignments(spark, sf_dir))


@query(f"""WITH {V.ALIGNMENTS}, b AS (SELECT DISTINCT read, reference FROM (SELECT *, min(mismatch) OVER (PARTITION BY read) AS low FROM alignments) WHERE mismatch = low)
    SELECT reference, count(*) AS solo FROM (SELECT read, min(reference) AS reference FROM b GROUP BY read HAVING count(*) = 1) GROUP BY 1""")
def solo_reads(spark, sf_dir):
    return A.solo_reads(V.alignments(spark, sf_dir))


@query(f"WITH {V.ALIGNMENTS} SELECT reference, count(DISTINCT read) AS reads FROM alignments GROUP BY 1")
def ref_distinct_reads(spark, sf_dir):
    return V.alignments(spark, sf_dir).groupBy("reference").agg(F.countDistinct("read").alias("reads"))


@query(f"WITH {V.ALIGNMENTS}, p AS (SELECT reference, count(DISTINCT read) AS reads, count(*) AS hits FROM alignments GROUP BY 1) SELECT *, row_number() OVER (ORDER BY reads DESC, hits DESC, reference)::INT AS priority FROM p")
def centroid_order(spark, sf_dir):
    return A.centroid_order(V.alignments(spark, sf_dir))


@query("WITH p AS (SELECT DISTINCT o_custkey AS a, l_suppkey AS b FROM lineitem JOIN orders ON o_orderkey = l_orderkey) SELECT x.a, x.b FROM p x WHERE EXISTS (SELECT 1 FROM p y WHERE y.a = x.b AND y.b = x.a)")
def reciprocal_pairs(spark, sf_dir):
    """Customers and suppliers of one number that deal with each other both ways."""
    o = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("a"))
    p = V.table(spark, sf_dir, "lineitem").join(o, "l_orderkey").select("a", F.col("l_suppkey").alias("b")).distinct()
    return A.reciprocal(p, [("a", "b")])


PLACED = "placed AS (SELECT l_suppkey AS reference, (l_partkey // 5)::BIGINT AS pos, substr('ACGTD', (l_partkey % 5 + 1)::BIGINT, 1) AS base, l_quantity::BIGINT AS size FROM lineitem)"


def placed_of(spark, sf_dir):
    i = V.table(spark, sf_dir, "lineitem")
    return i.select(F.col("l_suppkey").alias("reference"), F.floor(F.col("l_partkey") / 5).alias("pos"), F.substring(F.lit("ACGTD"), (F.col("l_partkey") % 5 + 1).cast("int"), F.lit(1)).alias("base"), F.col("l_quantity").cast("long").alias("size"))


@query(f"""WITH {PLACED}, v AS (SELECT reference, pos, base, sum(size) AS votes FROM placed GROUP BY ALL),
    b AS (SELECT reference, pos, max(votes) AS top FROM v GROUP BY ALL),
    c AS (SELECT reference, pos, CASE WHEN count(*) > 1 THEN 'n' WHEN max(base) = 'D' THEN 'N' ELSE max(base) END AS letter FROM v JOIN b USING (reference, pos) WHERE votes = top GROUP BY ALL),
    g AS (SELECT *, pos - coalesce(lag(pos) OVER (PARTITION BY reference ORDER BY pos) + 1, pos) AS gap FROM c)
    SELECT reference, min(pos) AS start, string_agg(repeat('N', gap) || letter, '' ORDER BY pos) AS seq FROM g GROUP BY reference""")
def vote_consensus(spark, sf_dir):
    return A.consensus(A.votes(placed_of(spark, sf_dir)))


@query("SELECT user_id, floor((sum(value)) * 1e6 + 0.501) / 1e6 AS weight, count(*) AS rows FROM (SELECT DISTINCT user_id, event_type, value, ts FROM events) GROUP BY 1")
def abundance_quant(spark, sf_dir):
    return A.abundance(V.table(spark, sf_dir, "events"), ["user_id", "event_type", "value", "ts"], "user_id", "value").select("user_id", six("weight"), "rows")


@query("SELECT l_suppkey AS accession, l_orderkey AS read, coalesce(s_name, 'gi|NoNucHits|gb|' || l_suppkey) AS name FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 3 > 0")
def left_join_default_parent(spark, sf_dir):
    h = V.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("accession"), F.col("l_orderkey").alias("read"))
    p = V.table(spark, sf_dir, "supplier").where("s_suppkey % 3 > 0").select(F.col("s_suppkey").alias("accession"), F.col("s_name").alias("name"))
    return A.with_parents(h, p).select("accession", "read", "name")


# sets


@query("SELECT l_orderkey AS name, 'lineitem' AS input FROM lineitem UNION ALL SELECT o_orderkey, 'orders' FROM orders")
def union_inputs(spark, sf_dir):
    a = V.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("name"), F.lit("lineitem").alias("input"))
    return a.unionByName(V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("name"), F.lit("orders").alias("input")))


@query(f"WITH {V.HITS}, {V.TAXONOMY} SELECT DISTINCT taxon AS taxid FROM hits UNION SELECT taxid FROM taxonomy")
def distinct_taxids(spark, sf_dir):
    return V.hits(spark, sf_dir).select(F.col("taxon").alias("taxid")).union(V.taxonomy(spark, sf_dir).select("taxid")).distinct()


# order-dependent operators, tested against plain loops


@query()
def greedy_centroids(spark, sf_dir):
    return C.greedy_centroids(V.alignments(spark, sf_dir), stage)
