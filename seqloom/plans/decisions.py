"""The registered queries of the decision half: protein and nucleotide hits together, contest, floors, candidates, annotation.

Hits of one kind or the other by the line's flag; the target group is ``first``, ``third`` a suppressor. The SQL follows the
rules of the operators' docstrings, segment by segment.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators import decide as D
from seqloom.operators import hits as H
from seqloom.operators import taxonomy as T
from seqloom.plans import views as V
from seqloom.plans.catalogue import CASE_SELF, CLOSED, GROUP_SQL, groups_of, query, six
from seqloom.plans.stages import dealt, stage

TARGET, SUPPRESSORS, INFO = "first", ["third"], 60.0
#: Most hits of a query and kind that are looked at: by the filter, and by all that classifies.
MOST, CLASSIFIED = 1_000, 100_000


def rounded(x: str, name: str) -> str:
    return f"floor(({x}) * 1e6 + 0.501) / 1e6 AS {name}"


def dual(floor: float = 10.0, share: float = 0.1, most: int = MOST) -> str:
    return f"""{V.DUAL_HITS}, {V.SCAFFOLDS},
    dtop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query, kind ORDER BY {', '.join(V.HIT_ORDER)}) AS rn FROM dhits WHERE evalue <= 0.1) WHERE rn <= {most}),
    dcuts AS (SELECT query, qstart AS start FROM dtop UNION SELECT query, qend + 1 FROM dtop),
    dseg AS (SELECT * FROM (SELECT query, start, lead(start) OVER (PARTITION BY query ORDER BY start) - 1 AS stop FROM dcuts) WHERE stop IS NOT NULL),
    dcov AS (SELECT h.*, start, stop - start + 1 AS len, CASE WHEN kind = 'NUC' THEN least(bits / (qend - qstart + 1), {S.BITS_CAP!r}::DOUBLE) ELSE bits / (qend - qstart + 1) END AS density
             FROM dtop h JOIN dseg s ON s.query = h.query AND h.qstart <= s.start AND h.qend >= s.stop),
    db1 AS (SELECT query, kind, start, len, taxon, max(density) AS density FROM dcov GROUP BY ALL),
    db2 AS (SELECT *, max(density) OVER (PARTITION BY query, kind, start) AS top FROM db1),
    dbest AS (SELECT * FROM (SELECT *, max((density >= 0.9::DOUBLE * top)::INT) OVER (PARTITION BY query, kind, taxon) AS near FROM db2) WHERE near = 1),
    dacc0 AS (SELECT c.*, b.top FROM dcov c JOIN dbest b USING (query, kind, start, taxon)),
    dn AS (SELECT query, kind, start, len, count(*) AS n FROM dacc0 GROUP BY ALL),
    dn2 AS (SELECT *, sum(n * len) OVER (PARTITION BY query, kind)::DOUBLE / sum(len) OVER (PARTITION BY query, kind) AS mean FROM dn),
    dacc AS (SELECT a.*, d.n FROM dacc0 a JOIN dn2 d USING (query, kind, start) WHERE kind = 'NUC' OR mean < {floor} OR n > {share}::DOUBLE * mean),
    haa AS (SELECT DISTINCT query, start, 1 AS aa FROM dacc WHERE kind = 'AA'),
    ev AS (SELECT query, start, len, kind, taxon, max(density) AS density, sum(CASE WHEN kind = 'NUC' AND aa = 1 THEN pow(density / top, 3.0) ELSE pow(density / top, 27.0) / 3 END) AS rep
           FROM dacc LEFT JOIN haa USING (query, start) GROUP BY query, start, len, kind, taxon)"""


STATES = """kg AS (SELECT query, start, len, kind, "group", max(density) AS density, sum(rep) AS rep FROM ev JOIN grp USING (taxon) GROUP BY ALL),
    bg AS (SELECT * FROM (SELECT query, start, "group", sum(density) AS score, sum(rep) AS rep, any_value(length(regexp_replace(substr(seq, start, len), '[Nn]', '', 'g'))) AS known
           FROM kg JOIN scaf USING (query) GROUP BY query, start, "group") WHERE known > 0),
    wide AS (SELECT query, start, known, max(CASE WHEN "group" = 'first' THEN score END) AS own, max(score) AS best, max(CASE WHEN "group" = 'third' THEN score END) AS sup FROM bg GROUP BY ALL),
    states AS (SELECT *, CASE WHEN own IS NULL THEN 'bad' WHEN own / best >= 0.99::DOUBLE THEN 'good' WHEN own / sup >= 0.98::DOUBLE AND own / sup < 1 THEN 'rescued' ELSE 'lost' END AS state FROM wide)"""
LETTERS = """lh AS (SELECT query, sum(length(regexp_replace(substr(seq, start, len), '[^ACGT]', '', 'g'))) AS u, sum(length(regexp_replace(substr(seq, start, len), '[^acgt]', '', 'g'))) AS l
           FROM (SELECT DISTINCT query, start, len FROM ev) JOIN scaf USING (query) GROUP BY query),
    lt AS (SELECT query, length(regexp_replace(seq, '[Nn]', '', 'g'))::INT AS total, (length(regexp_replace(seq, '[^ACGT]', '', 'g')) - u)::BIGINT AS unaligned,
                  (length(regexp_replace(seq, '[^acgt]', '', 'g')) - l)::BIGINT AS loose FROM lh JOIN scaf USING (query))"""
SCORES = """sc AS (SELECT query, "group", taxon, sum(density * len) AS overall, sum(CASE WHEN kind = 'AA' THEN density * len ELSE 0 END) AS aa,
                  sum(CASE WHEN kind = 'NUC' THEN density * len ELSE 0 END) AS nuc FROM ev JOIN grp USING (taxon) GROUP BY ALL)"""
MAXIMA = f"""raised AS (SELECT DISTINCT query, kind, rn, qstart, qend, bits FROM (SELECT *, max(density) OVER (PARTITION BY query, kind, start ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM dcov) WHERE density > coalesce(b, 0)),
    part AS (SELECT * FROM (SELECT r.*, upper(substr(seq, qstart, qend - qstart + 1)) AS part FROM raised r JOIN scaf USING (query)) WHERE part <> ''),
    att AS (SELECT query, kind, rn, CASE WHEN kind = 'NUC'
                THEN least(({S.NUC_LAMBDA!r}::DOUBLE * (4 * length(replace(part, 'N', '')) - 2 * length(part)) - ln({S.NUC_K!r}::DOUBLE)) / 0.6931471805599453 / length(part), {S.BITS_CAP!r}::DOUBLE)
                ELSE greatest(({S.PROT_LAMBDA!r}::DOUBLE * coalesce(list_sum(list_transform(regexp_extract_all(part, '(...)'), lambda c: {CASE_SELF})), 0) - ln({S.PROT_K!r}::DOUBLE)) / 0.6931471805599453 / length(part), bits / (qend - qstart + 1)) END AS best FROM part),
    sb AS (SELECT query, kind, start, len, max(best) AS best FROM dcov JOIN att USING (query, kind, rn) GROUP BY ALL),
    so AS (SELECT query, sum(CASE WHEN kind = 'AA' THEN best * len ELSE 0 END) AS s_aa, sum(CASE WHEN kind = 'NUC' THEN best * len ELSE 0 END) AS s_nuc FROM sb GROUP BY query),
    mx AS (SELECT query, any_value(s_aa) AS s_aa, any_value(s_nuc) AS s_nuc, max(overall) AS top, max(aa) AS top_aa, max(nuc) AS top_nuc FROM sc LEFT JOIN so USING (query) GROUP BY query),
    tops AS (SELECT query, top, top_aa, top_nuc, greatest(coalesce(s_aa + s_nuc, 0), top) AS self_all, greatest(coalesce(s_aa, 0), top_aa) AS self_aa, greatest(coalesce(s_nuc, 0), top_nuc) AS self_nuc FROM mx)"""


def radius_sql(best: str, own: str, protein: bool) -> str:
    share = f"{best} / {own}"
    identity = f"({share})" if protein else f"((2 * {share} + 3) / 5)"
    base = 2 ** (1 / 3) / 40 if protein else math.e / (math.pi * math.sqrt(2)) / 10
    blur = f"(-ln({identity}) / (ln({best}) * log10({best})) + {base!r}::DOUBLE)"
    return f"CASE WHEN {best} > 1 THEN ({math.e!r}::DOUBLE / log10({best}) * {blur} - log10({identity}) / log10(100 * {blur}) * {blur}) * {best} ELSE 0 END"


LIMITS = f"""rad AS (SELECT *, {radius_sql('top_nuc', 'self_nuc', False)} AS r_nuc, {radius_sql('top_aa', 'self_aa', True)} AS r_aa FROM tops),
    lim AS (SELECT *, CASE WHEN r_nuc + r_aa >= 50 THEN r_nuc + r_aa ELSE 50 END AS radius, top - CASE WHEN r_nuc + r_aa >= 50 THEN r_nuc + r_aa ELSE 50 END AS lower,
                   top_nuc - CASE WHEN r_nuc + r_aa >= 50 THEN r_nuc ELSE 50 * top_nuc / (top_nuc + top_aa) END AS lower_nuc,
                   top_aa - CASE WHEN r_nuc + r_aa >= 50 THEN r_aa ELSE 50 * top_aa / (top_nuc + top_aa) END AS lower_aa FROM rad)"""
POOL = """pf AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(nuc, 9) DESC, taxon) = 1 AND nuc > 0 AS fn, row_number() OVER (PARTITION BY query ORDER BY round(aa, 9) DESC, taxon) = 1 AND aa > 0 AS fa FROM sc),
    pt AS (SELECT p.query, "group", taxon, overall, CASE WHEN fn OR fa OR (overall > lower AND nuc > 0 AND nuc > lower_nuc AND NOT (aa < lower_aa AND aa > 200)) THEN 1
                  WHEN overall > lower AND NOT (nuc > 0 AND nuc < lower_nuc) THEN 2 WHEN overall > lower THEN 3 END AS tier FROM pf p JOIN lim USING (query) WHERE "group" <> 'third'),
    pool AS (SELECT query, "group", taxon, overall FROM (SELECT *, min(tier) OVER (PARTITION BY query, "group") AS low FROM pt WHERE tier IS NOT NULL) WHERE tier = low)"""
FULL = f"WITH RECURSIVE {CLOSED}, {GROUP_SQL}, {dual(most=CLASSIFIED)}, {SCORES}, {MAXIMA}"


def hits_of(spark, sf_dir, most: int = MOST, n: int | None = None):
    """The ``most`` best hits of each query and kind, in ``n`` tasks. A limit of hits is a feature of the analysis."""
    best = [F.col(o.split()[0]).desc() if o.endswith("DESC") else F.col(o).asc() for o in V.HIT_ORDER]
    order = F.row_number().over(H.Window.partitionBy("query", "kind").orderBy(*best))
    return H.by_query(H.usable(V.dual_hits(spark, sf_dir)), n).withColumn("rn", order).where(F.col("rn") <= most)


def cover_of(spark, sf_dir, most: int = MOST, n: int | None = None):
    """The hits in their segments."""
    return D.covered(hits_of(spark, sf_dir, most, n))


def evidence_of(spark, sf_dir, most: int = MOST, often: bool = False):
    """Rows stay with their query. Written, in buckets by query, where it is used ``often``."""
    if not often:
        return D.evidence(D.supported(cover_of(spark, sf_dir, most)))
    n = H.tasks(H.usable(V.dual_hits(spark, sf_dir)))
    return dealt(D.evidence(D.supported(cover_of(spark, sf_dir, most, n))), "query", n)


def classified_of(spark, sf_dir, often: str = ""):
    """What classifies: the evidence, taxon scores, what is attainable, and maxima. Those named in ``often``, by their first letters
    (e, s, a, t), are used more than once and written in buckets by query; the others are worked out in the plan that uses them."""
    n = H.tasks(H.usable(V.dual_hits(spark, sf_dir)))
    held = lambda df, letter: dealt(df, "query", n) if letter in often else df
    hits = hits_of(spark, sf_dir, CLASSIFIED, n)
    ev = held(D.evidence(D.supported(D.covered(hits))), "e")
    scored = held(D.scores(ev, groups_of(spark, sf_dir)), "s")
    attain = held(D.attainable(hits, V.scaffolds(spark, sf_dir)), "a")
    return ev, scored, attain, held(D.maxima(scored, attain, TARGET), "t")


def pool_of(spark, sf_dir):
    """The candidates, of scores that are written once."""
    _, scored, _, tops = classified_of(spark, sf_dir, "s")
    return D.pool(scored, D.limits(tops), SUPPRESSORS)


@query(f"""WITH {dual()}, per AS (SELECT DISTINCT query, start, len, kind, top, n FROM dacc)
    SELECT query, start, len AS length, {rounded("max(CASE WHEN kind = 'AA' THEN top END)", "top_aa")}, max(CASE WHEN kind = 'AA' THEN n END) AS n_aa,
           {rounded("max(CASE WHEN kind = 'NUC' THEN top END)", "top_nuc")}, max(CASE WHEN kind = 'NUC' THEN n END) AS n_nuc FROM per GROUP BY query, start, len""")
def dual_segments(spark, sf_dir):
    return D.both_kinds(D.supported(cover_of(spark, sf_dir))).select("query", "start", "length", six("top_aa"), "n_aa", six("top_nuc"), "n_nuc")


@query(f"WITH {dual(1.2, 0.75)} SELECT DISTINCT query, kind, start, len AS length, n FROM dacc")
def aa_support_drop(spark, sf_dir):
    return D.supported(cover_of(spark, sf_dir), 1.2, 0.75).select("query", "kind", "start", "length", "n").distinct()


@query(f"WITH {dual()} SELECT query, kind, taxon, {rounded('sum(rep * len)', 'rep')}, {rounded('sum(density * len)', 'score')} FROM ev GROUP BY query, kind, taxon")
def rep_power_sum_dual(spark, sf_dir):
    sums = evidence_of(spark, sf_dir).groupBy("query", "kind", "taxon").agg(F.sum(F.col("rep") * F.col("length")).alias("rep"), F.sum(F.col("density") * F.col("length")).alias("score"))
    return sums.select("query", "kind", "taxon", six("rep"), six("score"))


@query(f"""WITH RECURSIVE {CLOSED}, {GROUP_SQL}, {dual()}, {STATES}, {LETTERS},
    per AS (SELECT query, sum(CASE WHEN state IN ('bad', 'lost') THEN known ELSE 0 END)::BIGINT AS bad, sum(CASE WHEN state = 'lost' THEN known ELSE 0 END)::BIGINT AS lost,
                   sum(CASE WHEN state = 'rescued' THEN known ELSE 0 END)::BIGINT AS rescued, sum(known) AS hit FROM states GROUP BY query),
    sums AS (SELECT query, "group", sum(CASE WHEN state = 'rescued' AND "group" = 'third' THEN 0 ELSE rep END * bg.known) AS rep, sum(bg.known) AS hit, sum(rep * bg.known) AS plain FROM bg JOIN states USING (query, start) GROUP BY query, "group"),
    val AS (SELECT *, CASE WHEN rep > 1e-12 THEN log10(rep) * hit ELSE 0 END AS value FROM sums),
    agg AS (SELECT query, coalesce(max(CASE WHEN "group" = 'first' THEN value END), 0) AS own, max(CASE WHEN "group" <> 'first' THEN value END) AS theirs,
                   arg_max("group", CASE WHEN "group" <> 'first' THEN (round(value, 9), "group") END) AS rival, sum(plain) AS plain FROM val GROUP BY query),
    t AS (SELECT query, total, bad, lost, rescued, unaligned, (own + plain / hit * unaligned) / total AS own_rep, theirs / total AS theirs, rival FROM per JOIN agg USING (query) JOIN lt USING (query)),
    u AS (SELECT *, theirs IS NULL OR round(own_rep, 9) >= round(theirs, 9) AS leads FROM t),
    v AS (SELECT *, CASE WHEN leads THEN own_rep ELSE theirs END AS best_rep, CASE WHEN leads THEN 'first' ELSE rival END AS best_group FROM u)
    SELECT query, total, bad, lost, rescued, unaligned, {rounded('own_rep', 'own_rep')}, {rounded('best_rep', 'best_rep')}, best_group,
           CASE WHEN NOT (2 * bad > total OR best_rep = 0 OR NOT leads) THEN 'KEPT' WHEN best_group = 'third' AND own_rep > 0.5 * best_rep THEN 'RECOVERED' ELSE 'FILTERED' END AS status FROM v""")
def group_contest(spark, sf_dir):
    told = D.contest(evidence_of(spark, sf_dir, often=True), groups_of(spark, sf_dir), V.scaffolds(spark, sf_dir), TARGET, SUPPRESSORS)
    return told.select("query", "total", "bad", "lost", "rescued", "unaligned", six("own_rep"), six("best_rep"), "best_group", "status")


@query(f"""WITH RECURSIVE {CLOSED}, {GROUP_SQL}, {dual()}, {STATES}
    SELECT b.query, b."group", sum(b.known)::BIGINT AS failed, {rounded('sum(s.own / b.score * b.known) / sum(b.known)', 'mean_ratio')}
    FROM bg b JOIN states s USING (query, start) WHERE s.state IN ('lost', 'rescued') AND b."group" <> 'first' GROUP BY b.query, b."group\"""")
def contest_rescue_stats(spark, sf_dir):
    told = D.rescue_stats(evidence_of(spark, sf_dir), groups_of(spark, sf_dir), V.scaffolds(spark, sf_dir), TARGET, SUPPRESSORS)
    return told.select("query", "group", "failed", six("mean_ratio"))


@query(f"{FULL}, {LIMITS} SELECT query, {', '.join(rounded(c, c) for c in ('top', 'self_all', 'radius', 'lower', 'lower_nuc', 'lower_aa'))} FROM lim")
def lca_radius(spark, sf_dir):
    return D.limits(classified_of(spark, sf_dir)[3]).select("query", *map(six, ("top", "self_all", "radius", "lower", "lower_nuc", "lower_aa")))


@query(f"""{FULL}, {LIMITS}, {POOL} SELECT query, "group", taxon, {rounded('overall', 'overall')} FROM pool""")
def candidate_pool(spark, sf_dir):
    return pool_of(spark, sf_dir).select("query", "group", "taxon", six("overall"))


WEIGHTS = """raw AS (SELECT query, taxon, sum(CASE WHEN kind = 'AA' THEN rep * len ELSE 0 END) AS aa_, sum(CASE WHEN kind = 'NUC' THEN rep * len ELSE 0 END) AS nuc_ FROM ev GROUP BY ALL),
    rs AS (SELECT query, taxon, aa_ / total AS ra, nuc_ / total AS rn, round(top_aa / nullif(self_aa, 0), 9) AS acc_aa, round(CASE WHEN top_nuc > 0 THEN (2 * top_nuc / self_nuc + 3) / 5 ELSE 0 END, 9) AS acc_nuc
           FROM pool JOIN raw USING (query, taxon) JOIN tops USING (query) JOIN lt USING (query)),
    rl AS (SELECT *, least(1, coalesce(min(CASE WHEN ra > 0 THEN ra END) OVER (PARTITION BY query), 1)) AS la, least(1, coalesce(min(CASE WHEN rn > 0 THEN rn END) OVER (PARTITION BY query), 1)) AS ln_, coalesce(acc_aa, 0) AS aa FROM rs),
    wt AS (SELECT query, taxon, CASE WHEN aa = 1 OR ra = 0 THEN ra ELSE pow(ra / la, pow(aa, 10)) END + CASE WHEN acc_nuc = 1 OR rn = 0 THEN rn ELSE pow(rn / ln_, pow(acc_nuc, 10)) END AS rep FROM rl)"""


@query(f"""{FULL}, {LIMITS}, {POOL}, {LETTERS}, {WEIGHTS} SELECT query, taxon, {rounded("rep / sum(rep) OVER (PARTITION BY query)", 'share')} FROM wt""")
def pool_weights(spark, sf_dir):
    told = D.pool_weights(pool_of(spark, sf_dir), V.scaffolds(spark, sf_dir))
    return told.withColumn("share", F.col("rep") / F.sum("rep").over(H.Window.partitionBy("query"))).select("query", "taxon", six("share"))


@query(f"""{FULL}, {LETTERS}, own AS (SELECT query, max(overall) AS t FROM sc WHERE "group" = 'first' GROUP BY query),
    f AS (SELECT query, coalesce(t, 0) AS target_top, coalesce(t, 0) < {INFO} AND self_all < 1.25 * {INFO} AS low_info, coalesce(t, 0) < 0.9::DOUBLE * top AS low_presence, unaligned > 0.8::DOUBLE * (total - loose) AS low_hit
          FROM tops LEFT JOIN own USING (query) JOIN lt USING (query))
    SELECT query, {rounded('target_top', 'target_top')}, low_info, low_presence, low_hit, NOT (low_info OR low_presence OR low_hit) AS passes FROM f""")
def decision_floors(spark, sf_dir):
    ev, _, _, tops = classified_of(spark, sf_dir, "e")
    told = D.floors(tops, D.letters(ev, V.scaffolds(spark, sf_dir)), INFO)
    return told.select("query", six("target_top"), "low_info", "low_presence", "low_hit", "passes")


ANNOTATED = """kg AS (SELECT query, start, len, kind, "group", max(density) AS density FROM ev JOIN grp USING (taxon) GROUP BY ALL),
    gb AS (SELECT query, "group", floor(sum(CASE WHEN kind = 'AA' THEN density * len ELSE 0 END) + 1e-9)::BIGINT AS aa, floor(sum(CASE WHEN kind = 'NUC' THEN density * len ELSE 0 END) + 1e-9)::BIGINT AS nuc FROM kg GROUP BY ALL),
    a AS (SELECT query, coalesce(max(CASE WHEN "group" = 'first' THEN aa + nuc END), 0) AS max_score, coalesce(max(CASE WHEN "group" = 'first' THEN aa END), 0) AS prot_score, coalesce(max(CASE WHEN "group" = 'first' THEN nuc END), 0) AS nucl_score,
                 floor(greatest(max(self_all), max(aa + nuc)) + 1e-9)::BIGINT AS max_align, coalesce(string_agg(CASE WHEN "group" <> 'first' AND aa + nuc >= 0.86::DOUBLE * top THEN "group" || '=' || (aa + nuc) END, ',' ORDER BY "group"), '') AS high
          FROM gb JOIN tops USING (query) GROUP BY query)"""


@query(f"""{FULL}, {ANNOTATED}
    SELECT query, max_score, prot_score, nucl_score, max_align, max_score < 1000 AS weak, max_score > 0 AND max_score < 0.8::DOUBLE * max_align AS high_divergence, high FROM a""")
def final_annotation(spark, sf_dir):
    ev, _, _, tops = classified_of(spark, sf_dir, "e")
    return D.annotation(ev, groups_of(spark, sf_dir), tops, TARGET)


ENOUGH = 60
NAMES = """nm AS (SELECT o_orderkey AS query, o_orderstatus = 'P' AS mixed, t AS taxid, CASE WHEN o_orderstatus = 'P' THEN 'contig_' ELSE 'ref_' END || o_orderkey || ';taxId=' || t AS name
    FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) + 100000 AS t FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""


def names_of(spark, sf_dir):
    """Headers of the scaffolds; those of orders in part are contigs, and the least of their hits' taxa is the first guess."""
    first = V.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("query")).agg((F.min("l_suppkey") + 100_000).alias("taxid"))
    rows = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("query"), (F.col("o_orderstatus") == "P").alias("mixed")).join(first, "query")
    name = F.concat(F.when(F.col("mixed"), "contig_").otherwise("ref_"), F.col("query").cast("string"), F.lit(";taxId="), F.col("taxid").cast("string"))
    return rows.withColumn("name", name)


@query(f"""{FULL}, {LIMITS}, {POOL}, {LETTERS}, {WEIGHTS}, {ANNOTATED}, {NAMES}, white AS (SELECT s_suppkey + 100000 AS taxid FROM supplier WHERE s_acctbal > 9000),
    up AS (SELECT query, taxon, rep, sum(rep) OVER (PARTITION BY query) AS total FROM wt), depth AS (SELECT taxid, max(hops) AS depth FROM closed GROUP BY 1),
    n AS (SELECT query, ancestor, sum(rep) AS rep, max(total) AS total, any_value(depth) AS depth FROM up JOIN closed ON taxid = taxon JOIN depth d ON d.taxid = ancestor GROUP BY query, ancestor),
    w AS (SELECT *, rep > (0.5 + (2 / 3 - 0.5) / log2(greatest(total, 2.718281828459045::DOUBLE))) * total AND ancestor <> 10 AS wins FROM n),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY wins DESC, depth DESC, round(rep, 9) DESC, ancestor) AS first, row_number() OVER (PARTITION BY query ORDER BY round(rep, 9) DESC, depth DESC, ancestor) AS second,
                 bool_or(wins) OVER (PARTITION BY query) AS any, count(*) OVER (PARTITION BY query) AS n FROM w),
    lca AS (SELECT query, ancestor AS found, CASE WHEN NOT "any" THEN 'noMajority' WHEN rep < 2 / 3 * total THEN 'noSupermajority' ELSE '' END AS flag FROM r WHERE CASE WHEN "any" THEN first = 1 ELSE second = least(2, n) END),
    md AS (SELECT query, (sum(CASE WHEN kind = 'AA' THEN best * len END) / sum(CASE WHEN kind = 'AA' THEN len END)) AS m_aa, (sum(CASE WHEN kind = 'NUC' THEN best * len END) / sum(CASE WHEN kind = 'NUC' THEN len END)) AS m_nuc FROM sb GROUP BY query),
    h1 AS (SELECT a.*, nm.name, nm.mixed, nm.taxid AS orig, found, coalesce(flag, '') AS flag0, self_aa, self_nuc, total, length(seq) AS size, unaligned + loose AS unhit, (unaligned + loose) * (coalesce(m_aa, 0) + coalesce(m_nuc, 0)) AS more, white.taxid IS NOT NULL AS white
           FROM a JOIN nm USING (query) JOIN tops USING (query) JOIN lt USING (query) JOIN scaf USING (query) LEFT JOIN md USING (query) LEFT JOIN lca USING (query) LEFT JOIN white ON white.taxid = nm.taxid),
    h2 AS (SELECT *, mixed AND unhit > {D.UNKNOWN}::DOUBLE * total AND total > {ENOUGH} AS unknown, greatest(floor(max_align + more + 1e-9)::BIGINT, max_score) AS most, (20000 * total + size) // (2 * size) AS hd FROM h1),
    h3 AS (SELECT *, CASE WHEN white OR unknown THEN orig ELSE coalesce(found, orig) END AS taxid, CASE WHEN white OR unknown THEN '' ELSE flag0 END AS flag FROM h2)
    SELECT query, h3.taxid AS taxid, regexp_replace(name, 'taxId=.*', '') || 'taxId=' || h3.taxid || CASE WHEN h3.taxid <> orig THEN ';origTaxId=' || orig ELSE '' END || ';maxScore=' || max_score::BIGINT || ';maxAlign=' || max_align || ';maxPossibleScore=' || most::BIGINT || ';protScore=' || prot_score::BIGINT
        || ';maxProtAlign=' || floor(self_aa + 1e-9)::BIGINT || ';nuclScore=' || nucl_score::BIGINT || ';maxNuclAlign=' || floor(self_nuc + 1e-9)::BIGINT || ';letterOccupancy=' || (hd // 100) || '.' || lpad((hd % 100)::VARCHAR, 2, '0')
        || CASE WHEN max_score < 1000 THEN ';weak=1' ELSE '' END || CASE WHEN NOT unknown AND max_score > 0 AND max_score < 0.8::DOUBLE * most THEN ';highDivergence=1' ELSE '' END
        || CASE WHEN unknown THEN ';highUnknownInformation=1' ELSE list_aggregate(list_transform(list_filter(string_split(high, ','), lambda x: x <> ''), lambda x: ';high' || upper(x[1]) || x[2:]) || [''], 'string_agg', '') END
        || CASE WHEN flag <> '' THEN ';potentialMisannotations=' || flag ELSE '' END || CASE WHEN white THEN ';whiteListed=1' ELSE '' END AS header
    FROM h3 WHERE white OR unknown OR h3.taxid IN (SELECT taxid FROM closed WHERE ancestor = 10)""")
def result_headers(spark, sf_dir):
    """The whole header of every scaffold that is reported, with its taxon as resolved."""
    ev, scored, attain, tops = classified_of(spark, sf_dir, "esat")
    scaffolds = V.scaffolds(spark, sf_dir)
    lettered = stage(D.letters(ev, scaffolds))
    closed = stage(T.closure(V.taxonomy(spark, sf_dir)))
    weights = D.pool_weights(D.pool(scored, D.limits(tops), SUPPRESSORS), scaffolds).select("query", F.col("taxon").alias("taxid"), "rep")
    resolved = T.weighted_lca(weights, closed, stop=10)
    listed = V.table(spark, sf_dir, "supplier").where("s_acctbal > 9000").select((F.col("s_suppkey") + 100_000).alias("taxid"))
    inside = closed.where("ancestor = 10").select("taxid")
    told = D.annotation(ev, groups_of(spark, sf_dir), tops, TARGET)
    return D.headers(told, tops, D.possible(attain, lettered), lettered, resolved, names_of(spark, sf_dir), listed, inside, scaffolds, ENOUGH)


@query(f"""WITH RECURSIVE {CLOSED}, {GROUP_SQL}, {dual()}, {SCORES} SELECT query, "group", place::INT AS place, taxon, {rounded('overall', 'overall')}
    FROM (SELECT *, row_number() OVER (PARTITION BY query, "group" ORDER BY round(overall, 9) DESC, taxon) AS place FROM sc) WHERE place <= 10""")
def group_top10(spark, sf_dir):
    return D.best_of_group(D.scores(evidence_of(spark, sf_dir), groups_of(spark, sf_dir))).select("query", "group", "place", "taxon", six("overall"))


@query(f"""WITH RECURSIVE {CLOSED}, listed AS (SELECT n_nationkey + 1000 AS taxid FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING avg(c_acctbal) > 4500) UNION SELECT 11)
    SELECT DISTINCT taxid FROM taxonomy WHERE taxid IN (SELECT c.taxid FROM closed c JOIN listed l ON l.taxid = c.ancestor)""")
def whitelist_taxa(spark, sf_dir):
    t = V.taxonomy(spark, sf_dir)
    rich = V.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("mean")).where("mean > 4500")
    listed = rich.select((F.col("c_nationkey") + 1000).cast("long").alias("taxid")).union(V.table(spark, sf_dir, "region").where("r_regionkey = 1").select((F.col("r_regionkey") + 10).cast("long")))
    return D.within(T.closure(t), t.select("taxid").distinct(), listed)


@query(f"""WITH RECURSIVE {CLOSED}, {V.HITS}, m AS (SELECT c.taxid, r.hops AS room FROM closed c JOIN closed r ON r.taxid = c.taxid AND r.ancestor = 11 WHERE c.hops = 0),
    k AS (SELECT m.taxid, least(min(c.hops) + 1, any_value(room)) AS hops FROM m JOIN closed c USING (taxid) JOIN taxonomy t ON t.taxid = c.ancestor AND t.rank = 'species' GROUP BY m.taxid),
    tg AS (SELECT DISTINCT c.taxid, coalesce(d.ancestor, c.taxid) AS target FROM closed c LEFT JOIN k ON k.taxid = c.taxid LEFT JOIN closed d ON d.taxid = c.taxid AND d.hops = k.hops)
    SELECT query, coalesce(target, taxon) AS taxon, qstart, qend, bits, subject FROM hits LEFT JOIN tg ON taxid = taxon""")
def hits_corrected(spark, sf_dir):
    t = V.taxonomy(spark, sf_dir)
    return D.mapped(V.hits(spark, sf_dir), T.collapse(t, T.closure(t), {11: 1})).select("query", "taxon", "qstart", "qend", "bits", "subject")


@query(f"""WITH {dual()}, t AS (SELECT query, start, len, kind, max(density) AS top, sum(rep) AS rep FROM ev GROUP BY ALL), u AS (SELECT query, start, len, sum(top) AS top, sum(rep) AS rep FROM t GROUP BY ALL)
    SELECT query, sum(len)::BIGINT AS hit, {rounded('sum(top * len) / sum(len)', 'density')}, {rounded('sum(rep * len) / sum(len)', 'rep')} FROM u GROUP BY query""")
def hit_density(spark, sf_dir):
    return D.densities(evidence_of(spark, sf_dir)).select("query", "hit", six("density"), six("rep"))
