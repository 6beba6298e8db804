"""The decision half of the classifier: protein and nucleotide hits together, the contest of taxon groups, floors, the
radius of candidates, the pool and the final annotation.

Hits have query, kind (AA or NUC), taxon, qstart, qend, bits and rn (their order within query and kind). As in ``hits``, nothing
is expanded to single positions: both kinds are cut at the same places, and sums are sums over segments times their length,
or times the known letters of the scaffold in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators.hits import cut, near_top, radius_bits
from seqloom.plans.stages import lookup

SEGMENT = ["query", "start", "length"]
#: Powers of the two kinds, the ratio below which a position is lost, and the least ratio to a suppressor that rescues.
SCALE_AA, SCALE_NUC, LOSE, RESCUE = 3.0, 1.0, 0.99, 0.98
#: Least radius in bits; share of the best score at which another group is worth a remark; least score and
#: share of the possible score of a result that is neither weak nor far from all references.
LEAST_RADIUS, WORRY, WEAK, DIVERGED = 50.0, 0.86, 1000, 0.8
#: Share of letters without hits above which a scaffold of over so many letters is of unknown information.
UNKNOWN, UNKNOWN_LETTERS = 0.8, 500


def covered(hits: DataFrame) -> DataFrame:
    """Every hit in every segment that it covers, of the cuts of both kinds: density is at most a perfect alignment's for
    nucleotides."""
    span = F.col("qend") - F.col("qstart") + 1
    return cut(hits.withColumn("density", F.when(F.col("kind") == "NUC", S.bits_per_base("bits", span)).otherwise(F.col("bits") / span)))


def supported(cover: DataFrame, floor: float = 10.0, share: float = 0.1) -> DataFrame:
    """Hits of good taxa in their segments, with the segment's top and hits (n). Protein segments go whose hits are at most
    ``share`` of the query's mean over positions, where that mean is ``floor`` or more."""
    segment, molecule = Window.partitionBy("query", "kind", "start"), Window.partitionBy("query", "kind")
    # a segment's length counts once for the letters, and once a hit for the hits over them
    every = near_top(cover, "kind").withColumn("_first", F.row_number().over(segment.orderBy("start")) == 1).withColumn("n", F.count("*").over(segment))
    mean = F.sum("length").over(molecule) / F.sum(F.when(F.col("_first"), F.col("length"))).over(molecule)
    stay = (F.col("kind") == "NUC") | (F.col("_mean") < floor) | (F.col("n") > share * F.col("_mean"))
    return every.withColumn("_mean", mean).where(stay).drop("_first", "_mean")


def evidence(accepted: DataFrame) -> DataFrame:
    """query, start, length, kind, taxon, density (the taxon's best), rep: sum of (density / top) ^ (3 ^ scale) / scale of its
    hits. The scale is that of proteins also for nucleotides in segments without protein hits."""
    aa = F.max(F.col("kind") == "AA").over(Window.partitionBy("query", "start"))
    scale = F.when((F.col("kind") == "NUC") & F.col("_aa"), F.lit(SCALE_NUC)).otherwise(F.lit(SCALE_AA))
    power = F.pow(F.col("density") / F.col("top"), F.pow(F.lit(3.0), scale)) / scale
    return accepted.withColumn("_aa", aa).groupBy(*SEGMENT, "kind", "taxon").agg(F.max("density").alias("density"), F.sum(power).alias("rep"))


def both_kinds(accepted: DataFrame) -> DataFrame:
    """query, start, length, top_aa, n_aa, top_nuc, n_nuc: protein and nucleotide segments side by side, null where one has none."""
    of = lambda k, c, name: F.max(F.when(F.col("kind") == k, F.col(c))).alias(name)
    return accepted.groupBy(*SEGMENT).agg(of("AA", "top", "top_aa"), of("AA", "n", "n_aa"), of("NUC", "top", "top_nuc"), of("NUC", "n", "n_nuc"))


def perfect(hits: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """Hits with best, the density of a perfect alignment to the letters under each; null where there are none. ``scaffolds``: query, seq."""
    span = F.col("qend") - F.col("qstart") + 1
    seen = hits.join(scaffolds, "query").withColumn("_part", F.upper(F.substring("seq", F.col("qstart").cast("int"), span.cast("int"))))
    nuc = F.least(S.raw_to_bits(S.nucleotide_self_score("_part").cast("double")) / F.length("_part"), F.lit(S.BITS_CAP))
    aa = F.greatest(S.raw_to_bits(S.codon_self_score("_part").cast("double"), True) / F.length("_part"), F.col("bits") / span)
    best = F.when(F.col("_part") == "", None).when(F.col("_part").isNotNull(), F.when(F.col("kind") == "NUC", nuc).otherwise(aa))
    return seen.select(*hits.columns, best.alias("best"))


def attainable(hits: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """query, kind, start, length, best: what a perfect alignment would have a position, of the hits that raised the running
    best somewhere (in order rn). ``scaffolds``: query, seq. A hit meets its scaffold once, before it is cut."""
    cover = covered(perfect(hits, scaffolds))
    before = Window.partitionBy("query", "kind", "start").orderBy("rn").rowsBetween(Window.unboundedPreceding, -1)
    raised = F.col("density") > F.coalesce(F.max("density").over(before), F.lit(0.0))
    counts = F.max("_raised").over(Window.partitionBy("query", "kind", "rn"))
    seen = cover.withColumn("_raised", raised).withColumn("_raised", counts).where("_raised AND best IS NOT NULL")
    return seen.groupBy("query", "kind", "start", "length").agg(F.max("best").alias("best"))


def letters(found: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """Per query: total known letters, unaligned ones in upper case, and lower-case ones without hits; ``found`` has the segments."""
    count = lambda c, pattern: F.length(F.regexp_replace(c, pattern, ""))
    part = F.substring("seq", F.col("start").cast("int"), F.col("length").cast("int"))
    held = found.select(*SEGMENT).distinct().join(scaffolds, "query").groupBy("query", "seq").agg(F.sum(count(part, "[^ACGT]")).alias("upper"), F.sum(count(part, "[^acgt]")).alias("lower"))
    return held.select("query", count("seq", "[Nn]").alias("total"), (count("seq", "[^ACGT]") - F.col("upper")).alias("unaligned"), (count("seq", "[^acgt]") - F.col("lower")).alias("loose"))


def known(found: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """Segments with known, the letters of the scaffold in them that are not N."""
    part = F.substring("seq", F.col("start").cast("int"), F.col("length").cast("int"))
    return found.join(scaffolds, "query").withColumn("known", F.length(F.regexp_replace(part, "[Nn]", ""))).drop("seq")


def positions(ev: DataFrame, groups: DataFrame, scaffolds: DataFrame, target: str, suppressors: list[str]) -> DataFrame:
    """The contest segment by segment: query, start, known, group, rep, score, own, best, suppress (scores of the target, the best
    group and the best suppressor there), state (good, bad, lost or rescued) and first, which marks one row of a segment."""
    kinds = lookup(ev, groups, "taxon").groupBy(*SEGMENT, "kind", "group").agg(F.max("density").alias("density"), F.sum("rep").alias("rep"))
    by_group = known(kinds.groupBy(*SEGMENT, "group").agg(F.sum("density").alias("score"), F.sum("rep").alias("rep")), scaffolds).where("known > 0").drop("length")
    segment = Window.partitionBy("query", "start")
    of = lambda test: F.max(F.when(test, F.col("score"))).over(segment)
    wide = by_group.withColumn("first", F.row_number().over(segment.orderBy("group")) == 1)
    wide = wide.withColumns({"own": of(F.col("group") == target), "best": F.max("score").over(segment), "suppress": of(F.col("group").isin(*suppressors))})
    ratio, saved = F.col("own") / F.col("best"), F.col("own") / F.col("suppress")
    state = F.when(F.col("own").isNull(), "bad").when(ratio >= LOSE, "good").when((saved >= RESCUE) & (saved < 1), "rescued").otherwise("lost")
    return wide.withColumn("state", state)


def contest(ev: DataFrame, groups: DataFrame, scaffolds: DataFrame, target: str, suppressors: list[str]) -> DataFrame:
    """query, total, bad, lost, rescued, unaligned, own_rep, best_rep, best_group, status: KEPT, RECOVERED (a suppressor is best
    and the target above half of it) or FILTERED (over half of the letters bad, no representation, or another group's is
    larger). A group's representation is the log of its sum times the letters it hits, by the letters of the scaffold;
    a rescued position takes the suppressors' share away, and unaligned letters count for the target at the mean."""
    rows = positions(ev, groups, scaffolds, target, suppressors)
    freed = (F.col("state") == "rescued") & F.col("group").isin(*suppressors)
    counted = lambda *which: F.sum(F.when(F.col("first") & F.col("state").isin(*which), F.col("known")).otherwise(0))
    sums = rows.groupBy("query", "group").agg(
        F.sum(F.when(freed, 0.0).otherwise(F.col("rep")) * F.col("known")).alias("rep"), F.sum("known").alias("hit"), F.sum(F.col("rep") * F.col("known")).alias("all_rep"),
        counted("bad", "lost").alias("bad"), counted("lost").alias("lost"), counted("rescued").alias("rescued"), F.sum(F.when(F.col("first"), F.col("known")).otherwise(0)).alias("once"),
    )
    value = F.when(F.col("rep") > 1e-12, F.log10("rep") * F.col("hit")).otherwise(0.0)
    own = lambda x: F.max(F.when(F.col("group") == target, x))
    ranked = sums.withColumn("value", value).groupBy("query").agg(
        F.coalesce(own(F.col("value")), F.lit(0.0)).alias("own"), F.max(F.when(F.col("group") != target, F.col("value"))).alias("theirs"),
        F.max_by("group", F.when(F.col("group") != target, F.struct(F.round("value", 9), F.col("group")))).alias("rival"),
        *[F.sum(c).alias(c) for c in ("all_rep", "bad", "lost", "rescued")], F.sum("once").alias("hit"),
    )
    told = ranked.join(letters(ev, scaffolds), "query").withColumn("own_rep", (F.col("own") + F.col("all_rep") / F.col("hit") * F.col("unaligned")) / F.col("total")).withColumn("theirs", F.col("theirs") / F.col("total"))
    leads = F.col("theirs").isNull() | (F.round("own_rep", 9) >= F.round("theirs", 9))
    told = told.withColumn("best_rep", F.when(leads, F.col("own_rep")).otherwise(F.col("theirs"))).withColumn("best_group", F.when(leads, target).otherwise(F.col("rival")))
    fails = (2 * F.col("bad") > F.col("total")) | (F.col("best_rep") == 0) | ~leads
    status = F.when(~fails, "KEPT").when(F.col("best_group").isin(*suppressors) & (F.col("own_rep") > 0.5 * F.col("best_rep")), "RECOVERED").otherwise("FILTERED")
    return told.select("query", "total", "bad", "lost", "rescued", "unaligned", "own_rep", "best_rep", "best_group", status.alias("status"))


def rescue_stats(ev: DataFrame, groups: DataFrame, scaffolds: DataFrame, target: str, suppressors: list[str]) -> DataFrame:
    """query, group, failed (letters on which the target falls behind the best and the group is present), mean_ratio (of the
    target to the group there)."""
    rows = positions(ev, groups, scaffolds, target, suppressors).where((F.col("group") != target) & F.col("state").isin("lost", "rescued"))
    return rows.groupBy("query", "group").agg(F.sum("known").alias("failed"), (F.sum(F.col("own") / F.col("score") * F.col("known")) / F.sum("known")).alias("mean_ratio"))


def scores(ev: DataFrame, groups: DataFrame) -> DataFrame:
    """query, group, taxon, overall, aa, nuc: best densities over positions, of both kinds and each (0 where none); aa_, nuc_: the
    representation by each kind."""
    of = lambda k, c: F.sum(F.when(F.col("kind") == k, F.col(c) * F.col("length")).otherwise(0.0))
    return lookup(ev, groups, "taxon").groupBy("query", "group", "taxon").agg(
        F.sum(F.col("density") * F.col("length")).alias("overall"), of("AA", "density").alias("aa"), of("NUC", "density").alias("nuc"), of("AA", "rep").alias("aa_"), of("NUC", "rep").alias("nuc_")
    )


TOPS = ["top", "top_aa", "top_nuc", "self_all", "self_aa", "self_nuc"]


def maxima(scored: DataFrame, best: DataFrame, target: str | None = None) -> DataFrame:
    """query, top, top_aa, top_nuc, self_all, self_aa, self_nuc: best taxon scores and what perfect alignments would attain,
    the latter no less than the former. With ``target`` also target_top, that group's best."""
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("best") * F.col("length")).otherwise(0.0))
    own = best.groupBy("query").agg(of("AA").alias("s_aa"), of("NUC").alias("s_nuc"))
    theirs = [] if target is None else [F.coalesce(F.max(F.when(F.col("group") == target, F.col("overall"))), F.lit(0.0)).alias("target_top")]
    tops = scored.groupBy("query").agg(F.max("overall").alias("top"), F.max("aa").alias("top_aa"), F.max("nuc").alias("top_nuc"), *theirs)
    part = lambda c: F.coalesce(c, F.lit(0.0))
    most = [F.greatest(part(F.col("s_aa") + F.col("s_nuc")), "top").alias("self_all"), F.greatest(part("s_aa"), "top_aa").alias("self_aa"), F.greatest(part("s_nuc"), "top_nuc").alias("self_nuc")]
    return tops.join(own, "query", "left").select(*tops.columns, *most)


def limits(tops: DataFrame) -> DataFrame:
    """Adds radius, lower, lower_nuc and lower_aa to rows with TOPS: a taxon stays a candidate above them. A radius below
    LEAST_RADIUS is brought to it, in the shares of the two best scores."""
    side = lambda name, protein: F.when(F.col(f"top_{name}") > 0, F.coalesce(radius_bits(f"top_{name}", f"self_{name}", protein), F.lit(0.0))).otherwise(0.0)
    rows = tops.withColumns({"r_nuc": side("nuc", False), "r_aa": side("aa", True)}).withColumn("wide", F.col("r_nuc") + F.col("r_aa") >= LEAST_RADIUS)
    share = lambda name: LEAST_RADIUS * F.col(f"top_{name}") / (F.col("top_nuc") + F.col("top_aa"))
    r = lambda name: F.when(F.col("wide"), F.col(f"r_{name}")).otherwise(share(name))
    radius = F.when(F.col("wide"), F.col("r_nuc") + F.col("r_aa")).otherwise(LEAST_RADIUS)
    return rows.select(*tops.columns, radius.alias("radius"), (F.col("top") - radius).alias("lower"), (F.col("top_nuc") - r("nuc")).alias("lower_nuc"), (F.col("top_aa") - r("aa")).alias("lower_aa"))


def pool(scored: DataFrame, bounds: DataFrame, suppressors: list[str] = ()) -> DataFrame:
    """The rows of taxa that stay candidates, of ``scores`` with the ``limits`` of their query (``bounds``, a row a query).

    Of three tiers, a group takes the first that is not empty: the query's best taxa by nuc and by aa, and those above both
    limits whose protein evidence does not speak against them; those above the overall limit without weak nuc; those
    above the overall limit. Suppressors have no candidates. Of equal best taxa, the smallest counts."""
    best = lambda c: (F.row_number().over(Window.partitionBy("query").orderBy(F.round(c, 9).desc(), "taxon")) == 1) & (F.col(c) > 0)
    bounded = scored.join(bounds, "query")
    rows = bounded.withColumns({"first_nuc": best("nuc"), "first_aa": best("aa")})
    above = F.col("overall") > F.col("lower")
    strong = above & (F.col("nuc") > 0) & (F.col("nuc") > F.col("lower_nuc")) & ~((F.col("aa") < F.col("lower_aa")) & (F.col("aa") > 200))
    second = above & ~((F.col("nuc") > 0) & (F.col("nuc") < F.col("lower_nuc")))
    tier = F.when(F.col("first_nuc") | F.col("first_aa") | strong, 1).when(second, 2).when(above, 3)
    placed = rows.withColumn("tier", tier).where("tier IS NOT NULL")
    if suppressors:
        placed = placed.where(~F.col("group").isin(*suppressors))
    lowest = F.min("tier").over(Window.partitionBy("query", "group"))
    return placed.withColumn("lowest", lowest).where("tier = lowest").select(*bounded.columns)


def pool_weights(candidates: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """query, taxon, rep: candidates' representation by the letters of the scaffold, scaled by the accuracy of each kind (to nine
    places, as a perfect one is a case of its own). ``candidates`` is ``pool``'s."""
    total = F.length(F.regexp_replace("seq", "[Nn]", "")).alias("total")
    rows = candidates.select("query", "taxon", "aa_", "nuc_", *TOPS).join(scaffolds.select("query", total), "query")
    rows = rows.withColumns({"rep_aa": F.col("aa_") / F.col("total"), "rep_nuc": F.col("nuc_") / F.col("total")})
    least = lambda c: F.least(F.lit(1.0), F.coalesce(F.min(F.when(F.col(c) > 0, F.col(c))).over(Window.partitionBy("query")), F.lit(1.0)))
    identity = (2 * F.try_divide("top_nuc", "self_nuc") + 3) / 5
    rows = rows.withColumns({"low_aa": least("rep_aa"), "low_nuc": least("rep_nuc"), "acc_aa": F.round(F.coalesce(F.try_divide("top_aa", "self_aa"), F.lit(0.0)), 9), "acc_nuc": F.round(F.when(F.col("top_nuc") > 0, identity).otherwise(0.0), 9)})
    return rows.select("query", "taxon", (S.scale_accuracy("rep_aa", "low_aa", "acc_aa") + S.scale_accuracy("rep_nuc", "low_nuc", "acc_nuc")).alias("rep"))


def floors(tops: DataFrame, lettered: DataFrame, info: float) -> DataFrame:
    """query, target_top, low_info (the target's best and 4/5 of the attainable are below ``info``), low_presence (the target's
    best is below 9/10 of the best), low_hit (over 4/5 of the letters, lower-case ones aside, are unaligned), passes. ``tops`` is
    ``maxima``'s with the target."""
    rows = tops.join(lettered, "query")
    low_info = (F.col("target_top") < info) & (F.col("self_all") < 1.25 * info)
    low_presence = F.col("target_top") < 0.9 * F.col("top")
    low_hit = F.col("unaligned") > 0.8 * (F.col("total") - F.col("loose"))
    return rows.select("query", "target_top", low_info.alias("low_info"), low_presence.alias("low_presence"), low_hit.alias("low_hit"), (~(low_info | low_presence | low_hit)).alias("passes"))


def annotation(ev: DataFrame, groups: DataFrame, tops: DataFrame, target: str) -> DataFrame:
    """query, max_score, prot_score, nucl_score (of the target group), max_align, weak, high_divergence, and high: the other
    groups whose score is worth a remark, as group=score in order of their names."""
    kinds = lookup(ev, groups, "taxon").groupBy(*SEGMENT, "kind", "group").agg(F.max("density").alias("density"))
    of = lambda k: F.floor(F.sum(F.when(F.col("kind") == k, F.col("density") * F.col("length")).otherwise(0.0)) + 1e-9)
    best = kinds.groupBy("query", "group").agg(of("AA").alias("aa"), of("NUC").alias("nuc")).withColumn("both", F.col("aa") + F.col("nuc"))
    rows = best.join(tops.select("query", "top", "self_all"), "query")
    own = lambda c: F.coalesce(F.max(F.when(F.col("group") == target, F.col(c))), F.lit(0))
    remark = F.when((F.col("group") != target) & (F.col("both") >= WORRY * F.col("top")), F.concat_ws("=", "group", F.col("both").cast("string")))
    told = rows.groupBy("query").agg(own("both").alias("max_score"), own("aa").alias("prot_score"), own("nuc").alias("nucl_score"), F.floor(F.greatest(F.max("self_all"), F.max("both")) + 1e-9).alias("max_align"), F.concat_ws(",", F.array_sort(F.collect_list(remark))).alias("high"))
    return told.select("query", "max_score", "prot_score", "nucl_score", "max_align", (F.col("max_score") < WEAK).alias("weak"), ((F.col("max_score") > 0) & (F.col("max_score") < DIVERGED * F.col("max_align"))).alias("high_divergence"), "high")


def possible(attain: DataFrame, lettered: DataFrame) -> DataFrame:
    """query, more: bits that the letters without hits would add at the query's mean attainable density of each kind.
    ``attain`` is ``attainable``'s, ``lettered`` is ``letters``'s."""
    of = lambda k: F.coalesce(F.try_divide(F.sum(F.when(F.col("kind") == k, F.col("best") * F.col("length"))), F.sum(F.when(F.col("kind") == k, F.col("length")))), F.lit(0.0))
    mean = attain.groupBy("query").agg((of("AA") + of("NUC")).alias("mean"))
    return lettered.join(mean, "query", "left").select("query", ((F.col("unaligned") + F.col("loose")) * F.coalesce("mean", F.lit(0.0))).alias("more"))


def headers(told: DataFrame, tops: DataFrame, more: DataFrame, lettered: DataFrame, resolved: DataFrame, names: DataFrame, listed: DataFrame, inside: DataFrame, scaffolds: DataFrame, enough: int = UNKNOWN_LETTERS) -> DataFrame:
    """query, taxid, header: the full headers of the result.

    ``told`` is ``annotation``'s, ``tops`` ``maxima``'s, ``more`` ``possible``'s, ``lettered`` ``letters``'s. ``resolved`` has
    query, taxid and flag of the majority ancestor of the candidates, ``names`` query, name (with ;taxId=), its taxid, and mixed (a
    contig, or of mixed sources); ``listed`` the white-listed taxids, ``inside`` those of the target group.

    A mixed scaffold of over ``enough`` known letters of which over UNKNOWN have no hits is of unknown information; it and
    white-listed ones keep their taxon, as do those without candidates. Others that resolve outside the target group are left
    out. Remarks on other groups and on divergence are not made on unknown information."""
    rows = told.join(names, "query").join(tops.select("query", "self_aa", "self_nuc"), "query").join(more, "query").join(lettered, "query").join(scaffolds, "query")
    rows = rows.join(resolved.select("query", F.col("taxid").alias("found"), "flag"), "query", "left")
    mark = lambda table, name: table.select(F.col("taxid"), F.lit(True).alias(name)).distinct()
    rows = rows.join(mark(listed, "white"), "taxid", "left").withColumn("white", F.coalesce("white", F.lit(False)))
    unhit = (F.col("unaligned") + F.col("loose")) / F.nullif(F.col("total"), F.lit(0))
    rows = rows.withColumn("unknown", F.coalesce(F.col("mixed") & (unhit > UNKNOWN) & (F.col("total") > enough), F.lit(False)))
    free = F.col("white") | F.col("unknown")
    rows = rows.withColumns({"orig": F.col("taxid"), "flag": F.when(free, "").otherwise(F.coalesce("flag", F.lit(""))), "taxid": F.when(free, F.col("taxid")).otherwise(F.coalesce("found", "taxid"))})
    rows = rows.join(mark(inside, "inside"), "taxid", "left").where(free | F.col("inside"))
    most = F.greatest(F.floor(F.col("max_align") + F.col("more") + 1e-9), F.col("max_score"))
    size = F.length("seq")
    hundredths = F.expr("(20000 * total + length(seq)) div (2 * length(seq))")
    text = lambda c: c.cast("long").cast("string")
    field = lambda key, c: F.concat(F.lit(f";{key}="), text(c))
    on = lambda test, c: F.when(test, c).otherwise(F.lit(""))
    others = F.array_join(F.transform(F.filter(F.split("high", ","), lambda x: x != ""), lambda x: F.concat(F.lit(";high"), F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))), "")
    name = F.concat(F.regexp_replace("name", r"taxId=\d+", F.concat(F.lit("taxId="), text(F.col("taxid")))), on(F.col("taxid") != F.col("orig"), field("origTaxId", F.col("orig"))))
    header = F.concat(
        name, field("maxScore", F.col("max_score")), field("maxAlign", F.col("max_align")), field("maxPossibleScore", most), field("protScore", F.col("prot_score")), field("maxProtAlign", F.floor(F.col("self_aa") + 1e-9)),
        field("nuclScore", F.col("nucl_score")), field("maxNuclAlign", F.floor(F.col("self_nuc") + 1e-9)), F.lit(";letterOccupancy="), text(F.floor(hundredths / 100)), F.lit("."), F.lpad(text(hundredths % 100), 2, "0"),
        on(F.col("weak"), F.lit(";weak=1")), on(~F.col("unknown") & (F.col("max_score") > 0) & (F.col("max_score") < DIVERGED * most), F.lit(";highDivergence=1")),
        F.when(F.col("unknown"), ";highUnknownInformation=1").otherwise(others), on(F.col("flag") != "", F.concat(F.lit(";potentialMisannotations="), F.col("flag"))), on(F.col("white"), F.lit(";whiteListed=1")),
    )
    return rows.where(size > 0).select("query", "taxid", header.alias("header"))


def best_of_group(scored: DataFrame, n: int = 10) -> DataFrame:
    """query, group, place, taxon, overall: the n best taxa of each group."""
    order = Window.partitionBy("query", "group").orderBy(F.round("overall", 9).desc(), "taxon")
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).select("query", "group", "place", "taxon", "overall")


def within(closed: DataFrame, taxa: DataFrame, listed: DataFrame, hops: int = 100) -> DataFrame:
    """The taxa (taxid) that are on the list (taxid) or below one that is, ``hops`` steps at most."""
    near = closed.where(F.col("hops") < hops).join(listed.select(F.col("taxid").alias("ancestor")).distinct(), "ancestor", "left_semi")
    return taxa.join(near.select("taxid").distinct(), "taxid", "left_semi")


def mapped(hits: DataFrame, targets: DataFrame) -> DataFrame:
    """Hits with their taxon brought to its target (taxid, target), where it has one."""
    moved = targets.select(F.col("taxid").alias("taxon"), "target")
    return hits.join(moved, "taxon", "left").withColumn("taxon", F.coalesce("target", "taxon")).drop("target")


def densities(ev: DataFrame) -> DataFrame:
    """query, hit (positions with hits of either kind), density (tops of both kinds, summed) and rep, both a hit position."""
    tops = ev.groupBy(*SEGMENT, "kind").agg(F.max("density").alias("top"), F.sum("rep").alias("rep")).groupBy(*SEGMENT).agg(F.sum("top").alias("top"), F.sum("rep").alias("rep"))
    mean = lambda c: F.sum(F.col(c) * F.col("length")) / F.sum("length")
    return tops.groupBy("query").agg(F.sum("length").alias("hit"), mean("top").alias("density"), mean("rep").alias("rep"))
