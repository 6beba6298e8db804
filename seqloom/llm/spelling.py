"""Spelling variants: words one letter apart, found by pivotal grams, and the frequent form that each stands for.

A word's bigrams are ordered by how rare they are among the words (counts in 2^16 slots by a hash of the bigram, then the
bigram). Its gram prefix is the kinds of its PREFIX rarest bigrams. Two disjoint pivots are chosen from it, one for
each half: the first occurrence of its kind on the left, the last of its kind on the right. One edit leaves the left pivot
and all before it, or the right pivot and all behind it, as they are. So pivots are looked up in the other words' gram
prefixes under the position limits of one edit in their strongest form: the side of the pivot that is away from the edit
must be equal (by a 64-bit hash, which holds the position), and lengths differ by one at most. The dynamic program takes
the two pivots for which the fewest words are expected to share these sides, from the bigrams' shares. Of two near words,
the one whose prefix ends with the rarer kind finds the other, as all that is at least as rare as the other's last
kind is in the other's prefix. Candidates are verified by their edit distance; no bucket is capped.

Defined results: null texts and texts without letters have no words; a null doc_id counts as empty text; repeated rows
count as often as they come; other columns are not read; an empty table gives no rows. Words of any length are taken
whole. Words below four letters have no near words.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import ship, small, staged

#: Letters of a word after A-Z is lower case.
LETTERS = "a-zÀ-ÿ"
SLOTS = 1 << 16
#: Bigrams in a gram prefix; one edit needs three at least, more give pivots with more around them.
PREFIX = 5


def runs(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, word: every run of ``least`` letters and more, A-Z in lower case."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("word"))


def slipped(doc_id: Column, word: Column, one_in: int) -> Column:
    """The word, and for one in so many (by a checksum of document and word) without one of its letters."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = F.pmod(h, F.char_length(word)).cast("int")
    return F.when(F.pmod(h, F.lit(one_in)) == 0, F.concat(F.substring(word, F.lit(1), at), F.substr(word, at + 2))).otherwise(word)


def counted(words: DataFrame, least: int = 7, uses: int = 2) -> DataFrame:
    """word, n: distinct words of ``least`` letters and ``uses`` occurrences at least. Counts are partial before the shuffle."""
    return words.where(F.char_length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= uses)


def slot(a: str, b: str) -> int:
    return (ord(a) * 40_503 + ord(b) * 277) % SLOTS


def rarity(words: DataFrame) -> list[float]:
    """Share of each slot among the bigrams of all words; SLOTS numbers, whatever the words."""

    def count(batches):
        n = np.zeros(SLOTS, np.int64)
        for b in batches:
            for w in b.column("word").to_pylist():
                for x in map(slot, w, w[1:]):
                    n[x] += 1
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["slot", "n"])

    share = np.full(SLOTS, 0.5)
    for s, n in words.select("word").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():  # SLOTS rows at most
        share[s] = n
    return (share / share.sum()).tolist()


def pivots(word: str, share: list[float]) -> tuple[int, int, dict[str, int], dict[str, int], float]:
    """The places of the left and the right pivot, first and last place of each kind in the gram prefix, and the share of
    its most frequent kind."""
    grams = [word[i : i + 2] for i in range(len(word) - 1)]
    p = [share[slot(a, b)] for a, b in grams]
    kinds = {grams[i] for i in sorted(range(len(grams)), key=lambda i: (p[i], grams[i]))[:PREFIX]}
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    for i, g in enumerate(grams):
        if g in kinds:
            first.setdefault(g, i)
            last[g] = i
    # expected shares of words that are equal up to the end of each gram, and from its start on
    logs = np.log(p)
    before, behind = np.exp(np.cumsum(logs)), np.exp(np.cumsum(logs[::-1])[::-1])
    starts, stops = sorted(first.values()), sorted(last.values())
    # one pass from left to right: the cheapest left pivot that ends before each right one, then the cheapest of both
    best, one, at = (math.inf, -1, -1), (math.inf, -1), 0
    for j in stops:
        while at < len(starts) and starts[at] + 2 <= j:
            one = min(one, (float(before[starts[at]]), starts[at]))
            at += 1
        best = min(best, (one[0] + float(behind[j]), one[1], j))
    return best[1], best[2], first, last, max(p[i] for i in first.values())


def marks(words: DataFrame, share: list[float]) -> DataFrame:
    """key, pivot, bound, word, n: each word's two pivots under the lengths that one edit may lead to, and its gram prefix
    under its own length."""

    def key(side: str, n: int, text: str) -> int:
        return xxhash.xxh3_64_intdigest(f"{side}{n}:{text}") - (1 << 63)

    def run(batches):
        for b in small(batches, 4096):
            keys, pivot, bound, of = [], [], [], []
            for k, w in enumerate(b.column("word").to_pylist()):
                if len(w) < 4:
                    continue
                left, right, first, last, most = pivots(w, share)
                own = [key("L", n, w[: left + 2]) for n in range(len(w) - 1, len(w) + 2)] + [key("R", n, w[right:]) for n in range(len(w) - 1, len(w) + 2)]
                held = [key("L", len(w), w[: i + 2]) for i in first.values()] + [key("R", len(w), w[i:]) for i in last.values()]
                keys += own + held
                pivot += [True] * len(own) + [False] * len(held)
                bound += [most] * (len(own) + len(held))
                of += [k] * (len(own) + len(held))
            rows = b.take(pa.array(of, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(pivot, pa.bool_()), pa.array(bound, pa.float64()), rows.column("word"), rows.column("n")], ["key", "pivot", "bound", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, pivot boolean, bound double, word string, n long")


def near(words: DataFrame) -> DataFrame:
    """word, n, other, m: pairs of words (of ``counted``) that one inserted, deleted or replaced letter apart, both ways."""
    ship(words.sparkSession)
    dealt = staged(marks(words, rarity(words)), "spelling-marks")
    own = dealt.where("pivot").select("key", F.col("bound").alias("b"), F.col("word").alias("x"), F.col("n").alias("nx"))
    held = dealt.where("NOT pivot").select("key", "bound", F.col("word").alias("y"), F.col("n").alias("ny"))
    met = own.join(held.hint("merge"), "key").where("b <= bound AND x <> y AND levenshtein(x, y, 1) = 1")
    x, y = (F.struct(F.col(c).alias("word"), F.col(f"n{c}").alias("n")) for c in "xy")
    pairs = met.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).distinct()
    both = F.array(F.struct("x.*", "y.*"), F.struct("y.*", "x.*"))
    return pairs.select(F.inline(both)).toDF("word", "n", "other", "m")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``words`` (word, n; a row a word).

    form is the near word of most occurrences (ties: the smallest), where these are ``ratio`` times the word's at least. As
    forms are that much more frequent, chains are short; root is where a chain ends, the word itself if it has no form."""
    per = near(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("top"))
    fits = -F.col("top.m") >= ratio * F.col("n")
    told = per.select("word", "n_near", F.when(fits, F.col("top.other")).alias("form"), F.when(fits, -F.col("top.m")).alias("form_n"))
    told = staged(told, "spelling-near")
    roots = staged(told.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:  # each turn doubles how far a root reaches
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(on, "root", "left_semi").isEmpty():
            break
        roots = staged(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    out = words.select("word", "n").join(told, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
