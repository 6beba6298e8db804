"""Document probabilities by a subword lattice over an existing piece vocabulary.

A text is its words (`[^\\x20\\x09-\\x0D]+`, A-Z lower-cased) and one end. A word is spelt by pieces of a sentencepiece
vocabulary: its lattice has an arc for every piece between two of its characters, byte arcs for characters without a
piece, and one arc for the whole word where training documents hold it. All segmentations count: a forward recursion in
log space sums them, so a word's probability is marginal.

    P(word | class) = max(c - d, 0) / N + (d V1 / N) Z(word)

c, N: the word's and all tokens of the class; d: a discount from words seen once and twice; V1: distinct words, whose
discounts pay for the spellings; Z: the sum over spellings by pieces. A class is a language of the training documents;
a text's probability is marginal over classes too: log sum over classes of share times product over tokens.

Piece weights begin from the vocabulary's own scores (its order) and are brought to the corpus by STEPS expectation steps over
all training words; nothing is sampled. The pieces themselves never change. ``lattice_score`` is the same lattice by the
vocabulary's own weights alone, without arcs of whole words and classes: the words' log Z and the end's share of tokens.

Counts of words follow the corpus. Each task counts its words, Spark adds the counts up. Words above a count that at
most TOP words reach are sent to all tasks; the others' occurrences are joined to their scores by word.

Defined results: null and empty texts are the end alone; a null doc_id trains; without training documents N and V are
0, base_score is 0 * n_tokens and score comes from the vocabulary alone; repeated rows each get a row; words of any
length are scored whole. Only doc_id, text and (for classes) lang are read; lang may be missing.
"""

from __future__ import annotations

import functools
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm.common import large, ship, small, staged

#: Most words that are sent to every task, and the longest of them in bytes: some 20 MB.
TOP, LONG = 200_000, 64
#: Classes: the languages with most training documents; what is left makes one more.
CLASSES = 6
#: A task's counts are handed on when they hold so many words.
HELD = 400_000
#: Longest piece looked for, in characters; words above MANY characters go one by one.
MANY = 48
#: Expectation steps over all training words.
STEPS = 2
MARK = "▁"  # what the vocabulary puts before a word


class Pieces:
    """The vocabulary: pieces by hash, their natural log weights, and weights of bytes."""

    def __init__(self, path: str):
        import sentencepiece as sp

        model = sp.SentencePieceProcessor(model_file=path)
        self.text, order, self.byte = [], [], {}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                self.byte[int(model.id_to_piece(i)[3:5], 16)] = len(self.text)
            elif model.is_control(i) or model.is_unknown(i):
                continue
            self.text.append(model.id_to_piece(i))
            order.append(-model.get_score(i))
        # scores of this vocabulary are ranks: the share of a rank falls with its inverse
        start = 1 / (np.argsort(np.argsort(order)) + 3.0)
        self.start = np.log(start / start.sum())
        self.ids = {t: i for i, t in enumerate(self.text) if i not in set(self.byte.values())}
        self.longest = max(map(len, self.ids))
        rng = np.random.default_rng(11)
        self.base = int(rng.integers(1 << 40, 1 << 62)) | 1
        hashes = np.array([self.hash(t) for t in self.ids], np.uint64)
        at = np.argsort(hashes)
        self.hashes, self.order = hashes[at], np.array(list(self.ids.values()))[at]
        assert (np.diff(self.hashes) != 0).all()

    def hash(self, t: str) -> int:
        h = 0
        for c in t:
            h = (h * self.base + ord(c)) & (1 << 64) - 1
        return h

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _arcs(p: Pieces, words: list[str]) -> list[tuple[int, int, np.ndarray]]:
    """Arcs of words of one length, as (from, to, piece of each word or -1)."""
    n = len(words[0])
    chars = np.array(words, f"U{n}").view(np.uint32).reshape(len(words), n).astype(np.uint64)
    base, power = np.uint64(p.base), [np.uint64(1)]
    head = [np.zeros(len(words), np.uint64)]
    with np.errstate(over="ignore"):
        for i in range(n):
            head.append(head[-1] * base + chars[:, i])
            power.append(power[-1] * base)
        out = []
        for j in range(1, n + 1):
            for i in range(max(0, j - p.longest), j):
                ids = p.find(head[j] - head[i] * power[j - i])
                if j - i == 1 or (ids >= 0).any():
                    out.append((i, j, ids))
    return out


def _bytes(p: Pieces, weight: np.ndarray, words: list[str], i: int) -> np.ndarray:
    """Log weight of the i-th characters, spelt in bytes."""
    return np.array([sum(weight[p.byte[b]] for b in w[i].encode()) for w in words])


def spell(p: Pieces, weight: np.ndarray, words: list[str], counts: np.ndarray | None = None, arcs: list | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log Z of words of one length (the mark included); with counts, also the expected uses of each piece."""
    n, floor = len(words[0]), -1e300
    found, arcs = arcs or _arcs(p, words), []
    for i, j, ids in found:
        w = np.where(ids >= 0, weight[ids], floor)
        bare = (ids < 0) if j - i == 1 else None
        if bare is not None and bare.any():
            at = np.flatnonzero(bare)
            w[at] = _bytes(p, weight, [words[k] for k in at], i)
        arcs.append((i, j, ids, w))
    into = [[] for _ in range(n + 1)]
    for a in arcs:
        into[a[1]].append(a)
    forward = [np.zeros(len(words))]
    for j in range(1, n + 1):
        forward.append(functools.reduce(np.logaddexp, (forward[i] + w for i, _, _, w in into[j])))
    if counts is None:
        return forward[n], None
    back = [np.full(len(words), floor) for _ in range(n)] + [np.zeros(len(words))]
    used = np.zeros(len(p.text))
    for j in range(n, 0, -1):
        for i, _, ids, w in into[j]:
            back[i] = np.logaddexp(back[i], w + back[j])
            share = counts * np.exp(np.minimum(forward[i] + w + back[j] - forward[n], 0))
            known = ids >= 0
            used += np.bincount(ids[known], share[known], len(used))
            if j - i == 1 and not known.all():
                for k in np.flatnonzero(~known):
                    for b in words[k][i].encode():
                        used[p.byte[b]] += share[k]
    return forward[n], used


def by_length(words: list[str], size: int = 8192):
    """Indices of words of equal length, in blocks of at most ``size`` (fewer where words are long)."""
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        groups.setdefault(len(w), []).append(k)
    for n, g in groups.items():
        step = max(1, min(size, size * MANY // n))
        for at in range(0, len(g), step):
            yield g[at : at + step]


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def held_out(col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def count_words(docs: DataFrame, classes: list[str]) -> DataFrame:
    """word (binary), c: training counts by class, n: count in all documents."""
    ship(docs.sparkSession)
    k = len(classes) + 1

    def run(batches):
        found: list[Counter] = [Counter() for _ in range(k + 1)]  # the last: held-out documents

        def handed():
            words = list(set().union(*found))
            counts = np.array([[f.get(w, 0) for f in found] for w in words], np.int64).reshape(len(words), k + 1)
            flat = pa.array(counts[:, :k].reshape(-1))
            for f in found:
                f.clear()
            ends = pa.array(np.arange(0, k * len(words) + 1, k), pa.int32())
            whole = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.ListArray.from_arrays(ends, flat), pa.array(counts.sum(1))], ["word", "c", "n"])
            for at in range(0, len(words), 20_000):
                yield whole.slice(at, 20_000)

        for b in small(batches):
            for t, c, h in zip(*(b.column(x).to_pylist() for x in ("text", "class", "held")), strict=True):
                found[k if h else c].update(split(t))
            if sum(map(len, found)) > HELD:
                yield from handed()
        yield from handed()

    part = _marked(docs, classes).mapInArrow(run, "word binary, c array<long>, n long")
    sums = part.groupBy("word").agg(*[F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(k)], F.sum("n").alias("n"))
    return sums


def _marked(docs: DataFrame, classes: list[str]) -> DataFrame:
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    number = F.coalesce(F.array_position(F.array(*map(F.lit, classes)), lang), F.lit(0)).cast("int") if classes else F.lit(0)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", number.alias("class"), held_out().alias("held"))


class Model:
    """What every task needs: sizes, discounts, class shares and the frequent words' log10 scores."""

    def __init__(self, path, weight, tokens, distinct, ends, totals, shares, discount, spread, words, scores):
        self.path, self.weight, self.tokens, self.distinct, self.ends = path, weight, tokens, distinct, ends
        self.totals, self.shares, self.discount, self.spread = totals, shares, discount, spread
        self.words, self.scores = words, scores

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1.0) / (self.tokens + 1.0 * (self.distinct + 1.0)))

    def word_scores(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Columns: base, log10 Z by the vocabulary's own weights, then log10 P of each class. counts: training counts by
        class."""
        p, marked = pieces(self.path), [MARK + w.decode(errors="replace") for w in words]
        z, own = np.empty(len(words)), np.empty(len(words))
        for g in by_length(marked):
            block = [marked[k] for k in g]
            arcs = _arcs(p, block)
            z[g], own[g] = spell(p, self.weight, block, arcs=arcs)[0], spell(p, p.start, block, arcs=arcs)[0]
        seen = np.maximum(counts - self.discount, 0) / np.maximum(self.totals, 1)
        with np.errstate(divide="ignore"):
            both = np.logaddexp(np.log(seen), z[:, None] + np.log(self.spread)) / np.log(10)
        return np.column_stack([self.base(counts.sum(1)), own / np.log(10), both])


def expected_uses(path: str, weight: np.ndarray, batches):
    """The expected uses of each piece over a task's words, which count c."""
    p = pieces(path)
    used = np.zeros(len(p.text))
    for b in large(batches):
        marked = [MARK + w.decode(errors="replace") for w in b.column("word").to_pylist()]
        n = b.column("c").to_numpy()
        for g in by_length(marked):
            used += spell(p, weight, [marked[i] for i in g], n[g].astype(float))[1]
    at = np.flatnonzero(used)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(used[at])], ["piece", "used"])


def learn(docs: DataFrame, path: str) -> tuple[Model, DataFrame]:
    """The model, and the table of all words (word, c0.., n) with their training counts."""
    spark = docs.sparkSession
    classes = []
    if "lang" in docs.columns:
        langs = docs.where(~held_out() & F.col("lang").isNotNull()).groupBy("lang").count()
        classes = [r["lang"] for r in langs.orderBy(F.desc("count"), "lang").limit(CLASSES).collect()]
    k = len(classes) + 1
    words = staged(count_words(docs, classes), "words")
    cs = [f"c{i}" for i in range(k)]
    total = "+".join(cs)
    one = words.agg(*[F.sum(c).alias(f"s_{c}") for c in cs], F.count(F.expr(f"CASE WHEN {total} > 0 THEN 1 END")).alias("v"),
                    *[F.count(F.when(F.col(c) == m, 1)).alias(f"m{m}_{c}") for c in cs for m in (1, 2)], *[F.count(F.when(F.col(c) > 0, 1)).alias(f"d_{c}") for c in cs]).first()
    ends_by = {r["class"]: r["count"] for r in _marked(docs, classes).where("NOT held").groupBy("class").count().collect()}
    ends = np.array([ends_by.get(i, 0) for i in range(k)], float)
    spelt = np.array([one[f"s_{c}"] or 0 for c in cs], float)
    ones, twos, kinds = (np.array([one[f"{x}_{c}"] for c in cs], float) for x in ("m1", "m2", "d"))
    tokens, distinct = int(spelt.sum() + ends.sum()), one["v"] + int(ends.sum() > 0)
    totals = spelt + ends
    discount = np.clip(np.where(ones + twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5), 0.1, 0.9)
    # a class without words spells everything
    spread = np.where(kinds > 0, discount * kinds / np.maximum(totals, 1), 0.5)
    shares = (ends + 1 / k) / (ends.sum() + 1)

    p = pieces(path)
    weight = p.start
    # each word counts by the log of its count, as frequent words have arcs of their own
    learned = words.where(f"{total} > 0").selectExpr("word", f"ln(1 + {total}) AS c")
    for _ in range(STEPS):
        uses = learned.mapInArrow(functools.partial(expected_uses, path, weight), "piece int, used double")
        used = np.full(len(p.text), 1e-3)
        for r in uses.groupBy("piece").agg(F.sum("used").alias("used")).collect():  # at most one row a piece
            used[r[0]] += r[1]
        weight = np.log(used / used.sum())
    model = Model(path, weight, tokens, distinct, ends, totals, shares, discount, spread, {}, np.zeros((0, k + 1)))
    # the lowest count that at most TOP words reach
    steps = words.where(F.length("word") <= LONG).groupBy(F.floor(F.log2("n") * 8).alias("step")).count().collect()
    reach, least = 0, 10_000
    for step, n in sorted(map(tuple, steps), reverse=True):
        if reach + n > TOP:
            break
        reach, least = reach + n, step
    scored = staged(score_words(words, model, cs).withColumn("top", (F.floor(F.log2("n") * 8) >= least) & (F.length("word") <= LONG)), "scored-words")
    top = scored.where("top").select("word", "s").toArrow()
    model.words = {w: i for i, w in enumerate(top.column("word").to_pylist())}
    model.scores = np.array(top.column("s").to_pylist(), float).reshape(len(model.words), k + 3)
    return model, scored.where("NOT top").select("word", "s")


def score_words(words: DataFrame, model: Model, cs: list[str]) -> DataFrame:
    """Adds s: [known, base, log10 Z by the vocabulary's weights, log10 P by class] of every word."""
    held = words.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in large(batches):
            if not b.num_rows:
                continue
            counts = np.column_stack([b.column(c).to_numpy() for c in cs])
            s = np.column_stack([counts.sum(1) > 0, held.value.word_scores(b.column("word").to_pylist(), counts)])
            ends = pa.array(np.arange(0, s.size + 1, s.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("n"), pa.ListArray.from_arrays(ends, pa.array(s.reshape(-1)))], ["word", "n", "s"])

    return words.mapInArrow(run, "word binary, n long, s array<double>")


def score(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score for every row."""
    spark: SparkSession = docs.sparkSession
    model, rare = learn(docs, path)
    k = len(model.totals)
    held = spark.sparkContext.broadcast(model)  # at most TOP words
    ship(spark)

    def run(batches):
        from pyspark import TaskContext

        m, row = held.value, TaskContext.get().partitionId() << 40
        get = m.words.get
        for b in small(batches):
            sums, sizes, left, counts, ends = [], [], [], [], [0]
            for t in b.column("text").to_pylist():
                found = Counter(split(t))
                at = np.fromiter((get(w, -1) for w in found), np.int64, len(found))
                n = np.fromiter(found.values(), np.int64, len(found))
                far = at < 0
                near = ~far
                sums.append(n[near] @ m.scores[at[near]])
                sizes.append(int(n.sum()) + 1)
                if far.any():
                    names = list(found)
                    left += [names[i] for i in np.flatnonzero(far)]
                    counts.append(n[far])
                ends.append(len(left))
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(left, pa.binary()), pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))], ["word", "m"]))
            s = np.array(sums, float).reshape(len(sizes), k + 3)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, s.size + 1, k + 3), pa.int32()), pa.array(s.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + len(sizes))), b.column("doc_id"), b.column("held"), pa.array(sizes, pa.int64()), flat, rest], ["row", "doc_id", "held_out", "n_tokens", "s", "rest"])
            row += len(sizes)

    rows = staged(_marked(docs, []).mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, s array<double>, rest array<struct<word:binary,m:long>>"), "scored-rows")
    met = rows.select("row", F.inline("rest")).join(rare, "word")
    more = met.groupBy("row").agg(*[F.sum(F.col("m") * F.col("s")[i]).alias(f"r{i}") for i in range(k + 3)])
    parts = [F.col("s")[i] + F.coalesce(F.col(f"r{i}"), F.lit(0.0)) for i in range(k + 3)]
    # the end: a token of training, with its own count; classes without documents never end a text
    end_known = 1.0 if model.ends.sum() else 0.0
    end_base = float(model.base(np.array(model.ends.sum())))
    with np.errstate(divide="ignore"):
        per = np.log10(model.shares) + np.log10(np.maximum(model.ends, 1 / k) / np.maximum(model.totals, 1))
    logs = [parts[3 + i] + F.lit(float(per[i])) for i in range(k)]
    best = F.greatest(*logs) if k > 1 else logs[0]
    stop = float(np.clip(model.ends.sum() / max(model.tokens, 1), 1e-6, 1 - 1e-6)) if model.tokens else 0.5
    score_of = best + F.log10(sum((F.pow(F.lit(10.0), x - best) for x in logs), F.lit(0.0)))
    return rows.join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", F.round(parts[0] + end_known).cast("long").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (parts[1] + F.lit(end_base)).alias("base_score"), score_of.alias("score"), (parts[2] + F.lit(np.log10(1 - stop).item()) * (F.col("n_tokens") - 1) + F.lit(np.log10(stop).item())).alias("lattice_score"),
    )
