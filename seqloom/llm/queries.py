"""The registered queries of this subpackage: each runs its operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import archives, bpe, embeddings, exact_dedup, lattice, minhash, mixing, passages, secrets, spelling, token_files, toxicity, whitening
from seqloom.llm.common import documents, staged

TIKTOKEN_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZERS_FILE = public_tokenizers.path("byte_bpe_50k.json")


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(documents(spark, sf_dir), PIECE_FILE)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), TIKTOKEN_FILE, public_tokenizers.PATTERN)


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.9)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), width=2, percent=80)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir), TIKTOKEN_FILE, public_tokenizers.PATTERN)

    def written(x):
        return F.concat_ws(",", F.transform(x, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))

    base = F.filter("found", lambda f: f["kind"] != "random")
    count = lambda kind: F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(written(base), 256).alias("base_sha256"), written("found").alias("spans"))


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_tokens(token_files.write_tokens(documents(spark, sf_dir), TOKENIZERS_FILE))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs(documents(spark, sf_dir), 7)
    words = runs.select(spelling.slipped(F.col("doc_id"), F.col("word"), 31).alias("word"))
    return spelling.variants(staged(spelling.counted(words, 7, 2), "spelling-words"), 10)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=16, scale=64, base=1_000_000)
    return told.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = archives.read_warc(archives.convert(archives.write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"))))
    return told.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lattice": op1_lattice,
    "op2_bpe": op2_bpe,
    "op3_embeddings": op3_embeddings,
    "op4_minhash": op4_minhash,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mixing": op6_mixing,
    "op7_secrets": op7_secrets,
    "op8_passages": op8_passages,
    "op9_toxicity": op9_toxicity,
    "op10_token_files": op10_token_files,
    "op11_spelling": op11_spelling,
    "op12_whitening": op12_whitening,
    "op13_archives": op13_archives,
}

ORACLES: dict[str, str] = {
    "op3_embeddings": r"""
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                             WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
        r(vec_id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id AND r.c < l.b),
        n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1)
        SELECT e.vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, m.c = e.vec_id AS kept
        FROM embeddings e LEFT JOIN n USING (vec_id) JOIN (SELECT vec_id, min(c) AS c FROM r GROUP BY 1) m USING (vec_id)""",
    "op4_minhash": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x FROM documents),
        s AS (SELECT doc_id, unnest(list_transform(range(1, len(x)), lambda i: x[i] || ' ' || x[i + 1])) AS g FROM w WHERE len(x) > 1
              UNION SELECT doc_id, x[1] FROM w WHERE len(x) = 1),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
        l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id AND r.c < l.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, m.c = d.doc_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m USING (doc_id)""",
    "op6_mixing": r"""
        WITH r AS (SELECT doc_id, source, coalesce('s' || source, '') AS key,
                          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash FROM documents),
        g AS (SELECT source, key, sum(size)::BIGINT AS source_size FROM r GROUP BY source, key),
        s AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM g),
        l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
              FROM s WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)),
        t AS (SELECT key, source_size, coalesce(least(2 * source_size::DOUBLE, weight *
                     (SELECT arg_min(level, source_size / weight) FROM l WHERE level * weight < 2 * source_size)), 2 * source_size::DOUBLE) AS target FROM l),
        a AS (SELECT *, CASE WHEN target > source_size THEN target - source_size ELSE target END AS budget FROM t),
        b AS (SELECT key, hash, sum(size) AS n FROM r GROUP BY key, hash),
        h AS (SELECT *, sum(n) OVER (PARTITION BY key ORDER BY hash) - n AS below FROM b),
        e AS (SELECT key, max(hash) AS hash, max(below) AS below, arg_max(n, hash) AS n FROM h JOIN a USING (key) WHERE below <= budget GROUP BY key),
        c AS (SELECT a.*, CASE WHEN below + n - budget <= budget - below THEN hash + 1 ELSE hash END AS lim FROM a JOIN e USING (key))
        SELECT doc_id, size, source_size, target,
               (size * ((target > source_size)::INT + (hash < lim)::INT))::BIGINT AS taken
        FROM r JOIN c USING (key)""",
    "op5_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)""",
    "op11_spelling": r"""
        WITH RECURSIVE g AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{7,}')) AS w FROM documents),
        c AS (SELECT doc_id, w, count(*) AS n FROM g GROUP BY ALL),
        k AS (SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda x, s: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i)) AS t),
        h AS (SELECT w, n, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)), '..'), lambda x: ('0x' || x)::BIGINT),
                                           lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS crc FROM c, k),
        m AS (SELECT CASE WHEN crc % 31 = 0 THEN substr(w, 1, crc % length(w)) || substr(w, crc % length(w) + 2) ELSE w END AS word, n FROM h),
        v AS (SELECT word, sum(n)::BIGINT AS n FROM m WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        x AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
        p AS (SELECT a.word, b.word AS other FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
              UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.rest UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.rest),
        o AS (SELECT v.word, v.n, count(*) AS n_near, arg_min(b.word, (-b.n, b.word)) AS top, max(b.n) AS top_n FROM p JOIN v USING (word) JOIN v b ON b.word = other GROUP BY ALL),
        f AS (SELECT word, n_near, CASE WHEN top_n >= 10 * n THEN top END AS form, CASE WHEN top_n >= 10 * n THEN top_n END AS form_n FROM o),
        r(word, root, hops) AS (SELECT word, form, 1 FROM f WHERE form IS NOT NULL UNION ALL SELECT r.word, f.form, hops + 1 FROM r JOIN f ON f.word = r.root WHERE f.form IS NOT NULL)
        SELECT v.word, form, coalesce(e.root, v.word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
        FROM v LEFT JOIN f USING (word) LEFT JOIN (SELECT word, arg_max(root, hops) AS root FROM r GROUP BY word) e USING (word)""",
    "op13_archives": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
        t AS (SELECT *, sha1(h) AS payload_digest, payload_bytes >= 1000 AND page_id <> max(page_id) OVER (PARTITION BY h) AS again, max(page_id) OVER (PARTITION BY h) AS top FROM p)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to FROM t""",
}
