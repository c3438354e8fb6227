"""Contract queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import ann, langid, licenses, merkle, mixing, resampling, simhash, sitetree, spdropout, topk, toxicity, urlfilter, vecdedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(
    "op1_urlfilter",
    """
    WITH cut AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
    u AS (
        SELECT page_id,
               coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM cut),
    r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    j AS (
        SELECT u.*, (SELECT max_by({'k': r.h || r.p, 'v': r.v}, length(r.h || r.p)) FROM r
                     WHERE (u.host = r.h OR u.host LIKE '%.' || r.h) AND starts_with(u.path, r.p)) AS best
        FROM u)
    SELECT page_id, host, path, best.k AS rule, coalesce(best.v, 'allow') AS verdict FROM j
    """,
)
def op1_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL by the listed rules; unlisted URLs are allowed."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.contract_rules(spark)).drop("url")


@_query(
    "op2_mixing",
    """
    WITH RECURSIVE d AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
               (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '') || '|mix|29'), 1, 13))::BIGINT)::DOUBLE / 4503599627370496.0 AS u
        FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source),
    w AS (SELECT source, source_size, n, 3.0::DOUBLE * source_size AS lim,
                 [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS weight
          FROM s),
    lv(k, level) AS (
        SELECT 0, (SELECT sum(source_size)::DOUBLE / sum(weight) FROM w)
        UNION ALL
        SELECT k + 1, (SELECT ((SELECT sum(source_size) FROM w)::DOUBLE - coalesce(sum(w.lim) FILTER (w.lim <= w.weight * lv.level), 0.0))
                              / sum(w.weight) FILTER (w.lim > w.weight * lv.level) FROM w)
        FROM lv WHERE k < 60 AND level IS NOT NULL),
    t AS (SELECT source, source_size, source_size::DOUBLE / n AS mean, least(lim, weight * (SELECT max(level) FROM lv)) AS target FROM w),
    e AS (SELECT d.*, source_size, target, CASE WHEN size * 2 < mean THEN 0 WHEN size > mean * 2 THEN 2 ELSE 1 END AS class
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    z AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS sure,
                 coalesce(sum(size) FILTER (class = 0), 0)::DOUBLE AS z0, coalesce(sum(size) FILTER (class = 1), 0)::DOUBLE AS z1,
                 coalesce(sum(size) FILTER (class = 2), 0)::DOUBLE AS z2 FROM e GROUP BY source, source_size, target),
    r AS (SELECT *, greatest(target - sure * source_size, 0.0) AS rest FROM z),
    f2 AS (SELECT *, rest / nullif(z0 + z1 * 1.5 + z2 * 2, 0) AS c2 FROM r),
    f1 AS (SELECT *, CASE WHEN c2 * 2 < 1 THEN c2 ELSE (rest - z2) / nullif(z0 + z1 * 1.5, 0) END AS c1 FROM f2),
    f0 AS (SELECT *, CASE WHEN c1 * 1.5 < 1 THEN c1 ELSE (rest - z2 - z1) / nullif(z0, 0) END AS c0 FROM f1),
    p AS (SELECT *, coalesce(greatest(least(c0, 1), 0), 0) AS p0, coalesce(greatest(least(c1 * 1.5, 1), 0), 0) AS p1,
                 coalesce(greatest(least(c2 * 2, 1), 0), 0) AS p2 FROM f0),
    q AS (SELECT *, greatest(rest - CASE WHEN p0 >= 1 THEN z0 ELSE 0 END - CASE WHEN p1 >= 1 THEN z1 ELSE 0 END - CASE WHEN p2 >= 1 THEN z2 ELSE 0 END, 0) AS left_ FROM p),
    h AS (SELECT e.doc_id, e.source, e.size, e.u, e.source_size, e.target, q.sure, q.left_, CASE class WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS pr
          FROM e JOIN q ON e.source IS NOT DISTINCT FROM q.source),
    o AS (SELECT *, sum(CASE WHEN pr > 0 AND pr < 1 THEN size ELSE 0 END) OVER (
                        PARTITION BY source ORDER BY CASE WHEN pr > 0 AND pr < 1 THEN (u / (1 - u)) * ((1 - pr) / pr) END NULLS LAST, doc_id
                        ROWS UNBOUNDED PRECEDING) AS upto FROM h)
    SELECT doc_id, size, source_size, target,
           (size * (sure + CASE WHEN pr >= 1 OR (pr > 0 AND upto - size / 2.0 <= left_) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM o
    """,
)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pareto order sampling of all documents to the target weights of their sources."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@_query("op3_ann")
def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every vector whose id is divisible by 50."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, rows.where(F.col("vec_id") % 50 == 0))


@_query("op4_vecdedup")
def op4_vecdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine 0.9 among all vectors, and their components."""
    return vecdedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@_query("op5_sitetree")
def op5_sitetree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, and how many branches the style tree itself removed from it."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return sitetree.main_text(pages).select("page_id", "url", "text", "n_chars", "tree_removed")


@_query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional random field over every whole document; spans come with the scores."""
    return toxicity.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents through Golay-code keys."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


@_query("op8_licenses")
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every whole document, one row each."""
    return licenses.scan_docs(_table(spark, sf_dir, "documents"))


@_query("op9_spdropout")
def op9_spdropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole document under seeded merge dropout, and the round trip."""
    return spdropout.encode_docs(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@_query("op10_langid")
def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte convolutional network over every whole document."""
    return langid.predictions(_table(spark, sf_dir, "documents"))


#: One row ``t``: the 256 entries of the reflected CRC-32 table (polynomial 0xEDB88320), for crc32 in SQL.
CRC_TABLE = """
    crc_table AS (
        SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
               lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


def crc32_sql(codes: str) -> str:
    """SQL for the unsigned crc32 of a list of byte values, where ``t`` is the table."""
    steps = f"list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))"
    return f"xor(4294967295, {steps})"


def _id_crc_sql(col: str) -> str:
    return crc32_sql(f"list_transform(string_split({col}::VARCHAR, ''), lambda x: ord(x)::BIGINT)")


def _merkle_sql(rounds: int = 6, top_rounds: int = 4) -> str:
    """The manifest with its levels written out: 16 ** rounds rows a source, 16 ** top_rounds sources."""

    def leaf(text: str) -> str:
        values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    def levels(name: str, by: str, last: int) -> list[str]:
        return [
            f"{name}{k + 1} AS (SELECT {by}idx // 16 AS idx, (n + 15) // 16 AS n, sha256(string_agg(h, '' ORDER BY idx)) AS h"
            f" FROM {name}{k} WHERE n > 1 GROUP BY {by}idx // 16, n)"
            for k in range(last)
        ]

    def steps(name: str, rows: str, on: str, last: int) -> list[str]:
        return [
            f"{name}p{k} AS (SELECT {rows}.rid, coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < {rows}.pos // {16**k}), '') AS lft,"
            f" coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > {rows}.pos // {16**k}), '') AS rgt"
            f" FROM {rows} JOIN {name}{k} s ON {on}s.idx // 16 = {rows}.pos // {16 ** (k + 1)} WHERE s.n > 1 GROUP BY {rows}.rid)"
            for k in range(last)
        ]

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        CRC_TABLE.strip(),
        f"d AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {_id_crc_sql('doc_id')} % 5 = 0 THEN {leaf(low)} END AS changed FROM documents, crc_table)",
        "e AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,"
        " count(*) OVER (PARTITION BY source) AS n FROM d)",
        "l0 AS (SELECT source, pos AS idx, n, leaf AS h FROM e)",
        *levels("l", "source, ", rounds),
        "subs AS (" + " UNION ALL ".join(f"SELECT source, h FROM l{k} WHERE n = 1" for k in range(rounds + 1)) + ")",
        "t0s AS (SELECT source, h, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS idx, count(*) OVER () AS n FROM subs)",
        "t0 AS (SELECT idx, n, h FROM t0s)",
        *levels("t", "", top_rounds),
        "roots AS (" + " UNION ALL ".join(f"SELECT h FROM t{k} WHERE n = 1" for k in range(top_rounds + 1)) + ")",
        "u AS (SELECT e.rid, t0s.idx AS pos, t0s.h AS subroot FROM e JOIN t0s ON e.source IS NOT DISTINCT FROM t0s.source)",
        *steps("l", "e", "s.source IS NOT DISTINCT FROM e.source AND ", rounds),
        *steps("t", "u", "", top_rounds),
    ]
    names = [f"lp{k}" for k in range(rounds)] + [f"tp{k}" for k in range(top_rounds)]
    proof = " || ".join(f"coalesce({p}.lft || {p}.rgt, '')" for p in names)
    joins = " ".join(f"LEFT JOIN {p} ON {p}.rid = e.rid" for p in names)
    sides = ", ".join(f"{p}.lft AS {p}_l, {p}.rgt AS {p}_r" for p in names)
    parts.append(
        f"f0 AS (SELECT e.doc_id, e.leaf, u.subroot, (SELECT h FROM roots) AS root, sha256({proof}) AS proof_sha256,"
        f" coalesce(e.changed, e.leaf) AS f, {sides} FROM e JOIN u ON u.rid = e.rid {joins})"
    )
    for k, p in enumerate(names):
        parts.append(f"f{k + 1} AS (SELECT * REPLACE (CASE WHEN {p}_l IS NULL THEN f ELSE sha256({p}_l || f || {p}_r) END AS f) FROM f{k})")
    last = "SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM " + f"f{len(names)}"
    return "WITH " + ",\n".join(parts) + "\n" + last


@_query(
    "op11_topk",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.c, v.c)::BIGINT AS score
        FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
    SELECT query_id, place::INT AS rank, vec_id, score FROM r WHERE place <= 5
    """,
)
def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows of largest integer inner product for every vector whose id is divisible by 50."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(rows, rows.where(F.col("vec_id") % 50 == 0))


def _resampling_sql() -> str:
    def grams(table: str, rid: str) -> str:
        words = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
        runs = [
            "list_transform(range(1, len(ws) + 1 - %d), lambda i: %s)" % (n, " || ' ' || ".join(f"ws[i + {k}]" for k in range(n + 1)))
            for n in range(3)
        ]
        return f"SELECT {rid} AS rid, unnest(list_concat({', '.join(runs)})) AS g FROM (SELECT *, {words} AS ws FROM {table}) WHERE ws IS NOT NULL"

    codes = "list_transform(range(1, 2 * strlen(g), 2), lambda i: ('0x' || substr(hex(g), i, 2))::BIGINT)"
    word_count = "coalesce(len(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 0)"
    return f"""
    WITH {CRC_TABLE.strip()},
    d AS (SELECT *, row_number() OVER () AS rid FROM documents),
    dg AS (SELECT rid, g, count(*) AS n FROM ({grams('d', 'rid')}) GROUP BY rid, g),
    bg AS (SELECT g, count(*) AS n FROM ({grams('benchmark', '0')}) GROUP BY g),
    hashed AS (SELECT g, {crc32_sql(codes)} % 10000 AS b FROM (SELECT DISTINCT g FROM dg UNION SELECT g FROM bg), crc_table),
    s AS (SELECT b, sum(n) AS s FROM dg JOIN hashed USING (g) GROUP BY b),
    t AS (SELECT b, sum(n) AS t FROM bg JOIN hashed USING (g) GROUP BY b),
    gains AS (
        SELECT z.b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
                     / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
        FROM (SELECT unnest(range(10000)) AS b) z LEFT JOIN s ON s.b = z.b LEFT JOIN t ON t.b = z.b),
    weights AS (SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM dg JOIN hashed USING (g) JOIN gains ON gains.b = hashed.b GROUP BY rid),
    e AS (
        SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, {word_count} >= 20 AS fit,
               coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
        FROM d LEFT JOIN weights USING (rid)),
    r AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, count(*) FILTER (fit) OVER () AS n FROM e)
    SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 5 * n // 100 THEN place END AS rank FROM r
    """


@_query("op12_resampling", _resampling_sql())
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark's features; the drawn ones have a rank."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, _table(spark, sf_dir, "benchmark").select("text"))


@_query("op13_merkle", _merkle_sql())
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, every document's proof, and its check where texts of a fifth of them were lower-cased."""
    docs = _table(spark, sf_dir, "documents").select(*merkle.COLUMNS)
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = merkle.manifest(docs, tampered={"text": low}, tampered_where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    return merkle.prove(made)
