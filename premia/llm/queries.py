"""The operators as named queries with production settings, and SQL that gives the same rows where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.llm import bpe, decontaminate, embjoin, exactdup, main_text, merkle, neardup, repeats, resampling, search, secrets, toxicity, warc
from premia.llm.common import table
from premia.workspace import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
RANKS = "byte_bpe_50k.tiktoken"


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), root)
    return warc.read_records(spark, root).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP2_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
g AS (SELECT payload, max(page_id) AS top FROM p GROUP BY payload)
SELECT page_id, CAST(octet_length(p.payload) AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
  CASE WHEN octet_length(p.payload) >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(p.payload) >= 1000 AND page_id < top THEN top END AS refers_to
FROM p JOIN g ON p.payload = g.payload
"""


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op4_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embjoin.near_vectors(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
l AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND len(p.x) = len(q.x) AND p.vec_id <> q.vec_id
  WHERE list_cosine_similarity(p.x, q.x) >= 0.98),
r(node, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.seen FROM r JOIN l ON l.a = r.node),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN m ON node = vec_id LEFT JOIN n ON a = vec_id
"""


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    file, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    tokens = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), file, pattern), file, pattern)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS k
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM d, ns, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
m AS (SELECT doc_id, dw.n, i, item FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM m, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[secrets.count_of(spans, k).alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(secrets.listed(secrets.of_base(spans)), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
    )


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_MATCHES = "\nUNION ALL\n".join(
    f"SELECT doc_id, source, '{kind}' AS kind, {rank} AS rank, {least} AS least, string_split_regex(t, {_sql_text(p)}) AS gaps, "
    f"regexp_extract_all(t, {_sql_text(p)}) AS ms, regexp_extract_all(t, {_sql_text(p)}, {group}) AS vs FROM d"
    for rank, (kind, (p, group, least)) in enumerate(secrets.KINDS.items())
)
OP7_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
m AS ({_MATCHES}),
e AS (SELECT doc_id, source, kind, rank, least, i, len(gaps[i]) + len(ms[i]) AS step, ms[i] AS mt, vs[i] AS v
  FROM m, unnest(range(1, len(ms) + 1)) AS u(i)),
c AS (SELECT *, sum(step) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM e),
k AS (SELECT doc_id, source, kind, rank, stop - len(mt) AS start, stop, v FROM c WHERE len(v) >= least AND (kind <> 'owned' OR
  (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')))),
o AS (SELECT v, count(DISTINCT source) AS owners FROM k GROUP BY v),
r AS (SELECT k.*, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS s FROM k JOIN o ON k.v = o.v WHERE kind <> 'owned' OR owners = 1),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, string_agg(s, ',' ORDER BY start, rank) FILTER (kind <> 'owned') AS base,
  string_agg(s, ',' ORDER BY start, rank) AS spans FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s, md5_number(array_to_string(w[i:i + 4], ' ')) AS t
  FROM w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.t = y.t AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.seen FROM r JOIN e ON e.a = r.node),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op9_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP9_SQL = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
x AS (SELECT doc_id, j, h[2000 * j + 1:2000 * j + 2098] AS part FROM d, unnest(range(0, CAST(ceil(len(h) / 2000.0) AS BIGINT))) AS u(j)),
w AS (SELECT doc_id, 1000 * j + k AS i, md5_number(part[2 * k + 1:2 * k + 100]) AS s
  FROM x, unnest(range(0, least(1000, CAST(len(part) / 2 - 49 AS BIGINT)))) AS u(k) WHERE len(part) >= 100),
o AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
r AS (SELECT doc_id, i FROM w JOIN o ON w.s = o.s WHERE doc_id > first),
g AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS fresh FROM r),
k AS (SELECT doc_id, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
c AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM c),
t AS (SELECT p.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (toxicity.fold_of() == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("doc_id").cast("string")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(number) % 3 == 0, lowered).otherwise(F.col("text"))
    found = merkle.manifest_of(table(spark, sf_dir, "documents"), LEAF_FIELDS, "doc_id", "lang", {"text": tampered})
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _tree_sql(name: str, leaves: str, levels: int) -> str:
    """CTEs of one forest: ``<name><k>`` (t, i, n, h) are its nodes of height k, ``<name>s<k>`` their joined siblings."""
    parts = [f"{name}0 AS ({leaves})"]
    for k in range(levels):
        this = f"{name}{k}"
        parts.append(
            f"{name}s{k} AS (SELECT a.t, a.i, a.n, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lo, "
            f"coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS hi "
            f"FROM {this} a JOIN {this} b ON a.t = b.t AND a.i // 8 = b.i // 8 GROUP BY a.t, a.i, a.n)"
        )
        parts.append(
            f"{name}{k + 1} AS (SELECT t, i // 8 AS i, (n + 7) // 8 AS n, "
            f"CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {this} GROUP BY t, i // 8, n)"
        )
    return ",\n".join(parts)


def _folded_sql(name: str, of: str, levels: int) -> str:
    """CTEs that fold ``of`` (doc, t, i, f, p): the changed digest ``f`` goes up, the proof ``p`` grows."""
    parts = []
    for k in range(levels):
        parts.append(
            f"{name}f{k + 1} AS (SELECT doc, o.t, o.i // 8 AS i, CASE WHEN n = 1 THEN f ELSE sha256(lo || f || hi) END AS f, "
            f"p || lo || hi AS p FROM {of if k == 0 else f'{name}f{k}'} o JOIN {name}s{k} s ON o.t = s.t AND o.i = s.i)"
        )
    return ",\n".join(parts)


def _framed_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


#: The SQL goes up to eight levels of documents and three of languages: 16 million documents a language.
OP11_SQL = f"""
WITH d AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
  dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM documents),
crc AS (SELECT list(c ORDER BY k) AS tab FROM (
  WITH RECURSIVE r(k, step, c) AS (SELECT range, 0, range FROM range(256)
    UNION ALL SELECT k, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM r WHERE step < 8)
  SELECT k, c FROM r WHERE step = 8)),
c AS (SELECT d.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295) AS crc FROM d, crc),
h AS (SELECT doc_id, lang, t, row_number() OVER (PARTITION BY t ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY t) AS n,
  sha256({" || ".join(_framed_sql(c) for c in LEAF_FIELDS)}) AS h,
  sha256({" || ".join(_framed_sql("(CASE WHEN crc % 3 = 0 THEN lowered ELSE text END)" if c == "text" else c) for c in LEAF_FIELDS)}) AS f FROM c),
{_tree_sql("a", "SELECT t, i, n, h FROM h", 8)},
u AS (SELECT t, h FROM a8),
{_tree_sql("b", "SELECT 0 AS t, t AS i, count(*) OVER () AS n, h FROM u", 3)},
l0 AS (SELECT doc_id AS doc, t, i, f, '' AS p FROM h),
{_folded_sql("a", "l0", 8)},
m0 AS (SELECT doc, 0 AS t, t AS i, f, p FROM af8),
{_folded_sql("b", "m0", 3)}
SELECT doc_id, h.h AS leaf, u.h AS subroot, b3.h AS root, sha256(p) AS proof_sha256, bf3.f AS folded_root, bf3.f = b3.h AS verified
FROM h JOIN u ON h.t = u.t JOIN bf3 ON doc = doc_id, b3
"""


def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, row_number() OVER () AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
q AS (SELECT item, item_id, term, count(*) AS q FROM (SELECT item, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
s AS (SELECT count(*) FILTER (len(w) > 0) AS nd, CAST(sum(len(w)) AS BIGINT) AS nl FROM d),
m AS (SELECT doc_id, 25 + (75 * len(w) * nd) // nl AS m FROM d, s WHERE len(w) > 0),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
g AS (SELECT item, item_id, t.doc_id, CAST(sum(q * CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN t ON q.term = t.term JOIN f ON f.term = q.term JOIN m ON m.doc_id = t.doc_id, s GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INT) AS rank FROM g WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


QUERIES: dict[str, Query] = {
    "op1_importance_resampling": op1_importance_resampling,
    "op2_warc_archive": op2_warc_archive,
    "op3_main_text": op3_main_text,
    "op4_embedding_join": op4_embedding_join,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_decontaminate": op6_decontaminate,
    "op7_secret_scan": op7_secret_scan,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_byte_repeats": op9_byte_repeats,
    "op10_toxicity": op10_toxicity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_exact_duplicates": op12_exact_duplicates,
    "op13_ranked_search": op13_ranked_search,
}
ORACLES: dict[str, str] = {
    "op2_warc_archive": OP2_SQL,
    "op4_embedding_join": OP4_SQL,
    "op6_decontaminate": OP6_SQL,
    "op7_secret_scan": OP7_SQL,
    "op8_near_duplicates": OP8_SQL,
    "op9_byte_repeats": OP9_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_exact_duplicates": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
