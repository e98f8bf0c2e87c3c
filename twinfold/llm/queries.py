"""The registered queries of this subpackage, each a thin contract over its operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.llm.shared import WORD, read_table

#: The rules that op1 judges by: action, host, path.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
MIX_WEIGHTS = [5.0, 2.0, 1.0]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.url_filter import judge_urls

    return judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.mixing import mix_sources

    return mix_sources(read_table(spark, sf_dir, "documents"), MIX_WEIGHTS).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "finish_time")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.ngram_lm import score_documents

    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 1
    return score_documents(read_table(spark, sf_dir, "documents"), held_out).withColumnRenamed("id", "doc_id")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.near_dedup import near_groups

    return near_groups(read_table(spark, sf_dir, "documents"), width=4).withColumnRenamed("id", "doc_id")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.html_text import extract_pages

    return extract_pages(read_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.exact_dedup import exact_groups

    groups = exact_groups(read_table(spark, sf_dir, "documents"), keep="largest")
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.quality import judge_quality

    return judge_quality(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _is(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def _count_kinds(kinds: tuple[str, ...]) -> list[Column]:
    return [F.size(F.filter(F.transform("spans", lambda s: s["kind"]), _is(k))).cast("long").alias(f"n_{k}") for k in kinds]


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.pii import BASE, find_personal
    from twinfold.llm.secret_scan import span_list

    found = find_personal(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), *_count_kinds(BASE), F.sha2(span_list(F.filter("spans", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_personal"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.bpe import encode_documents

    return encode_documents(read_table(spark, sf_dir, "documents"), default_vocabulary()).withColumnRenamed("id", "doc_id")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.secret_scan import scan_paths, span_list

    found = scan_paths(read_table(spark, sf_dir, "documents"))
    base = ("assign", "access", "hex")
    return found.select(F.col("id").alias("doc_id"), *_count_kinds(base), F.sha2(span_list(F.filter("spans", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def repeating(docs: DataFrame) -> DataFrame:
    """doc_id and text of documents, where every tenth, by the hash of its id, repeats a part of its own words from some place on."""
    words, h = F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    place = "CAST(g % size(words) AS INT)"
    period = f"CAST(1 + floor((size(words) - {place}) / (3 + g % 8)) AS INT)"
    changed = F.expr(f"array_join(transform(words, (w, i) -> CASE WHEN i < {place} THEN w ELSE words[{place} + (i - {place}) % {period}] END), ' ')")
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    return rows.select("doc_id", F.when(F.size("words") > 0, changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.periodic_runs import find_runs

    found = find_runs(repeating(read_table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    rows = found.withColumn("best", best)
    return rows.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.warc import read_records, write_archive

    records = read_records(write_archive(read_table(spark, sf_dir, "pages")))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinfold.llm.prefix_trie import rebuilt, trie_nodes, turn_rows, with_parents

    turns = turn_rows(read_table(spark, sf_dir, "conversations"))
    lists = rebuilt(turns, F.crc32(F.col("conv").cast("string")) % 9, F.col("conv") - F.col("conv") % 5, most=8)
    nodes = with_parents(trie_nodes(lists))
    return nodes.select(
        F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_mixing, op3_lm_score, op4_near_dedup, op5_html_text, op6_exact_dedup, op7_quality, op8_personal_data, op9_bpe, op10_secret_scan, op11_periodic_runs, op12_warc, op13_prefix_trie)}


#: Texts with A-Z in lower case; DuckDB's translate changes nothing else.
_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP6 = f"""
WITH t AS (SELECT doc_id, {_NORM} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       (t.doc_id IS NOT DISTINCT FROM g.keep_id
        AND row_number() OVER (PARTITION BY t.norm, t.doc_id) = 1) AS kept,
       sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""


_OP2 = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  ('0x' || substr(md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR))), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][1 + (rank - 1) % 3] AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, weight, least(cap, weight * max(CASE WHEN level * weight <= cap THEN level END) OVER ()) AS target FROM l),
p AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.weight,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, source, upto / weight AS finish_time,
       greatest(0, least(size, CAST(floor(target) AS BIGINT) - (upto - size))) + greatest(0, least(size, CAST(floor(target) AS BIGINT) - source_size - (upto - size))) AS taken
FROM p
"""


_OP12 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS turn, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN n >= 1000 AND turn > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND turn > 1 THEN top END AS refers_to
FROM r
"""


_CRC_STEP = "xor(c >> 1, 3988292384 * (c & 1))"
for _ in range(7):
    _CRC_STEP = f"list_transform([{_CRC_STEP}], lambda c: xor(c >> 1, 3988292384 * (c & 1)))[1]"
_OP13 = f"""
WITH t AS (SELECT conv_id AS conv, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS turn, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
                  row_number() OVER (PARTITION BY conv_id ORDER BY conversations.turn NULLS FIRST, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS place FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv, conv - conv % 5 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
             lambda a, b: list_transform([xor(a, b)], lambda c: {_CRC_STEP})[1])) % 9 AS head FROM (SELECT DISTINCT conv FROM t)),
r AS (SELECT c.conv, t.place, t.turn, t.bytes FROM c JOIN t ON t.conv = c.base AND t.place <= c.head UNION ALL SELECT c.conv, t.place, t.turn, t.bytes FROM c JOIN t ON t.conv = c.conv AND t.place > c.head),
o AS (SELECT conv, turn, bytes, row_number() OVER (PARTITION BY conv ORDER BY place) AS depth FROM r),
p AS (SELECT conv, 0 AS depth, 'root' AS node, NULL AS parent, 0 AS bytes FROM c UNION ALL
      SELECT conv, depth, node, coalesce(lag(node) OVER (PARTITION BY conv ORDER BY depth), 'root'), bytes
      FROM (SELECT conv, depth, bytes, sha256(string_agg(turn, ',') OVER (PARTITION BY conv ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS node FROM o)),
n AS (SELECT node, any_value(parent) AS parent, min(depth) AS depth, min(conv) AS conv, count(*) AS members, max(bytes) AS bytes FROM p GROUP BY node),
k AS (SELECT parent AS node, count(*) AS children FROM n GROUP BY 1),
below AS (SELECT p.node, sum(CASE WHEN k.children IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.members - 1) * n.bytes) AS saved
          FROM n LEFT JOIN k ON k.node = n.node JOIN p ON p.conv = n.conv AND p.depth <= n.depth GROUP BY p.node),
last AS (SELECT conv, arg_max(node, depth) AS node FROM p GROUP BY conv),
e AS (SELECT node, sha256(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv)) AS ends FROM last GROUP BY node)
SELECT n.conv AS conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv AS parent_conv_id, CAST(n.members AS BIGINT) AS n_convs, CAST(coalesce(k.children, 0) AS BIGINT) AS n_children,
       CAST(below.leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM n LEFT JOIN n u ON u.node = n.parent LEFT JOIN k ON k.node = n.node JOIN below ON below.node = n.node LEFT JOIN e ON e.node = n.node
"""


def _op1_sql(depth: int = 4, max_children: int = 50, min_share: float = 0.5, z: float = 2.58, prior: float = 5.0, min_labels: int = 5, reject_at: float = 0.8) -> str:
    """op1 in SQL, level by level."""
    ranked = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(a, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for a, h, p in ranked]
    shape = "s"
    for pattern, sign, every in (
        ("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "{uuid}", ""), ("[0-9]{4}-[0-9]{2}-[0-9]{2}", "{date}", ", 'g'"),
        *[("(^|[^0-9A-Za-z])[0-9a-fA-F]{12,}($|[^0-9A-Za-z])", r"\1{hex}\2", ", 'g'")] * 2, ("[0-9]+", "{n}", ", 'g'"),
    ):
        shape = f"regexp_replace({shape}, '{pattern}', '{sign}'{every})"
    parts = "list_filter(string_split(path, '/'), lambda s: s <> '')"
    steps = [
        f"""u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r AS (SELECT *, CASE {' '.join(f"WHEN {f} THEN '{n}'" for _, n, f in fits)} END AS rule, CASE {' '.join(f"WHEN {f} THEN '{a}'" for a, _, f in fits)} END AS ruled, {parts} AS parts FROM u),
k AS (SELECT *, list_transform(CASE WHEN len(parts) > {depth} THEN list_append(parts[1:{depth - 1}], array_to_string(parts[{depth}:], '/')) ELSE parts END, lambda s: {shape}) AS shapes FROM r),
t0 AS (SELECT host, shapes, count(ruled) AS l, count(*) FILTER (ruled = 'block') AS b, count(*) AS n, '' AS template FROM k GROUP BY host, shapes)"""
    ]
    for d in range(1, depth + 1):
        steps.append(
            f"""c{d} AS (SELECT *, coalesce(shapes[{d}], '') AS child FROM t{d - 1}),
n{d} AS (SELECT host, template, child, sum(l) AS l, sum(b) AS b, sum(n) AS n FROM c{d} GROUP BY 1, 2, 3),
p{d} AS (SELECT *, count(*) OVER w > {max_children} AND count(*) OVER w >= {min_share} * sum(n) OVER w AS variable FROM n{d} WINDOW w AS (PARTITION BY host, template)),
q{d} AS (SELECT *, lag(l) OVER o AS l0, lag(b) OVER o AS b0 FROM p{d} WHERE l >= {min_labels} AND child <> '' AND NOT variable WINDOW o AS (PARTITION BY host, template ORDER BY b / l, child)),
k{d} AS (SELECT *, sum(CASE WHEN l0 IS NULL OR abs(b / l - b0 / l0) > {z} * sqrt(((b + b0) / (l + l0)) * (1 - (b + b0) / (l + l0)) * (1 / l + 1 / l0)) THEN 1 ELSE 0 END) OVER (PARTITION BY host, template ORDER BY b / l, child ROWS UNBOUNDED PRECEDING) AS cluster FROM q{d}),
m{d} AS (SELECT host, template, child, CASE WHEN count(*) OVER g > 1 THEN '/{{like ' || min(child) OVER g || '}}' END AS merged FROM k{d} WINDOW g AS (PARTITION BY host, template, cluster)),
s{d} AS (SELECT p.host, p.template, p.child, CASE WHEN p.child = '' THEN '' WHEN variable THEN '/*' ELSE coalesce(merged, '/' || p.child) END AS step FROM p{d} p LEFT JOIN m{d} m ON m.host = p.host AND m.template = p.template AND m.child = p.child),
t{d} AS (SELECT c.host, c.shapes, c.l, c.b, c.n, c.template || s.step AS template FROM c{d} c JOIN s{d} s ON s.host = c.host AND s.template = c.template AND s.child = c.child)"""
        )
    steps.append(
        f"""g AS (SELECT coalesce(sum(b), 0) / greatest(coalesce(sum(l), 0), 1) AS share FROM t{depth}),
j AS (SELECT host, template, sum(l) AS l, (sum(b) + {prior} * (SELECT share FROM g)) / (sum(l) + {prior}) AS purity FROM t{depth} GROUP BY 1, 2)"""
    )
    return "WITH " + ",\n".join(steps) + f"""
SELECT k.page_id, k.host, k.path, k.rule, coalesce(k.ruled, CASE WHEN j.purity >= {reject_at} AND j.l >= {min_labels} THEN 'block' ELSE 'allow' END) AS verdict, t.template, j.purity
FROM k JOIN t{depth} t ON t.host = k.host AND t.shapes = k.shapes JOIN j ON j.host = t.host AND j.template = t.template
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": _op1_sql(), "op2_mixing": _OP2, "op6_exact_dedup": _OP6, "op12_warc": _OP12, "op13_prefix_trie": _OP13}
