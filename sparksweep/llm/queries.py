"""The registered queries of the llm operators, one per operator, with DuckDB twins.

A query is ``fn(spark, sf_dir) -> DataFrame`` over whole tables, with the
production parameters that are the defaults of its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksweep.llm import (
    decontamination,
    html_extraction,
    jaccard_join,
    language_id,
    language_model,
    line_dedup,
    merkle_manifest,
    mixing,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    token_alignment,
    url_filters,
)

# In SQL texts DOCS stands for the table of documents, as the pipeline applies them to its stages.
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.replace("DOCS", "documents")
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The measurements of the quality ledger of a CTE ``docs(doc_id, text)``.
QUALITY_CTES = r"""
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM DOCS),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, i, k, count(*) OVER (PARTITION BY rid, k) AS c
      FROM (SELECT rid, unnest(range(1, len(ws) - 1)) AS i,
                   unnest(list_transform(range(1, len(ws) - 1),
                                         lambda j: ws[j] || ' ' || ws[j + 1] || ' ' || ws[j + 2])) AS k
            FROM w WHERE len(ws) >= 3)),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g WHERE c >= 2) GROUP BY rid),
l AS (SELECT rid, list_filter(string_split(t, chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w JOIN l USING (rid) LEFT JOIN r USING (rid)),
bits AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
                 | (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
                 | (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
                 | (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
                 | (CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END)
                 | (CASE WHEN word_chars > 10 * n_words THEN 32 ELSE 0 END)
                 | (CASE WHEN n_lines <= 1 AND n_words > 2000 THEN 64 ELSE 0 END) AS fail_bits FROM m)
"""
QUALITY_SQL = "WITH " + QUALITY_CTES + """
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, fail_bits,
       (fail_bits & 3) != 0 AS base_failed, (fail_bits & 63) = 0 AS kept, 'web-2' AS policy FROM bits
"""


@query("op3_quality_rules", QUALITY_SQL)
def op3_quality_rules(spark, sf_dir):
    led = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return quality_rules.apply_policy(led).select(
        "doc_id", *quality_rules.MEASURES, "fail_bits", "base_failed", "kept", "policy")


URL_SQL = r"""
WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
s AS (SELECT *, '.' || host AS h FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN contains(host, 'cheap-pills.') OR contains(host, 'spam-farm.') OR regexp_matches(h, 'casino[^/]*\.')
              OR regexp_matches(h || path, '/wp-login\.php$') OR contains(path, '/cgi-bin/') THEN 'block'
            ELSE 'allow' END AS verdict
FROM (SELECT *, CASE WHEN ends_with(h, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                     WHEN ends_with(h, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                     WHEN ends_with(h, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
                     WHEN ends_with(h, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                     WHEN ends_with(h, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM s)
"""


@query("op5_url_filters", URL_SQL)
def op5_url_filters(spark, sf_dir):
    return url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


MIX_SQL = r"""
WITH z AS (SELECT source, coalesce(sum(length(text)), 0)::BIGINT AS size FROM DOCS GROUP BY source),
tot AS (SELECT sum(size)::DOUBLE AS a, sum(CASE WHEN size > 0 THEN sqrt(size::DOUBLE) ELSE 0 END) AS w FROM z),
rates AS (SELECT source, round(CASE WHEN size > 0 THEN sqrt(size::DOUBLE) * (a / w) / size ELSE 1.0 END, 9) AS rate FROM z, tot),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c
        FROM (SELECT source, k, CASE WHEN rate = 0 THEN 1.0 ELSE exp(k * ln(rate) - rate - lgamma(k + 1)) END AS p
              FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 31)::BIGINT)) AS k FROM rates))),
d AS (SELECT row_number() OVER () AS rid, *, coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS key FROM DOCS),
n AS (SELECT rid, count(c) AS copies
      FROM (SELECT *, ('0x' || substr(md5('mix-1:' || key), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM d) d
      LEFT JOIN cdf ON cdf.source IS NOT DISTINCT FROM d.source AND cdf.c <= d.u GROUP BY rid)
SELECT doc_id, text, lang, e.source, n_chars, rate, copy_no::INTEGER AS copy_no,
       md5('mix-1:order:' || key || ':' || copy_no) AS shuffle_key
FROM (SELECT d.*, unnest(range(1, copies + 1)) AS copy_no FROM d JOIN n USING (rid) WHERE copies > 0) e
JOIN rates ON rates.source IS NOT DISTINCT FROM e.source
"""


@query("op6_mixing", MIX_SQL)
def op6_mixing(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


LINE_CTES = r"""
d AS (SELECT row_number() OVER () AS rid, *, string_split(text, chr(10)) AS ls FROM DOCS),
x AS (SELECT rid, doc_id, source, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
y AS (SELECT *, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[ \t\r\f\v]+', ' ', 'g'), ' ') AS norm FROM x),
bad AS (SELECT norm, min(doc_id) AS first FROM y WHERE length(norm) >= 12
        GROUP BY norm HAVING count(DISTINCT coalesce('s' || source, 'null')) >= 8),
k AS (SELECT rid, count(*) FILTER (first IS DISTINCT FROM doc_id AND bad.norm IS NOT NULL) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (bad.norm IS NULL OR first = doc_id), '') AS clean_text
      FROM y LEFT JOIN bad USING (norm) GROUP BY rid)
"""
LINE_SQL = "WITH " + LINE_CTES + """
SELECT doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, clean_text
FROM d LEFT JOIN k USING (rid)
"""


@query("op1_line_dedup", LINE_SQL)
def op1_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "clean_text")


LEAK_CTES = r"""
b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM benchmark),
bs AS (SELECT item, ws, least(len(ws), 10) AS n FROM b WHERE len(ws) > 0),
p AS (SELECT DISTINCT item, n, array_to_string(ws[i: i + n - 1], ' ') AS w
      FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM bs)),
d AS (SELECT row_number() OVER () AS rid, *, coalesce(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS ws FROM DOCS),
s AS (SELECT DISTINCT n FROM p),
dw AS (SELECT rid, n, i, array_to_string(ws[i: i + n - 1], ' ') AS w
       FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, s)),
h AS (SELECT rid, i, n, item FROM dw JOIN p USING (n, w)),
c AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
"""
LEAK_SQL = "WITH " + LEAK_CTES + """
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""


@query("op2_decontamination", LEAK_SQL)
def op2_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_items(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op7_language_id")
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (language_id.remainder(F.col("doc_id"), 3) == 1).alias("held_out"))
    model = language_id.fit(docs.where("not held_out"))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query("op9_language_model")
def op9_language_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (language_id.remainder(F.col("doc_id"), 5) == 1).alias("held_out"), "text")
    model = language_model.train(docs.where("not held_out"))
    return language_model.score(docs, model)


@query("op8_html_extraction")
def op8_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract_pages(pages, html_extraction.fit(pages))


NEAR_CTES = r"""
d AS (SELECT row_number() OVER () AS rid, doc_id, text, lang, source, n_chars, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM DOCS),
sh AS (SELECT DISTINCT rid, array_to_string(ws[i: i + 4], ' ') AS s
       FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
pairs AS (SELECT p.a, p.b FROM (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM sh x JOIN sh y USING (s)
                                WHERE x.rid != y.rid GROUP BY 1, 2) p
          JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 10 * c >= 8 * (na.n + nb.n - c)),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
cls AS (SELECT a AS rid, min(doc_id) AS class_id FROM reach JOIN d ON d.rid = b GROUP BY a),
lnk AS (SELECT a AS rid, count(*) AS n_links FROM pairs GROUP BY a)
"""
NEAR_SQL = "WITH RECURSIVE " + NEAR_CTES + """
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM d JOIN cls USING (rid) LEFT JOIN lnk USING (rid)
"""


@query("op4_jaccard_join", NEAR_SQL)
def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.link(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "n_links")


@query("op10_substring_dedup")
def op10_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, keep_text=False).drop("removed")


@query("op12_simhash_dedup")
def op12_simhash_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _tree_ctes(name: str, key: str, levels: int) -> str:
    """CTEs of a tree above {name}0(key, pos, m, d): nodes {name}1.. and siblings {name}s0.. left (l) and right (r)."""
    out = ""
    for i in range(levels):
        run = f"OVER (PARTITION BY {key}, pos // 8 ORDER BY pos ROWS BETWEEN"
        out += f"""
{name}{i + 1} AS MATERIALIZED (SELECT {key}, pos // 8 AS pos, (m + 7) // 8 AS m,
    CASE WHEN m > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE min(d) END AS d FROM {name}{i} GROUP BY {key}, pos // 8, m),
{name}s{i} AS MATERIALIZED (SELECT {key}, pos, m, coalesce(string_agg(d, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{i}),"""
    return out


def _walk_ctes(name: str, tree: str, key: str, levels: int) -> str:
    """CTEs {name}1.. that lift {name}0(rid, key, pos, d, p) one level each: d folded, p with the siblings."""
    return "".join(f"""
{name}{i + 1} AS (SELECT rid, w.{key}, w.pos // 8 AS pos, CASE WHEN m > 1 THEN sha256(l || w.d || r) ELSE w.d END AS d, p || l || r AS p
    FROM {name}{i} w JOIN {tree}s{i} s ON s.{key} IS NOT DISTINCT FROM w.{key} AND s.pos = w.pos),""" for i in range(levels))


_TREE, _TOP = 9, 5  # levels that the SQL spells out: 8**9 rows of a language, 8**5 languages
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
MERKLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, *, translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM DOCS),
crc AS (SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
        string_split(doc_id::VARCHAR, ''), lambda c: list_concat([ord(c)::BIGINT], list_transform(range(8), lambda k: -1::BIGINT))))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 3 = 0 AS hit FROM docs),
leaves AS (SELECT rid, doc_id, lang, {_LEAF.format(text="text")} AS leaf,
    CASE WHEN hit THEN {_LEAF.format(text="low")} ELSE {_LEAF.format(text="text")} END AS found FROM crc),
t AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS m FROM leaves),
n0 AS (SELECT lang, pos, m, leaf AS d FROM t),{_tree_ctes("n", "lang", _TREE)}
u0 AS MATERIALIZED (SELECT 1 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS m, d, lang FROM n{_TREE}),
{_tree_ctes("u", "one", _TOP).strip()}
f0 AS (SELECT rid, lang, pos, found AS d, '' AS p FROM t),{_walk_ctes("f", "n", "lang", _TREE)}
g0 AS (SELECT rid, 1 AS one, u0.pos, f.d, p FROM f{_TREE} f JOIN u0 ON u0.lang IS NOT DISTINCT FROM f.lang),{_walk_ctes("g", "u", "one", _TOP)}
x AS (SELECT doc_id, leaf, u0.d AS subroot, u{_TOP}.d AS root, sha256(p) AS proof_sha256, g.d AS folded_root
    FROM t JOIN g{_TOP} g USING (rid) JOIN u0 ON u0.lang IS NOT DISTINCT FROM t.lang JOIN u{_TOP} ON true)
SELECT *, folded_root = root AS verified FROM x
"""


@query("op13_merkle_manifest", MERKLE_SQL)
def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate(
        "text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    found = tuple(tampered if f == "text" else F.col(f) for f in merkle_manifest.FIELDS)
    return merkle_manifest.manifest(docs, suspect=found).drop("lang")


@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    return token_alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
