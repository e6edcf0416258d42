"""Registered catalog, requirement and URI queries (SRC-2, SRC-6, PRJ-2,
WIN-1, WIN-2, JON-5, JON-6, AGG-8, JOB-1, JOB-2, SET-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparksweep.operators import catalog as C
from sparksweep.operators import requirements as R
from sparksweep.plans import views as V
from sparksweep.plans.registry import register
from sparksweep.plans.views import table, with_views
from sparksweep.session import shared_dir
from sparksweep.sources import catalog as SC
from sparksweep.sources import uris as U

_PRJ2_SQL = """
SELECT name, pos, framework, CAST(CASE WHEN pos % 4 <> 0 THEN num_nodes ELSE 1 END AS BIGINT) AS num_nodes,
       CASE WHEN pos % 3 = 2 THEN coalesce(image, 'img/init') ELSE image END AS image,
       CASE WHEN pos % 11 = 0 THEN 'not a runtime document'
            WHEN coalesce(name, '') = '' THEN 'missing name'
            WHEN coalesce(framework, '') = '' THEN 'missing framework'
            WHEN (CASE WHEN pos % 3 = 2 THEN coalesce(image, 'img/init') ELSE image END) IS NULL THEN 'no image'
       END AS error, prio, CASE WHEN framework = 'torchtune' THEN 'BuiltinTrainer' ELSE 'CustomTrainer' END AS trainer_type,
       CASE WHEN framework = 'torchtune' THEN 'tune run' WHEN pos % 5 = 1 THEN 'torchrun' WHEN pos % 5 = 2 THEN 'mpirun' ELSE 'python' END AS command
FROM v_catalog"""


@register("prj2_runtime_documents", with_views(
    "SELECT name, pos, framework, num_nodes, image, trainer_type, command, error FROM prj2", "v_catalog", ctes={"prj2": _PRJ2_SQL}))
def prj2_runtime_documents(spark, sf_dir):
    """Runtime documents (JSON) flattened: framework label, node count default 1,
    image from the ``node`` container else the first with an image."""
    docs = C.runtime_documents(V.catalog(spark, sf_dir))
    return C.parse_runtime_documents(docs, "doc", keep=["pos"]).select(
        "name", "pos", "framework", "num_nodes", "image", "trainer_type", "command", "error")


@register("win1_first_wins", with_views("""
SELECT name, prio, pos, framework, image, num_nodes FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY prio, pos) AS rn FROM v_catalog) x WHERE rn = 1""",
                                        "v_catalog"))
def win1_first_wins(spark, sf_dir):
    """First-wins dedup by name over the priority-ordered catalog."""
    return C.first_wins(V.catalog(spark, sf_dir), "name", ["prio", "pos"])


@register("jon5_default_fallback", with_views("""
SELECT name, prio, pos, false AS is_default FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY prio, pos) AS rn FROM v_catalog) x WHERE rn = 1
UNION ALL
SELECT name, NULL AS prio, NULL AS pos, true AS is_default FROM v_catalog_defaults
WHERE name NOT IN (SELECT name FROM v_catalog)""", "v_catalog", "v_catalog_defaults"))
def jon5_default_fallback(spark, sf_dir):
    """Catalog winners plus each built-in default no source provided."""
    found = C.first_wins(V.catalog(spark, sf_dir), "name", ["prio", "pos"]).select(
        "name", "prio", "pos").withColumn("is_default", F.lit(False))
    defaults = V.catalog_defaults(spark, sf_dir).withColumn("is_default", F.lit(True))
    return C.with_defaults(found, defaults)


_SRC6_SQL = with_views("""
SELECT name, framework, num_nodes, image, prio FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY prio, pos) AS rn FROM prj2 WHERE error IS NULL) x
WHERE rn = 1
UNION ALL
SELECT name, NULL, NULL, NULL, NULL FROM v_catalog_defaults
WHERE name NOT IN (SELECT name FROM prj2 WHERE error IS NULL)""", "v_catalog", "v_catalog_defaults", ctes={"prj2": _PRJ2_SQL})


def _spread_documents(spark, sf_dir):
    """Documents rendered by all tasks: a few small files hold many catalog rows."""
    return C.runtime_documents(V.catalog(spark, sf_dir).repartition("pos"))


@register("src6_catalog_from_files", _SRC6_SQL)
def src6_catalog_from_files(spark, sf_dir):
    """Catalog documents landed as files in three source folders, read back in
    one scan, bad documents skipped, first source wins, defaults filled in."""
    docs = _spread_documents(spark, sf_dir)
    base = shared_dir(spark, "catalog-sources")
    sources = SC.write_catalog_sources(docs, base)
    runtimes, _ = SC.load_catalog(spark, sources, V.catalog_defaults(spark, sf_dir))
    return runtimes.select("name", "framework", "num_nodes", "image", "prio")


@register("src6_catalog_from_yaml", _SRC6_SQL)
def src6_catalog_from_yaml(spark, sf_dir):
    """The same catalog landed as YAML files of many documents, cut at their markers in many tasks."""
    docs = _spread_documents(spark, sf_dir)
    sources = SC.write_catalog_sources(docs, shared_dir(spark, "catalog-yaml"), style="yaml")
    runtimes, _ = SC.load_catalog(spark, sources, V.catalog_defaults(spark, sf_dir))
    return runtimes.select("name", "framework", "num_nodes", "image", "prio")


def _shown(df):
    """Positions are long decimals: shown as text."""
    return df.withColumn("pos", F.col("pos").cast("string"))


_BAD_SQL = "CASE WHEN ends_with(requirement, '7') THEN concat('@@', requirement) ELSE requirement END"
_NAME_SQL = f"lower(regexp_replace(regexp_extract(requirement, '{R.NAME_RE}', 1), '[-_.]+', '-', 'g'))"


@register("win2_last_wins", with_views(f"""
SELECT job, name, CAST(pos AS VARCHAR) AS pos, requirement FROM (
  SELECT job, pos, requirement, {_NAME_SQL} AS name,
         row_number() OVER (PARTITION BY job, {_NAME_SQL} ORDER BY pos DESC) AS rn
  FROM v_req_runtime) x WHERE rn = 1 AND name <> ''""", "v_req_runtime"))
def win2_last_wins(spark, sf_dir):
    """Last-wins dedup of each runtime requirement list on canonical name."""
    return _shown(R.last_wins(V.req_runtime(spark, sf_dir)))


@register("set1_ordered_distinct", with_views("""
SELECT job, requirement, CAST(min(pos) AS VARCHAR) AS pos FROM v_req_runtime GROUP BY job, requirement""", "v_req_runtime"))
def set1_ordered_distinct(spark, sf_dir):
    """Order-preserving distinct of each list: every value at its first position."""
    return _shown(R.ordered_distinct(V.req_runtime(spark, sf_dir), ["job"], "requirement"))


@register("jon6_requirement_merge", with_views(f"""
SELECT job, section, CAST(pos AS VARCHAR) AS pos, requirement FROM (
SELECT job, 0 AS section, pos, requirement FROM rt_last r
WHERE job IN (SELECT job FROM jb) AND NOT EXISTS (SELECT 1 FROM jb WHERE jb.job = r.job AND jb.name = r.name)
UNION ALL SELECT job, 0, pos, requirement FROM rt WHERE job NOT IN (SELECT job FROM jb)
UNION ALL SELECT job, 1, pos, requirement FROM jb) u""", "v_req_runtime", "v_req_job", ctes={
    "rt": f"SELECT job, pos, requirement, {_NAME_SQL} AS name FROM v_req_runtime",
    "jb": f"SELECT job, pos, requirement, {_NAME_SQL} AS name FROM v_req_job",
    "rt_last": """SELECT job, name, pos, requirement FROM (
        SELECT *, row_number() OVER (PARTITION BY job, name ORDER BY pos DESC) AS rn FROM rt WHERE name <> '') x
        WHERE rn = 1"""}))
def jon6_requirement_merge(spark, sf_dir):
    """Job requirement lists override runtime lists on canonical name, per job."""
    both = V.req_all(spark, sf_dir).where(F.col("side").isin("F", "O"))
    section = F.when(F.col("side") == "F", 0).otherwise(1)
    return _shown(R.merge_sections(both.select("job", section.alias("section"), "pos", "requirement")))


@register("jon6_requirement_rejects", with_views(f"""
SELECT job, section, CAST(pos AS VARCHAR) AS pos, requirement, reason FROM (
  SELECT job, 1 AS section, pos, requirement, 'listed twice' AS reason FROM (
    SELECT *, rank() OVER (PARTITION BY job, name ORDER BY pos) AS rk FROM jb WHERE name <> '') x WHERE rk > 1
  UNION ALL SELECT job, 0, pos, requirement, 'unparsable requirement' FROM rt WHERE name = ''
  UNION ALL SELECT job, 1, pos, requirement, 'unparsable requirement' FROM jb WHERE name = '') u""",
                                                "v_req_runtime", "v_req_job", ctes={
    "rt": f"SELECT job, pos, requirement, {_NAME_SQL} AS name FROM (SELECT job, pos, {_BAD_SQL} AS requirement FROM v_req_runtime) b",
    "jb": f"SELECT job, pos, requirement, {_NAME_SQL} AS name FROM (SELECT job, pos, {_BAD_SQL} AS requirement FROM v_req_job) b"}))
def jon6_requirement_rejects(spark, sf_dir):
    """What the merge refuses: text without a name, names a job lists twice."""
    bad = F.when(F.col("requirement").endswith("7"), F.concat(F.lit("@@"), F.col("requirement"))).otherwise(F.col("requirement"))
    both = V.req_all(spark, sf_dir).where(F.col("side").isin("F", "O"))
    section = F.when(F.col("side") == "F", 0).otherwise(1)
    return _shown(R.reject_sections(both.select("job", section.alias("section"), "pos", bad.alias("requirement"))))


@register("agg8_duplicate_requirements", with_views(f"""
SELECT job, name, count(*) AS count FROM (SELECT job, {_NAME_SQL} AS name FROM v_req_job) x
WHERE name <> '' GROUP BY job, name HAVING count(*) > 1""", "v_req_job"))
def agg8_duplicate_requirements(spark, sf_dir):
    """Every duplicated canonical name in the job lists (the reference's error)."""
    return R.duplicate_names(V.req_job(spark, sf_dir))


@register("job1_requirement_inventory", with_views(f"""
SELECT name, count(*) AS rows, count(DISTINCT job) AS jobs, count(DISTINCT spec) AS specifiers FROM (
  SELECT job, {_NAME_SQL} AS name, trim(regexp_extract(requirement, '{R.REST_RE}', 1)) AS spec FROM v_req_all) x
WHERE name <> '' GROUP BY name""", "v_req_all"))
def job1_requirement_inventory(spark, sf_dir):
    """Per canonical package name: rows, jobs and distinct version specifiers."""
    inv, _ = R.inventory(V.req_all(spark, sf_dir).select("job", "pos", "requirement"))
    return inv


_HOST = f"regexp_extract(url, '{U.HOST_RE}', 1)"
_PATH = f"regexp_extract(url, '{U.PATH_RE}', 1)"


def _src_urls(spark, sf_dir):
    pg = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = F.regexp_extract("url", U.HOST_RE, 1), F.regexp_extract("url", U.PATH_RE, 1)
    m = F.col("page_id") % 5
    src = (F.when(m == 0, F.col("url")).when(m == 1, F.concat(F.lit("github://"), host, path))
           .when(m == 2, F.concat(F.lit("file://"), path)).when(m == 3, path)
           .when(F.col("page_id") % 2 == 0, F.concat(F.lit("ftp://"), host)).otherwise(F.concat(F.lit("owner"), path)))
    return pg.select("page_id", src.alias("src"))


@register("job2_source_uris", with_views(f"""
SELECT page_id, src, source_type, path,
       CASE WHEN rel <> '.' AND contains(rel, '.') THEN concat('dataset.data_files=/workspace/dataset/', rel)
            ELSE concat('dataset.data_dir=/workspace/dataset/', rel) END AS dataset_arg
FROM (SELECT page_id, src,
        CASE WHEN starts_with(src, 'github://') THEN 'github' WHEN starts_with(src, 'https://') THEN 'https'
             WHEN starts_with(src, 'http://') THEN 'http' WHEN starts_with(src, 'file://') THEN 'file'
             WHEN starts_with(src, '/') THEN 'file' END AS source_type,
        CASE WHEN starts_with(src, 'github://') THEN substr(src, 10) WHEN starts_with(src, 'file://') THEN substr(src, 8)
             WHEN starts_with(src, 'https://') OR starts_with(src, 'http://') OR starts_with(src, '/') THEN src END AS path,
        CASE WHEN len(parts) > 1 THEN array_to_string(parts[2:], '/') ELSE '.' END AS rel
      FROM (SELECT page_id, src,
              string_split(regexp_replace(regexp_extract(CASE WHEN regexp_matches(src, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN src ELSE 'hf://' || src END, '{U.PATH_RE}', 1), '^/+|/+$', '', 'g'), '/') AS parts
            FROM (SELECT page_id,
                    CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN concat('github://', {_HOST}, {_PATH})
                         WHEN 2 THEN concat('file://', {_PATH}) WHEN 3 THEN {_PATH}
                         ELSE CASE WHEN page_id % 2 = 0 THEN concat('ftp://', {_HOST}) ELSE concat('owner', {_PATH}) END
                         END AS src FROM pages) a) b) c"""))
def job2_source_uris(spark, sf_dir):
    """Source URIs classified (github / https / http / file / rejected) with the dataset path rule."""
    x = U.classify_sources(_src_urls(spark, sf_dir), "src")
    return x.select("page_id", "src", "source_type", "path", U.dataset_arg(F.col("src")).alias("dataset_arg"))


@register("job2_uri_inventory", with_views(f"""
SELECT scheme, host, count(*) AS uris, count(DISTINCT path) AS paths
FROM (SELECT lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, lower({_HOST}) AS host, {_PATH} AS path FROM pages) x
GROUP BY scheme, host"""))
def job2_uri_inventory(spark, sf_dir):
    """URIs by scheme and host."""
    return U.inventory(table(spark, sf_dir, "pages"), "url")


@register("src2_source_uris", with_views(f"""
SELECT page_id, kind, uri, CASE WHEN error IS NULL THEN scan END AS scan, error,
       concat_ws(';', CASE WHEN access_token IS NOT NULL THEN 'ACCESS_TOKEN=' || access_token END,
                      CASE WHEN cluster_size IS NOT NULL THEN 'CLUSTER_SIZE=' || cluster_size END,
                      CASE WHEN endpoint IS NOT NULL THEN 'ENDPOINT=' || endpoint END,
                      CASE WHEN ignore_patterns IS NOT NULL THEN 'IGNORE_PATTERNS=' || ignore_patterns END,
                      CASE WHEN metadata_loc IS NOT NULL THEN 'METADATA_LOC=' || metadata_loc END) AS options
FROM (SELECT page_id, uri, kind,
        CASE WHEN kind IS NULL THEN 'unsupported scheme'
             WHEN kind = 'hf' AND path = '' THEN 'hf uri needs hf://<owner>/<name>'
             WHEN kind = 'cache' AND len(string_split(substr(uri, 9), '/')) <> 2 THEN 'cache uri needs cache://<schema>/<table>'
             WHEN kind = 'cache' AND NOT (nodes > 1) THEN 'num_data_nodes must be greater than 1' END AS error,
        CASE kind WHEN 'hf' THEN concat('/mnt/hf/', host, path) WHEN 's3' THEN concat('s3a://', substr(uri, 6))
                  WHEN 'cache' THEN array_to_string(string_split(substr(uri, 9), '/'), '.') END AS scan,
        CASE WHEN page_id % 3 = 0 THEN concat('tok-', page_id) END AS access_token,
        CASE WHEN kind = 'cache' THEN CAST(nodes + 1 AS VARCHAR) END AS cluster_size,
        CASE WHEN kind = 's3' THEN concat('https://', host) END AS endpoint,
        CASE WHEN page_id % 2 = 0 THEN '*.bin,*.h5' END AS ignore_patterns,
        CASE WHEN kind = 'cache' THEN concat('s3://meta/', page_id, '.json') END AS metadata_loc
      FROM (SELECT page_id, uri, nodes,
              CASE WHEN starts_with(uri, 'hf://') THEN 'hf' WHEN starts_with(uri, 's3://') THEN 's3'
                   WHEN starts_with(uri, 'cache://') THEN 'cache' END AS kind,
              regexp_extract(uri, '{U.HOST_RE}', 1) AS host, regexp_extract(uri, '{U.PATH_RE}', 1) AS path
            FROM (SELECT page_id, 1 + page_id % 3 AS nodes,
                    CASE page_id % 4 WHEN 0 THEN concat('hf://', {_HOST}, {_PATH})
                                     WHEN 1 THEN concat('s3://', {_HOST}, {_PATH})
                                     WHEN 2 THEN concat('cache://sch', page_id % 5, '/tbl', page_id,
                                                        CASE WHEN page_id % 8 = 6 THEN '/extra' ELSE '' END)
                                     ELSE url END AS uri FROM pages) a) b) c"""))
def src2_source_uris(spark, sf_dir):
    """Initializer URIs resolved to scans, validated, with their option maps."""
    pg = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = F.regexp_extract("url", U.HOST_RE, 1), F.regexp_extract("url", U.PATH_RE, 1)
    pid = F.col("page_id")
    uri = (F.when(pid % 4 == 0, F.concat(F.lit("hf://"), host, path))
           .when(pid % 4 == 1, F.concat(F.lit("s3://"), host, path))
           .when(pid % 4 == 2, F.concat(F.lit("cache://sch"), pid % 5, F.lit("/tbl"), pid,
                                        F.when(pid % 8 == 6, F.lit("/extra")).otherwise(F.lit(""))))
           .otherwise(F.col("url")))
    x = pg.select("page_id", uri.alias("uri"), (F.lit(1) + pid % 3).alias("nodes"))
    kind, scan, err = U.resolve(F.col("uri"), F.col("nodes"))
    x = x.select("*", kind.alias("kind"), scan.alias("scan"), err.alias("error"))
    uhost = F.regexp_extract("uri", U.HOST_RE, 1)
    raw = F.create_map(
        F.lit("access_token"), F.when(pid % 3 == 0, F.concat(F.lit("tok-"), pid)),
        F.lit("cluster_size"), F.when(F.col("kind") == "cache", (F.col("nodes") + 1).cast("string")),
        F.lit("endpoint"), F.when(F.col("kind") == "s3", F.concat(F.lit("https://"), uhost)),
        F.lit("ignore_patterns"), F.when(pid % 2 == 0, F.array_join(F.array(F.lit("*.bin"), F.lit("*.h5")), ",")),
        F.lit("metadata_loc"), F.when(F.col("kind") == "cache", F.concat(F.lit("s3://meta/"), pid, F.lit(".json"))))
    return x.select("page_id", "kind", "uri", "scan", "error", U.options_text(U.option_map(raw)).alias("options"))


@register("prj2_runtime_documents_cluster", with_views("""
SELECT name, pos, framework, CAST(CASE WHEN pos % 4 <> 0 THEN num_nodes ELSE 1 END AS BIGINT) AS num_nodes,
       CASE WHEN pos % 6 = 4 THEN NULL ELSE image END AS image, CASE WHEN framework = 'torchtune' THEN 'BuiltinTrainer' ELSE 'CustomTrainer' END AS trainer_type,
       CASE WHEN framework = 'torchtune' THEN 'tune run' WHEN pos % 5 = 1 THEN 'torchrun' WHEN pos % 5 = 2 THEN 'mpirun' ELSE 'python' END AS command,
       CASE WHEN coalesce(name, '') = '' THEN 'missing name'
            WHEN coalesce(framework, '') = '' THEN 'missing framework'
            WHEN pos % 6 = 4 OR image IS NULL THEN 'no trainer container' END AS error
FROM v_catalog""", "v_catalog"))
def prj2_runtime_documents_cluster(spark, sf_dir):
    """The same documents read the cluster way: the first container ``node`` of
    the replicated jobs with the ancestor label, initializers included (no fallback)."""
    docs = C.runtime_documents(V.catalog(spark, sf_dir))
    return C.parse_runtime_documents(docs, "doc", keep=["pos"], mode="cluster").select(
        "name", "pos", "framework", "num_nodes", "image", "trainer_type", "command", "error")
