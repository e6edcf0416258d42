"""Registered data-preparation queries (SRC-1, SRC-3, SRC-4, DAT-1..4, PRJ-3,
PRJ-4, HPO-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparksweep.functions import render as RD
from sparksweep.operators import datasets as D
from sparksweep.plans import space as SP
from sparksweep.plans import views as V
from sparksweep.plans.registry import register
from sparksweep.plans.views import table, with_views
from sparksweep.session import shared_dir
from sparksweep.sources import files as FL
from sparksweep.sources import formats as FM

DOC_COLS = ["doc_id", "lang", "source", "n_chars", "text"]
_DOC_SQL = "SELECT doc_id, lang, source, n_chars, length(text) AS text_len, md5(text) AS text_md5 FROM documents"


def _round_trip(fmt):
    def q(spark, sf_dir):
        docs = table(spark, sf_dir, "documents").select(*DOC_COLS)
        path = shared_dir(spark, f"docs-{fmt}")
        options = {"multiLine": "true"} if fmt == "csv" else {}  # texts hold line breaks
        FM.write_dataset(docs, path, fmt)
        schema = "doc_id bigint, lang string, source string, n_chars bigint, text string"
        back = FM.read_dataset(spark, path, fmt, schema=None if fmt in ("parquet", "arrow") else schema, options=options)
        return back.select("doc_id", "lang", "source", "n_chars", F.length("text").cast("bigint").alias("text_len"),
                           F.md5("text").alias("text_md5"))
    q.__doc__ = f"Documents written as {fmt} and read back by declared format."
    return q


for _fmt in ("json", "csv", "parquet", "xml", "arrow"):
    register(f"src1_read_{_fmt}", _DOC_SQL)(_round_trip(_fmt))


@register("src1_read_text", with_views("""
SELECT line, count(*) AS n FROM (
  SELECT unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL AND length(text) > 0) x
GROUP BY line"""))
def src1_read_text(spark, sf_dir):
    """Document texts written as text and read back as lines (counted per line)."""
    path = shared_dir(spark, "docs-text")
    FM.write_dataset(table(spark, sf_dir, "documents").select("text"), path, "text")
    lines = FM.read_dataset(spark, path, "text")
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@register("src3_choose_files", with_views("""
SELECT page_id, file_name FROM v_files
WHERE file_name NOT LIKE '%.msgpack' AND file_name NOT LIKE '%.h5' AND file_name NOT LIKE '%.bin'
  AND file_name <> '.pt' AND file_name <> '.pth'""", "v_files"))
def src3_choose_files(spark, sf_dir):
    """Files left after the default ignore patterns (``.pt`` only drops a file named ``.pt``)."""
    return D.choose_files(V.files(spark, sf_dir)).select("page_id", "file_name")


_EXT = {0: ".bin", 1: ".h5", 2: ".pt", 3: "", 4: ".msgpack", 5: ".safetensors", 6: ".json"}
_EXT_SQL = "CASE page_id % 7 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _EXT.items()) + " END"
_FILE_SQL = f"""SELECT concat(page_id % 16, '/', page_id % 3, '/', page_id, {_EXT_SQL}) AS path, page_id, coalesce(html, '') AS html,
       page_id % 7 NOT IN (0, 1, 4) AS chosen FROM pages"""


def _page_files(spark, sf_dir):
    pg = table(spark, sf_dir, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("html"))
    pid = F.col("page_id")
    ext = V._case(pid % 7, _EXT)
    return pg.select(F.concat(pid % 16, F.lit("/"), pid % 3, F.lit("/"), pid, ext).alias("path"), "page_id", "html")


@register("src3_file_manifest", f"""
SELECT path, strlen(html) AS size, sha256(html) AS sha256 FROM ({_FILE_SQL}) f WHERE chosen""")
def src3_file_manifest(spark, sf_dir):
    """Pages landed as a tree of files, listed and hashed in tasks, without the ignored ones."""
    path = shared_dir(spark, "page-files")
    FL.write_files(_page_files(spark, sf_dir).select("path", F.encode("html", "utf-8").alias("content")), path)
    return FL.file_manifest(spark, path).select("path", "size", "sha256")


@register("src3_manifest_diff", f"""
SELECT CASE WHEN page_id % 5 = 2 THEN 'new/' || path ELSE path END AS path,
       CASE page_id % 5 WHEN 0 THEN 'gone' WHEN 1 THEN 'changed' ELSE 'added' END AS change,
       CASE WHEN page_id % 5 IN (0, 1) THEN strlen(html) END AS old_size,
       CASE page_id % 5 WHEN 1 THEN strlen(html) + 1 WHEN 2 THEN strlen(html) END AS size
FROM ({_FILE_SQL}) f WHERE chosen AND page_id % 5 IN (0, 1, 2)
UNION ALL SELECT path, 'gone', strlen(html), NULL FROM ({_FILE_SQL}) f WHERE chosen AND page_id % 5 = 2""")
def src3_manifest_diff(spark, sf_dir):
    """What changed between two manifests: of five pages one is gone, one is longer, one has moved."""
    old, new = shared_dir(spark, "page-files"), shared_dir(spark, "page-files-later")
    files = _page_files(spark, sf_dir)
    FL.write_files(files.select("path", F.encode("html", "utf-8").alias("content")), old)
    m = F.col("page_id") % 5
    later = files.where(m != 0).select(F.when(m == 2, F.concat(F.lit("new/"), "path")).otherwise(F.col("path")).alias("path"),
                                       F.encode(F.when(m == 1, F.concat("html", F.lit("+"))).otherwise(F.col("html")), "utf-8").alias("content"))
    FL.write_files(later, new)
    found = FL.manifest_diff(FL.file_manifest(spark, old), FL.file_manifest(spark, new))
    return found.select("path", "change", "old_size", "size")


@register("src4_cached_table", with_views("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"""))
def src4_cached_table(spark, sf_dir):
    """Orders saved as the catalog table of cache://tpch/orders, bucketed by key, and read from it."""
    src = D.CacheSource("cache://tpch/orders", 3)
    cached = D.cached_table(table(spark, sf_dir, "orders"), src, key="o_orderkey")
    return cached.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@register("src4_cached_join", """
SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS lines, coalesce(sum(l_quantity), 0) AS quantity
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus""")
def src4_cached_join(spark, sf_dir):
    """Orders and their lines from two cached tables, joined and grouped bucket by bucket."""
    sources = [("orders", "o_orderkey"), ("lineitem", "l_orderkey")]
    held = [(table(spark, sf_dir, t), D.CacheSource(f"cache://tpch/{t}", 3), key) for t, key in sources]
    n = max(D.buckets_for(df, source) for df, source, _ in held)
    orders, lines = (D.cached_table(df, source, key, buckets=n) for df, source, key in held)
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").groupBy("o_orderkey", "o_orderstatus").agg(
        F.count("l_orderkey").alias("lines"), F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("quantity"))


@register("dat1_column_map", with_views(
    "SELECT conv_id, turn, prompt AS input, answer AS output FROM v_pairs", "v_pairs"))
def dat1_column_map(spark, sf_dir):
    """Prompt / answer pairs mapped onto the ``input`` / ``output`` columns."""
    return D.column_map(V.pairs(spark, sf_dir), {"input": "prompt", "output": "answer"}, keep=["conv_id", "turn"])


SPLIT = "train[5%:-10%]"


@register("dat2_split_slice", with_views("""
SELECT doc_id, row_idx FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx,
                                    count(*) OVER () AS n FROM documents) x
WHERE row_idx >= CAST(round_even(5 * n / 100.0, 0) AS BIGINT) AND row_idx < n - CAST(round_even(10 * n / 100.0, 0) AS BIGINT)"""))
def dat2_split_slice(spark, sf_dir):
    """``train[5%:-10%]`` of the documents ordered by doc_id, scalable row index."""
    return D.split_slice(table(spark, sf_dir, "documents").select("doc_id"), SPLIT, ["doc_id"])


SYSTEM_PROMPT = "You are a helpful assistant."


@register("dat3_instruct_messages", with_views(f"""
SELECT conv_id, turn, 0 AS msg_no, 'system' AS role, '{SYSTEM_PROMPT}' AS content, true AS masked FROM v_pairs
UNION ALL SELECT conv_id, turn, 1, 'user', prompt, true FROM v_pairs
UNION ALL SELECT conv_id, turn, 2, 'assistant', answer, false FROM v_pairs""", "v_pairs"))
def dat3_instruct_messages(spark, sf_dir):
    """Instruct examples as chat messages: system, masked user prompt, answer."""
    pairs = D.column_map(V.pairs(spark, sf_dir), {"input": "prompt", "output": "answer"}, keep=["conv_id", "turn"])
    msgs = D.instruct_messages(pairs, ["conv_id", "turn"], train_on_input=False, new_system_prompt=SYSTEM_PROMPT)
    return D.explode_messages(msgs, ["conv_id", "turn"])


WORLD = 4  # 2 nodes x 2 processes


@register("dat4_shards", with_views(f"""
SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % {WORLD} AS INTEGER) AS rank FROM documents"""))
def dat4_shards(spark, sf_dir):
    """Documents sharded over 2 nodes x 2 processes by the row index."""
    x = D.shard(table(spark, sf_dir, "documents").select("doc_id"), WORLD, order_cols=["doc_id"])
    return x.select("doc_id", "rank")


def _configs(spark, sf_dir):
    j = F.col("job_no")
    jobs = V.jobs(spark, sf_dir)
    return jobs.select(
        "job",
        F.when(j % 3 == 0, F.lit("bf16")).when(j % 3 == 1, F.lit("fp32")).alias("dtype"),
        (j % 8).alias("batch_size"),
        (F.lit(1) + j % 3).alias("epochs"),
        F.when(j % 2 == 0, F.lit("torchtune.modules.loss.CEWithChunkedOutputLoss")).alias("loss"),
        (j % 5 == 0).alias("apply_lora_to_mlp"),
        (j % 16).alias("lora_rank"),
        (2 * (j % 16)).alias("lora_alpha"),
        ((j % 4).cast("double") / F.lit(10.0)).alias("lora_dropout"),
        F.when(j % 3 == 0, F.array(F.lit("q_proj"), F.lit("v_proj")))
        .when(j % 3 == 1, F.array().cast("array<string>"))
        .otherwise(F.array(F.lit("q_proj"), F.lit("v_proj"), F.lit("output_proj"))).alias("lora_attn_modules"),
        F.when(j % 4 == 0, F.lit("train[:10%]")).alias("dataset_split"),
        (j % 6 == 0).alias("dataset_train_on_input"),
        F.when(j % 9 == 0, F.create_map(F.lit("input"), F.lit("question"), F.lit("output"), F.lit("answer"))).alias("dataset_column_map"),
        F.when(j % 4 == 0, F.lit("hf://owner/name/data/part.parquet")).when(j % 4 == 1, F.lit("owner/name"))
        .when(j % 4 == 2, F.lit("owner/name/sub")).alias("source"),
    )


@register("prj3_trainer_args", with_views("""
SELECT job, concat_ws(' ',
  CASE WHEN job_no % 3 = 0 THEN 'dtype=bf16' WHEN job_no % 3 = 1 THEN 'dtype=fp32' END,
  CASE WHEN job_no % 8 <> 0 THEN 'batch_size=' || (job_no % 8) END,
  'epochs=' || (1 + job_no % 3),
  CASE WHEN job_no % 2 = 0 THEN 'loss=torchtune.modules.loss.CEWithChunkedOutputLoss' END,
  CASE job_no % 4 WHEN 0 THEN 'dataset.data_files=/workspace/dataset/data/part.parquet' WHEN 1 THEN 'dataset.data_dir=/workspace/dataset/.'
                  WHEN 2 THEN 'dataset.data_dir=/workspace/dataset/sub' END,
  CASE WHEN job_no % 5 = 0 THEN 'model.apply_lora_to_mlp=True' END,
  CASE WHEN job_no % 16 <> 0 THEN 'model.lora_rank=' || (job_no % 16) END,
  CASE WHEN job_no % 16 <> 0 THEN 'model.lora_alpha=' || (2 * (job_no % 16)) END,
  CASE WHEN job_no % 4 <> 0 THEN 'model.lora_dropout=' || CAST(CAST(job_no % 4 AS DOUBLE) / 10.0 AS VARCHAR) END,
  CASE WHEN job_no % 3 = 0 THEN 'model.lora_attn_modules=[q_proj,v_proj]'
       WHEN job_no % 3 = 2 THEN 'model.lora_attn_modules=[q_proj,v_proj,output_proj]' END,
  'dataset=torchtune.datasets.instruct_dataset',
  CASE WHEN job_no % 4 = 0 THEN 'dataset.split=train[:10%]' END,
  CASE WHEN job_no % 6 = 0 THEN 'dataset.train_on_input=True' END,
  CASE WHEN job_no % 9 = 0 THEN 'dataset.column_map={''input'': ''question'', ''output'': ''answer''}' END) AS args
FROM v_jobs""", "v_jobs"))
def prj3_trainer_args(spark, sf_dir):
    """Every job's fine-tuning config rendered as ``key=value`` overrides, falsy values dropped."""
    cfg = _configs(spark, sf_dir)
    return cfg.select("job", RD.trainer_args(cfg.schema, with_dataset=True, source=F.col("source")).alias("args"))


TEMPLATE = "python train.py --lr ${trialParameters.lr} --epochs ${trialParameters.epochs}"


@register("prj4_bind_parameters", with_views("""
SELECT job,
       concat_ws(';', 'batch=32', 'epochs=' || (1 + job_no % 5), 'lr=0.0' || (job_no % 10),
                 CASE WHEN job_no % 2 = 1 THEN 'seed=7' END) AS args,
       'python train.py --lr 0.0' || (job_no % 10) || ' --epochs ' || (1 + job_no % 5) AS command
FROM v_jobs""", "v_jobs"))
def prj4_bind_parameters(spark, sf_dir):
    """Trial parameters override and extend the base arguments; placeholders filled."""
    j = F.col("job_no")
    x = V.jobs(spark, sf_dir).select(
        "job", F.concat(F.lit("0.0"), j % 10).alias("lr"), (F.lit(1) + j % 5).cast("string").alias("epochs"),
        (j % 2 == 0).alias("drop_seed"))
    params = F.create_map(F.lit("lr"), F.col("lr"), F.lit("epochs"), F.col("epochs"))
    base = F.when(F.col("drop_seed"), F.create_map(F.lit("lr"), F.lit("0.1"), F.lit("batch"), F.lit("32"))).otherwise(
        F.create_map(F.lit("lr"), F.lit("0.1"), F.lit("batch"), F.lit("32"), F.lit("seed"), F.lit("7")))
    merged = RD.bind_parameters(base, params)
    from sparksweep.sources.uris import options_text
    return x.select("job", options_text(merged).alias("args"),
                    RD.fill_placeholders(F.lit(TEMPLATE), ["lr", "epochs"]).alias("command"))


@register("hpo9_search_space_readback", with_views("""
SELECT experiment, param, kind,
       CASE WHEN continuous THEN lo END AS "min", CASE WHEN continuous THEN hi END AS "max",
       CASE WHEN continuous THEN distribution END AS distribution,
       CASE WHEN NOT continuous THEN array_to_string(string_split(choices_text, ','), '|') END AS choices,
       CASE WHEN NOT continuous AND choices_text IS NULL THEN 'no choices'
            WHEN continuous AND (min_text IS NULL OR max_text IS NULL OR distribution IS NULL) THEN 'bounds or distribution missing'
            WHEN continuous AND (lo IS NULL OR hi IS NULL) THEN 'bound is not a number'
            WHEN continuous AND distribution NOT IN ('uniform', 'logUniform') THEN 'unknown distribution' END AS error
FROM (SELECT *, kind <> 'categorical' AS continuous,
             TRY_CAST(trim(min_text) AS DOUBLE) AS lo, TRY_CAST(trim(max_text) AS DOUBLE) AS hi
      FROM (SELECT p_brand AS experiment, concat('param_', p_partkey) AS param,
                   CASE WHEN p_partkey % 13 = 0 THEN 'float16' WHEN p_size % 4 = 0 THEN 'double'
                        WHEN p_size % 4 = 1 THEN 'int' WHEN p_size % 4 = 2 THEN 'categorical' ELSE 'discrete' END AS kind,
                   CASE WHEN p_partkey % 9 = 0 THEN 'abc' WHEN p_partkey % 11 = 0 THEN NULL
                        ELSE CAST(p_retailprice / 1000 AS VARCHAR) END AS min_text,
                   CASE WHEN p_partkey % 19 = 0 THEN CAST(p_retailprice / 1000 AS VARCHAR)
                        ELSE CAST(p_retailprice / 100 AS VARCHAR) END AS max_text,
                   CASE WHEN p_partkey % 17 = 0 THEN 'normal' WHEN p_size % 3 = 0 THEN 'logUniform' ELSE 'uniform' END AS distribution,
                   CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE concat_ws(',', lower(p_type), p_brand, CAST(p_size AS VARCHAR)) END AS choices_text
            FROM part) s) t"""))
def hpo9_search_space_readback(spark, sf_dir):
    """Stored search-space settings read back to typed values, problems as error rows."""
    return SP.read_back_space(SP.settings_from_part(table(spark, sf_dir, "part")))


@register("hpo9_algorithm_readback", with_views("""
SELECT experiment,
       CASE algorithm WHEN 'random' THEN 'RandomSearch' WHEN 'grid' THEN 'GridSearch' END AS algorithm,
       CASE WHEN algorithm = 'random' THEN TRY_CAST(trim(random_state) AS BIGINT) END AS random_state,
       CASE WHEN algorithm IS NULL OR algorithm NOT IN ('random', 'grid') THEN 'unknown algorithm: ' || coalesce(algorithm, 'none')
            WHEN algorithm = 'random' AND TRY_CAST(trim(random_state) AS BIGINT) IS NULL THEN 'random_state is not an integer' END AS error
FROM (SELECT DISTINCT p_brand AS experiment,
             CASE right(p_brand, 1) WHEN '1' THEN 'grid' WHEN '2' THEN 'Random' WHEN '4' THEN NULL ELSE 'random' END AS algorithm,
             CASE WHEN right(p_brand, 1) = '3' THEN 'x7' ELSE right(p_brand, 2) END AS random_state
      FROM part) a"""))
def hpo9_algorithm_readback(spark, sf_dir):
    """Stored algorithm settings per experiment read back; unknown names are errors."""
    b = F.col("p_brand")
    last = F.substring(b, -1, 1)
    algos = table(spark, sf_dir, "part").select(
        b.alias("experiment"),
        F.when(last == "1", F.lit("grid")).when(last == "2", F.lit("Random")).when(last != "4", F.lit("random")).alias("algorithm"),
        F.when(last == "3", F.lit("x7")).otherwise(F.substring(b, -2, 2)).alias("random_state")).distinct()
    return SP.read_back_algorithm(algos)
