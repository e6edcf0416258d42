"""Training-data preparation (SRC-3, SRC-4, DAT-1..4).

The row index of split slices and shards is the range-partitioned index of
``ordinal.with_row_index``: no global window, no single task, and the only
thing the driver sees is one count per partition.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksweep.operators.ordinal import with_row_index
from sparksweep.session import plan_bytes, shared_dir

# fixed value: the model initializer's default ignore patterns (".pt" has no "*": kept as is)
DEFAULT_IGNORE_PATTERNS = ["*.msgpack", "*.h5", "*.bin", ".pt", ".pth"]


# ---------------------------------------------------------------- SRC-3

GLOB_TOKEN = re.compile(r"(?P<set>\[(?P<not>!?)(?P<body>\]?[^\]]*)\])|(?P<any>\*+)|(?P<one>\?)|(?P<text>[^*?\[]+|\[)", re.S)


def glob_to_regex(pattern: str) -> str:
    """A shell glob (``*``, ``?``, ``[..]``, ``[!..]``) as an anchored Java regex:
    one regular expression cuts the glob into tokens, each of which has its Java form."""
    def java(m: re.Match) -> str:
        if m["set"]:
            body = re.sub(r"([\\\[\]^&])", r"\\\1", m["body"])  # special inside a Java class
            return f"[{'^' if m['not'] else ''}{body}]"
        return ".*" if m["any"] else "." if m["one"] else re.sub(r"(\W)", r"\\\1", m["text"])

    return "(?s)^" + GLOB_TOKEN.sub(java, pattern) + r"\z"


def excluded(name: Column, patterns: list[str] | None) -> Column:
    pats = DEFAULT_IGNORE_PATTERNS if patterns is None else patterns
    if not pats:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [name.rlike(glob_to_regex(p)) for p in pats])


def choose_files(files: DataFrame, name_col: str = "file_name", patterns: list[str] | None = None) -> DataFrame:
    """Files whose base name matches no ignore pattern."""
    return files.filter(~excluded(F.col(name_col), patterns))


# ---------------------------------------------------------------- SRC-4

BUCKET_BYTES = 128 << 20
CACHE_URI = re.compile(r"cache://([^/]*)/([^/]*)")


@dataclass(frozen=True)
class CacheSource:
    """``cache://<schema>/<table>`` spread over ``num_data_nodes`` (> 1) nodes."""
    storage_uri: str
    num_data_nodes: int
    metadata_loc: str | None = None

    def __post_init__(self):
        if not CACHE_URI.fullmatch(self.storage_uri):
            raise ValueError(f"not a cache table (cache://schema/table): {self.storage_uri!r}")
        if self.num_data_nodes < 2:
            raise ValueError(f"a cached table needs 2 data nodes or more, not {self.num_data_nodes}")

    @property
    def table_name(self) -> str:
        return ".".join(CACHE_URI.fullmatch(self.storage_uri).groups())

    @property
    def cluster_size(self) -> int:
        return self.num_data_nodes + 1


def buckets_for(df: DataFrame, source: CacheSource, bucket_bytes: int = BUCKET_BYTES) -> int:
    """A power of two that gives buckets of about ``bucket_bytes`` by the size of the tables that ``df`` reads, and at
    least one bucket per data node. Tables to be joined bucket by bucket need the same number: pass the largest to all."""
    size = plan_bytes(df)
    return 1 << min(16, (max(source.num_data_nodes, -(-size // bucket_bytes)) - 1).bit_length())


def cached_table(df: DataFrame, source: CacheSource, key: str | None = None, buckets: int | None = None) -> DataFrame:
    """Save ``df`` as the catalog table of ``source`` below the shared folder, replacing an earlier one, and read it.
    With ``key`` the table is bucketed and sorted by it, one file per bucket, so that jobs which join or group it
    by the key read it as it lies, without exchange. It outlives lost executors; drop it with ``drop_cached``."""
    spark = df.sparkSession
    n = buckets or buckets_for(df, source)
    schema = source.table_name.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{shared_dir(spark, 'cache-' + schema)}'")
    rows = (df.repartition(n, key) if key else df.repartition(n)).write.option("path", shared_dir(spark, "cache")).mode("overwrite")
    (rows.bucketBy(n, key).sortBy(key) if key else rows).format("parquet").saveAsTable(_quoted(source))
    return spark.table(_quoted(source))


def drop_cached(spark: SparkSession, source: CacheSource) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(source)}")


def _quoted(source: CacheSource) -> str:
    return ".".join(f"`{p}`" for p in source.table_name.split("."))


# ---------------------------------------------------------------- DAT-1

def column_map(df: DataFrame, mapping: dict | None, keep: list[str] | tuple = (),
               allowed=("input", "output")) -> DataFrame:
    """``{"input": a, "output": b}``: rename source columns to the expected
    names; missing keys keep their default names. Unknown keys or columns are errors."""
    mapping = dict(mapping or {})
    bad = [k for k in mapping if k not in allowed]
    if bad:
        raise ValueError(f"unknown column_map keys {bad}; allowed {list(allowed)}")
    src = {k: mapping.get(k, k) for k in allowed}
    missing = [c for c in src.values() if c not in df.columns]
    if missing:
        raise ValueError(f"column_map names missing columns {missing}")
    return df.select(*keep, *[F.col(c).alias(k) for k, c in src.items()])


# ---------------------------------------------------------------- DAT-2

_SPLIT = re.compile(r"^\s*(\w+)\s*(?:\[\s*(-?\d+%?)?\s*:\s*(-?\d+%?)?\s*\])?\s*$")


def parse_split(spec: str):
    """``train``, ``train[:10%]``, ``train[10:20]``, ``train[-5%:]`` ->
    (name, start, end) with bounds as text (None = open)."""
    m = _SPLIT.match(spec or "")
    if not m:
        raise ValueError(f"invalid split {spec!r}")
    a, b = m.group(2), m.group(3)
    if a and b and a.endswith("%") != b.endswith("%"):
        raise ValueError(f"split bounds must both be percent or both absolute: {spec!r}")
    return m.group(1), a, b


def _bound(text: str | None, n: int, default: int) -> int:
    """Percent bounds are rounded to the closest row; negative counts from the end."""
    if text is None:
        return default
    v = int(round(int(text[:-1]) * n / 100.0)) if text.endswith("%") else int(text)
    if v < 0:
        v = n + v
    return max(0, min(n, v))


def split_bounds(spec: str, n: int) -> tuple[int, int]:
    _, a, b = parse_split(spec)
    return _bound(a, n, 0), _bound(b, n, n)


def split_slice(df: DataFrame, spec: str, order_cols: list[str], index_col: str = "row_idx") -> DataFrame:
    """Rows of ``spec`` in ``order_cols`` order (add a unique tie-break column)."""
    indexed = with_row_index(df, order_cols, index_col)
    n = indexed.count()
    lo, hi = split_bounds(spec, n)
    return indexed.filter((F.col(index_col) >= lo) & (F.col(index_col) < hi))


# ---------------------------------------------------------------- DAT-3

def instruct_messages(pairs: DataFrame, keep: list[str], train_on_input: bool = False,
                      new_system_prompt: str | None = None) -> DataFrame:
    """Chat messages per example: optional system message first, then the user
    prompt (masked unless ``train_on_input``), then the answer (never masked).
    Returns ``messages ARRAY<STRUCT<role, content, masked>>``."""
    def msg(role, content, masked):
        return F.struct(F.lit(role).alias("role"), content.alias("content"), F.lit(masked).alias("masked"))

    items = []
    if new_system_prompt:
        items.append(msg("system", F.lit(new_system_prompt), True))
    items += [msg("user", F.col("input"), not train_on_input), msg("assistant", F.col("output"), False)]
    return pairs.select(*keep, F.array(*items).alias("messages"))


def explode_messages(msgs: DataFrame, keep: list[str]) -> DataFrame:
    x = msgs.select(*keep, F.posexplode("messages").alias("msg_no", "m"))
    return x.select(*keep, "msg_no", "m.role", "m.content", "m.masked")


# ---------------------------------------------------------------- DAT-4

def shard(df: DataFrame, world_size: int, order_cols: list[str] | None = None,
          key: str | None = None, rank_col: str = "rank") -> DataFrame:
    """Every row to exactly one rank, same on every run. With ``order_cols``
    ranks are ``row_idx % world_size`` (sizes differ by at most one); with
    ``key`` ranks are ``pmod(xxhash64(key), world_size)`` (no index pass)."""
    if world_size < 1:
        raise ValueError("world_size must be >= 1")
    if order_cols:
        x = with_row_index(df, order_cols, "row_idx")
        return x.withColumn(rank_col, (F.col("row_idx") % world_size).cast("int"))
    if key:
        return df.withColumn(rank_col, F.pmod(F.xxhash64(F.col(key)), F.lit(world_size)).cast("int"))
    raise ValueError("shard needs order_cols or key")


def write_shards(df: DataFrame, path: str, rank_col: str = "rank", fmt: str = "parquet") -> None:
    df.repartition(rank_col).write.partitionBy(rank_col).mode("overwrite").format(fmt).save(path)
