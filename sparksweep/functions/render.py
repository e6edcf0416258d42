"""Config rendering and parameter binding as Column expressions (PRJ-3, PRJ-4).

A whole table of trial configs is rendered in one projection: each field
becomes ``key=value`` when truthy (NULL, 0, 0.0, false, "" and empty lists
are dropped), in a fixed field order; booleans print as ``True``, lists as
``[a,b]``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.sources.uris import dataset_arg

# fixed values: trainer argument names, in the order they are emitted
TRAINER_FIELDS = [
    ("dtype", "dtype"), ("batch_size", "batch_size"), ("epochs", "epochs"), ("loss", "loss"),
]
PEFT_FIELDS = [
    ("apply_lora_to_mlp", "model.apply_lora_to_mlp"),
    ("apply_lora_to_output", "model.apply_lora_to_output"),
    ("lora_rank", "model.lora_rank"),
    ("lora_alpha", "model.lora_alpha"),
    ("lora_dropout", "model.lora_dropout"),
    ("quantize_base", "model.quantize_base"),
    ("use_dora", "model.use_dora"),
]
LORA_MODULES_ARG = "model.lora_attn_modules"
INSTRUCT_DATASET = "torchtune.datasets.instruct_dataset"
DATASET_FIELDS = [
    ("source", "dataset.source"), ("split", "dataset.split"), ("train_on_input", "dataset.train_on_input"),
    ("new_system_prompt", "dataset.new_system_prompt"), ("column_map", "dataset.column_map"),
]
PLACEHOLDER = "${trialParameters.%s}"


def _text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("True")).otherwise(F.lit("False"))
    if isinstance(dtype, T.MapType):  # as Python prints a dict of texts
        quoted = F.transform(F.map_entries(c), lambda e: F.concat(F.lit("'"), e["key"], F.lit("': '"), e["value"], F.lit("'")))
        return F.concat(F.lit("{"), F.array_join(quoted, ", "), F.lit("}"))
    if isinstance(dtype, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(c, ","), F.lit("]"))
    return c.cast("string")


def truthy(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, (T.IntegralType, T.FractionalType)):
        return F.coalesce(c != 0, F.lit(False))
    if isinstance(dtype, T.StringType):
        return F.coalesce(c != "", F.lit(False))
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def arg(name: str, c: Column, dtype: T.DataType) -> Column:
    return F.when(truthy(c, dtype), F.concat(F.lit(name + "="), _text(c, dtype)))


def render_args(schema: T.StructType, fields: list[tuple[str, str]], dataset: str | None = None,
                modules_col: str | None = None) -> Column:
    """``ARRAY<STRING>`` of overrides for the named columns, falsy ones dropped."""
    types = {f.name: f.dataType for f in schema.fields}
    items = [arg(a, F.col(c), types[c]) for c, a in fields if c in types]
    if modules_col and modules_col in types:
        items.append(arg(LORA_MODULES_ARG, F.col(modules_col), types[modules_col]))
    return F.array_compact(F.array(*items)) if items else F.array().cast("array<string>")


def trainer_args(schema: T.StructType, with_dataset: bool = False, source: Column | None = None) -> Column:
    """Trainer, data path (of the ``source`` URI, where it isn't NULL), PEFT and
    (optionally) instruct-dataset overrides in the reference's emission order,
    joined with spaces."""
    path = F.array() if source is None else F.array_compact(F.array(F.when(source.isNotNull(), dataset_arg(source))))
    parts = [render_args(schema, TRAINER_FIELDS), path.cast("array<string>"), render_args(schema, PEFT_FIELDS, modules_col="lora_attn_modules")]
    if with_dataset:
        ds = [f"dataset_{c}" for c, _ in DATASET_FIELDS]
        types = {f.name: f.dataType for f in schema.fields}
        items = [F.lit(f"dataset={INSTRUCT_DATASET}")]
        items += [arg(a, F.col(c2), types[c2]) for (c, a), c2 in zip(DATASET_FIELDS, ds) if c2 in types]
        parts.append(F.array_compact(F.array(*items)))
    return F.array_join(reduce(F.concat, parts), " ")


def bind_parameters(base: Column, params: Column) -> Column:
    """PRJ-4: trial parameters override or extend the function arguments
    (both ``MAP<STRING,STRING>``)."""
    kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(params, k))
    return F.map_concat(kept, params)


def fill_placeholders(template: Column, names: list[str]) -> Column:
    """Replace ``${trialParameters.<name>}`` by the value of column ``<name>``."""
    out = template
    for n in names:
        out = F.replace(out, F.lit(PLACEHOLDER % n), F.coalesce(F.col(n).cast("string"), F.lit("")))
    return out
