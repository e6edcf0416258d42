"""Runtime catalogs (PRJ-2, WIN-1, JON-5).

Runtime documents are JSON text shaped like the cluster's runtime objects.
Flattening uses higher-order functions over the nested arrays (no explode,
no shuffle); priority dedup is one ``min_by`` per name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: document kinds and the trainer group's name
RUNTIME_KINDS = ("ClusterTrainingRuntime", "TrainingRuntime")
NODE = "node"
TORCHTUNE = "torchtune"
# label keys of our runtime documents; pass your documents' keys to the parser
FRAMEWORK_LABEL = "trainer/framework"
ANCESTOR_LABEL = "trainer/ancestor-step"

_CONTAINER = T.StructType([T.StructField("name", T.StringType()), T.StructField("image", T.StringType())])
_POD_SPEC = T.StructType([T.StructField("containers", T.ArrayType(_CONTAINER))])
_RJOB = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("template", T.StructType([
        T.StructField("metadata", T.StructType([T.StructField("labels", T.MapType(T.StringType(), T.StringType()))])),
        T.StructField("spec", T.StructType([
            T.StructField("template", T.StructType([T.StructField("spec", _POD_SPEC)]))]))])),
])
RUNTIME_DOC_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("metadata", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    ])),
    T.StructField("spec", T.StructType([
        T.StructField("mlPolicy", T.StructType([
            T.StructField("numNodes", T.StringType()),  # a number, quoted or not
            T.StructField("torch", T.MapType(T.StringType(), T.StringType())),
            T.StructField("mpi", T.MapType(T.StringType(), T.StringType()))])),
        T.StructField("template", T.StructType([T.StructField("spec", T.StructType([
            T.StructField("replicatedJobs", T.ArrayType(_RJOB))]))])),
    ])),
])


def _has_image(c: Column) -> Column:
    return c["image"].isNotNull() & (c["image"] != "")


def parse_runtime_documents(docs: DataFrame, doc_col: str = "doc", keep: list[str] | tuple = (),
                            mode: str = "files", framework_label: str = FRAMEWORK_LABEL,
                            ancestor_label: str = ANCESTOR_LABEL) -> DataFrame:
    """Flatten runtime documents: name, framework, num_nodes (default 1), image.

    ``files`` (catalog files): the replicated job named ``node``; image of its
    container ``node`` if it has one, else of the first container with one; the
    document kind must be a runtime kind. ``cluster`` (objects read from the
    cluster API): of all replicated jobs that carry the ancestor label the first
    container ``node``. ``error`` names the first failed check; malformed
    JSON is rejected, never fatal."""
    if mode not in ("files", "cluster"):
        raise ValueError(f"mode must be files or cluster, got {mode!r}")
    d = F.from_json(F.col(doc_col), RUNTIME_DOC_SCHEMA)
    x = docs.select(*keep, d.alias("d"))
    rjobs = F.col("d.spec.template.spec.replicatedJobs")
    if mode == "files":
        trainer_job = F.try_element_at(F.filter(rjobs, lambda j: j["name"] == NODE), F.lit(1))
    else:
        trainer_job = F.filter(rjobs, lambda j: F.coalesce(
            F.map_contains_key(j["template"]["metadata"]["labels"], ancestor_label), F.lit(False)))
        trainer_job = F.when(F.size(trainer_job) > 0, trainer_job)  # all labelled jobs; the first container ``node`` counts
    if mode == "files":
        containers = trainer_job["template"]["spec"]["template"]["spec"]["containers"]
    else:
        containers = F.flatten(F.transform(trainer_job, lambda j: F.coalesce(
            j["template"]["spec"]["template"]["spec"]["containers"], F.array().cast(_POD_SPEC["containers"].dataType))))
    node_img = F.try_element_at(F.filter(containers, lambda c: (c["name"] == NODE) & _has_image(c)), F.lit(1))["image"]
    if mode == "files":
        img = F.coalesce(node_img, F.try_element_at(F.filter(containers, _has_image), F.lit(1))["image"])
    else:
        img = F.nullif(F.try_element_at(F.filter(containers, lambda c: c["name"] == NODE), F.lit(1))["image"], F.lit(""))
    framework = F.col("d.metadata.labels")[framework_label]
    blank = F.col("d").isNull() | (F.col("d.kind").isNull() & F.col("d.metadata").isNull() & F.col("d.spec").isNull())
    bad_kind = ~F.coalesce(F.col("d.kind").isin(*RUNTIME_KINDS), F.lit(False)) | F.col("d.metadata").isNull()
    if mode == "cluster":
        bad_kind = F.col("d.metadata").isNull()
    err = (F.when(blank, F.lit("malformed document"))
           .when(bad_kind, F.lit("not a runtime document"))
           .when(F.coalesce(F.col("d.metadata.name"), F.lit("")) == "", F.lit("missing name"))
           .when(F.coalesce(framework, F.lit("")) == "", F.lit("missing framework"))
           .when(trainer_job.isNull(), F.lit("no node job" if mode == "files" else "no trainer job"))
           .when(F.coalesce(F.size(containers), F.lit(0)) <= 0, F.lit("no containers"))
           .when(img.isNull(), F.lit("no image" if mode == "files" else "no trainer container")))
    return x.select(*keep,
                    F.col("d.metadata.name").alias("name"),
                    framework.alias("framework"),
                    F.coalesce(F.col("d.spec.mlPolicy.numNodes").try_cast("bigint"), F.lit(1)).alias("num_nodes"),
                    img.alias("image"),
                    F.when(framework == TORCHTUNE, F.lit("BuiltinTrainer")).otherwise(F.lit("CustomTrainer")).alias("trainer_type"),
                    trainer_command(framework, F.col("d.spec.mlPolicy.torch").isNotNull(),
                                    F.col("d.spec.mlPolicy.mpi").isNotNull()).alias("command"),
                    err.alias("error"))


def trainer_command(framework: Column, torch: Column, mpi: Column) -> Column:
    """The trainer's entry point by framework and policy, as its first words
    (the script that embeds a function's source is not part of it)."""
    return (F.when(framework == TORCHTUNE, F.lit("tune run")).when(torch, F.lit("torchrun"))
            .when(mpi, F.lit("mpirun")).otherwise(F.lit("python")))


def runtime_documents(catalog: DataFrame) -> DataFrame:
    """Render catalog rows (name, pos, framework, image, num_nodes) as runtime
    documents with three container layouts and some invalid kinds."""
    pos = F.col("pos")
    ancestor = F.struct(F.create_map(F.lit(ANCESTOR_LABEL), F.lit("trainer")).alias("labels")).alias("metadata")
    init_label = F.struct(F.create_map(F.lit(ANCESTOR_LABEL), F.lit("dataset-initializer")).alias("labels")).alias("metadata")
    init_job = F.struct(F.lit("initializer").alias("name"), F.struct(init_label, F.struct(F.struct(F.struct(F.array(
        F.struct(F.lit("init").alias("name"), F.lit("img/init").alias("image"))).alias("containers")).alias("spec"))
        .alias("template")).alias("spec")).alias("template"))

    def rjob(containers):
        return F.struct(F.lit(NODE).alias("name"), F.struct(ancestor, F.struct(F.struct(F.struct(
            containers.alias("containers")).alias("spec")).alias("template")).alias("spec")).alias("template"))

    def cont(name, image):
        return F.struct(F.lit(name).alias("name"), image.alias("image"))

    none_map = F.lit(None).cast("map<string,string>")
    img = F.col("image")
    none = F.lit(None).cast("string")
    jobs = (F.when(pos % 3 == 0, F.array(rjob(F.array(cont("node", img)))))
            .when(pos % 6 == 1, F.array(init_job, rjob(F.array(cont("sidecar", none), cont("node", img)))))
            .when(pos % 6 == 4, F.array(init_job, rjob(F.array(cont("sidecar", none), cont("trainer", img)))))
            .otherwise(F.array(rjob(F.array(cont("init", F.lit("img/init")), cont("node", img))))))
    labels = F.when(F.col("framework").isNull(), F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(F.lit(FRAMEWORK_LABEL), F.col("framework")))
    doc = F.struct(
        F.when(pos % 11 == 0, F.lit("Deployment")).otherwise(F.lit(RUNTIME_KINDS[0])).alias("kind"),
        F.struct(F.col("name").alias("name"), labels.alias("labels")).alias("metadata"),
        F.struct(F.struct(F.when(pos % 4 != 0, F.col("num_nodes").cast("string")).alias("numNodes"),
                          F.when(pos % 5 == 1, F.create_map(F.lit("numProcPerNode"), F.lit("2"))).otherwise(none_map).alias("torch"),
                          F.when(pos % 5 == 2, F.create_map(F.lit("numProcPerNode"), F.lit("4"))).otherwise(none_map).alias("mpi"))
                 .alias("mlPolicy"),
                 F.struct(F.struct(jobs.alias("replicatedJobs")).alias("spec")).alias("template")).alias("spec"))
    return catalog.select("*", F.to_json(doc).alias("doc"))


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """WIN-1: per key the row with the smallest ``order`` (priority, position).
    One mergeable ``min_by``: partial aggregation, no window, no sort."""
    cols = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*[F.col(c) for c in order])).alias("w"))
    return best.select(key, "w.*")


def with_defaults(found: DataFrame, defaults: DataFrame, key: str = "name") -> DataFrame:
    """JON-5: built-in rows only where no source gave that name."""
    missing = defaults.join(found.select(key), key, "left_anti")
    return found.unionByName(missing, allowMissingColumns=True)
