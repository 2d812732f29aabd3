"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.session import checkpoint_dir


BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only a local-mode session
    without one (tests, one machine) gets a temporary folder, set once."""
    d = checkpoint_dir(spark)
    if d is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pluvio-llm-"))
        d = spark.sparkContext.getCheckpointDir()
    return d


def run_folder(spark: SparkSession) -> str:
    """The part of the shared folder that this application's intermediate tables are in."""
    return f"{shared_folder(spark)}/pluvio-llm/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> bool:
    """Delete the intermediate tables of this application. Results of operators read them:
    call it when these are written. Tables of an application that failed stay in a folder
    of its id, to be deleted by whoever keeps the shared folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the application's part of the shared folder and read
    it back: lineage is cut, every consumer sees the same rows, and a lost executor costs
    a re-read. The files stay until ``clear``."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    batch = spark.conf.get(BATCH)
    spark.conf.set(BATCH, BATCH_BYTES)  # texts go to Python workers in small batches
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH, batch)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, underscored until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add (an operator's own
    output replaces a clashing extra column)."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def widened(df: DataFrame, **fields: T.DataType) -> T.StructType:
    """The schema of ``df`` with nullable fields and these added."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema]
                        + [T.StructField(n, t, True) for n, t in fields.items()])


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids in the links (a[i], b[i]) of one task, and the smallest id that each
    reaches by them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        new = root.copy()
        np.minimum.at(new, u, root[v])
        np.minimum.at(new, v, root[u])
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (a long, b long): the smallest id
    reachable. Minimum labels travel along the edges and then jump to their own
    label, so a long chain halves with every round. Each round reads its inputs
    from stored tables, so both sides of each join have an exchange of their own
    and adaptive execution can split a hub's rows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    e = store(both.distinct())
    labels = store(e.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    while True:
        near = (e.join(labels, e["b"] == labels["id"]).groupBy("a")
                .agg(F.min("component").alias("near")))
        hooked = store(labels.join(near, labels["id"] == near["a"])
                       .select("id", F.col("component").alias("old"),
                               F.least("component", "near").alias("component")))
        above = hooked.select(F.col("id").alias("up"), F.col("component").alias("top"))
        jumped = store(hooked.join(above, hooked["component"] == above["up"])
                       .select("id", "old", F.least("component", "top").alias("component")))
        moved = jumped.filter(F.col("component") < F.col("old")).limit(1).count()
        labels = jumped.select("id", "component")
        if not moved:
            return labels
