"""Exact dedup by content sort.

Rows are range-partitioned by sampled splitters over their normalised content and
sorted externally, so equal texts lie side by side; each row is then compared in
full with its neighbour. The splitter key is a bounded piece of content (first
characters, then the digest of the whole normalised text, then the identifier), so
what the driver samples stays small whatever the text lengths, and a group of
copies of any size is cut over many partitions because the identifier is part of
the key, and after it a number drawn for the row, which cuts rows that repeat in both.
Runs that touch a partition's edge are put together afterwards by their
full text (at most two runs a partition).
"""
from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.common import fresh, partitions, store, without

OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")
SPACE = r"[\x20\x09-\x0D]+"
HEAD = 32  # characters of content at the front of the sort key


def normalised(text):
    """Each run of ASCII white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _runs(norm: str, out_schema: pa.Schema, names: tuple):
    """Numbers runs of equal neighbours in a sorted partition; ends with one
    marker row for the first and the last run, which carries the text."""
    run_c, first_c, mark_c = names

    def go(batches):
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 33
        run, last, ends = -1, None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            text = batch.column(batch.schema.get_field_index(norm))
            same = [last is not None and last == text[0].as_py()]
            if batch.num_rows > 1:
                same += pc.equal(text.slice(1), text.slice(0, batch.num_rows - 1)).to_pylist()
            runs = []
            for s in same:
                run += not s
                runs.append(base + run)
            if not ends:
                ends[base] = text[0].as_py()
            last = text[batch.num_rows - 1].as_py()
            cols = {run_c: pa.array(runs, pa.int64()), first_c: pa.array([not s for s in same]),
                    mark_c: pa.nulls(batch.num_rows, pa.string())}
            yield pa.RecordBatch.from_arrays(
                [cols[f.name] if f.name in cols else batch.column(batch.schema.get_field_index(f.name)).cast(f.type)
                 for f in out_schema], schema=out_schema)
        if ends:
            ends[base + run] = last
            k = len(ends)
            cols = {run_c: pa.array(list(ends), pa.int64()), first_c: pa.array([False] * k),
                    mark_c: pa.array(list(ends.values()), pa.string())}
            yield pa.RecordBatch.from_arrays(
                [cols.get(f.name, pa.nulls(k, f.type)) for f in out_schema], schema=out_schema)
    return go


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str, only_first: bool, keep_text: bool):
    """Stored rows with run number, first-of-run flag and digest, and the table
    (run, keep_id, group's first run, rows) of the runs at partition edges."""
    from pyspark.sql.pandas.types import to_arrow_schema
    norm, sha, run, first, mark, head, salt = fresh(docs, "norm", "sha", "run", "first", "mark", "head", "salt")
    n = partitions(docs.sparkSession)
    ident = F.col(f"`{id_col}`").asc_nulls_last()
    keyed = (docs.withColumn(norm, normalised(F.col(f"`{text_col}`")))
             .withColumns({head: F.substring(norm, 1, HEAD), sha: F.unhex(F.sha2(norm, 256)), salt: F.rand(2)}).drop(norm))
    # the normalised text is made again after the exchange rather than sent through it
    rows = (keyed.repartitionByRange(n, head, sha, ident, salt)
            .withColumn(norm, normalised(F.col(f"`{text_col}`")))
            .sortWithinPartitions(head, sha, norm, ident, salt).drop(head, salt))
    if not keep_text:
        rows = rows.drop(text_col)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema if f.name != norm]
                          + [T.StructField(run, T.LongType()), T.StructField(first, T.BooleanType()),
                             T.StructField(mark, T.StringType())])
    runs = rows.mapInArrow(_runs(norm, to_arrow_schema(schema), (run, first, mark)), schema)
    if only_first:
        runs = runs.filter(F.col(first) | F.col(mark).isNotNull())
    return store(runs), (sha, run, first, mark)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies: of rows whose normalised texts are equal the one
    with the smallest identifier stays (null identifiers last; of rows alike in both,
    one). All columns are kept. Null text counts as empty; an empty table stays empty."""
    t, (sha, run, first, mark) = _sorted_runs(docs, id_col, text_col, True, True)
    ends = t.filter(F.col(mark).isNotNull()).select(run, mark)
    w = Window.partitionBy(mark)
    later = (ends.withColumn("_lead", F.min(run).over(w)).filter(F.col(run) != F.col("_lead"))
             .select(run).distinct())
    # at most two rows for each partition of the sort
    return (t.filter(F.col(mark).isNull()).join(F.broadcast(later), run, "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text if ``keep_text`` is false) plus keep_id, group_size,
    kept and text_sha256 (lowercase hex of the normalised text in UTF-8). One row per
    input row. Extra columns with these names are replaced. keep_id is null only where
    all identifiers of a group are null; of rows alike in identifier and text one is
    kept."""
    docs = without(docs, *OUTPUTS)
    t, (sha, run, first, mark) = _sorted_runs(docs, id_col, text_col, False, keep_text)
    ends = t.filter(F.col(mark).isNotNull()).select(run, mark).distinct()
    rows = t.filter(F.col(mark).isNull())
    # runs at partition edges: at most two for each partition of the sort
    sizes = (rows.join(F.broadcast(ends.select(run)), run, "left_semi").groupBy(run)
             .agg(F.min(F.col(f"`{id_col}`")).alias("_id"), F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(mark)
    joined = ends.join(sizes, run).select(
        F.col(run), F.min("_id").over(w).alias("_keep"), F.sum("_n").over(w).alias("_size"),
        F.min(run).over(w).alias("_lead"))
    cols = [c for c in docs.columns if keep_text or c != text_col]
    # counted with partial sums and joined back, so a long run is in no task as a whole
    own = store(rows.groupBy(F.col(run).alias("_run")).agg(F.min(F.col(f"`{id_col}`")).alias("_id"), F.count(F.lit(1)).alias("_n")))
    return (rows.join(own, F.col(run) == F.col("_run")).join(F.broadcast(joined), run, "left")
            .select(*[F.col(f"`{c}`") for c in cols],
                    F.coalesce("_keep", "_id").alias("keep_id"),
                    F.coalesce("_size", "_n").alias("group_size"),
                    (F.col(first) & F.coalesce(F.col("_lead") == F.col(run), F.lit(True))).alias("kept"),
                    F.lower(F.hex(sha)).alias("text_sha256")))
