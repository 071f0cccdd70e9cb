"""Shared helpers of the corpus operators: table access, Arrow plumbing, shared storage."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Rows that one task of a ``packed`` table makes and one file takes.
FILE_ROWS = 1 << 16


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables, through Spark's reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """Lower-case A-Z only. Pure ASCII strings take ``lower``'s byte-wise fast path."""
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(
        F.translate(col, ASCII_UPPER, ASCII_LOWER)
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, as the context's checkpoint folder too.

    A local folder serves only where none is set and the master is local (tests); else that is an error.
    """
    context = spark.sparkContext
    wanted, current = spark.conf.get("spark.checkpoint.dir", None), context.getCheckpointDir()
    if wanted is None and current is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        wanted = "/tmp/checkpoints/corvane"
    if current is None:
        context.setCheckpointDir(wanted)
    return wanted or current


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than so many rows need at ``FILE_ROWS``; its rows stay as they are.

    For a file and for its checksum an executor starts a process each (Hadoop's chmod on a local file system), which shares
    the executor's memory until it runs and counts with all of it once more. Few rows need not be hundreds of files.
    """
    return df.coalesce(max(1, math.ceil(rows / FILE_ROWS)))


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    ``rows``: a bound, if one is known, on the rows that its last step takes or makes, which are ``packed`` then.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return (df if rows is None else packed(df, rows)).checkpoint(eager=True)


def chunks_by_bytes(values: Sequence[bytes | None], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of ``values`` holding about ``limit`` bytes each, one value at least."""
    start, held = 0, 0
    for i, v in enumerate(values):
        size = len(v) if v else 0
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(values):
        yield start, len(values)


def map_texts(
    df: DataFrame,
    keys: Sequence[str],
    text_col: str,
    make: Callable[[], Callable[[list[bytes | None]], dict[str, object]]],
    fields: str,
    keep_text: bool = False,
) -> DataFrame:
    """Per-text columns computed in Arrow batches; one output row per input row.

    Keeps ``keys`` (and the text, if asked to) and adds the columns of ``fields`` (DDL). ``make()`` runs once per task and returns
    the function from a list of UTF-8 texts (None for null) to the new columns. Nothing but the keys and
    the text is read; other columns of ``df``, whatever their names, play no part.
    """
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    narrow = df.select(*named, F.col(text_col).cast("binary").alias("_text"))
    key_ddl = ", ".join(f"_k{i} {narrow.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(keys)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            new = compute(texts)
            columns = [batch.column(i) for i in range(batch.num_columns - (not keep_text))]
            names = [*[f"_k{i}" for i in range(batch.num_columns - 1)], "_text"][: len(columns)]
            for name, values in new.items():
                columns.append(values if isinstance(values, pa.Array) else pa.array(values))
                names.append(name)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = narrow.mapInArrow(run, ", ".join([key_ddl, *["_text binary"] * keep_text, fields]))
    if keep_text:
        out = out.withColumn("_text", F.col("_text").cast("string"))
    return out.withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keys)} | {"_text": text_col})
