"""Helpers shared by the corpus operators: tables, scratch space, batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (Spark's addPyFile), so
    that batch functions can be imported there; once a Spark context."""
    import os
    import shutil
    import tempfile

    import cohortlens

    # A batch for Python is bounded by its bytes, not only by its rows.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_cohortlens_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(cohortlens.__file__))
    if not os.path.isdir(home):  # already imported from a shipped archive
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "cohortlens_code"), "zip",
                                  os.path.dirname(home), os.path.basename(home))
    sc.addPyFile(archive)
    sc._cohortlens_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage without a local checkpoint: a lost executor costs the
    running tasks only, never the work before this point."""
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, text as bytes); only these two columns are read, so that extra or
    clashing columns of the input cannot matter."""
    return docs.select(F.col(key).cast("long").alias(key), F.col(column).cast("binary").alias("text"))


def map_batches(df: DataFrame, fn: Callable[[dict], Iterator[dict] | dict], schema: str) -> DataFrame:
    """``mapInArrow`` over dictionaries of Python lists.

    ``fn`` gets {column: list} for at most ``PIECE_BYTES`` of input at a time
    (a single longer row still comes alone) and returns {column: array}."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    parsed = StructType.fromDDL(schema)
    target = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                out = fn({n: piece.column(i).to_pylist() for i, n in enumerate(piece.schema.names)})
                for part in [out] if isinstance(out, dict) else out:
                    arrays = [_array(part[f.name], f.type) for f in target]
                    if len(arrays[0]):
                        yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, parsed)


#: Bytes of an Arrow batch on its way to Python.
BATCH_BYTES = 8 << 20
#: Bytes of input that one call of a batch function gets at most (a longer row comes alone).
PIECE_BYTES = 4 << 20


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if not batch.num_rows:
        return
    per_row = max(1, batch.nbytes // batch.num_rows)
    if batch.nbytes <= PIECE_BYTES:
        yield batch
        return
    sizes = None
    for i, field in enumerate(batch.schema):
        if pa.types.is_binary(field.type) or pa.types.is_string(field.type):
            import pyarrow.compute as pc

            sizes = pc.fill_null(pc.binary_length(batch.column(i)), 0).to_pylist()
            break
    sizes = sizes or [per_row] * batch.num_rows
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > PIECE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def small_enough(df: DataFrame, most_rows: int) -> bool:
    """Whether ``df`` has at most ``most_rows`` rows; reads no more than that."""
    return df.limit(most_rows + 1).count() <= most_rows
