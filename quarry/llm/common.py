"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_importable, parallelism, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator needs, under its own names: ``pick(df, id="doc_id")``.

    Other columns of the input, whatever their names, never reach the operator's plan.
    """
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in columns.items()])


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read back.

    Cuts the lineage with files that survive the loss of an executor, and gives later
    joins a plain scan (so adaptive execution may split skewed keys on either side).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def giving_back(made):
    """The same batches; after each the process hands freed memory back to the system.

    Spark keeps its Python workers from stage to stage, and with them what their allocators hold.
    """
    import pyarrow as pa

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; other C libraries have none
    for batch in made:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable in the Python workers, which keep no freed memory."""
    ensure_importable(df.sparkSession)
    return df.mapInArrow(lambda batches: giving_back(fn(batches)), schema)


def slots(spark: SparkSession) -> int:
    """Tasks the application can run at a time."""
    return max(1, parallelism(spark))


def hash_order(*cols: Column) -> Column:
    """A fixed pseudo-random order of rows, for bounded deterministic samples."""
    return F.xxhash64(F.lit("sample"), *cols)


def pages_of(batch_iter, *names):
    """Column lists of each Arrow batch, small slices at a time (bounded Python objects)."""
    for batch in batch_iter:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            yield [part.column(n).to_pylist() for n in names]


def appended(df: DataFrame, col: str, added: list[tuple[str, str]], setup) -> DataFrame:
    """``df`` with the ``added`` (name, type) columns, computed in tasks from column ``col``.

    ``setup()`` runs once a task and returns a function from an Arrow array (a few hundred
    rows) to one Arrow array for each added column.  Rows and other columns pass through
    under neutral names, so any input names do; an added name replaces an input column of it.
    """
    from pyspark.sql import types as T

    names = df.columns
    made = [f"_c{i}" for i in range(len(names))]
    src = df.toDF(*made)
    extra = [f"_a{i}" for i in range(len(added))]
    types = T.StructType.fromDDL(", ".join(f"{e} {kind}" for e, (_, kind) in zip(extra, added)))
    at = made[names.index(col)]

    def run(batches):
        import pyarrow as pa

        of = setup()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, *of(part.column(at))], names=[*made, *extra])

    out = map_arrow(src, run, T.StructType(list(src.schema.fields) + list(types.fields)))
    new = {n for n, _ in added}
    return out.select(*[F.col(m).alias(n) for m, n in zip(made, names) if n not in new],
                      *[F.col(e).alias(n) for e, (n, _) in zip(extra, added)])
