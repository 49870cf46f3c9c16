"""Tables between steps in the shared folder, and joins on sets of integer ids."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wearlens.session import shared_folder

BLOCK = 64  # ids that share one bitmap
BLOCK_OF = "shiftright(cast(doc_id as bigint), 6)"  # in integers: doubles lose ids above 2**53


def ship() -> None:
    """Executors need not have this package installed: its functions travel with the query."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__.split(".")[0]])


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage in a way that survives lost executors, lets later steps read single columns,
    and gives the optimizer the true size. ``forget`` removes the files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete tables made by ``keep`` once nothing reads them any more."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._kept_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_arrow(
    df: DataFrame, columns: list[str], schema: T.StructType, batch: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """Apply ``batch`` to every Arrow batch of the named columns, in that order; a name may come twice.

    Spark sees numbered columns only, so that names with dots or a step's own names do no harm.
    """
    ship()
    target = pa.schema([(f"o{i}", _arrow(f.dataType)) for i, f in enumerate(schema.fields)])

    def run(batches):
        for b in batches:
            for out in batch(pa.RecordBatch.from_arrays(b.columns, columns)):
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(out.columns, target)], schema=target)

    numbered = T.StructType([T.StructField(f"o{i}", f.dataType) for i, f in enumerate(schema.fields)])
    given = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    return given.mapInArrow(run, numbered).toDF(*schema.names)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def own(df: DataFrame, *names: str) -> DataFrame:
    """The named columns of ``df``; other columns cannot clash with a step's own names."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def set_aside(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], *used: str) -> DataFrame:
    """``stage`` applied to ``docs`` with all but the ``used`` columns under numbered names; they come back under their own.

    So a stage's own names cannot clash with a column, and names with dots need no care.
    """
    given = docs.columns
    inner = [c if c in used else f"__x{i}" for i, c in enumerate(given)]
    out = stage(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(given, inner)]))
    new = [c for c in out.columns if c not in inner]
    return out.select(*inner, *new).toDF(*given, *new)


def id_blocks(ids: DataFrame, *flags: str) -> DataFrame:
    """Rows (doc_id, boolean flags) as a table of one row per 64 neighbouring ids, a bitmap per flag.

    Dense ids shrink 64-fold before the shuffle. Spark joins the table by its true size: broadcast
    while small, so that the documents need no shuffle, by hash otherwise.
    """
    bit = F.expr(f"shiftleft(1L, cast(pmod(doc_id, {BLOCK}) as int))")
    blocks = ids.filter("doc_id is not null").groupBy(F.expr(BLOCK_OF).alias("__block"))
    return keep(blocks.agg(*[F.bit_or(F.when(F.col(f), bit).otherwise(F.lit(0).cast("long"))).alias(f"__{f}") for f in flags]), "id-blocks")


def with_flags(df: DataFrame, blocks: DataFrame, *flags: str) -> DataFrame:
    """``df`` with a boolean column per flag of ``id_blocks``; false for ids outside it and for null ids."""
    joined = df.withColumn("__block", F.expr(BLOCK_OF)).join(blocks, "__block", "left")
    for f in flags:
        hit = F.expr(f"getbit(`__{f}`, cast(pmod(doc_id, {BLOCK}) as int)) = 1")
        joined = joined.withColumn(f, F.coalesce(hit, F.lit(False)))
    return joined.drop("__block", *[f"__{f}" for f in flags])
