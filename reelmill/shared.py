"""Tables that a job writes to cut its lineage, in a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tables of this process, for release().
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a local folder, set once per session, where that is unset and all tasks run in this process.

    On a cluster a folder of one machine would leave each executor with files that no other sees, so there the setting
    has to be made.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("reelmill.shared.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        where = f"file://{tempfile.mkdtemp(prefix='reelmill-')}"
        spark.conf.set("reelmill.shared.dir", where)
    return where.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back.

    What follows starts from the files, so a lost executor never makes the work before it run again and
    nothing that is used twice is computed twice.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Side tables of up to so many bytes, counted in what their rows hold, are broadcast.
BROADCAST_BYTES = 48 << 20


def _bytes(c: Column, kind: T.DataType) -> Column:
    """What a value takes in a row: a word, and what a string, a list or a struct holds besides."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        more = F.octet_length(c)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
        more = F.greatest(F.size(c), F.lit(0)) * 8 + 8
    elif isinstance(kind, T.StructType):
        more = sum((_bytes(c.getField(f.name), f.dataType) for f in kind.fields), F.lit(8))
    elif isinstance(kind, (T.ArrayType, T.MapType, T.VariantType)):
        more = F.octet_length(F.to_json(F.struct(c))) * 2
    else:
        return F.lit(8)
    return F.coalesce(more, F.lit(0)).cast("long") + 8


def row_bytes(df: DataFrame) -> int:
    """The bytes of all rows of df, 16 more for each; one pass over it."""
    total = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16)).cast("long")
    return df.agg(F.sum(total)).first()[0] or 0


def small(table: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, hint: str | None = None) -> DataFrame:
    """table (a written one, as it is read to be measured), to be broadcast if its rows hold few enough bytes."""
    if row_bytes(table) <= broadcast_bytes:
        return F.broadcast(table)
    return table.hint(hint) if hint else table


def looked_up(df: DataFrame, table: DataFrame, on: list[str] | str, name: str, how: str = "inner", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df joined with a table that has one row for each key.

    The table is written first and so has a known size: a small one is broadcast. A large one meets df in a join whose
    two sides are both plain shuffles, which adaptive execution can split where a key has very many rows; joined
    straight from its aggregate, it would hold all rows of a key in one task.
    """
    return df.join(small(stored(table, name), broadcast_bytes), on, how)


def written() -> int:
    """How many tables this process has in the shared folder."""
    return len(_written)


def release(spark: SparkSession, but: int = 0, since: int = 0) -> None:
    """Deletes the tables that this process has written to the shared folder, but the first `since` and the last `but`.

    Results that still read them are lost.
    """
    jvm = spark.sparkContext._jvm
    gone = _written[since : len(_written) - but]
    for path in gone:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _written[since : len(_written) - but] = []


def bounded_batches(spark: SparkSession, max_bytes: int = 4 << 20) -> None:
    """Caps what goes to a Python worker at once: Arrow batches of whole texts are counted in bytes, not only in rows.

    The setting is read when a plan runs, which is after the operator has returned it, so it stays; a session that has
    set a smaller one keeps its own.
    """
    now = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    if not (now and now.isdigit() and 0 < int(now) <= max_bytes):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(max_bytes))
