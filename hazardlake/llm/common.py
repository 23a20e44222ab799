"""What several corpus operators share: shipping the package, shared-folder tables, row marks."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazardlake.session import new_folder

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in these low bits
# Bytes of a batch on its way to a Python worker: long texts then come a few at a time, and neither
# side holds more than some copies of this.
BATCH_BYTES = 4 << 20
SCRATCH_CODEC = "zstd"  # texts take two thirds of what they take with snappy


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors once per application, and bound Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_hazardlake_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    handle, path = tempfile.mkstemp(prefix="hazardlake-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(path)
    context._hazardlake_shipped = True


_holder: tuple[str, Callable[[], object] | None] = ("", None)


def enter(operator: str, drop: Callable[[], object] | None = None) -> None:
    """Say in a Python worker whose work it does now; ``drop`` frees what that operator keeps there.

    Workers outlive tasks and stages. Caches stay over the tasks of one operator and go when the
    worker's next task is another one's.
    """
    global _holder
    before, forget = _holder
    if before == operator:
        return
    _holder = (operator, drop)
    if forget:
        forget()
    give_back()


def give_back() -> None:
    """Return a worker's freed memory to the system, which the allocators else keep for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def free(name: str, docs: DataFrame) -> str:
    """A name for a new column: underscores are added while the frame has it, in any case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=SCRATCH_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(docs: DataFrame, label: str, slim: Callable[[Column], Column] = lambda row: row, **extra: Column) -> DataFrame:
    """Write every row once, with a stable address, so that later passes can find it again.

    Columns: ``sender`` (the task that wrote the row), ``seq`` (its number there), ``row``
    (all columns of ``docs`` as a struct, so no name can clash; of it, what ``slim`` leaves) and the ``extra``
    columns, which are worked out on the whole row.
    The files are bucketed by ``sender``: joins and groups on it read them without moving
    any text. The table's catalogue entry is dropped at once; its files stay.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"))
    rows = packed.select(F.monotonically_increasing_id().alias("_at"), "row").select(
        F.shiftright("_at", ROW_BITS).cast("int").alias("sender"),
        F.col("_at").bitwiseAND((1 << ROW_BITS) - 1).alias("seq"), slim(F.col("row")).alias("row"),
        *[value.alias(name) for name, value in extra.items()])
    table = f"hazardlake_{label}_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, "sender").format("parquet").options(
        path=new_folder(spark, label), compression=SCRATCH_CODEC).saveAsTable(table)
    staged = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return staged


def unpacked(staged: DataFrame) -> DataFrame:
    """The original columns of a staged frame."""
    fields = staged.schema["row"].dataType.names
    return staged.select(*[F.col("row").getField(c).alias(c) for c in fields])


def words_of(positions: np.ndarray) -> np.ndarray:
    """64-bit words in which the bits at these positions are set."""
    bits = np.zeros((int(positions.max()) // 64 + 1) * 64, np.uint8)
    bits[positions] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def marks_of(hits: DataFrame) -> DataFrame:
    """One row per sender: which of its rows are among ``hits`` (sender, seq), a bit each."""
    def collect(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sender": group.sender.iloc[:1], "marks": [words_of(group.seq.to_numpy())]})

    return hits.groupBy("sender").applyInPandas(collect, "sender int, marks array<bigint>")


def is_marked() -> Column:
    word = F.get("marks", F.expr("CAST(seq DIV 64 AS INT)"))
    return F.coalesce(F.getbit(word, F.expr("CAST(seq % 64 AS INT)")) == 1, F.lit(False))


def with_marks(staged: DataFrame, marks: DataFrame, how: str = "inner") -> DataFrame:
    """Staged rows beside the marks of their sender; only the marks are shuffled."""
    return staged.join(marks.hint("shuffle_hash"), "sender", how)


def carried(staged: DataFrame, found: DataFrame, fields: list[str], everything: bool = False) -> DataFrame:
    """The staged rows that ``found`` (sender, seq and plain fields) names, with those fields.

    With ``everything`` the other rows come too, with null fields. Like marks, the fields travel as one row of arrays per sender, so staged rows stay where they
    are. The entries of each 64 rows are found by their number of predecessors.
    """
    def collect(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seq")
        seqs = group.seq.to_numpy()
        starts = np.searchsorted(seqs, np.arange(0, (int(seqs[-1]) // 64 + 2) * 64, 64)).astype(np.int32)
        return pd.DataFrame({"sender": group.sender.iloc[:1], "_starts": [starts], "_seqs": [seqs],
                             **{f"_{name}": [group[name].to_numpy()] for name in fields}})

    lists = ", ".join(f"_{name} array<{found.schema[name].dataType.simpleString()}>" for name in fields)
    packed = found.groupBy("sender").applyInPandas(
        collect, f"sender int, _starts array<int>, _seqs array<bigint>, {lists}")
    word = F.expr("CAST(seq DIV 64 AS INT)")
    low, high = F.get("_starts", word), F.get("_starts", word + 1)
    place = F.array_position(F.slice("_seqs", low + 1, high - low), F.col("seq"))
    rows = with_marks(staged, packed, "left" if everything else "inner") \
        .withColumn("_place", F.when(place > 0, low + place - 1))
    rows = rows if everything else rows.filter("_place IS NOT NULL")
    return rows.select(*staged.columns, *[F.get(f"_{name}", F.col("_place").cast("int")).alias(name) for name in fields])
