"""What the operators of this subpackage share: tables, text batches, word rules, checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker takes from an Arrow batch at once.
SLICE_BYTES = 8 << 20

#: bytes.translate table: A-Z to a-z, every other ASCII byte that is no digit or letter to a blank; bytes of other characters stay.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def item_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null has none."""
    return text.translate(WORD_TABLE).split() if text else []


def blank_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; null has none."""
    return text.lower().split() if text else []  # for bytes both look at ASCII only


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice has up to ``most`` bytes of the column, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


def map_texts(docs: DataFrame, function: Callable[[list, list], dict[str, list]], schema: str, id_col: str = "doc_id", text_col: str = "text", binary: bool = True) -> DataFrame:
    """One result row for each row of ``docs``, without a shuffle.

    ``function`` gets the ids and the texts (bytes, or str if not ``binary``; None for null) of a slice and returns the columns of
    ``schema`` after ``doc_id``. Other columns of ``docs`` are not read, so their names cannot clash.
    """
    text = F.col(text_col).cast("binary" if binary else "string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    full = f"doc_id long, {schema}"
    arrow = _arrow(source.sparkSession, full)

    def run(batches):
        for part in slices(batches, 1):
            ids, texts = part.column(0), part.column(1).to_pylist()
            columns = function(ids, texts)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(columns[f.name], f.type) for f in list(arrow)[1:])], schema=arrow)

    return source.mapInArrow(run, full)


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return pa.schema([pa.field(f.name, f.type) for f in to_arrow_schema(StructType.fromDDL(ddl))])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where it is unset on one machine (tests) a temporary one, on a cluster an error."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quarry-checkpoint-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        root = f"file://{root}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared checkpoint folder; a lost executor loses none of them."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_of_id(column: str) -> Column:
    """crc32 of the id as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def keep(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as compressed Parquet to the shared checkpoint folder and read again; gone when the driver ends."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/quarry-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    _file_system(spark, path)[0].deleteOnExit(_file_system(spark, path)[1].getParent())
    return spark.read.schema(df.schema).parquet(path)


def drop_kept(kept: DataFrame) -> None:
    """Removes what ``keep`` wrote, once nothing reads it any more."""
    for path in {f.rpartition("/")[0] for f in kept.inputFiles()}:
        system, at = _file_system(kept.sparkSession, path)
        system.delete(at, True)


def _file_system(spark: SparkSession, path: str):
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context.hadoopConfiguration()), at
