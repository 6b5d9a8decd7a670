"""What the operators of this subpackage share: sessions, stored tables, and text columns computed in batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from basketry.session import configure, cut_lineage

# A batch holds at most this many rows or bytes, so a run of very long texts stays small in memory.
BATCH_ROWS = 300
BATCH_BYTES = 4 * 1024 * 1024

# Words kept in one worker's table of known words.
KNOWN_WORDS = 120_000

WORD = "[^\\x20\\x09-\\x0D]+"


def ship_package(spark: SparkSession) -> None:
    """Give the package's source to all executors, once for each application, so that it need not be installed there."""
    context = spark.sparkContext
    if getattr(context, "_basketry_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="basketry-")).resolve() / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._basketry_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of the library, small Arrow batches, and the package on the executors."""
    ship_package(spark)
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/documents.parquet")


def keep(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and read them back, until the application ends.

    Several passes then read the same rows, and none of them needs an executor that may be gone.
    """
    return cut_lineage(df, "snappy")


def drop_kept(*frames: DataFrame) -> None:
    """Remove tables written by ``keep`` once nothing reads them any more."""
    for df in frames:
        for path in df.inputFiles()[:1]:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path).getParent()
            system = folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
            system.delete(folder, True)


def release_memory() -> None:
    """Give freed memory back to the system: Spark uses a worker again for later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # there with glibc
    if trim:
        trim(0)


def with_text_columns(docs: DataFrame, text: str, fields: T.StructType,
                      start: Callable[[], Callable[[list[str]], Sequence[Sequence]]]) -> DataFrame:
    """Add columns computed from a text column, batch by batch.

    ``start`` runs once in each task and returns a function from a list of texts to one list per
    field. A null text is given as an empty one. Columns of ``docs`` named like a field are replaced.
    """
    taken = {name.lower() for name in fields.names}
    others = [c for c in docs.columns if c.lower() not in taken]
    source = docs.select(*others, *([] if text in others else [F.col(text).alias("__text")]))
    at = text if text in others else "__text"
    schema = T.StructType([f for f in source.schema if f.name != "__text"] + list(fields))
    arrow = to_arrow_schema(T.StructType(list(fields)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(200_000)  # lists of words form no cycles
        compute = start()
        for batch in batches:
            found = compute([t or "" for t in batch.column(at).to_pylist()])
            arrays = [pa.array(values, type=f.type) for values, f in zip(found, arrow)]
            kept = [(n, batch.column(n)) for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([a for _, a in kept] + arrays,
                                             names=[n for n, _ in kept] + list(fields.names))
        del compute
        release_memory()

    return source.mapInArrow(run, schema)


class KnownWords(dict):
    """A bounded table from word to value; unknown words of a batch are worked out together.

    Early words of a text collection are its frequent ones, so a full table stays as it is and the
    rest is held for the batch only.
    """

    def __init__(self, compute: Callable[[list], Sequence], size: int = KNOWN_WORDS):
        super().__init__()
        self.compute, self.size, self.rare = compute, size, {}

    def learn(self, words: set) -> None:
        """Make every given word known until the next call."""
        new = [w for w in words if w not in self]
        self.rare = {}
        if new:
            into = self if len(self) < self.size else self.rare
            into.update(zip(new, self.compute(new)))

    def __missing__(self, word):
        return self.rare[word]


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)
