"""Pieces shared by the training-data operators: shared storage, tokens, row keys.

Everything that outlives one task goes to the folder that ``spark.checkpoint.dir``
names, which every executor and the driver can reach.  Files are written under a
name of their own attempt and renamed when complete, so a task that is run again
(lost executor, speculation) replaces its own output and leaves nothing partial.
"""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that setting is absent (local tests) a temporary folder is set for it once.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    # a bare path is one of the cluster's default file system
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    base = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if base.startswith("file:/") and not base.startswith("file://"):
        base = "file://" + base.removeprefix("file:")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of rows that the driver holds, made in the JVM: a list handed to Spark as it is starts Python workers to unpickle it."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=fields), StructType.fromDDL(schema))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("file:///", "/") if uri.startswith("file:///") else uri)


def write_file(uri: str, chunks: Iterable[bytes]) -> int:
    """Write a file whole or not at all; the final name does not depend on the attempt."""
    from pyarrow import fs as pafs

    filesystem, path = _fs(uri.rsplit("/", 1)[0])
    name = uri.rsplit("/", 1)[1]
    filesystem.create_dir(path, recursive=True)
    temp, n = f"{path}/.{name}.{uuid.uuid4().hex}", 0
    with filesystem.open_output_stream(temp) as out:
        for chunk in chunks:
            out.write(chunk)
            n += len(chunk)
    filesystem.move(temp, f"{path}/{name}")
    assert filesystem.get_file_info(f"{path}/{name}").type != pafs.FileType.NotFound
    return n


def open_file(uri: str):
    """The file as a seekable binary file object."""
    filesystem, path = _fs(uri)
    return filesystem.open_input_file(path)


def ascii_lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8; None is empty.

    ``bytes.lower`` and ``bytes.split`` act on ASCII alone, which is exactly this rule.
    """
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def id_bucket(doc_id, modulus: int) -> int:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """``id_bucket`` as a column."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")), F.lit(modulus))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name after as many underscores as make it none of df's columns."""
    there, lead = {c.lower() for c in df.columns}, "_"
    while any(f"{lead}{n}".lower() in there for n in names):
        lead += "_"
    return [f"{lead}{n}" for n in names]


def text_key(text: Column) -> Column:
    """A 128-bit key of a text: rows with one id and one key are repeats of one row."""
    return F.md5(F.coalesce(text, F.lit("")))


def batches(frames: Iterator, columns: list[str], size: int = 512, most: int = 16 << 20) -> Iterator[list[tuple]]:
    """Rows of Arrow batches as lists of tuples: at most ``size`` rows and, but for a row that is larger alone, ``most`` bytes of texts."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in frames:
        kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        lengths = np.zeros(batch.num_rows, np.int64)
        for column in kept:
            if any(test(column.type) for test in (pa.types.is_string, pa.types.is_binary, pa.types.is_large_string, pa.types.is_large_binary)):
                lengths += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(lengths), 0
        while at < batch.num_rows:
            fits = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
            end = min(at + size, max(fits, at + 1))
            yield list(zip(*(column.slice(at, end - at).to_pylist() for column in kept), strict=True))
            at = end
