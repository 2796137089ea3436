"""Sources and sinks.  Large tables stay with Spark's readers; small workbook and database files load on the driver."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SNIFF = 10_000  # bytes that the sniffers look at
SMALL = 256 << 20  # most bytes of a file that is loaded on the driver


def sniff_encoding(path: str) -> str:
    with open(path, "rb") as f:
        head = f.read(SNIFF)
    if head.startswith(b"\xef\xbb\xbf"):
        return "utf-8"
    try:
        head.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError as e:
        return "utf-8" if e.start > len(head) - 4 else "latin1"


def sniff_delimiter(path: str, encoding: str = "utf-8") -> str:
    with open(path, encoding=encoding, errors="replace") as f:
        lines = [f.readline() for _ in range(5)]
    return max(",;\t|", key=lambda d: sum(x.count(d) for x in lines))


def read(spark: SparkSession, path: str, sep: str | None = None, encoding: str | None = None, sheet: str | None = None, schema=None) -> DataFrame:
    """Read by suffix: csv, tsv, parquet, json (records), xlsx, sqlite/db, duckdb.  Remote csv needs sep and encoding."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix in ("json", "jsonl"):
        return spark.read.option("multiLine", suffix == "json").json(path, schema=schema)
    if suffix in ("csv", "tsv", "txt"):
        encoding = encoding or sniff_encoding(path)
        sep = sep or ("\t" if suffix == "tsv" else sniff_delimiter(path, encoding))
        options = dict(header=True, sep=sep, encoding=encoding)
        return spark.read.csv(path, schema=schema, **options) if schema else spark.read.csv(path, inferSchema=True, **options)
    if os.path.getsize(path) > SMALL:
        raise ValueError(f"{path}: over {SMALL} bytes; export it to parquet first")
    if suffix in ("sqlite", "db", "sqlite3"):
        import sqlite3

        import pandas as pd

        with sqlite3.connect(path) as con:
            table = con.execute("select name from sqlite_master where type = 'table' order by rowid limit 1").fetchone()[0]
            return spark.createDataFrame(pd.read_sql(f'select * from "{table}"', con))
    if suffix == "duckdb":
        import duckdb

        with duckdb.connect(path, read_only=True) as con:
            table = con.execute("select table_name from information_schema.tables order by 1 limit 1").fetchone()[0]
            return spark.createDataFrame(con.execute(f'select * from "{table}"').to_arrow_table())
    if suffix in ("xlsx", "xls"):
        import pandas as pd

        book = pd.ExcelFile(path)
        named = [s for s in book.sheet_names if any(k in s.lower() for k in ("data", "sheet1", "master", "dataset"))]
        return spark.createDataFrame(book.parse(sheet or (named or book.sheet_names)[0]))
    raise ValueError(f"no reader for {path}")


ROWS = 10_000  # rows that the driver holds at once for a single-file sink


def _plain(v):
    """Rows inside a value as mappings, which Arrow takes for structs."""
    if isinstance(v, Row):
        return {k: _plain(x) for k, x in zip(v.__fields__, v)}
    return [_plain(x) for x in v] if isinstance(v, list) else list(v.items()) if isinstance(v, dict) else v


def _portions(df: DataFrame):
    """Rows of df as Arrow tables of ROWS at most; the driver holds one partition at a time."""
    import itertools

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, rows, none = to_arrow_schema(df.schema), df.toLocalIterator(), True
    while some := list(itertools.islice(rows, ROWS)):
        none = False
        yield pa.Table.from_arrays([pa.array([_plain(r[i]) for r in some], f.type) for i, f in enumerate(schema)], schema=schema)
    if none:
        yield schema.empty_table()


def write(df: DataFrame, path: str, by: Sequence[str] = (), mark: bool = False) -> None:
    """Write by suffix: parquet, csv, tsv, json lines; sqlite, duckdb and xlsx are single files that the driver writes in portions.

    With ``mark`` each csv or tsv file starts with a byte order mark.  A workbook needs openpyxl and has at most 1,048,575 rows.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    w = df.write.mode("overwrite")
    w = w.partitionBy(*by) if by else w
    if suffix == "parquet":
        w.parquet(path)
    elif suffix in ("csv", "tsv"):
        if mark and df.columns:
            w = df.withColumnsRenamed({df.columns[0]: "\ufeff" + df.columns[0]}).write.mode("overwrite")
        w.csv(path, header=True, sep="\t" if suffix == "tsv" else ",")
    elif suffix in ("json", "jsonl"):
        w.json(path)
    elif suffix in ("sqlite", "db"):
        import sqlite3

        with sqlite3.connect(path) as con:
            for i, rows in enumerate(_portions(df)):
                rows.to_pandas().to_sql("data", con, index=False, if_exists="append" if i else "replace")
    elif suffix == "duckdb":
        import duckdb

        with duckdb.connect(path) as con:
            for i, rows in enumerate(_portions(df)):
                con.register("spark_rows", rows)
                con.execute("insert into data select * from spark_rows" if i else "create or replace table data as select * from spark_rows")
    elif suffix == "xlsx":
        import pandas as pd

        if df.limit(1_048_576).count() > 1_048_575:
            raise ValueError("a sheet holds at most 1,048,575 rows")
        with pd.ExcelWriter(path) as book:
            for i, rows in enumerate(_portions(df)):
                rows.to_pandas().to_excel(book, sheet_name="data", index=False, header=not i, startrow=i * ROWS + bool(i))
    else:
        raise ValueError(f"no writer for {path}")


def append_log(df: DataFrame, path: str) -> None:
    """Add rows to a log of JSON lines; what is there stays."""
    df.write.mode("append").json(path)


def union_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All files by column name, absent columns null, with ``_source_file``."""
    out = None
    for p in paths:
        df = read(spark, p).withColumn("_source_file", F.lit(os.path.basename(p)))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def feature_store(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Write one folder per key and return the manifest (keys, rows)."""
    df.repartition(*keys).write.mode("overwrite").partitionBy(*keys).parquet(path)
    return df.sparkSession.read.parquet(path).groupBy(*keys).agg(F.count("*").alias("rows"))


def content_addressed(files: DataFrame, source: str) -> DataFrame:
    """binaryFile rows -> their place in an immutable store: source/resource/v<version>/<hash><suffix>; equal contents share it."""
    h = F.substring(F.sha2("content", 256), 1, 16)
    name = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    suffix = F.regexp_extract("path", r"(\.[^./]*)$", 1)
    g = files.select(name.alias("resource"), h.alias("hash"), suffix.alias("suffix"), "modificationTime", "length")
    from pyspark.sql import Window

    first = g.groupBy("resource", "hash", "suffix", "length").agg(F.min("modificationTime").alias("since"))
    v = F.row_number().over(Window.partitionBy("resource").orderBy("since", "hash"))
    return first.withColumn("version", v).withColumn("place", F.concat_ws("/", F.lit(source), "resource", F.concat(F.lit("v"), F.col("version")), F.concat("hash", "suffix")))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long, nulls kept."""
    return df.unpivot(list(ids), list(values), name, value)


def complete_schema(df: DataFrame, canonical: dict[str, str]) -> DataFrame:
    """All canonical columns in their order (absent ones null), then the others."""
    have = [c for c in canonical if c in df.columns]
    made = [F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in canonical.items()]
    return df.select(*made, *[c for c in df.columns if c not in canonical])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; several sources of one name are coalesced in their order."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        groups.setdefault(mapping.get(c, c), []).append(c)
    return df.select(*[(F.coalesce(*cs) if len(cs) > 1 else F.col(cs[0])).alias(t) for t, cs in groups.items()])


def map_column(name: str, source_map: dict[str, str], variants: dict[str, Sequence[str]], least: float = 0.75) -> str | None:
    """Canonical column for a name: exact map, normalised map, variant, then the closest variant; plan-time only."""
    import difflib
    import re

    norm = lambda s: re.sub(r"[^a-z0-9_]", "", re.sub(r"[\s-]+", "_", s.strip().lower()))
    if name in source_map:
        return source_map[name]
    by = {norm(k): v for k, v in source_map.items()}
    if norm(name) in by:
        return by[norm(name)]
    every = {norm(v): c for c, vs in variants.items() for v in (c, *vs)}
    if norm(name) in every:
        return every[norm(name)]
    best = difflib.get_close_matches(norm(name), list(every), 1, least)
    return every[best[0]] if best else None


def html_tables(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table_no, row_no, col_no, cell): cells of all tables of a page, row and column spans expanded."""

    def run(frames):
        from html.parser import HTMLParser

        import pyarrow as pa

        class Tables(HTMLParser):
            def __init__(self):
                super().__init__()
                self.tables, self.cell, self.spans = [], None, (1, 1)

            def handle_starttag(self, tag, attrs):
                if tag == "table":
                    self.tables.append([])
                elif tag == "tr" and self.tables:
                    self.tables[-1].append([])
                elif tag in ("td", "th") and self.tables and self.tables[-1]:
                    size = lambda k: max(1, min(100, int(v) if (v := dict(attrs).get(k) or "1").isdigit() else 1))
                    self.cell, self.spans = [], (size("rowspan"), size("colspan"))

            def handle_data(self, data):
                if self.cell is not None:
                    self.cell.append(data)

            def handle_endtag(self, tag):
                if tag in ("td", "th") and self.cell is not None:
                    self.tables[-1][-1].append((" ".join("".join(self.cell).split()), *self.spans))
                    self.cell = None

        for part in frames:
            out = []
            for k, h in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                p = Tables()
                p.feed(h or "")
                for t, rows in enumerate(p.tables):
                    grid: dict[tuple[int, int], str] = {}
                    for r, cells in enumerate(rows):
                        c = 0
                        for text, down, right in cells:
                            while (r, c) in grid:
                                c += 1
                            grid.update({(r + i, c + j): text for i in range(down) for j in range(right)})
                            c += right
                    out += [(k, t, r, c, v) for (r, c), v in sorted(grid.items())]
            kinds = [part.schema.field(0).type, pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=[key, "table_no", "row_no", "col_no", "cell"])

    return df.select(key, html).mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, table_no int, row_no int, col_no int, cell string")
