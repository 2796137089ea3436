"""Secret scans with an incremental ledger of blobs.

Each version of each path is known by the hash of its content.  A ledger holds the pairs
(blob, rule version) already scanned; only pairs it lacks are scanned, once per blob however
many paths and versions share it, and findings are joined back to all paths.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.spans import listed, matches, none

RULES = 1  # version of the rules below; a ledger row counts for its version alone
KINDS = ["assign", "access", "hex", "pem", "github"]  # the first three are the base, in the order of ties
ASSIGN = r"""(?:(?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}+"
PEM = "-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"
GITHUB = "gh[pousr]_[A-Za-z0-9]{36,}"


def _found(text: Column) -> list[Column]:
    assign = F.filter(matches(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["m"], ASSIGN, 1)) >= 6)
    access = F.filter(matches(text, ACCESS), lambda s: F.length(s["m"]) >= 20)
    return [
        F.when(text.rlike(r"""[A-Za-z]["']?\x20*[:=]"""), assign).otherwise(none()),
        F.when(text.contains("AKIA"), access).otherwise(none()),
        F.when(text.rlike(HEX), matches(text, HEX)).otherwise(none()),
        F.when(text.contains("PRIVATE KEY-----"), matches(text, PEM)).otherwise(none()),
        F.when(text.rlike("gh[pousr]_"), matches(text, GITHUB)).otherwise(none()),
    ]


def scan(blobs: DataFrame, content: str = "content") -> DataFrame:
    """All columns of blobs and ``_spans``: array<struct<start, rank, end, kind>>, ordered; null content is empty."""
    text = F.coalesce(F.col(content), F.lit(""))
    full = lambda i, k: lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"), (s["start"] + F.length(s["m"])).cast("bigint").alias("end"), F.lit(k).alias("kind"))
    return blobs.withColumn("_spans", F.array_sort(F.concat(*[F.transform(f, full(i, k)) for i, (k, f) in enumerate(zip(KINDS, _found(text)))])))


def unseen(history: DataFrame, ledger: DataFrame | None, content: str = "content", rules: int = RULES) -> DataFrame:
    """(blob, content): each distinct content of history that the ledger lacks for these rules."""
    blobs = history.select(F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias("blob"), F.coalesce(F.col(content), F.lit("")).alias("content"))
    if ledger is not None:
        blobs = blobs.join(ledger.filter(F.col("rules") == rules).select("blob").distinct(), "blob", "left_anti")
    return blobs.dropDuplicates(["blob"])


def incremental(history: DataFrame, ledger: DataFrame | None = None, content: str = "content", rules: int = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings by path, ledger rows that are new).

    history: any columns and ``content``, one row per version of a path; ledger: (blob, rules,
    spans) or None.  Findings are history's columns without the content, ``blob`` and
    ``spans`` (an empty array where nothing was found), for every row of history, repeats
    included; a null content is empty.  The ledger returned holds blobs scanned now; append it.
    """
    new = stored(scan(unseen(history, ledger, content, rules)).select("blob", F.lit(rules).alias("rules"), F.col("_spans").alias("spans")), "ledger")
    known = new if ledger is None else new.unionByName(ledger.filter(F.col("rules") == rules).select("blob", "rules", "spans").dropDuplicates(["blob"]))
    # only blobs with findings are joined; Spark splits a blob that many paths share
    hits = known.filter(F.size("spans") > 0).select("blob", "spans")
    paths = history.withColumn("blob", F.sha2(F.coalesce(F.col(content), F.lit("")), 256)).drop(content, "spans")
    found = paths.join(hits, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(dict(hits.dtypes)["spans"])))
    return found, new


def update(history: DataFrame, path: str, content: str = "content", rules: int = RULES) -> DataFrame:
    """Findings by path of ``incremental`` with the ledger kept as Parquet below ``path``.

    What the ledger lacks is scanned and appended; a call over the same history scans nothing.
    One writer at a time; a call that is lost before its append is simply run again.
    """
    spark = history.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    found, new = incremental(history, spark.read.parquet(path) if there else None, content, rules)
    new.write.mode("append").parquet(path)
    return found


def report(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of docs.

    docs: doc_id, text; other columns are ignored.  Null and empty texts have no spans.
    Repeated rows come back as often as they are there; an empty table gives an empty result.
    """
    found, _ = incremental(docs.select("doc_id", F.col("text").alias("content")), ledger)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["rank"] < 3)
    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
