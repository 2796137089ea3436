"""Benchmark decontamination by winnowing, DataFrame functions only.

A fingerprint is the hash of GRAM words, kept where it is the smallest of WINDOW successive
ones; GRAM + WINDOW - 1 = 13, so each span of 13 words has a fingerprint of its own and any
two equal spans have the same one: no shared span is missed.  Fingerprints of texts and of
benchmark items are joined, and hits are extended to the whole 13 words, compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored, text_key, unused

GRAM = 7
WINDOW = 7
SPAN = GRAM + WINDOW - 1
BROADCAST = 1_000_000  # most distinct benchmark fingerprints (16 bytes each) that are broadcast


def words(text: Column) -> Column:
    """Lower-cased words (letters, digits, anything beyond ASCII); null has none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))
    return F.array_remove(F.split(F.coalesce(plain, F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _gram(w: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, at + i) for i in range(size)])


def _whole(n: int):
    return lambda i: F.struct(F.lit(n).alias("len"), i.alias("at"), _gram(F.col("w"), i, n).alias("h"))


def _marked(df: DataFrame, short: list[int]) -> DataFrame:
    """df with column w, plus ``marks``: array<struct<len, at, h>>, a fingerprint for each span.

    Spans of SPAN words, and of each length in ``short`` (hash of the whole span).
    """
    empty = F.array().cast("array<struct<len:int,at:int,h:bigint>>")
    df = df.withColumn("_grams", F.when(F.size("w") >= SPAN, F.transform(F.sequence(F.lit(0), F.size("w") - GRAM), lambda i: _gram(F.col("w"), i, GRAM))))
    least = lambda i: F.struct(F.lit(SPAN).alias("len"), i.alias("at"), F.least(*[F.get(F.col("_grams"), i + k) for k in range(WINDOW)]).alias("h"))
    marks = [F.when(F.size("w") >= SPAN, F.transform(F.sequence(F.lit(0), F.size("w") - SPAN), least)).otherwise(empty)]
    for n in short:
        marks.append(F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(0), F.size("w") - n), _whole(n))).otherwise(empty))
    return df.withColumn("marks", F.concat(*marks) if len(marks) > 1 else marks[0]).drop("_grams")


def _text(w: Column, at: Column, size: Column) -> Column:
    return F.array_join(F.slice(w, at + 1, size), " ")


def _windows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """(item_id, len, h, span) of every window of every item, and the lengths below SPAN that occur."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    short = sorted(r[0] for r in items.select(F.size("w").alias("n")).filter(F.col("n") < SPAN).distinct().collect())  # at most 12
    # explode_outer: for explode Spark infers a filter that repeats all of the expression below
    marks = _marked(items, short).withColumn("m", F.explode_outer("marks"))
    fits = (F.col("m.len") == SPAN) | (F.col("m.len") == F.size("w"))  # an item's short lengths are its own alone
    return marks.filter(fits).select("item_id", F.col("m.len").alias("len"), F.col("m.h").alias("h"), _text(F.col("w"), F.col("m.at"), F.col("m.len")).alias("span")).distinct(), short


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of ``judged`` without the text's key."""
    return judged(docs, benchmark).drop("key")


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key (of the text), n_words, n_hit, n_items, items_sha256, contaminated for every row of docs.

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored.  Null and empty
    texts have no words and are never contaminated; items without words never occur; a null
    item_id hits but is not listed.  Repeated rows come back as often as they are there; an
    empty table gives an empty result, an empty benchmark no hits.
    """
    windows, short = _windows(benchmark)
    windows = stored(windows, "windows")
    prints = windows.select("len", "h").distinct().withColumn("hit", F.lit(True))
    if prints.count() <= BROADCAST:
        prints = F.broadcast(prints)
    slim = docs.select("doc_id", "text").withColumn("key", text_key(F.col("text")))
    marked = _marked(slim.select("doc_id", "key", words(F.col("text")).alias("w")), short).select("doc_id", "key", F.size("w").cast("bigint").alias("n_words"), "marks")
    marked = marked.select("doc_id", "key", "n_words", F.posexplode_outer("marks").alias("nth", "m"))  # without the words
    rows = marked.select("doc_id", "key", "n_words", F.coalesce("nth", F.lit(0)).alias("nth"), F.col("m.len").alias("len"), F.col("m.at").alias("at"), F.coalesce("m.h", F.xxhash64("key")).alias("h"))
    # the first row of each text stays for its number of words, others only if they hit
    kept = rows.join(prints, ["len", "h"], "left").filter("nth = 0 or hit")
    per = stored(kept.groupBy("doc_id", "key").agg(F.max("n_words").alias("n_words"), F.sum((F.col("nth") == 0).cast("int")).alias("k"), F.collect_set(F.when(F.col("hit"), F.struct("len", "at"))).alias("hits")), "hits")
    there = per.filter(F.size("hits") > 0).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "hits")
    # extend each hit to the words of the whole span
    texts = slim.join(there, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    cut = lambda w: F.transform("hits", lambda s: F.struct(s["len"].alias("len"), s["at"].alias("at"), _text(w, s["at"], s["len"]).alias("span")))
    once = F.transform(F.array(words(F.col("text"))), cut)[0]  # the words as a variable: cut up once per text
    spans = texts.select("doc_id", "key", F.explode_outer(once).alias("s")).select("doc_id", "key", "s.*")
    found = spans.join(windows.select("item_id", "len", "span").distinct(), ["len", "span"]).groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("len")).alias("end")))).alias("runs"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("sum"))
    add = lambda a, r: F.struct(F.greatest(a["end"], r["end"]).alias("end"), (a["sum"] + F.greatest(F.lit(0), r["end"] - F.greatest(a["end"], r["at"]))).cast("bigint").alias("sum"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.aggregate("runs", zero, add, lambda a: a["sum"]).alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.array_join("items", ",").alias("items"))
    out = per.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return out.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("k").cast("int")))).select(
        "doc_id", "key", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns.

    Rows are told apart by id and text, so ids may repeat or be null.
    """
    hash_, id_, key_ = unused(docs, "hash", "id", "key")
    flagged = judged(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias(id_), F.col("key").alias(key_)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(key_))
    return docs.withColumn(hash_, text_key(F.col("text"))).join(flagged, same, "left_anti").drop(hash_)
