"""Personal data: expressions propose spans, checksums confirm them, context sets the score.

DataFrame functions only.  Loops over groups in an expression recurse in the JVM and
overflow on long runs; dots inside host names and single separators inside digit runs are
therefore first turned into characters of their own, one for one, so that plain character
classes, which loop, suffice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.spans import listed, matches, none

KINDS = ["email", "ip", "card", "phone", "iban"]  # the first four are the base, in the order of ties
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.8}
CONTEXT = {
    "email": "mail|contact|write to|@",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|master|amex|payment|credit|debit",
    "phone": "phone|tel|call|mobile|fax|whatsapp",
    "iban": "iban|account|bank|transfer|konto",
}
NEAR = 40  # characters before a span that count as its context

DOT, DOT_FREE, GAP, GAP_FREE = "\ue000", "\ue001", "\ue002", "\ue003"  # private use
LOCAL = f"A-Za-z0-9._%+{DOT}-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9{DOT}-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = f"[0-9][0-9{GAP}]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?+)(?![A-Za-z0-9])"  # whole or in groups of four


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of ASCII digits passes Luhn's check."""
    state = F.struct(F.lit(False).alias("double"), F.lit(0).alias("sum"))

    def step(acc, c):
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.struct((~acc["double"]).alias("double"), (acc["sum"] + F.when(acc["double"], twice).otherwise(d)).alias("sum"))

    return F.aggregate(F.split(F.reverse(digits), "(?<=.)(?=.)"), state, step, lambda a: a["sum"] % 10 == 0)


def mod97(iban: Column) -> Column:
    """Whether an account number's rearranged digits leave 1 when divided by 97."""
    chars = F.split(F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4)), "(?<=.)(?=.)")
    step = lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(chars, F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return F.when(F.length(_digits(m)).between(14, 19), luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    if kind == "iban":
        return mod97(F.translate(m, " ", ""))
    return F.lit(True)


def _found(kind: str, text: Column) -> Column:
    """Proposed spans; a cheap test keeps texts without a trace of the kind out."""
    if kind == "email":
        marked = F.regexp_replace(F.translate(text, DOT, DOT_FREE), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)
        return F.when(text.contains("@"), matches(marked, EMAIL)).otherwise(none())
    if kind == "ip":
        return F.when(text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), matches(text, IP)).otherwise(none())
    if kind == "card":
        marked = F.regexp_replace(F.translate(text, GAP, GAP_FREE), r"(?<=[0-9])[\x20-](?=[0-9])", GAP)
        return F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), matches(marked, CARD)).otherwise(none())
    if kind == "phone":
        return F.when(text.contains("+"), matches(text, PHONE)).otherwise(none())
    return F.when(text.rlike(IBAN), matches(text, IBAN)).otherwise(none())


def personal_data(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of df and ``_spans``: array<struct<start, rank, end, kind, score>>, ordered.

    Null texts are empty and have no spans; offsets count code points.  A column that is
    named ``_spans`` already is replaced; nothing is shuffled and every row comes back.
    """
    text = F.coalesce(F.col("_text"), F.lit(""))

    def spans(rank: int, kind: str) -> Column:
        def full(s):
            near = F.lower(F.substring(text, F.greatest(F.lit(1), s["start"] - NEAR + 1).cast("int"), F.least(F.lit(NEAR), s["start"]).cast("int")))
            score = F.least(F.lit(1.0), F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), 0.2).otherwise(0.0))
            return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), (s["start"] + F.length(s["m"])).cast("bigint").alias("end"), F.lit(kind).alias("kind"), score.alias("score"))

        return F.transform(F.filter(_found(kind, text), lambda s: _valid(kind, s["m"])), full)

    return df.withColumn("_text", F.col(text_col)).withColumn("_spans", F.array_sort(F.concat(*[spans(i, k) for i, k in enumerate(KINDS)]))).drop("_text")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores for every row of docs.

    docs: doc_id, text; other columns are ignored.  Repeated rows come back as often as they
    are there; an empty table gives an empty result.
    """
    found = personal_data(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = F.filter("_spans", lambda s: s["rank"] < 4)
    return found.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"), F.array_join(F.transform("_spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))
