"""Queries: identifiers, titles, measurements, ladders, entities, chunks, retrieval, evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import recommend, retrieval
from tessera.plans.registry import query
from tessera.plans.tables import table


@query("WITH r AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN ' HTTPS://doi.org/10.1234/Ab' || page_id WHEN 1 THEN 'doi:10.55/x' WHEN 2 THEN 'http://doi.org/10.99999/q.' || page_id WHEN 3 THEN url ELSE '' END AS s FROM pages) SELECT page_id, CASE WHEN regexp_full_match(regexp_replace(lower(trim(s)), '^(https?://doi\\.org/|doi:)', ''), '10\\.\\d{4,9}/\\S+') THEN regexp_replace(lower(trim(s)), '^(https?://doi\\.org/|doi:)', '') END AS doi FROM r")
def doi_normalization(spark, d):
    p = table(spark, d, "pages")
    s = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit(" HTTPS://doi.org/10.1234/Ab"), F.col("page_id"))).when(F.col("page_id") % 5 == 1, "doi:10.55/x").when(F.col("page_id") % 5 == 2, F.concat(F.lit("http://doi.org/10.99999/q."), F.col("page_id"))).when(F.col("page_id") % 5 == 3, F.col("url")).otherwise("")
    return p.select("page_id", X.normalize_doi(s).alias("doi"))


@query("SELECT page_id, ['10.1234/a' || page_id, '10.5555/b'] AS dois FROM pages")
def doi_extraction(spark, d):
    t = F.concat(F.lit("see 10.1234/A"), F.col("page_id"), F.lit("), and doi:10.5555/b; again 10.5555/B."))
    return table(spark, d, "pages").select("page_id", X.extract_dois(t).alias("dois"))


@query("SELECT doc_id, trim(regexp_replace(lower(left(text, 80)), '[^a-z0-9]+', ' ', 'g')) AS title FROM documents")
def title_normalization(spark, d):
    return table(spark, d, "documents").select("doc_id", X.normalize_title(F.substring("text", 1, 80)).alias("title"))


@query("SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS title FROM documents")
def title_normalization_whole(spark, d):
    return table(spark, d, "documents").select("doc_id", X.normalize_title("text").alias("title"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size + 0.5 WHEN 1 THEN 1000 + p_size WHEN 2 THEN p_size END::DOUBLE AS value FROM part")
def measurement_parsing(spark, d):
    s = F.col("p_size").cast("string")
    cell = F.when(F.col("p_partkey") % 4 == 0, F.concat(s, F.lit(".5 ± 0.3"))).when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("1,0"), F.lpad(s, 2, "0"), F.lit("*"))).when(F.col("p_partkey") % 4 == 2, F.concat(s, F.lit("abc†"))).otherwise("n.a.")
    return table(spark, d, "part").select("p_partkey", X.parse_measurement(cell).alias("value"))


@query("SELECT p_partkey, ['mean_sd', 'mean_se', 'interval', 'lsd', 'cv', 'letters', 'number'][p_partkey % 7 + 1] AS kind, p_size::DOUBLE AS value, CASE WHEN p_partkey % 7 IN (0, 1, 2) THEN p_size + 1 END::DOUBLE AS spread, CASE WHEN p_partkey % 7 = 5 THEN 'ab' END AS letters FROM part")
def statistic_parsing(spark, d):
    s, t = F.col("p_size").cast("string"), (F.col("p_size") + 1).cast("string")
    forms = [F.concat(s, F.lit(" ± "), t), F.concat(s, F.lit(" ("), t, F.lit(")")), F.concat(s, F.lit(" to "), t), F.concat(F.lit("LSD = "), s), F.concat(F.lit("CV% "), s), F.concat(s, F.lit(" ab")), s]
    cell = F.element_at(F.array(*forms), (F.col("p_partkey") % 7 + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", X.statistic(cell).alias("x")).select("p_partkey", "x.*")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN p_size END::DOUBLE AS value, CASE p_partkey % 3 WHEN 0 THEN 'kg' WHEN 1 THEN 'ml' END AS unit, CASE p_partkey % 3 WHEN 0 THEN 'ha' WHEN 1 THEN 'litre' END AS per FROM part")
def dose_extraction(spark, d):
    s = F.col("p_size").cast("string")
    t = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("applied at "), s, F.lit(" Kg/ha in May"))).when(F.col("p_partkey") % 3 == 1, F.concat(s, F.lit(" ml per litre"))).otherwise("none")
    return table(spark, d, "part").select("p_partkey", X.dose(t).alias("x")).select("p_partkey", "x.*")


_L = "lower(p_name || ' ' || p_type)"


@query(f"SELECT p_partkey, CASE WHEN contains({_L}, 'ring') THEN 'review' WHEN contains({_L}, 'red') OR contains({_L}, 'promo') THEN 'letter' WHEN contains({_L}, 'economy') THEN 'dataset' ELSE {_L} END AS kind, list_filter([CASE WHEN regexp_matches({_L}, 'small|red') THEN 'A' END, CASE WHEN regexp_matches({_L}, '\\bring\\b') THEN 'B' END, CASE WHEN regexp_matches({_L}, 'o') THEN 'C' END], lambda x: x IS NOT NULL) AS labels FROM part")
def classification_ladders(spark, d):
    t = F.concat("p_name", F.lit(" "), "p_type")
    steps = [("review", ["ring"]), ("letter", ["red", "promo"]), ("dataset", ["economy"])]
    return table(spark, d, "part").select("p_partkey", X.ladder(t, steps, F.lower(t)).alias("kind"), X.labels(t, [("small|red", "A"), (r"\bring\b", "B"), ("o", "C")]).alias("labels"))


@query("WITH h AS (SELECT doc_id, regexp_matches(text, 'the|and')::INT + regexp_matches(text, 'ing')::INT AS a, regexp_matches(text, 'le|la')::INT + regexp_matches(text, 'é')::INT AS b, regexp_matches(text, 'der|die')::INT AS c FROM documents) SELECT doc_id, CASE WHEN greatest(a, b, c) = 0 THEN 'none' WHEN a = greatest(a, b, c) THEN 'en' WHEN b = greatest(a, b, c) THEN 'fr' ELSE 'de' END AS family FROM h")
def table_type(spark, d):
    return table(spark, d, "documents").select("doc_id", X.best_type(F.col("text"), {"en": ["the|and", "ing"], "fr": ["le|la", "é"], "de": ["der|die"]}, "none").alias("family"))


@query("WITH m AS (SELECT doc_id, regexp_extract_all(text, '[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+') AS ips, regexp_extract_all(text, '[A-Z]{6,}') AS caps FROM documents), e AS (SELECT doc_id, 'ip' AS type, unnest(ips) AS value FROM m UNION ALL SELECT doc_id, 'caps', unnest(caps) FROM m) SELECT DISTINCT doc_id, type, lower(value) AS value FROM e")
def entity_extraction(spark, d):
    all_of = lambda p, t: F.transform(F.regexp_extract_all("text", F.lit(p), F.lit(0)), lambda v: F.struct(F.lit(t).alias("type"), F.lower(v).alias("value")))
    found = F.concat(all_of(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "ip"), all_of("[A-Z]{6,}", "caps"))
    return table(spark, d, "documents").select("doc_id", F.explode_outer(F.array_distinct(found)).alias("e")).filter("e is not null").select("doc_id", "e.*")


@query("SELECT p_partkey, p_partkey % 3 <> 2 AS grounded FROM part")
def grounding(spark, d):
    v = F.col("p_retailprice")
    quote = F.concat(F.lit("a price of "), F.when(F.col("p_partkey") % 3 == 2, F.lit("7")).otherwise(F.format_number(v, 2)), F.lit(" was seen in 3 shops"))
    return table(spark, d, "part").select("p_partkey", X.grounded(v, quote).alias("grounded"))


@query("SELECT c_custkey, left(sha256(c_name), 16) AS id, md5(c_mktsegment) AS schema_id, regexp_replace(c_name, '[^A-Za-z0-9_.-]+', '_', 'g') AS safe FROM customer")
def identifiers(spark, d):
    return table(spark, d, "customer").select("c_custkey", X.short_hash(F.col("c_name")).alias("id"), F.md5("c_mktsegment").alias("schema_id"), X.safe_name(F.col("c_name")).alias("safe"))


@query("SELECT a.p_partkey AS p_partkey, (a.p_size * 100 + a.p_partkey % 10) > (25 * 100 + 3) AS newer FROM part a")
def version_compare(spark, d):
    v = F.concat(F.lit("v"), F.col("p_size"), F.lit("."), F.col("p_partkey") % 10)
    return table(spark, d, "part").select("p_partkey", (X.version_key(v) > X.version_key(F.lit("25.3"))).alias("newer"))


@query("SELECT doc_id, len(list_filter(string_split(text, ' '), lambda w: regexp_matches(w, '[^a-zA-Z0-9\\s.,;:\\-()/%]')))::BIGINT AS odd_cells FROM documents")
def odd_characters(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(F.filter(F.split("text", " "), lambda w: w.rlike(r"[^a-zA-Z0-9\s.,;:\-()/%]"))).cast("bigint").alias("odd_cells"))


@query("WITH n AS (SELECT doc_id, text, greatest(1, ceil((length(text) - 64) / 448.0))::INT AS n FROM documents WHERE length(text) > 0), c AS (SELECT doc_id, k AS chunk_no, substr(text, k * 448 + 1, 512) AS chunk FROM (SELECT doc_id, text, unnest(range(0, n))::INT AS k FROM n)) SELECT doc_id, chunk_no, md5(chunk) AS h, length(chunk) AS n FROM c WHERE length(chunk) >= 8")
def chunking(spark, d):
    return retrieval.chunks(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "chunk_no", F.md5("chunk").alias("h"), F.length("chunk").cast("bigint").alias("n"))


QUERY = ["the", "tion", "queeux", "sch"]


@query(f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents), n AS (SELECT count(*) AS n, avg(len(w)) AS al FROM w),
    t AS (SELECT doc_id, len AS len, tok, count(*) AS tf FROM (SELECT doc_id, len(w) AS len, unnest(w) AS tok FROM w) WHERE tok IN {tuple(QUERY)} GROUP BY ALL), f AS (SELECT tok, count(*) AS df FROM t GROUP BY 1)
    SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / al))), 5) AS score FROM t JOIN f USING (tok), n GROUP BY 1""")
def bm25(spark, d):
    return retrieval.bm25(table(spark, d, "documents"), "doc_id", "text", QUERY).withColumn("score", F.round("score", 5))


@query("WITH q AS (SELECT vec_id AS query, embedding::DOUBLE[] AS a FROM embeddings WHERE vec_id % 100 = 0), s AS (SELECT query, vec_id, list_cosine_similarity(a, embedding::DOUBLE[]) AS score FROM embeddings, q) SELECT query, vec_id, round(score, 6) AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM s WHERE score >= 0.1) WHERE rank <= 15")
def vector_top_k(spark, d):
    v = table(spark, d, "embeddings")
    return retrieval.nearest(v.filter("vec_id % 100 = 0"), v, "vec_id", "embedding", 15, 0.1).withColumn("score", F.round("score", 6))


@query()
def hashed_embeddings(spark, d):
    """Hashed character trigram vectors of chunks; their length is 1."""
    c = retrieval.chunks(table(spark, d, "conversations").withColumn("key", F.col("conv_id") * 1000 + F.col("turn")), "key", "text")
    v = retrieval.hashed_embedding(c.withColumn("id", F.col("key") * 1000 + F.col("chunk_no")), "id", "chunk", 64)
    return v.select("id", F.round(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)), 6).alias("length"))


@query("SELECT event_id, round(0.55 * (value / 500) + 0.2 * (user_id % 10 / 10.0) + 0.15 * (event_id % 4 / 4.0) + 0.1, 6) AS score, CASE WHEN 0.55 * (value / 500) + 0.2 * (user_id % 10 / 10.0) + 0.15 * (event_id % 4 / 4.0) + 0.1 >= 0.5 THEN 'A' WHEN 0.55 * (value / 500) + 0.2 * (user_id % 10 / 10.0) + 0.15 * (event_id % 4 / 4.0) + 0.1 >= 0.3 THEN 'B' ELSE 'C' END AS grade FROM events")
def hybrid_score(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("value") / 500).alias("semantic"), (F.col("user_id") % 10 / 10.0).alias("keyword"), (F.col("event_id") % 4 / 4.0).alias("ontology"), F.lit(1.0).alias("graph"))
    s = recommend.weighted({"semantic": 0.55, "keyword": 0.20, "ontology": 0.15, "graph": 0.10})
    return e.select("event_id", F.round(s, 6).alias("score"), F.when(s >= 0.5, "A").when(s >= 0.3, "B").otherwise("C").alias("grade"))


@query("SELECT user_id, list_sort(list(DISTINCT event_type)) AS links, round(len(list_intersect(list(DISTINCT event_type), ['click', 'view', 'purchase', 'refund', 'signup'])) / 5.0, 4)::DOUBLE AS completeness FROM events GROUP BY 1")
def chain_completeness(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("links"))
    return g.withColumn("completeness", F.round(retrieval.completeness(F.col("links"), ["click", "view", "purchase", "refund", "signup"]), 4))


@query(
    """WITH e AS (SELECT event_type AS g, value AS x, 5 + event_id % 5 AS se FROM events), a AS (SELECT g, count(*) AS k, sum(1 / (se * se)) AS sw, sum(1 / (se * se) ** 2) AS sw2, sum(x / (se * se)) AS swx, sum(x * x / (se * se)) AS swxx FROM e GROUP BY 1),
    b AS (SELECT *, greatest(0, swxx - swx * swx / sw) AS q, sw - sw2 / sw AS c FROM a), t AS (SELECT *, greatest(0, (q - (k - 1)) / c) AS tau2 FROM b)
    SELECT t.g AS g, any_value(k) AS k, round(any_value(swx / sw), 6) AS fixed, round(any_value(q), 3) AS q, round(any_value(tau2), 4) AS tau2, round(any_value(greatest(0, (q - (k - 1)) / q * 100)), 5) AS i2, round(sum(x / (se * se + tau2)) / sum(1 / (se * se + tau2)), 6) AS random FROM e JOIN t USING (g) GROUP BY 1"""
)
def meta_analysis(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("g"), F.col("value").alias("x"), (5 + F.col("event_id") % 5).alias("se"))
    p = retrieval.pooled(e, ["g"], "x", "se")
    return p.select("g", "k", F.round("fixed", 6).alias("fixed"), F.round("q", 3).alias("q"), F.round("tau2", 4).alias("tau2"), F.round("i2", 5).alias("i2"), F.round("random", 6).alias("random"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY 1, 2")
def response_curve(spark, d):
    r = retrieval.response_line(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "l_extendedprice")
    return r.select("l_returnflag", "l_linestatus", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round("r2", 6).alias("r2"))


@query("SELECT o_orderkey, round(exp(-ln(2) * greatest(0, 2003 - year(o_orderdate)) / 10), 6) AS recency FROM orders")
def paper_priority(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.round(retrieval.recency(F.year("o_orderdate"), 2003), 6).alias("recency"))


@query("WITH c AS (SELECT coalesce(nullif(p_brand, 'Brand#1'), '(unspecified)') AS crop, t AS design FROM (SELECT p_brand, unnest([p_type, CASE WHEN p_size > 25 THEN 'large' END]) AS t FROM part)) SELECT crop, coalesce(design, '(unspecified)') AS design, count(*) AS n FROM c GROUP BY 1, 2")
def cross_counts(spark, d):
    p = table(spark, d, "part").select(F.coalesce(F.nullif("p_brand", F.lit("Brand#1")), F.lit("(unspecified)")).alias("crop"), F.explode(F.array("p_type", F.when(F.col("p_size") > 25, "large"))).alias("design"))
    return p.groupBy("crop", F.coalesce("design", F.lit("(unspecified)")).alias("design")).agg(F.count("*").alias("n"))


@query()
def html_table_cells(spark, d):
    """Cells of all tables of the pages, spans expanded."""
    from tessera.sources.files import html_tables

    return html_tables(table(spark, d, "pages"), "page_id", "html")
