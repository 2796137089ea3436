"""Chunks, BM25, vectors and hybrid retrieval; pooled effects; response lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunks(df: DataFrame, key: str, text: str, size: int = 512, overlap: int = 64, least: int = 8) -> DataFrame:
    """(key, chunk_no, chunk): windows of ``size`` characters, ``overlap`` shared; shorter than ``least`` dropped."""
    step = size - overlap
    n = F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / float(step))).cast("int")
    cut = lambda i: F.struct(i.alias("chunk_no"), F.substring(F.col(text), i * step + 1, F.lit(size)).alias("chunk"))
    # chunks are exploded, not the text with each chunk's number
    t = df.filter(F.length(text) > 0).select(key, F.explode(F.transform(F.sequence(F.lit(0), n - 1), cut)).alias("c"))
    return t.select(key, "c.chunk_no", "c.chunk").filter(F.length("chunk") >= least)


def tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token, tf) of words [a-z0-9]+ in lower case."""
    words = F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))
    return df.select(key, F.explode(words).alias("token")).groupBy(key, "token").agg(F.count("*").alias("tf"))


def bm25(df: DataFrame, key: str, text: str, query: Sequence[str], k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(key, score) of documents with a query word.  Only those words leave the scan; lengths are counted in place."""
    words = F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))
    t = df.select(F.col(key), F.size(words).alias("len"), F.filter(words, lambda w: w.isin(*query)).alias("hits"))
    whole = F.broadcast(t.agg(F.count("*").alias("n"), F.avg("len").alias("avg_len")))
    tf = t.select(key, "len", F.explode("hits").alias("token")).groupBy(key, "len", "token").agg(F.count("*").alias("tf"))
    df_ = F.broadcast(tf.groupBy("token").agg(F.count("*").alias("df")))  # at most one row per query word
    s = tf.join(df_, "token").crossJoin(whole)
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    score = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))
    return s.groupBy(key).agg(F.sum(score).alias("score"))


def nearest(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int, threshold: float = -1.0, block: int = 10_000) -> DataFrame:
    """(query, key, score, rank): the k vectors of greatest cosine for each of a stated set of queries.

    Queries go in blocks of about ``block`` rows, each broadcast against all vectors, and results
    of several blocks are written one by one.  A matrix product in float32 proposes, with a margin above
    its error; what it proposes is scored in double, element after element as SQL does, so copies tie and the smaller
    key comes first.  Every task keeps k rows per query before the shuffle.  Null and zero vectors have no score.
    """
    from tessera.operators.graph import written

    spark = vectors.sparkSession
    q = queries.select(F.col(key).alias("query"), F.col(vector).alias("_q")).filter("_q is not null")
    blocks = max(1, -(-q.count() // block))
    w, out = Window.partitionBy("query").orderBy(F.col("score").desc(), key), None
    schema = f"query {dict(q.dtypes)['query']}, {key} {dict(vectors.dtypes)[key]}, score double"
    for i in range(blocks):
        some = q if blocks == 1 else q.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == i)
        shared = spark.sparkContext.broadcast(_matrices()(some.toArrow()))
        s = vectors.select(key, vector).mapInArrow(_nearest(shared, key, k, threshold), schema)
        best = s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        if blocks > 1:
            best = written(best, "nearest")
            shared.unpersist()
        out = best if out is None else out.union(best)
    return out


def _matrices():
    """The function that gives keys and vectors (doubles) of a table of two columns by length; vectors with nulls are left out.

    It is pickled whole, so that executors need not import this package.
    """

    def of(table) -> dict:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        keys, lists = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns)
        holes = pc.list_parent_indices(lists).filter(pc.is_null(pc.list_flatten(lists))).to_numpy()
        sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False).copy()
        sizes[holes] = -1
        out = {}
        for n in np.unique(sizes[sizes > 0]).tolist():
            at = pa.array(np.flatnonzero(sizes == n))
            out[n] = keys.take(at), pc.list_flatten(lists.take(at)).to_numpy(zero_copy_only=False).reshape(-1, n).astype(float)
        return out

    return of


def _nearest(shared, key: str, k: int, threshold: float, step: int = 512):
    """The function for Arrow batches that gives (query, key, score) of the k best of a task for each query."""
    matrices = _matrices()

    def run(frames):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def squares(m):  # summed in order, as the score is
            s = np.zeros(len(m))
            for c in m.T:
                s += c * c
            return s

        def unit(m, square):  # what float32 can't hold safely is NaN, and so always proposed
            with np.errstate(all="ignore"):
                return np.where(((square > 1e-60) & (square < 1e60))[:, None], m / np.sqrt(square)[:, None], np.nan).astype(np.float32)

        class Best:
            def __init__(self, names, m):
                self.names, self.columns, self.square = names, np.ascontiguousarray(m.T), squares(m)
                self.unit, self.margin = unit(m, self.square), 2e-7 * (m.shape[1] + 8)
                self.low = np.full(len(m), threshold)
                self.rows, self.held = [], 0

            def add(self, names, m):
                square = squares(m)
                units, columns = unit(m, square), np.ascontiguousarray(m.T)
                for at in range(0, len(m), step):
                    some = units[at : at + step]
                    s = self.unit @ some.T
                    low = lambda: (self.low - self.margin).astype(np.float32)[:, None]
                    found = ~(s < low())
                    if len(some) > k and np.count_nonzero(found) > 2 * k * len(s):  # the k best of these bound the rest
                        least = -np.partition(-s, k - 1, axis=1)[:, k - 1].astype(float)
                        self.low = np.fmax(self.low, least - self.margin)
                        found = ~(s < low())
                    q, v = np.nonzero(found)
                    v += at
                    for c in range(0, len(q), 1_000_000):
                        self.score(q[c : c + 1_000_000], v[c : c + 1_000_000], names, columns, square)

            def score(self, q, v, names, columns, square):
                dot = np.zeros(len(q))
                with np.errstate(all="ignore"):
                    for x, y in zip(self.columns, columns):
                        dot += x[q] * y[v]
                    size = np.sqrt(self.square[q] * square[v])
                    cosine = np.clip(dot / size, -1, 1)
                kept = (size != 0) & ~(cosine < np.maximum(self.low[q], threshold))
                self.rows.append((q[kept], names.take(pa.array(v[kept])), cosine[kept]))
                self.held += int(kept.sum())
                if self.held > 4 * k * len(self.square) + 100_000:
                    self.prune()

            def prune(self):
                q, cosine = (np.concatenate([r[c] for r in self.rows]) for c in (0, 2))
                names = pa.concat_arrays([r[1] for r in self.rows])
                place = np.empty(len(names), np.int64)
                place[pc.array_sort_indices(names).to_numpy()] = np.arange(len(names))
                order = np.lexsort((place, np.where(np.isnan(cosine), -np.inf, -cosine), q))
                q = q[order]
                first = np.searchsorted(q, np.arange(len(self.square)))
                nth = np.arange(len(q)) - first[q]
                order, q, nth = order[nth < k], q[nth < k], nth[nth < k]
                cosine = cosine[order]
                full = nth == k - 1
                self.low[q[full]] = np.fmax(self.low[q[full]], cosine[full])
                self.rows, self.held = [(q, names.take(pa.array(order)), cosine)], len(q)

        best = {n: Best(names, m) for n, (names, m) in shared.value.items()}
        for part in frames:
            for n, (names, m) in matrices(part).items():
                if n in best:
                    # of equal vectors only the k smallest keys can count
                    order = pc.array_sort_indices(names).to_numpy()
                    _, same = np.unique(m[order].view(np.dtype((np.void, m.itemsize * n))).ravel(), return_inverse=True)
                    by = np.argsort(same, kind="stable")
                    group = same[by]
                    nth = np.arange(len(by)) - np.searchsorted(group, group)
                    kept = order[by[nth < k]]
                    kept.sort()
                    best[n].add(names.take(pa.array(kept)), m[kept])
        for b in best.values():
            if b.rows:
                b.prune()
                for q, names, cosine in b.rows:
                    for at in range(0, len(q), 100_000):
                        to = slice(at, at + 100_000)
                        yield pa.RecordBatch.from_arrays([b.names.take(pa.array(q[to])), names[to], pa.array(cosine[to])], names=["query", key, "score"])

    return run


def hashed_embedding(df: DataFrame, key: str, text: str, size: int = 256, n: int = 3) -> DataFrame:
    """(key, vector): hashed character n-grams, signed, of unit length; empty texts have zeros."""
    import numpy as np

    def run(frames):
        import zlib

        import pyarrow as pa

        for part in frames:
            out = []
            for t in part.column(1).to_pylist():
                v = np.zeros(size)
                t = (t or "").lower()
                for i in range(len(t) - n + 1):
                    h = zlib.crc32(t[i : i + n].encode())
                    v[h % size] += 1 if h >> 31 else -1
                length = np.linalg.norm(v)
                out.append((v / length if length else v).tolist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.list_(pa.float64()))], names=[key, "vector"])

    return df.select(key, text).mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, vector array<double>")


def pooled(df: DataFrame, by: Sequence[str], effect: str, error: str) -> DataFrame:
    """Fixed and random effects per group: inverse variance, Q, tau2 (DerSimonian-Laird), I2.

    One aggregate of power sums gives all; the random mean needs tau2 first and one more.
    """
    w, x = 1 / (F.col(error) * F.col(error)), F.col(effect)
    d = df.filter((F.col(error) > 0) & x.isNotNull())
    g = d.groupBy(*by).agg(F.count("*").alias("k"), F.sum(w).alias("sw"), F.sum(w * w).alias("sw2"), F.sum(w * x).alias("swx"), F.sum(w * x * x).alias("swxx"))
    q = F.greatest(F.lit(0.0), F.col("swxx") - F.col("swx") * F.col("swx") / F.col("sw"))
    c = F.col("sw") - F.col("sw2") / F.col("sw")
    g = g.withColumns({"fixed": F.col("swx") / F.col("sw"), "q": q, "tau2": F.when(c > 0, F.greatest(F.lit(0.0), (q - (F.col("k") - 1)) / c)).otherwise(0.0), "i2": F.when(q > 0, F.greatest(F.lit(0.0), (q - (F.col("k") - 1)) / q * 100)).otherwise(0.0)})
    wr = 1 / (F.col(error) * F.col(error) + F.col("tau2"))
    r = d.join(g.select(*by, "tau2"), list(by)).groupBy(*by).agg((F.sum(wr * x) / F.sum(wr)).alias("random"), F.sqrt(1 / F.sum(wr)).alias("random_se"))
    return g.select(*by, "k", "fixed", F.sqrt(1 / F.col("sw")).alias("fixed_se"), "q", "tau2", "i2").join(r, list(by))


def response_line(df: DataFrame, by: Sequence[str], x: str, y: str, least: int = 3) -> DataFrame:
    """Slope, intercept and r2 per group; null with too few points or a constant x."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    ok = a.isNotNull() & b.isNotNull()
    g = df.filter(ok).groupBy(*by).agg(F.count("*").alias("n"), F.var_pop(a).alias("vx"), F.var_pop(b).alias("vy"), F.covar_pop(a, b).alias("cxy"), F.avg(a).alias("mx"), F.avg(b).alias("my"))
    slope = F.when((F.col("n") >= least) & (F.col("vx") > 0), F.col("cxy") / F.nullif(F.col("vx"), F.lit(0.0)))
    return g.select(*by, "n", slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"), (slope * F.col("cxy") / F.nullif(F.col("vy"), F.lit(0.0))).alias("r2"))


def completeness(links: Column, required: Sequence[str]) -> Column:
    """Share of required links that an array of links has."""
    return F.size(F.array_intersect(links, F.array(*[F.lit(r) for r in required]))) / float(len(required))


def recency(year: Column, now: int, half_life: float = 10.0) -> Column:
    return F.exp(-F.log(F.lit(2.0)) * F.greatest(F.lit(0.0), now - year) / half_life)


GRAM = 4  # words between blanks that a text and an item must share before they are compared
BLOCK = 64 << 20  # bytes of short items that are sought at once


def mentions(docs: DataFrame, items: DataFrame, item: str, text: str = "text", bound: int = 64 << 20) -> DataFrame:
    """(item, mentions): the number of rows of docs whose text holds the whole text of an item; an empty or null one is in none.

    The words inside an item, its first and last left out, stand as whole words in any text that holds it: both sides
    join by a hash of GRAM such words, one per item, and candidates are compared as texts.  Items too short for that are
    sought in blocks, as a stated list against all documents.  Items are broadcast only below `bound` bytes of text.
    """
    d = docs.select(F.col(text).alias("_text")).filter("_text is not null")
    q = items.select(F.col(item).alias("_item"), F.col(text).alias("_needle")).filter("_needle <> ''")
    needles = q.select("_needle").distinct()
    w = F.split("_needle", " ", -1)
    inside = F.transform(F.sequence(F.lit(2), F.size(w) - GRAM), lambda i: F.array_join(F.slice(w, i, GRAM), " "))
    long = F.size(w) >= GRAM + 2
    # the longest run of words is seldom the commonest
    anchor = F.array_max(F.transform(F.when(long, inside), lambda g: F.struct(F.length(g).alias("n"), g.alias("g"))))["g"]
    keyed = needles.filter(long).withColumn("_gram", F.xxhash64(anchor))
    short = needles.filter(~long)
    cost = F.length("_needle") * 4 + 64
    size, brief = needles.select(cost.alias("c"), long.alias("l")).agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum(F.when(~F.col("l"), F.col("c"))), F.lit(0))).first()
    words = d.select("_text", F.split("_text", " ", -1).alias("_w")).filter(F.size("_w") >= GRAM + 2)
    grams = F.array_distinct(F.transform(F.sequence(F.lit(2), F.size("_w") - GRAM), lambda i: F.xxhash64(F.array_join(F.slice("_w", i, GRAM), " "))))
    if size <= bound:  # one stage: a text stays where it is, only grams that an item has leave the join
        met = words.select("_text", F.explode(grams).alias("_gram")).join(F.broadcast(keyed), "_gram")
    else:  # slim rows are shuffled, texts only to those items that they meet
        sent = words.select(F.md5("_text").alias("_t"), F.explode(grams).alias("_gram")).join(keyed, "_gram").select("_t", "_needle").distinct()
        met = words.select("_text", F.md5("_text").alias("_t")).join(sent, "_t")
    found = met.filter(F.col("_text").contains(F.col("_needle"))).select("_needle")
    blocks = 1 + 2 * brief // BLOCK
    for k in range(blocks if brief else 0):
        some = F.broadcast(short.filter(F.pmod(F.xxhash64("_needle"), F.lit(blocks)) == k))
        found = found.union(d.join(some, d["_text"].contains(F.col("_needle"))).select("_needle"))
    n = found.groupBy("_needle").agg(F.count(F.lit(1)).alias("mentions"))
    out = items.select(F.col(item).alias("_item"), F.col(text).alias("_needle")).join(n, "_needle", "left")
    return out.select(F.col("_item").alias(item), F.coalesce("mentions", F.lit(0)).cast("bigint").alias("mentions"))
