"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of hashed features: each word, the character
3- and 4-grams of the word between brackets, and the character skip-bigram of each two
neighbouring words (their first characters).  A softmax over two labels stands on the
average.  Vectors and softmax are trained by numpy stochastic gradient descent on a bounded
sample of labelled rows.  Because the output is linear in the average, scoring needs one
number per feature.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, id_remainder, open_file, stored

BUCKETS = 1 << 17
DIM = 8
SAMPLE = 4000  # most labelled rows that the model is fitted on, the first by md5 of the id
FEATURES = 16_000_000  # ... and most features of those rows together, 8 bytes each on the driver
EPOCHS = 8
RATE = 0.8
SHORT = 100  # features of no meaning in every average: a text of a few words stays near the prior
KNOWN, LONG = 150_000, 200  # words whose sums a worker keeps, and the length from which it does not
SPREAD = np.uint64(0x9E3779B97F4A7C15)  # multiplicative hashing


def word_features(word: str) -> Iterator[int]:
    """Buckets of a word and its character 3- and 4-grams, one at a time: a text without white space is one word."""
    b = f"<{word}>"
    if b.isascii():
        b = b.encode()
        yield zlib.crc32(b) % BUCKETS
        for n in (3, 4):
            for i in range(len(b) - n + 1):
                yield zlib.crc32(b[i : i + n]) % BUCKETS
    else:
        yield zlib.crc32(b.encode("utf-8", "surrogatepass")) % BUCKETS
        for n in (3, 4):
            for i in range(len(b) - n + 1):
                yield zlib.crc32(b[i : i + n].encode("utf-8", "surrogatepass")) % BUCKETS


def pair_features(words: list[str]) -> np.ndarray:
    """Bucket of the first characters of each two neighbouring words."""
    first = np.frombuffer("".join([w[0] for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return ((first[:-1] << np.uint64(21) | first[1:]) * SPREAD >> np.uint64(47)).astype(np.int64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids, ascending, and their shares of the text (empty text: none)."""
    words = (text or "").split()
    tally: Counter = Counter()
    for w, n in Counter(words).items():
        for f in word_features(w):
            tally[f] += n
    ids, share = np.unique(pair_features(words), return_counts=True) if len(words) > 1 else (np.zeros(0, np.int64),) * 2
    for f, n in zip(ids.tolist(), share.tolist()):
        tally[f] += n
    ids = np.array(sorted(tally), np.int64)
    share = np.array([tally[f] for f in ids.tolist()], float)
    return ids, share / (share.sum() + SHORT)


class Classifier:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
        self.out, self.bias = np.zeros((2, DIM)), np.zeros(2)

    def fit(self, rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 0) -> "Classifier":
        """rows: label, feature ids, shares."""
        rng, n = np.random.default_rng(seed), len(rows)
        tally = np.bincount([y for y, _, _ in rows], minlength=2)
        if n == 0 or tally.min() == 0:
            self.bias = np.log((tally + 1) / (n + 2))
            return self
        step, steps = 0, EPOCHS * n
        for _ in range(EPOCHS):
            for i in rng.permutation(n):
                y, ids, share = rows[i]
                rate = RATE * (1 - step / steps)
                step += 1
                mean = share @ self.vectors[ids]
                z = self.out @ mean + self.bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y] -= 1
                back = p @ self.out
                self.out -= rate * p[:, None] * mean
                self.bias -= 0.1 * rate * p
                self.vectors[ids] -= (rate * share / (share @ share))[:, None] * back  # moves the average by rate * back
        return self

    def weights(self) -> tuple[np.ndarray, float]:
        """The margin of label 1 over label 0 that each feature gives, and the constant part."""
        return self.vectors @ (self.out[1] - self.out[0]), float(self.bias[1] - self.bias[0])


def in_training(doc_id: Column) -> Column:
    """The fold that labels are learnt from."""
    return id_remainder(doc_id, 3) != 1


def train(docs: DataFrame, labels: DataFrame, label: str, fold=in_training, sample: int = SAMPLE, most: int = FEATURES, seed: int = 0) -> Classifier:
    """Fit on labelled rows of the fold, the first by md5 of the id: at most ``sample`` rows of ``most`` features in all.

    Ids and labels that are null are left out; of an id's several labels the largest counts,
    of its several texts the first by md5, so reruns agree.
    """
    import pyarrow as pa

    slim = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").withColumn("nth", F.md5(F.col("doc_id").cast("string")))
    chosen = slim.filter(fold(F.col("doc_id"))).groupBy("doc_id", "nth").agg(F.max("y").alias("y")).orderBy("nth", "doc_id").limit(sample)

    def run(frames):
        import pyarrow as pa

        names = ["nth", "y", "n", "ids", "share"]
        types = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        for part in frames:
            for rows in batches([part], ["nth", "y", "text"], 256):
                made = [(nth, y, len(f[0]), f[0].astype(np.int32).tobytes(), f[1].astype(np.float32).tobytes()) for nth, y, f in ((nth, y, features(t)) for nth, y, t in rows)]
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(types)], names=names)

    # at most ``sample`` rows are broadcast, and as many texts are grouped
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "nth", "y").agg(F.min(F.struct(F.md5("text").alias("h"), "text"))["text"].alias("text"))
    made = stored(joined.select("nth", "y", "text").mapInArrow(run, "nth string, y int, n bigint, ids binary, share binary"), "quality-sample")
    views = _sample(made.inputFiles(), most)
    model = Classifier(seed).fit(views, seed)
    del views
    pa.default_memory_pool().release_unused()
    return model


def _sample(files: list[str], most: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Label, feature ids and shares by ``nth``, of the first rows of ``most`` features in all.

    Read from the shared folder by portions: collected through Spark, the features would stand in the driver's JVM as well, twice.
    """
    from urllib.parse import unquote

    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    def read(*columns):
        for f in files:
            with open_file(unquote(f) if f.startswith("file:") else f) as source:
                yield from pq.ParquetFile(source).iter_batches(256, columns=columns)

    sizes = sorted((nth, n) for b in read("nth", "n") for nth, n in zip(*(c.to_pylist() for c in b.columns)))
    fits, views = np.cumsum([n for _, n in sizes]) <= most, []
    for b in read("nth", "y", "ids", "share"):
        if not fits.all():
            b = b.filter(pc.less(b["nth"], sizes[int(np.argmin(fits))][0]))
        views += [(nth.as_py(), y.as_py(), np.frombuffer(i.as_buffer(), np.int32), np.frombuffer(s.as_buffer(), np.float32)) for nth, y, i, s in zip(b["nth"], b["y"], b["ids"], b["share"])]
    return [v[1:] for v in sorted(views, key=lambda v: v[0])]


def scored(docs: DataFrame, model: Classifier, name: str = "quality_score") -> DataFrame:
    """All columns of docs and the score, 0 to 1, of the whole text under ``name`` (a column of that name is replaced); no shuffle."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model.weights())
    at = docs.columns.index("text")

    def run(frames):
        import pyarrow as pa

        weights, bias = shared.value
        weight = weights.tolist()
        known: dict[str, complex] = {}

        def of(word):  # sum of the word's features, and their number as imaginary part
            s, n = 0.0, 0
            for i in word_features(word):
                s += weight[i]
                n += 1
            return complex(s, n)

        def score(text):
            words = (text or "").split()
            look, new = known, set(words).difference(known)
            if new:
                made = {w: of(w) for w in new}
                if len(known) + len(new) <= KNOWN:
                    known.update((w, x) for w, x in made.items() if len(w) < LONG)
                if not new <= known.keys():
                    look = {w: known[w] if w in known else made[w] for w in set(words)}
            total = sum(map(look.__getitem__, words), 0j)
            s, n = total.real, total.imag
            if len(words) > 1:
                s, n = s + float(weights[pair_features(words)].sum()), n + len(words) - 1
            return 1 / (1 + np.exp(-(s / (n + SHORT) + bias)))

        for part in frames:
            for k in range(0, part.num_rows, 256):
                piece = part.slice(k, 256)
                scores = pa.array([float(score(t)) for t in piece.column(at).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([*piece.columns, scores], names=[*piece.schema.names, name])
            del part, piece
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, fold=in_training) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    docs: doc_id, text; labels: doc_id, quality; other columns are ignored.  Null and empty
    texts get the model's prior.  Without labelled rows the score is 0.5 throughout; with
    rows of one label only it is that label's smoothed share.  Repeated rows come back as
    often as they are there; an empty table gives an empty result.  A text of any length is
    read whole; a task holds the rows of one Arrow batch.
    """
    slim = docs.select("doc_id", "text")
    out = scored(slim, train(slim, labels, "quality", fold))
    return out.select("doc_id", (~fold(F.col("doc_id"))).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
