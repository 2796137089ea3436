"""Hidden Markov language model.

Word counts are taken over all training rows.  Words that occur SEEN times or more and make
up at least 1/HEAD of all tokens (so at most HEAD of them, whatever the corpus) have
emissions of their own; every other word is emitted through one class "rare" and, inside it,
by its smoothed share of the rare tokens, which does not depend on the state.  Words that
occur once are rare at every size, so the class has the mass that new words need.  A
sequence's likelihood is exactly

    P(classes by the scaled forward recursion) * product over rare words of P(word | rare)

Every text is cut into words once; its classes are stored and all rounds read them.
Baum-Welch: each partition sums expected counts of its training rows in full, partitions
are added up, the driver normalises the K x (K + HEAD) table.  Rounds over all training rows
go on until the log likelihood (with the smoothing's prior) gained a share below TOLERANCE in
CALM rounds in succession.  From states that are near-copies of each other EM stays on a
plateau for some twenty rounds, so rounds start from the best of STARTS random models with
lasting states, each fitted on a sample of training rows; the sample decides the start alone.
Expected counts of a round are single precision inside a batch of sequences; scores are double.
The part of each text outside the head joins the word counts by word; no word of the join is frequent.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import compress, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower_words, batches, id_bucket, stored

HEAD = 200_000  # most words with emissions of their own, besides the end
SEEN = 2  # occurrences of such a word at least
END = b""  # no word is empty
FLUSH = 200_000  # distinct words a task counts before it hands them on
CELLS = 1_000_000  # padded positions of a batch of sequences
LONG = 1 << 18  # positions of a sequence that are held at once
SMOOTH = 0.01  # added to each expected count
TOLERANCE, CALM = 1e-4, 2  # training ends when so many rounds in succession gain less than this share
MOST = 200  # rounds after which training that has not settled is an error
SAMPLE, PREFIX, STARTS = 600, 20_000, 4  # rows of the start's sample, their characters, random starts
PRIOR = 100  # tokens of the word counts that stand beside the sample's expected counts


def word_counts(docs: DataFrame, in_training) -> DataFrame:
    """(word binary, c): counts over the training rows, one end per row as the empty word."""

    def run(frames):
        import pyarrow as pa

        def out(c):
            return pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "c"])

        counts: Counter = Counter()
        for part in frames:
            for rows in batches([part], ["doc_id", "text"], 256):
                for d, text in rows:
                    if in_training(d):
                        counts.update(ascii_lower_words(text))
                        counts[END] += 1
                if len(counts) >= FLUSH:
                    yield out(counts)
                    counts = Counter()
        yield out(counts)

    return docs.select("doc_id", "text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


class Model:
    """Initial, transition and emission probabilities over head words, then the class rare."""

    def __init__(self, words: list[bytes], counts: np.ndarray, rare: int, states: int, seed: int = 0):
        self.ids = {w: i for i, w in enumerate(words)}
        share = np.append(counts, max(rare, 1)).astype(float)
        share /= share.sum()
        tilt = np.array([[zlib.crc32(w + bytes([k, seed])) / 2**32 for w in [*words, b" rare"]] for k in range(states)])
        self.emit = share * (0.5 + tilt)
        self.emit /= self.emit.sum(1, keepdims=True)
        near = np.random.default_rng(seed).random((states, states)) + 1
        self.move = near / near.sum(1, keepdims=True)
        self.first = np.full(states, 1 / states)

    def updated(self, first: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.first = (first + SMOOTH) / (first + SMOOTH).sum()
        self.move = (move + SMOOTH) / (move + SMOOTH).sum(1, keepdims=True)
        self.emit = (emit + SMOOTH) / (emit + SMOOTH).sum(1, keepdims=True)

    def prior(self) -> float:
        """Log density, up to a constant, that SMOOTH puts on the tables; with it no round of Baum-Welch loses."""
        return SMOOTH * float(np.log(self.first).sum() + np.log(self.move).sum() + np.log(self.emit).sum())

    def classes(self, text: str | None) -> np.ndarray:
        get, rare = self.ids.get, len(self.ids)
        words = ascii_lower_words(text)
        words.append(END)
        return np.array(list(map(get, words, repeat(rare))), np.int32)


def _batched(sequences: list[np.ndarray]):
    """Index lists of sequences of like length whose padded size stays below CELLS."""
    order, at = sorted(range(len(sequences)), key=lambda i: -len(sequences[i])), 0
    while at < len(order):
        n = max(1, CELLS // len(sequences[order[at]]))
        yield order[at : at + n]
        at += n


def _padded(sequences: list[np.ndarray], part: list[int]):
    """Lengths, number of sequences that reach each step (a prefix), and cells by step and sequence."""
    lengths = np.array([len(sequences[i]) for i in part])
    live = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left").tolist()
    cells = np.zeros((lengths[0], len(part)), np.int32)
    for k, i in enumerate(part):
        cells[: lengths[k], k] = sequences[i]
    return lengths, live, cells


def _alphas(model: Model, turn: np.ndarray, emit: np.ndarray, live: list[int], before: np.ndarray | None):
    """Scaled forward probabilities by state, step and sequence, and the scales; ``before`` is the step ahead of the first."""
    alphas, scales = np.zeros(emit.shape, emit.dtype), np.ones(emit.shape[1:], emit.dtype)
    for t, n in enumerate(live):
        a = np.repeat(model.first[:, None].astype(emit.dtype), n, 1) if before is None else turn @ before[:, :n]
        a *= emit[:, t, :n]
        scale = a.sum(0)
        a /= scale
        alphas[:, t, :n], scales[t, :n], before = a, scale, a
    return alphas, scales


def forward(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log likelihood of each sequence, by the scaled forward recursion; LONG steps are held at once."""
    result, turn = np.zeros(len(sequences)), np.ascontiguousarray(model.move.T)
    for part in _batched(sequences):
        _, live, cells = _padded(sequences, part)
        alpha, total = None, np.zeros(len(part))
        for at in range(0, len(live), LONG):
            emit = model.emit[:, cells[at : at + LONG]]
            scales = np.ones(emit.shape[1:])
            for t, n in enumerate(live[at : at + LONG]):
                alpha = model.first[:, None] * emit[:, t, :n] if alpha is None else (turn @ alpha[:, :n]) * emit[:, t, :n]
                scale = alpha.sum(0)
                alpha /= scale
                scales[t, :n] = scale
            total += np.log(scales).sum(0)
        result[part] = total
    return result


def expected(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected first-state, transition and emission counts of the sequences, and their log likelihood.

    In the precision of ``model.emit``; sums over batches are double.  Of a sequence beyond
    LONG steps the forward pass keeps one column for each LONG steps and is repeated from it.
    """
    kind, (states, size) = model.emit.dtype, model.emit.shape
    first, move, emit_sum, loglik = np.zeros(states), np.zeros((states, states)), np.zeros((states, size)), 0.0
    step = model.move.astype(kind)
    turn = np.ascontiguousarray(step.T)
    for part in _batched(sequences):
        lengths, live, cells = _padded(sequences, part)
        starts: list[np.ndarray | None] = [None]  # the column ahead of each block
        for at in range(0, len(live) - LONG, LONG):
            starts.append(_alphas(model, turn, model.emit[:, cells[at : at + LONG]], live[at : at + LONG], starts[-1])[0][:, -1])
        beta = np.ones((states, len(part)), kind)
        for at in range((len(live) - 1) // LONG * LONG, -1, -LONG):
            here, before = live[at : at + LONG], starts[at // LONG]
            emit = model.emit[:, cells[at : at + LONG]]
            alphas, scales = _alphas(model, turn, emit, here, before)
            loglik += float(np.log(scales).sum(dtype=float))
            emit /= scales
            moved = np.zeros((states, states), kind)
            for t in range(len(here) - 1, -1, -1):
                n = here[t]
                alphas[:, t, :n] *= beta[:, :n]  # gamma from here on
                if at + t:
                    ahead = emit[:, t, :n] * beta[:, :n]
                    moved += (alphas[:, t - 1, :n] if t else before[:, :n]) @ ahead.T
                    beta[:, :n] = step @ ahead
            move += moved
            if not at:
                first += alphas[:, 0].sum(1, dtype=float)
            mask = np.arange(at, at + len(here))[:, None] < lengths[None, :]
            where = cells[at : at + LONG][mask]
            for k in range(states):
                emit_sum[k] += np.bincount(where, weights=alphas[k][mask], minlength=size)
    return first, move * model.move, emit_sum, loglik


def _settled(history: list[float]) -> bool:
    gains = [b - a < TOLERANCE * abs(b) for a, b in zip(history[:-1], history[1:])]
    return len(gains) >= CALM and all(gains[-CALM:])


def vocabulary(counts: DataFrame) -> dict:
    """Head words in order with their counts, and sums over all words; the driver holds HEAD + 1 words at most."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = counts.filter((F.col("c") * HEAD >= total) & (F.col("c") >= SEEN) | (F.col("word") == F.lit(END))).orderBy("word").toArrow()
    words, c = head["word"].to_pylist(), head["c"].to_numpy().astype(np.int64)
    rare, kinds = int(total) - int(c.sum()), int(distinct) - len(words)
    if END not in words[:1]:
        words, c = [END, *words], np.append(0, c)
    return {"words": words, "counts": c, "tokens": int(total), "kinds": int(distinct), "rare": rare, "rare_kinds": kinds}


def coded(docs: DataFrame, facts: dict, in_training) -> DataFrame:
    """docs: doc_id, key, text -> doc_id, key, train, n, n_known, base, ids, words, times.

    ids: the class of each word and of the end, 2 or 4 bytes each; words and times: the rare
    words of the text; n_known and base: those of the head.
    """
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    shared = spark.sparkContext.broadcast((facts["words"], facts["counts"]))

    def run(frames):
        import pyarrow as pa

        words, counts = shared.value
        get, rare, width = {w: i for i, w in enumerate(words)}.get, len(words), _width(len(words))
        logs, there = np.log10(counts + 1), (counts > 0).astype(np.int64)
        names = ["doc_id", "key", "train", "n", "n_known", "base", "ids", "words", "times"]
        types = [None, pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]
        for part in frames:
            types[0] = part.schema.field("doc_id").type
            for rows in batches([part], ["doc_id", "key", "text"], 512):
                made = []
                for d, key, t in rows:
                    said = ascii_lower_words(t)
                    said.append(END)
                    ids = np.array(list(map(get, said, repeat(rare))), np.int32)
                    other = Counter(compress(said, (ids == rare).tolist()))
                    head = np.bincount(ids)[:rare]
                    at = np.flatnonzero(head)
                    made.append((d, key, in_training(d), len(said), int(head[at] @ there[at]), float(head[at] @ logs[at]), ids.astype(width).tobytes(), list(other), list(other.values())))
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(types)], names=names)

    return docs.select("doc_id", "key", "text").mapInArrow(run, f"doc_id {kind}, key bigint, train boolean, n bigint, n_known bigint, base double, ids binary, words array<binary>, times array<int>")


def _width(classes: int):
    return np.uint16 if classes < 1 << 16 else np.int32


def _started(codes: DataFrame, facts: dict, states: int) -> Model:
    """The start of training: the best of STARTS random models after Baum-Welch on a sample of about SAMPLE rows."""
    words, counts, rare = facts["words"], facts["counts"], facts["rare"]
    share = np.append(counts, max(rare, 1)).astype(float)
    share /= share.sum()
    width, rows = _width(len(words)), max(1, int(counts[0]))
    at = F.pmod(F.xxhash64("doc_id", "key"), F.lit(1 << 30)) < int(SAMPLE / rows * (1 << 30)) + 1
    chosen = codes.filter(F.col("train") & at).select(F.substring("ids", 1, PREFIX * np.dtype(width).itemsize).alias("ids")).limit(4 * SAMPLE).toArrow()
    seqs = [np.frombuffer(b, width) for b in sorted(chosen["ids"].to_pylist())]
    best, found = -math.inf, Model(words, counts, rare, states)
    for seed in range(STARTS if seqs else 0):
        rng = np.random.default_rng(seed)
        model = Model(words, counts, rare, states, seed)
        model.emit = share * rng.random(model.emit.shape)
        model.emit /= model.emit.sum(1, keepdims=True)
        model.move = 0.7 * np.eye(states) + 0.3 * model.move
        history: list[float] = []
        while len(history) < MOST and not _settled(history):
            first, move, emit, loglik = expected(model, seqs)
            model.updated(first, move, emit + PRIOR * share)
            history.append(loglik)
        if history[-1] > best:
            best, found = history[-1], model
    return found


def train(codes: DataFrame, facts: dict, states: int = 4, rounds: int | None = None) -> tuple[Model, list[float]]:
    """Fit on every training row of ``codes``, until it settles or for at most ``rounds`` rounds: the model, the log likelihood by round.

    The driver holds the K x (K + HEAD) table and the start's sample.
    """
    spark, words = codes.sparkSession, facts["words"]
    model = _started(codes, facts, states)
    history: list[float] = []
    rows = codes.filter("train").select("ids")
    size = len(words) + 1
    width = states * (1 + states + size) + 1
    while not _settled(history) and (rounds is None or len(history) < rounds):
        if len(history) >= MOST:
            raise RuntimeError(f"training did not settle in {MOST} rounds")
        shared = spark.sparkContext.broadcast((model.first, model.move, model.emit.astype(np.float32)))

        def run(frames, shared=shared):
            import pyarrow as pa

            now, sums = Model([], np.zeros(0), 1, states), np.zeros(width)
            now.first, now.move, now.emit = shared.value
            for part in frames:
                for at in range(0, part.num_rows, 2048):
                    seqs = [np.frombuffer(b.as_buffer(), _width(size - 1)) for b in part.column(0).slice(at, 2048)]
                    f, m, e, ll = expected(now, seqs)
                    sums += np.concatenate([f, m.ravel(), e.ravel(), [ll]])
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at], pa.float64())], names=["i", "x"])

        sums = np.zeros(width)
        added = rows.mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()  # at most width rows
        shared.unpersist()
        sums[added["i"].to_numpy()] = added["x"].to_numpy()
        history.append(float(sums[-1]) + model.prior())
        model.updated(sums[:states], sums[states : states + states**2].reshape(states, states), sums[states + states**2 : -1].reshape(states, -1))
    return model, history


def score(docs: DataFrame, in_training=lambda d: id_bucket(d, 7) != 2, states: int = 4, rounds: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    docs: doc_id, text; other columns are ignored.  A null text is an empty one (its end
    alone is scored), a null id counts as empty text for the split.  Repeated rows come
    back as often as they are there.  With no training row all counts are 0 and the model is
    uniform.  An empty table gives an empty result.  Of a text of any length a task holds its
    words and LONG steps of the recursion.
    """
    slim = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    counts = stored(word_counts(slim, in_training), "hmm-counts")
    facts = vocabulary(counts)
    codes = stored(coded(slim, facts, in_training), "hmm-codes")
    model, _ = train(codes, facts, states, rounds)
    base_all = math.log10(facts["tokens"] + facts["kinds"] + 1)
    rare_all = math.log10(facts["rare"] + facts["rare_kinds"] + 1)
    size, tables = len(facts["words"]), docs.sparkSession.sparkContext.broadcast((model.first, model.move, model.emit))

    def run(frames):
        import pyarrow as pa

        now = Model([], np.zeros(0), 1, states)
        now.first, now.move, now.emit = tables.value
        for part in frames:
            for at in range(0, part.num_rows, 2048):
                piece = part.slice(at, 2048)
                scores = forward(now, [np.frombuffer(b.as_buffer(), _width(size)) for b in piece.column(piece.num_columns - 1)]) / math.log(10)
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(scores, pa.float64())], names=[*piece.schema.names[:-1], "score"])

    slim_kind = ", ".join(f"{c} {t}" for c, t in codes.select("doc_id", "key", "n", "n_known", "base").dtypes)
    scored = codes.select("doc_id", "key", "n", "n_known", "base", "ids").mapInArrow(run, f"{slim_kind}, score double")
    n, c = F.col("n"), F.coalesce(F.col("c"), F.lit(0))
    pairs = codes.select("doc_id", "key", F.explode(F.arrays_zip("words", "times")).alias("p")).select("doc_id", "key", F.col("p.words").alias("word"), F.col("p.times").alias("n"))
    rare = (
        pairs.join(counts, "word", "left")
        .groupBy("doc_id", "key").agg(F.sum(F.when(c > 0, n).otherwise(0)).alias("n_known"), F.sum(n * F.log10(c + 1)).alias("base"), F.sum(n).alias("n_rare"))
        .select("doc_id", "key", F.lit(0).cast("bigint").alias("n"), "n_known", "base", F.lit(0.0).alias("score"), F.lit(0).alias("whole"), "n_rare")
    )
    whole = scored.withColumn("whole", F.lit(1)).withColumn("n_rare", F.lit(0).cast("bigint"))
    # one shuffle of slim rows brings both parts of a text together; k counts repeats of the row
    both = whole.unionByName(rare).groupBy("doc_id", "key").agg(
        F.sum("whole").alias("k"), F.max("n").alias("n"),
        F.max(F.when(F.col("whole") == 1, F.col("n_known"))).alias("known0"), F.max(F.when(F.col("whole") == 1, F.col("base"))).alias("base0"),
        F.max(F.when(F.col("whole") == 1, F.col("score"))).alias("score0"),
        F.sum(F.when(F.col("whole") == 0, F.col("n_known"))).alias("known1"), F.sum(F.when(F.col("whole") == 0, F.col("base"))).alias("base1"), F.sum("n_rare").alias("n_rare"),
    )
    share = lambda x, zero: F.coalesce(x / F.col("k"), F.lit(zero))
    return both.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("k").cast("int")))).select(
        "doc_id",
        (F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")), F.lit(7)) == 2).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("known0") + share(F.col("known1"), 0.0).cast("bigint")).alias("n_known"),
        F.lit(facts["tokens"]).cast("bigint").alias("train_tokens"),
        (F.col("base0") + share(F.col("base1"), 0.0) - F.col("n") * base_all).alias("base_score"),
        (F.col("score0") + share(F.col("base1"), 0.0) - share(F.col("n_rare"), 0.0) * rare_all).alias("score"),
    )
