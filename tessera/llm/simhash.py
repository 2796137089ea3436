"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two 64-bit fingerprints with at most three differing bits differ in at most three bytes, so
they share at least five of eight positional bytes.  Five of eight positions always hold
three positions of one half, so postings are kept under three bytes of a half (eight tables
of 24-bit keys) and a pair's shared bytes are tallied inside a posting: five are the
guaranteed minimum, pairs that reach it are verified bit by bit.

A posting that gathers too many fingerprints is split by two further positions (the 56 sets
of five positions, dealt out to the eight tables): whichever five bytes a pair shares, it
still meets.  A task receives a posting, emits the edges of a spanning forest of its links
and never all pairs, which keeps every component whole.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower_words, batches, shuffle_partitions, small, stored, unused
from tessera.llm.components import components, star_forest

NEAR = 3  # differing bits of a link
SHARED = 5  # positional bytes that such a pair shares at least
HOT = 2048  # fingerprints of a posting before it is split
HOT_SHARE = 2048  # ... or one part in so many of all fingerprints, if that is more
TRIPLES = [tuple(p for p in half if p != out) for half in (range(4), range(4, 8)) for out in half]
FIVES = [[s for s in combinations(range(8), 5) if next(t for t, tr in enumerate(TRIPLES) if set(tr) <= set(s)) == t_] for t_ in range(8)]


def _mask(positions) -> int:
    m = sum(0xFF << 8 * p for p in positions)
    return m - (1 << 64) if m >= 1 << 63 else m


# XXH64, fixed values of its specification
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, k: int) -> np.ndarray:
    return x << np.uint64(k) | x >> np.uint64(64 - k)


def xxh64_slices(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of data[start:end] for each pair; numpy works on all slices below 32 bytes at once."""
    size = ends - starts
    out = np.empty(len(starts), np.uint64)
    for i in np.flatnonzero(size >= 32).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], seed)
    small = np.flatnonzero(size < 32)
    size, at = size[small], starts[small].astype(np.int64)
    padded = data + b"\0" * 8
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    with np.errstate(over="ignore"):
        h = size.astype(np.uint64) + (np.uint64(seed) + P5)
        left = size.copy()
        for _ in range(3):
            go = np.flatnonzero(left >= 8)
            if len(go):
                k = _turn(eights[at[go]] * P2, 31) * P1
                h[go] = _turn(h[go] ^ k, 27) * P1 + P4
                at[go] += 8
                left[go] -= 8
        go = np.flatnonzero(left >= 4)
        if len(go):
            h[go] = _turn(h[go] ^ (eights[at[go]] & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
            at[go] += 4
            left[go] -= 4
        for _ in range(3):
            go = np.flatnonzero(left)
            if len(go):
                h[go] = _turn(h[go] ^ (eights[at[go]] & np.uint64(0xFF)) * P5, 11) * P1
                at[go] += 1
                left[go] -= 1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
    out[small] = h
    return out


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned SimHash of the word shingles of a text; a text without words has 0."""
    line = b" ".join(ascii_lower_words(text))
    if not line:
        return 0
    stops = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts, ends = np.append(0, stops + 1), np.append(stops, len(line))
    k = min(width, len(starts))
    hashes = xxh64_slices(line, starts[: len(starts) - k + 1], ends[k - 1 :])
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(0, dtype=np.uint16)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, key, fp long) of every row, key a hash of the text; a null text counts as empty."""
    slim = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    kind = dict(slim.dtypes)["doc_id"]

    def run(frames):
        import pyarrow as pa

        for part in frames:
            for rows in batches([part], ["doc_id", "key", "text"], 512):
                fps = np.array([fingerprint(t, width) for _, _, t in rows], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], part.schema.field("doc_id").type), pa.array([r[1] for r in rows], pa.int64()), pa.array(fps)], names=["doc_id", "key", "fp"])

    return slim.mapInArrow(run, f"doc_id {kind}, key bigint, fp bigint")


def linked(fps: np.ndarray, near: int = NEAR, shared: int = SHARED) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints (int64)."""
    left, edges = np.unique(fps).view(np.uint64), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            differ = left ^ x
            tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(1)
            hit = tally >= shared
            hit[hit] = np.bitwise_count(differ[hit]) <= near
            if hit.any():
                found = left[hit]
                edges += [(int(x.view(np.int64)), int(y)) for y in found.view(np.int64)]
                queue += list(found)
                left = left[~hit]
    return edges


def _edges_of(posting: np.ndarray) -> list[tuple[int, int]]:
    """Links of one posting; a large one is split by five positions, then by runs of six bits."""
    if len(posting) <= HOT:
        return linked(posting)
    edges, u = [], np.unique(posting).view(np.uint64)

    def groups(values, mask):
        order = np.argsort(keys := values & np.uint64(mask), kind="stable")
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        return [g for g in np.split(values[order], cuts) if len(g) > 1]

    for five in combinations(range(8), SHARED):
        mask = _mask(five) & (1 << 64) - 1
        rest = [b for b in range(64) if not mask >> b & 1]
        for g in groups(u, mask):
            if len(g) <= HOT:
                edges += linked(g.view(np.int64))
                continue
            for k in range(0, 24, 6):  # three differing bits leave one of four runs untouched
                for h in groups(g, mask | sum(1 << b for b in rest[k : k + 6])):
                    edges += linked(h.view(np.int64))
    return edges


def edges(fps: DataFrame, stars: bool = False) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that span all components.

    ``stars``: instead of its links a task returns the star forest of them, of the same reach.
    """
    spark = fps.sparkSession
    n = fps.count()
    key = lambda table: F.col("fp").bitwiseAND(F.lit(_mask(TRIPLES[table])))
    index = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("table"), key(t).alias("key")) for t in range(8)])).alias("p")).select("fp", "p.*")
    sizes = index.groupBy("table", "key").agg(F.count("*").alias("size"))
    limit = max(HOT, n // HOT_SHARE)  # so at most 8 * HOT_SHARE postings exceed it
    hot = sizes.filter(F.col("size") > limit).select("table", "key").collect()
    if hot:
        marks = F.broadcast(small(spark, hot, "table int, key bigint"))
        five = F.create_map(*[x for t in range(8) for x in (F.lit(t), F.array(*[F.lit(_mask(s)).cast("bigint") for s in FIVES[t]]))])
        split = index.join(marks, ["table", "key"]).select("fp", F.explode(five[F.col("table")]).alias("mask")).select("fp", F.col("mask").alias("table"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        index = index.join(marks, ["table", "key"], "left_anti").select("fp", F.col("table").cast("bigint").alias("table"), "key").union(split)

    def run(frames):
        import pyarrow as pa

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in range(2)], names=["a", "b"])

        now, held, found = None, [], []
        for part in frames:
            t, k, f = (part.column(i).to_numpy() for i in range(3))
            cuts = [0, *(np.flatnonzero((np.diff(t) != 0) | (np.diff(k) != 0)) + 1).tolist(), len(t)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if (t[a], k[a]) != now:
                    if len(held) > 1 or held and len(held[0]) > 1:
                        found += _edges_of(np.concatenate(held))
                    now, held = (t[a], k[a]), []
                held.append(f[a:b])
            if len(found) > 50_000:
                yield out(found)
                found = []
        if held:
            found += _edges_of(np.concatenate(held))
        yield out(found)

    dealt = index.select("table", "key", "fp").repartition(shuffle_partitions(spark), "table", "key").sortWithinPartitions("table", "key")
    return dealt.mapInArrow((lambda frames: star_forest(run(frames))) if stars else run, "a bigint, b bigint")


def _labelled(marked: DataFrame) -> DataFrame:
    """(fp, least, label) of each distinct fingerprint: its smallest doc_id, and a fingerprint that stands for its component."""
    least = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    labels = components(edges(least.select("fp"), stars=True), stars=True)
    return least.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of docs.

    docs: doc_id, text; other columns are ignored.  Null and empty texts have fingerprint 0
    and are linked like any other.  component_id is the smallest non-null doc_id reachable
    (null where a component has only null ids).  Repeated rows come back as often as they are
    there; an empty table gives an empty result.
    """
    marked = stored(fingerprints(docs, width), "fingerprints")
    named = _labelled(marked)
    first = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(first, "label").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: that of the smallest doc_id.

    Rows are told apart by id and text, so ids may repeat or be null (a null id comes last).
    Of rows with one id and one text that of the smallest hash of all columns stays.
    """
    marked = stored(fingerprints(docs, width), "fingerprints")
    rows = marked.groupBy("doc_id", "key").agg(F.first("fp").alias("fp"), F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "n")
    per = rows.groupBy("fp").agg(F.min(order).alias("kept"))  # summed up before it is dealt: copies are one row
    least = per.join(_labelled(marked).select("fp", "label"), "fp").groupBy("label").agg(F.min("kept").alias("kept"))
    hash_, id_, key_, n_ = unused(docs, "hash", "id", "key", "n")
    kept = stored(least.select(F.col("kept.doc_id").alias(id_), F.col("kept.key").alias(key_), F.col("kept.n").alias(n_)), "kept")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(key_))
    out = docs.withColumn(hash_, F.xxhash64("text")).join(kept.select(id_, key_), same, "left_semi")
    if kept.filter(F.col(n_) > 1).limit(1).count():
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        out = out.groupBy("doc_id", hash_).agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias(key_)).select(f"{key_}.*")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
