"""Fusion, de-duplication and hierarchy operators over observations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_value(c: str, *order: str) -> Column:
    """The first non-null value in the given order, as a deterministic aggregate."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order)))


def fuse_treatments(df: DataFrame, keys: Sequence[str], numeric: Sequence[str], categorical: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: means of numerics without nulls, first categorical value, ``replicates``."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in numeric], *[first_value(c, *order).alias(c) for c in categorical], F.count("*").alias("replicates"))


def reader_confidence(weight: Column, stage: Column) -> Column:
    """0.6 of the reader's weight (0.5 if unknown) and 0.4 of the stage's confidence, to four places."""
    return F.round(0.6 * F.coalesce(weight, F.lit(0.5)) + 0.4 * stage, 4)


def fuse_evidence(long: DataFrame, keys: Sequence[str], value: str, confidence: str, reader: str, order: str) -> DataFrame:
    """One row per key: the most confident value (earliest of ties), candidates, conflict, mean, readers.

    Rows with a null value are no candidates.  One hash aggregate, no window.
    """
    rank = F.struct((-F.col(confidence)).alias("c"), F.col(order).alias("o"))
    return long.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.min_by(value, rank).alias("fused"), F.min_by(reader, rank).alias("fused_by"), F.count("*").alias("candidates"),
        (F.count_distinct(value) > 1).alias("conflict"), F.avg(value).alias("mean_value"), F.array_join(F.array_sort(F.collect_set(reader)), ",").alias("readers"),
        F.round(F.avg(confidence), 4).alias("mean_confidence"),
    )


def best_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The row with most non-null columns per key, the first of ties; an aggregate, so hot keys combine map-side."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in columns or df.columns), F.lit(0))
    row = F.struct(*df.columns)
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min_by(row, F.struct((-filled).alias("n"), *order)).alias("r")).select("r.*")


def majority(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, majority): the most frequent value of a key, the smallest of ties; nulls do not vote."""
    votes = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return votes.groupBy(key).agg(F.min_by(value, F.struct((-F.col("n")).alias("n"), value)).alias("majority"))


def rewrite_minority(df: DataFrame, key: str, value: str) -> DataFrame:
    """Every row gets its key's majority; ``rewritten`` says where that changed it."""
    return df.join(majority(df, key, value), key, "left").withColumn("rewritten", F.col(value) != F.col("majority"))


def deduplicate_records(df: DataFrame, key: Column, completeness: Column, order: str, lists: Sequence[str], maxima: Sequence[str], firsts: Sequence[str]) -> DataFrame:
    """One record per key: that of most complete, lists merged without repeats, maxima, first non-null fields."""
    rank = F.struct((-completeness).alias("c"), F.col(order).alias("o"))
    return df.groupBy(key.alias("dedup_key")).agg(
        F.min_by(order, rank).alias(order), F.count("*").alias("members"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists], *[F.max(c).alias(c) for c in maxima],
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in firsts],
    )


def similar_titles(df: DataFrame, key: str, title: str, block: Column, threshold: float = 0.95) -> DataFrame:
    """(a, b, similarity) with a < b of titles alike, compared inside a block (never all pairs).

    Give blocks that bound their size, e.g. leading words of the normalised title.
    """
    from tessera.functions.text import title_similarity

    t = df.select(F.col(key).alias("k"), F.col(title).alias("t"), block.alias("block")).filter("block is not null")
    pairs = t.alias("a").join(t.alias("b"), (F.col("a.block") == F.col("b.block")) & (F.col("a.k") < F.col("b.k")))
    return pairs.select(F.col("a.k").alias("a"), F.col("b.k").alias("b"), title_similarity(F.col("a.t"), F.col("b.t")).alias("similarity")).filter(F.col("similarity") >= threshold)


def title_pairs(titles: DataFrame, threshold: float = 0.95, block: int = 45_000) -> DataFrame:
    """(p, q, similarity) of all ordered pairs of titles whose ratio reaches the threshold; titles: distinct n, normalised.

    Where titles have columns low and high, only pairs with low of p below high of q; where they have a number u (bigint), p and q
    are numbers.

    Titles are dealt to blocks, and a task compares two blocks.  Complete: such a pair differs by at most
    D = (1 - threshold) * (both lengths) deleted and added letters.  Of D + 1 pieces that the shorter title is cut into, there is
    an i-th (from 0) that stands whole in the other, with i letters deleted or added before it and at most D - i from it on: so
    it is shifted by at most i, by as many less an even number, and by at most D - i against the other end.  Only pairs
    that meet in such a piece are looked at; counts of letters sift them before the ratio is taken.
    """
    from tessera.operators.graph import written

    keys = [c for c in ("low", "high", "u") if c in titles.columns]
    t = written(titles.filter("n <> ''").select("n", *keys), "titles")
    blocks = max(4, -(-t.count() // block))
    dealt = t.select("n", *keys, F.pmod(F.xxhash64("n"), F.lit(blocks)).cast("int").alias("own")).select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    both = dealt.select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "n", *keys)
    return both.groupBy("i", "j").applyInArrow(_title_matcher(threshold), "p {0}, q {0}, similarity double".format("bigint" if "u" in keys else "string"))


def _longest_blocks(a, b):
    """(size, start in a, start in b) of the longest equal block of each column's letters, the first in a, then in b; sizes below 256."""
    import numpy as np

    wide, many = b.shape
    runs = np.zeros((len(a) + 1, wide + 1, many), np.uint8)  # letters of the block that ends at both places
    equal, size, end = np.empty((wide, many), bool), np.zeros(many, np.uint8), np.zeros(many, np.int64)
    for x in range(len(a)):
        np.equal(b, a[x], out=equal)
        np.add(runs[x, :-1], np.uint8(1), out=runs[x + 1, 1:])
        runs[x + 1, 1:] *= equal.view(np.uint8)
        best = runs[x + 1].max(0)
        end[best > size] = x + 1
        np.maximum(size, best, out=size)
    at = (runs[end, :, np.arange(many)] == size[:, None]).argmax(1)
    return size.astype(np.int64), end - size, at - size


def block_ratios(flat, start, size, p, q, threshold: float, cells: int = 80_000):
    """Ratcliff-Obershelp ratios of pairs of rows p and q of letters (0 where surely below the threshold), as difflib's.

    All pairs' longest blocks are sought at once, then those left and right of them.  Texts of 200 letters and more are left to
    difflib, which has another rule for their frequent letters.
    """
    from difflib import SequenceMatcher

    import numpy as np

    letters = size[p] + size[q]
    allowed, lost, out = (1 - threshold) * letters + 1e-9, np.zeros(len(p), np.int64), np.zeros(len(p))
    long = np.flatnonzero(np.maximum(size[p], size[q]) >= 200)
    if len(long):
        text = lambda r: flat[start[r] : start[r] + size[r]].tobytes().decode()
        matcher, last = SequenceMatcher(None), -1
        for at in long[np.argsort(q[long], kind="stable")].tolist():
            if q[at] != last:
                matcher.set_seq2(text(last := q[at]))  # what it knows of the second text is kept
            matcher.set_seq1(text(p[at]))
            out[at] = matcher.ratio()
    pair = np.flatnonzero(np.maximum(size[p], size[q]) < 200)
    x, y, m, n = start[p[pair]], start[q[pair]], size[p[pair]], size[q[pair]]
    while len(pair):
        none = (m == 0) | (n == 0)
        np.add.at(lost, pair[none], (m + n)[none])
        least = lost.copy()
        np.add.at(least, pair[~none], np.abs(m - n)[~none])
        open_ = ~none & (least <= allowed)[pair]
        lost[pair[~none & ~open_]] = letters[pair[~none & ~open_]]  # below the threshold
        pair, x, y, m, n = pair[open_], x[open_], y[open_], m[open_], n[open_]
        order, nexts, at = np.lexsort((m, n)), [], 0
        pair, x, y, m, n = pair[order], x[order], y[order], m[order], n[order]
        while at < len(pair):
            to = at + max(1, cells // int(n[min(len(n) - 1, at + cells // int(n[at]))]))
            r, f, g, k, w = pair[at:to], x[at:to], y[at:to], m[at:to], n[at:to]
            at = to
            of, seen = np.arange(k.max())[:, None], np.arange(w.max())[:, None]
            a = np.where(of < k, flat[np.minimum(f + of, len(flat) - 1)], np.uint8(0))
            b = np.where(seen < w, flat[np.minimum(g + seen, len(flat) - 1)], np.uint8(1))
            length, i, j = _longest_blocks(a, b)
            np.add.at(lost, r[length == 0], (k + w)[length == 0])
            r, f, g, k, w, i, j, length = (c[length > 0] for c in (r, f, g, k, w, i, j, length))
            nexts += [(r, f, g, i, j), (r, f + i + length, g + j + length, k - i - length, w - j - length)]
        pair, x, y, m, n = (np.concatenate(c) for c in zip(*nexts)) if nexts else (pair,) * 5
    short = np.maximum(size[p], size[q]) < 200
    out[short] = 2.0 * ((letters - lost)[short] // 2) / letters[short]
    return out


def _title_matcher(threshold: float, most: int = 1_000_000):
    """The function that gives the alike pairs of one group of two blocks (i, j, own, n), looking at ``most`` meetings at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        table = pa.Table.from_batches(list(batches)).combine_chunks()
        i, j, own, texts = table["i"][0].as_py(), table["j"][0].as_py(), table["own"].to_numpy(), table["n"].combine_chunks()
        low, high = (table[c].to_numpy() if c in table.column_names else None for c in ("low", "high"))
        named, titles = table["u"].combine_chunks() if "u" in table.column_names else texts, texts.to_pylist()
        size = np.array([len(x) for x in titles])
        flat = np.frombuffer("".join(titles).encode(), np.uint8)  # normalised titles are ASCII
        used, letter = np.unique(flat, return_inverse=True)
        counts = np.bincount(np.repeat(np.arange(len(texts)), size) * len(used) + letter, minlength=len(texts) * len(used)).reshape(-1, len(used)).astype(np.int16)
        # 128 bits "more than t of a letter", those that part titles best: two titles differ in no more bits than letters
        parts = [(abs(share - 0.5), c, t) for c in range(len(used)) for t in range(int(counts[:, c].max())) if 0 < (share := float((counts[:, c] > t).mean())) < 1]
        marks = np.zeros((len(texts), 2), np.uint64)
        for bit, (_, c, t) in enumerate(sorted(parts)[:128]):
            marks[:, bit % 2] |= (counts[:, c] > t).astype(np.uint64) << np.uint64(bit // 2)
        start, mark = np.cumsum(size) - size, [np.ascontiguousarray(marks[:, 0]), np.ascontiguousarray(marks[:, 1])]
        base, power = np.uint64(0x9E3779B97F4A7C15), [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(int(size.max())):
                power.append(power[-1] * base)

        def side(rows):
            """By length: rows and the hashes of their beginnings."""
            out = {}
            for n in np.unique(size[rows]).tolist():
                at = rows[size[rows] == n]
                sums = np.zeros((n + 1, len(at)), np.uint64)
                for k in range(n):
                    sums[k + 1] = sums[k] * base + flat[start[at] + k]
                out[n] = at, sums
            return out

        def piece(sums, a, b):
            return sums[b] - sums[a] * power[b - a]

        def meetings(short, long, m, n, gap):
            """Pairs of rows, in portions, that meet in a piece; all pairs where there are fewer letters than pieces."""
            (rows, sums), (others, theirs) = short[m], long[n]
            for k in range(gap + 1) if gap < m else [None]:
                if k is None:
                    shifts, keys, order = [0], np.zeros(len(rows), np.uint64), np.arange(len(rows))
                else:
                    a, b = k * m // (gap + 1), (k + 1) * m // (gap + 1)
                    shifts = [s for s in range(-k, k + 1, 2) if abs(s - (n - m)) <= gap - k and a + s >= 0 and b + s <= n]
                    if not shifts:
                        continue
                    order = np.argsort(keys := piece(sums, a, b), kind="stable")
                    keys = keys[order]
                there = np.zeros(1 << 17, bool)  # most that is sought is not there
                there[keys >> np.uint64(47)] = True
                for s in shifts:
                    sought = np.zeros(len(others), np.uint64) if k is None else piece(theirs, a + s, b + s)
                    met = np.flatnonzero(there[sought >> np.uint64(47)])
                    first = np.searchsorted(keys, sought[met])
                    hits = np.searchsorted(keys, sought[met], side="right") - first
                    met, first, hits = met[hits > 0], first[hits > 0], hits[hits > 0]
                    total, at = np.concatenate([[0], np.cumsum(hits)]), 0
                    while at < len(met):
                        to = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
                        place = np.repeat(first[at:to] - (total[at:to] - total[at]), hits[at:to]) + np.arange(total[to] - total[at])
                        yield rows[order[place]], np.repeat(others[met[at:to]], hits[at:to])
                        at = to

        def compared(pairs):
            """Batches of those pairs, in both orders, that reach the threshold."""
            for at in range(0, len(pairs), 50_000):
                x, y = pairs[at : at + 50_000] // len(texts), pairs[at : at + 50_000] % len(texts)
                for p, q in ((x, y), (y, x)):
                    if low is not None:
                        p, q = p[asked := ~(low[p] >= high[q])], q[asked]
                    ratios = block_ratios(flat, start, size, p, q, threshold)
                    p, q, ratios = (c[ratios >= threshold] for c in (p, q, ratios))
                    if len(p):
                        yield pa.RecordBatch.from_arrays([named.take(pa.array(p)), named.take(pa.array(q)), pa.array(ratios)], names=["p", "q", "similarity"])

        with np.errstate(over="ignore"):
            first = side(np.flatnonzero(own == i))
            second = first if i == j else side(np.flatnonzero(own == j))
            found, held = [], 0
            for short, long, equal in [(first, second, True)] + [(second, first, False)] * (i != j):
                for m in short:
                    for n in long:
                        gap = int(np.floor((1 - threshold) * (m + n) + 1e-9))
                        if n < m or n == m and not equal or n - m > gap or gap < 1:
                            continue
                        met, full = [], 4 * most
                        for x, y in meetings(short, long, m, n, gap):
                            if i == j and m == n:
                                x, y = x[x < y], y[x < y]
                            alike = np.bitwise_count(mark[0][x] ^ mark[0][y]) + np.bitwise_count(mark[1][x] ^ mark[1][y]) <= gap
                            x, y = x[alike], y[alike]
                            for at in range(0, len(x), 100_000):
                                p, q = x[at : at + 100_000], y[at : at + 100_000]
                                alike = np.abs(counts[p] - counts[q]).sum(1) <= gap
                                met.append(p[alike] * len(texts) + q[alike])
                            if sum(map(len, met)) > full:
                                met = [np.unique(np.concatenate(met))]
                                full = max(full, 2 * len(met[0]))
                        if met:
                            found.append(np.unique(np.concatenate(met)))
                            held += len(found[-1])
                        if held > 50_000:
                            yield from compared(np.concatenate(found))
                            found, held = [], 0
            if held:
                yield from compared(np.concatenate(found))

    return run


def all_similar_titles(df: DataFrame, key: str, title: str, threshold: float = 0.95) -> DataFrame:
    """(a, b, similarity) with a < b of all titles alike, wherever they differ; titles without letters are left out."""
    from tessera.functions.text import normalize_title
    from tessera.operators.graph import written

    t = written(df.select(F.col(key).alias("k"), normalize_title(F.col(title)).alias("n")).filter("n <> ''"), "normalised")
    titles = t.select("n").distinct()
    if dict(t.dtypes)["k"] in ("tinyint", "smallint", "int", "bigint", "string"):
        titles = t.filter("k is not null").groupBy("n").agg(F.min("k").alias("low"), F.max("k").alias("high"))
    titles = written(titles.withColumn("u", F.monotonically_increasing_id()), "numbers")  # pairs carry numbers, not titles
    keys = written(t.join(titles.select("n", "u"), "n").select("k", "u"), "keys")
    a, b = keys.select(F.col("k").alias("a"), F.col("u").alias("p")), keys.select(F.col("k").alias("b"), F.col("u").alias("q"))
    alike = title_pairs(titles, threshold).join(a, "p").join(b, "q").filter("a < b").select("a", "b", "similarity")
    equal = a.join(b, F.col("p") == F.col("q")).filter("a < b").select("a", "b", F.lit(1.0).alias("similarity"))
    return alike.union(equal)


def hierarchy_ids(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Positional number of a child inside its parent (dense rank), as ``<parent>_E<n>``."""
    n = F.dense_rank().over(Window.partitionBy(parent).orderBy(child))
    return df.withColumn("experiment_id", F.concat(F.col(parent).cast("string"), F.lit("_E"), n.cast("string")))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of their key, rows in groups of several, keys that repeat (nulls are equal)."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return g.agg(zero(F.col("n") - 1).alias("beyond_first"), zero(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("members"), zero((F.col("n") > 1).cast("int")).alias("repeated_keys"))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by an ingest order."""
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")
