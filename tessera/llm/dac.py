"""Token ids as directly addressable codes.

An id is split into chunks of CHUNK bits.  Level 0 holds the lowest chunk of every id, level
1 the next chunk of those ids that need it, and so on; a bitmap per level marks ids that go
on, and a directory holds the number of marks before each block of 512 bits.  Token i is
read by following rank(i) down the levels: no block is decoded, whatever i is.

File, little-endian: "DAC2", chunk bits u32, levels u32, documents u64, ids u64; document
table (starts u64 each, documents + 1); per level: number of entries u64, chunks (u8 or
u16), bitmap (bytes, padded to 8), directory u32.
"""

from __future__ import annotations

import struct
import zlib
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, open_file, shared_dir, shuffle_partitions, small, write_file

CHUNK = 8
BLOCK = 512  # bits of the bitmap for each entry of the directory
FILE_IDS = 4_000_000  # ids after which a task starts another file
KNOWN = 600_000  # pieces of text whose ids a worker keeps
END_ID = 0


def encode(ids: np.ndarray, starts: np.ndarray, chunk: int = CHUNK) -> bytes:
    """The file of documents whose ids stand one after another; starts has one more entry than documents."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        low, high = rest & np.uint32((1 << chunk) - 1), rest >> np.uint32(chunk)
        more = high > 0
        bitmap = np.packbits(more, bitorder="little").tobytes()
        bitmap += b"\0" * (-len(bitmap) % (BLOCK // 8))
        per_block = np.bitwise_count(np.frombuffer(bitmap, np.uint64)).reshape(-1, BLOCK // 64).sum(1) if bitmap else np.zeros(0, int)
        directory = np.append(0, np.cumsum(per_block)).astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + low.astype("<u1" if chunk <= 8 else "<u2").tobytes() + bitmap + directory.tobytes())
        rest = high[more]
        if not len(rest):
            break
    return b"DAC2" + struct.pack("<IIQQ", chunk, len(levels), len(starts) - 1, len(ids)) + np.asarray(starts, "<u8").tobytes() + b"".join(levels)


class Reader:
    """Random access to a file's bytes (any buffer, also a memory map)."""

    def __init__(self, data):
        if bytes(data[:4]) != b"DAC2":
            raise ValueError("no DAC file")
        self.chunk, n_levels, self.n_docs, self.n_ids = struct.unpack_from("<IIQQ", data, 4)
        at = 28
        self.starts = np.frombuffer(data, "<u8", self.n_docs + 1, at)
        at += 8 * (self.n_docs + 1)
        self.levels = []
        kind = np.dtype("<u1" if self.chunk <= 8 else "<u2")
        for _ in range(n_levels):
            n = struct.unpack_from("<Q", data, at)[0]
            chunks = np.frombuffer(data, kind, n, at + 8)
            at += 8 + n * kind.itemsize
            blocks = -(-n // BLOCK)
            bitmap = np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at)
            at += len(bitmap)
            directory = np.frombuffer(data, "<u4", blocks + 1, at)
            at += 4 * (blocks + 1)
            self.levels.append((chunks, bitmap, directory))

    def token(self, i: int) -> int:
        """The i-th id of the file, by rank alone."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bitmap, directory in self.levels:
            value |= int(chunks[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                return value
            shift += self.chunk
            block = i // BLOCK * (BLOCK // 8)
            i = int(directory[i // BLOCK]) + int(np.bitwise_count(bitmap[block : i >> 3]).sum()) + int(bitmap[i >> 3] & (1 << (i & 7)) - 1).bit_count()
        raise ValueError("an id goes on beyond the last level")

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids a to b, level by level."""
        out, at, shift, where = np.zeros(b - a, np.uint32), (a, b), 0, np.arange(b - a)
        for chunks, bitmap, directory in self.levels:
            lo, hi = at
            if lo == hi:
                break
            out[where] |= chunks[lo:hi].astype(np.uint32) << np.uint32(shift)
            bits = np.unpackbits(bitmap[lo >> 3 : (hi + 7) >> 3], bitorder="little")[lo & 7 : (lo & 7) + hi - lo].astype(bool)
            block = lo // BLOCK * (BLOCK // 8)
            first = int(directory[lo // BLOCK]) + int(np.bitwise_count(bitmap[block : lo >> 3]).sum()) + (int(bitmap[lo >> 3] & (1 << (lo & 7)) - 1).bit_count() if lo & 7 else 0)
            where, shift = where[bits], shift + self.chunk
            at = (first, first + len(where))
        return out

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]))


def _byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PieceEncoder:
    """Ids of a text by the tokenizers library, with the ids of frequent pieces kept.

    A byte-level pattern cuts before every space that follows a character other than white
    space, and merges never cross a cut, so ids of a text are those of its pieces in turn: the
    first word, then each further word with the space before it.  New pieces are cut by the
    vocabulary's own pattern and each part is merged by the library's model.  A text where
    white space stands before a space, or that has a special token, is encoded whole, as are
    all texts where the file is not of this kind.
    """

    def __init__(self, path: str, known: int = KNOWN):
        import json

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec.get("pre_tokenizer") or {}
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
        self.by_pieces = bool(plain and spec.get("normalizer") is None and (spec.get("post_processor") or {"type": "ByteLevel"})["type"] == "ByteLevel")
        self.parts = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = {b: c for b, c in enumerate(_byte_letters()) if chr(b) != c}
        self.odd = regex.compile(r"[\s\x1c-\x1f] ").search
        self.gaps = [c + " " for c in " \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f"]
        self.merges: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.most = known

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, part: str) -> bytes:
        """Ids of one part of the pattern; frequent parts are kept like pieces."""
        bare = part[1:] if part[0] == " " else part
        if bare and bare.isascii() and bare.isprintable() and " " not in bare:  # only the space before has a letter of its own
            letters = part if bare is part else self.letters[32] + bare
        else:
            letters = part.encode("utf-8").decode("latin1").translate(self.letters)
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])
        if len(self.merges) < self.most:
            self.merges[part] = ids
        return ids

    def piece(self, text: str) -> bytes:
        """Ids of a short text without special tokens: the pattern's parts, each merged by the model."""
        merges = self.merges
        return b"".join([merges[p] if p in merges else self._merged(p) for p in self.parts(text)])

    def _whole_only(self, t: str) -> bool:
        space = any(g in t for g in self.gaps) if t.isascii() else self.odd(t) is not None
        return space or any(s in t for s in self.special)

    def _look(self, table: dict[str, bytes], words, before: str) -> dict[str, bytes]:
        """A table that has all the words; new ones are kept while there is room."""
        new = set(words).difference(table)
        if not new:
            return table
        made = {w: self.piece(before + w) for w in new}
        if len(table) + len(made) <= self.most:
            table.update(made)
            return table
        return {w: made[w] if w in made else table[w] for w in set(words)}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian u32 bytes, without the end."""
        if not self.by_pieces:
            return self.whole(texts)
        odd = [self._whole_only(t) for t in texts]
        rest, out = iter(self.whole([t for t, o in zip(texts, odd) if o])), []
        for t, o in zip(texts, odd):
            if o:
                out.append(next(rest))
                continue
            words = t.split(" ")
            head = words.pop(0)
            known = self._look(self.known, words, " ")
            out.append(self._look(self.first, [head], "")[head] + b"".join(map(known.__getitem__, words)))
        return out


def write(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write ids of all rows in ascending doc_id order (nulls first) as files; return their manifest.

    docs: doc_id, text; other columns are ignored; null and empty texts have the end id alone.
    Repeated ids stand next to each other, by text.  Rows are range-dealt by id; each task
    writes files of about FILE_IDS ids under names that do not depend on the attempt.
    Manifest: part, seq, path, n_docs, n_ids.  An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark, "dac")
    dealt = docs.select("doc_id", "text").repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(frames):
        import pyarrow as pa
        from pyspark import TaskContext

        part_id, encoder = TaskContext.get().partitionId(), _encoder(tokenizer)
        seq, held, doc_ids, n = 0, [], [], 0

        def flush():
            nonlocal seq, held, doc_ids, n
            ids = np.frombuffer(b"".join(held), "<u4")
            starts = np.append(0, np.cumsum([len(h) // 4 for h in held]))
            name = f"{path}/part-{part_id:06d}-{seq:05d}"
            write_file(f"{name}.dac", [encode(ids, starts)])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("doc_id", kind)])) as out:
                out.write_table(pa.table([pa.array(doc_ids, kind)], names=["doc_id"]))
            write_file(f"{name}.ids", [sink.getvalue().to_pybytes()])
            row = (part_id, seq, name, len(held), len(ids))
            seq, held, doc_ids, n = seq + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["part", "seq", "path", "n_docs", "n_ids"])

        kind, end = None, np.array([END_ID], "<u4").tobytes()
        for part in frames:
            kind = part.schema.field("doc_id").type
            for rows in batches([part], ["doc_id", "text"], 1024):
                for (d, _), ids in zip(rows, encoder([t or "" for _, t in rows])):
                    held.append(ids + end)
                    doc_ids.append(d)
                    n += len(ids) // 4 + 1
                    if n >= FILE_IDS:
                        yield flush()
        if held:
            yield flush()

    manifest = dealt.mapInArrow(run, "part bigint, seq bigint, path string, n_docs bigint, n_ids bigint")
    manifest.write.parquet(f"{path}/manifest")  # one pass writes the files
    return spark.read.schema(manifest.schema).parquet(f"{path}/manifest")


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """One encoder per worker process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def read(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files of a manifest.

    start counts the ids of all documents before: those of earlier parts (one sum per part,
    so as many numbers as tasks wrote), of earlier files of the part, of earlier documents.
    """
    spark = manifest.sparkSession
    sums = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row per writing task
    before, total = {}, 0
    for r in sums:
        before[r["part"]], total = total, total + r["n"]
    offsets = F.broadcast(small(spark, list(before.items()), "part bigint, offset bigint"))
    earlier = F.sum("n_ids").over(_window()) - F.col("n_ids")
    files = manifest.withColumn("earlier", earlier).join(offsets, "part").select("path", (F.col("earlier") + F.col("offset")).alias("start"))
    files = files.repartition(shuffle_partitions(spark), "path")

    def run(frames):
        import pyarrow as pa

        for part in frames:
            for name, start in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                with open_file(f"{name}.dac") as f:
                    reader = Reader(f.read())
                with open_file(f"{name}.ids") as f:
                    ids = pa.ipc.open_stream(f.read()).read_all().column(0).combine_chunks()
                if isinstance(ids, pa.ChunkedArray):
                    ids = pa.concat_arrays(ids.chunks)
                starts = reader.starts.astype(np.int64)
                for a in range(0, reader.n_docs, 4096):
                    b = min(reader.n_docs, a + 4096)
                    tokens = reader.slice(int(starts[a]), int(starts[b])).astype("<u4")
                    cuts = starts[a : b + 1] - starts[a]
                    crc = [zlib.crc32(tokens[x:y].tobytes()) for x, y in zip(cuts, cuts[1:])]
                    yield pa.RecordBatch.from_arrays([ids[a:b], pa.array(starts[a:b] + start), pa.array(np.diff(cuts)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def _window():
    from pyspark.sql import Window

    return Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all rows and read the files back: doc_id, start, n_tokens, ids_crc32."""
    return read(write(docs, tokenizer), dict(docs.dtypes)["doc_id"])
