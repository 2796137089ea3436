"""WARC writer with revisit records, and a reader that salvages damaged archives.

Archives are gzip files of one member per record.  The reader follows members; after a
failed check (header, CRC, length) it searches for the next member or version line that
opens a record, goes on from there and logs the bytes it skipped.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, open_file, shared_dir, shuffle_partitions, write_file

FILE_BYTES = 16 << 20  # compressed bytes after which a task starts another archive
READ = 1 << 20
PIECE = 1 << 16  # compressed bytes handed to zlib at once, and plain ones taken from it
MOST = (1 << 31) - (1 << 16)  # bytes of a record: Spark's values hold no more
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
LEAST = 0  # least payload bytes for a revisit


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in {"WARC-Type": kind, **headers, "Content-Length": str(len(block))}.items())
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; ValueError if it does not check."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not lines[0].startswith(VERSION):
        raise ValueError("no version line")
    headers = {}
    for line in lines[1:]:
        k, colon, v = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        headers[k.decode("utf-8", "replace").strip()] = v.decode("utf-8", "surrogatepass").strip()
    if not headers.get("Content-Length", "").isdigit() or "WARC-Type" not in headers:
        raise ValueError("required header missing")
    n = int(headers["Content-Length"])
    if len(rest) < n + 4 or rest[n : n + 4] != b"\r\n\r\n":
        raise ValueError("block length differs")
    if (d := headers.get("WARC-Block-Digest")) and d != f"sha1:{digest32(rest[:n])}":
        raise ValueError("block digest differs")
    return headers, rest[:n]


class _Stream:
    """A window on a file: bytes from ``base`` on, more on demand."""

    def __init__(self, f):
        self.f, self.buf, self.base, self.ended = f, bytearray(), 0, False

    def more(self) -> bool:
        chunk = b"" if self.ended else self.f.read(READ)
        self.ended = not chunk
        self.buf += chunk
        return bool(chunk)

    def drop(self, n: int) -> None:
        del self.buf[:n]
        self.base += n

    def find_start(self) -> int:
        """Index of the next gzip magic or version line, reading on; -1 at the end."""
        at = 0
        while True:
            hits = [k for k in (self.buf.find(MAGIC, at), self.buf.find(VERSION, at)) if k >= 0]
            if hits:
                return min(hits)
            at = max(0, len(self.buf) - 8)
            if not self.more():
                return -1


def salvage(f, most: int = MOST) -> Iterator[tuple[str, int, int, dict, bytes]]:
    """("record", offset, length, headers, block) of each sound record, ("gap", offset, length, {reason}, b"") of bytes skipped.

    Reads the file piece by piece and keeps one record (``most`` bytes at most) in memory.
    Archives may hold gzip members, plain records, or both.  Several records of one member
    have its offset, and the last has its length; what does not parse in it is a gap as well.
    """
    s, gap, reason = _Stream(f), None, ""
    while True:
        if len(s.buf) < 8:
            s.more()
        if not s.buf:
            break
        try:
            if s.buf.startswith(MAGIC):
                d, plain, given, piece = zlib.decompressobj(31), bytearray(), 0, b""
                while not d.eof:
                    if not piece:
                        piece = bytes(s.buf[given : given + PIECE])
                        given += len(piece)
                        if not piece:
                            if not s.more():
                                raise ValueError("member cut short")
                            continue
                    plain += d.decompress(piece, 16 * PIECE)
                    piece = d.unconsumed_tail
                    if len(plain) > most:
                        raise ValueError("member too long")
                used = given - len(d.unused_data)
                plain = bytes(plain)
                try:
                    headers, block = parse(plain)
                    found = [("record", 0, 0, headers, block)]
                    single = len(plain) == plain.index(b"\r\n\r\n") + 8 + len(block)
                except ValueError:
                    found, single = [], False
                if not single:  # several records, or a damaged one
                    inner = list(salvage(io.BytesIO(plain), most))
                    found = inner if any(e[0] == "record" for e in inner) else found
                if not found:
                    parse(plain)  # raises
            elif s.buf.startswith(VERSION):
                while (end := s.buf.find(b"\r\n\r\n")) < 0:
                    if len(s.buf) > READ or not s.more():
                        raise ValueError("no end of headers")
                length = [h.split(b":")[1].strip() for h in bytes(s.buf[:end]).split(b"\r\n") if h.lower().startswith(b"content-length:")]
                if not length or not length[0].isdigit() or int(length[0]) > most:
                    raise ValueError("required header missing")
                used = end + 8 + int(length[0])
                while len(s.buf) < used:
                    if not s.more():
                        raise ValueError("record cut short")
                found = [("record", 0, 0, *parse(bytes(s.buf[:used])))]
            else:
                raise ValueError("no record here")
        except (ValueError, zlib.error) as e:
            if gap is None:
                gap, reason = s.base, f"{type(e).__name__}: {e}"
            s.drop(1)
            k = s.find_start()
            s.drop(len(s.buf) if k < 0 else k)
            continue
        if gap is not None:
            yield "gap", gap, s.base - gap, {"reason": reason}, b""
            gap = None
        for i, (kind, at, _, h, b) in enumerate(found, 1):
            yield kind, s.base, used if i == len(found) else 0, h | {"reason": f"at byte {at} of the member: {h['reason']}"} if kind == "gap" else h, b
        s.drop(used)
    if gap is not None:
        yield "gap", gap, s.base - gap, {"reason": reason}, b""


def planned(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages (page_id, url, html) and ``_first``: the largest page_id with an equal payload.

    Only hashes are grouped (pre-aggregated before the shuffle); a payload that many pages
    share is one row of the group table, and Spark splits its rows in the join.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("_sha", F.sha2("html", 256))
    firsts = pages.select("page_id", F.sha2(F.coalesce("html", F.lit("")), 256).alias("_sha")).groupBy("_sha").agg(F.max("page_id").alias("_first"))
    return p.join(firsts, "_sha", "left").withColumn("_first", F.when(F.octet_length("html") >= least, F.col("_first")).otherwise(F.col("page_id")))


def write(pages: DataFrame, path: str | None = None, least: int = LEAST) -> DataFrame:
    """Write one record per page as archives; return their manifest (path, n_records, n_bytes).

    pages: page_id, url, html; a null html is an empty payload, a null url an empty target.
    Repeated rows with one page_id and one payload are all responses, and have one record id.
    Other columns are not written.  Names hold the task's attempt and the manifest lists those
    of committed tasks alone, so what a lost or doubled attempt leaves behind is never read.
    """
    spark = pages.sparkSession
    path = path or shared_dir(spark, "warc")
    rows = planned(pages, least).select("page_id", "url", "html", "_first", F.substring("_sha", 1, 16).alias("sha"))

    def run(frames):
        import pyarrow as pa
        from pyspark import TaskContext

        part_id, attempt, seq, held, n = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, [], 0

        def flush():
            nonlocal seq, held, n
            name = f"{path}/part-{part_id:06d}-{seq:05d}-{attempt}.warc.gz"
            write_file(name, held)
            row = (name, len(held), n)
            seq, held, n = seq + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["path", "n_records", "n_bytes"])

        for part in frames:
            for batch in batches([part], ["page_id", "url", "html", "_first", "sha"], 256):
                for page_id, url, html, first, sha in batch:
                    payload = html.encode("utf-8", "surrogatepass")
                    response = first is None or page_id == first
                    headers = {
                        "WARC-Record-ID": f"<urn:page:{page_id}:{sha}>", "WARC-Target-URI": " ".join((url or "").split()), "WARC-Date": "1970-01-01T00:00:00Z",
                        "WARC-Payload-Digest": f"sha1:{digest32(payload)}", "X-Payload-Length": str(len(payload)),
                    }
                    if response:
                        data = record("response", {**headers, "WARC-Block-Digest": f"sha1:{digest32(payload)}"}, payload)
                    else:
                        data = record("revisit", {**headers, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:page:{first}:{sha}>"}, b"")
                    held.append(member(data))
                    n += len(held[-1])
                    if n >= FILE_BYTES:
                        yield flush()
        if held:
            yield flush()

    manifest = rows.mapInArrow(run, "path string, n_records bigint, n_bytes bigint")
    manifest.write.parquet(f"{path}/manifest")  # one pass writes the archives
    return spark.read.schema(manifest.schema).parquet(f"{path}/manifest")


def read(files: DataFrame, strict: bool = False) -> DataFrame:
    """Every record and gap of the archives named in column ``path``; other columns but n_records are ignored.

    kind (record or gap), path, offset, length, warc_type, record_id, refers_to, uri,
    payload_length, payload_digest, payload, reason.  A file that cannot be opened fails the
    job; with ``strict`` so does one whose sound records are not ``n_records``.  No files, no rows.
    """
    spark = files.sparkSession
    due = F.max("n_records") if strict else F.lit(None).cast("bigint")
    # dealt by another key than it is grouped by, else the few rows are put into one task
    dealt = files.groupBy("path").agg(due.alias("due")).repartition(shuffle_partitions(spark), F.xxhash64("path"))

    def run(frames):
        import pyarrow as pa

        names = ["kind", "path", "offset", "length", "warc_type", "record_id", "refers_to", "uri", "payload_length", "payload_digest", "payload", "reason"]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

        rows, held = [], 0
        for part in frames:
            for path, due in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                sound = 0
                with open_file(path) as f:
                    for kind, at, n, h, block in salvage(f):
                        sound += kind == "record"
                        length = h.get("X-Payload-Length", "")
                        rows.append((kind, path, at, n, h.get("WARC-Type"), h.get("WARC-Record-ID"), h.get("WARC-Refers-To"), h.get("WARC-Target-URI"), int(length) if length.isdigit() else None, h.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, block, h.get("reason")))
                        held += len(block)
                        if held > 8 << 20 or len(rows) > 2000:
                            yield out(rows)
                            rows, held = [], 0
                if due is not None and sound != due:
                    raise ValueError(f"{path}: {sound} sound records, the manifest says {due}")
        yield out(rows)

    return dealt.mapInArrow(run, "kind string, path string, offset bigint, length bigint, warc_type string, record_id string, refers_to string, uri string, payload_length bigint, payload_digest string, payload binary, reason string")


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from the archives read back.

    pages: page_id, url, html; other columns are ignored.  Repeated rows come back as often as
    they are there, an empty table gives an empty result, a damaged archive an error.
    """
    kind = dict(pages.dtypes)["page_id"]
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(.*):', 1) as {kind})")
    got = read(write(pages, least=least), strict=True).filter("kind = 'record'")
    return got.select(page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", F.col("warc_type").alias("record_type"), F.when(F.col("warc_type") == "revisit", page("refers_to")).alias("refers_to"))
