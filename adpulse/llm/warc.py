"""WARC archives compressed record by record with a shared Zstandard dictionary.

Every page becomes one record. Of the records whose equal payloads have at
least ``min_bytes`` bytes, the one with the largest id is stored as a response;
the others only name it (revisit). Each task writes its records to files of
bounded size in the shared folder:

* a skippable frame (magic 0x184D2A5D) whose content is the dictionary, itself
  one Zstandard frame;
* then one Zstandard frame per WARC record, compressed with that dictionary, so
  any record can be read alone at its offset.

The dictionary is trained on a bounded sample: the ``SAMPLE_ROWS`` pages with
the smallest id hashes, at most ``SAMPLE_BYTES`` bytes of each.

A file is written under a name of its own attempt and is only part of the
archive once a successful task has listed it in the manifest; files of lost
attempts are never read. The driver sees no payloads but the sample.

Defined results: a null payload is an empty record; null ids are written and
read back as null (they lose against any id as the response; equal payloads
that all have null ids are all responses); repeated rows are records of their
own, and copies of the response row itself are responses too; an empty table
gives an empty archive. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm.common import shared_dir

DICT_MAGIC = 0x184D2A5D
DICT_BYTES = 64 << 10
SAMPLE_ROWS = 400
SAMPLE_BYTES = 8 << 10
FILE_BYTES = 64 << 20
HEAD = "WARC/1.1"
HOT = 200
FOUND = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def page_rows(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """Pages as ``(id, payload, payload_bytes, digest)``; payloads are hashed where they lie."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    return (pages.select(F.col(id_col).cast("long").alias("id"), payload.alias("payload"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("digest", F.sha1(F.encode("payload", "UTF-8"))))


def revisits(rows: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """``(id, digest, refers_to)`` of the records that only name another.

    Only ids and digests are grouped and joined, never payloads, and a digest
    that fills much of the table is joined apart, without a shuffle.
    """
    big = rows.where(F.col("payload_bytes") >= min_bytes).select("id", "digest")
    groups = (big.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("copies"))
              .where("copies > 1 AND refers_to IS NOT NULL"))
    total = rows.count()
    # At most HOT digests can each hold a HOT-th of all rows: a proven bound for the broadcast.
    hot = big.join(F.broadcast(groups.where(F.col("copies") * HOT > total)), "digest")
    rest = big.join(groups.where(F.col("copies") * HOT <= total), "digest")
    return (hot.unionByName(rest).where("id IS NULL OR id < refers_to")
            .groupBy("id", "digest").agg(F.max("refers_to").alias("refers_to")))


def frames(rows: DataFrame, dictionary: bytes) -> DataFrame:
    """Every page's whole response record as one compressed frame, in place of its payload."""
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zc = _compressor(dictionary)
        for b in batches:
            b["frame"] = [zc.compress(record("response", _int(i), None, p.encode(), d, n))
                          for i, p, d, n in zip(b["id"], b["payload"], b["digest"], b["payload_bytes"])]
            yield b[["id", "payload_bytes", "digest", "frame"]].astype({"id": "Int64"})

    return rows.mapInPandas(run, "id long, payload_bytes long, digest string, frame binary")


def plan_records(compressed: DataFrame, refs: DataFrame) -> DataFrame:
    """The frames with ``refers_to`` where a record is a revisit; joined by the
    unique id, so that equal payloads stay spread over all tasks."""
    r, x = compressed.alias("r"), refs.alias("x")
    return r.join(x, F.col("r.id").eqNullSafe(F.col("x.id")) & (F.col("r.digest") == F.col("x.digest")),
                  "left").select("r.id", "r.payload_bytes", "r.digest", "r.frame", "x.refers_to")


def train_dictionary(rows: DataFrame) -> bytes:
    """A dictionary from a bounded sample of records; empty if there is too little to learn from.

    The sample's id hashes are found first, as bare numbers, so that no task
    sends payloads that are then dropped.
    """
    import zstandard

    some = rows.where("payload != ''").withColumn("h", F.xxhash64("id", "digest"))
    least = [r[0] for r in some.select("h").orderBy("h").limit(SAMPLE_ROWS).collect()]
    if not least:
        return b""
    sample = sorted(r[0].encode() for r in some.where(F.col("h") <= least[-1])
                    .select(F.substring("payload", 1, SAMPLE_BYTES)).limit(2 * SAMPLE_ROWS).collect())
    whole = [record("response", i, None, p, hashlib.sha1(p).hexdigest(), len(p)) for i, p in enumerate(sample)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, whole, threads=1).as_bytes()
    except zstandard.ZstdError:
        return b""


def _int(x) -> int | None:
    return None if pd.isna(x) else int(x)


def _compressor(dictionary: bytes):
    import zstandard

    zd = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=zd, write_checksum=True)


def record(kind: str, rid: int | None, refers_to: int | None, payload: bytes, digest: str, size: int) -> bytes:
    """One WARC record of a payload of ``size`` bytes. A revisit holds no payload, only digest and size."""
    lines = [HEAD, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if rid is None else rid}>",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of one record; raises if it isn't whole."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *fields = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in fields)
    length = int(headers["Content-Length"])
    if version != HEAD or rest[length:] != b"\r\n\r\n":
        raise ValueError("broken WARC record")
    return headers, rest[:length]


def _filesystem(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class _File:
    """One archive file: the dictionary frame, then record frames."""

    def __init__(self, folder: str, dictionary: bytes):
        import zstandard

        self.fs, base = _filesystem(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = self.fs.open_output_stream(f"{base}/{self.name}")
        self.size = self.records = 0
        if dictionary:
            frame = zstandard.ZstdCompressor(level=3).compress(dictionary)
            self._put(struct.pack("<II", DICT_MAGIC, len(frame)) + frame)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, frame: bytes) -> None:
        self._put(frame)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.name, self.records, self.size


def write_archive(records: DataFrame, folder: str, dictionary: bytes, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the planned records; the manifest (name, records, size) of the files.

    The manifest is a lazy table: store it, do not evaluate it twice.
    """
    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, done, zc = None, [], _compressor(dictionary)
        for batch in batches:
            for row in batch.itertuples(index=False):
                out = out or _File(folder, dictionary)
                ref = _int(row.refers_to)
                out.add(row.frame if ref is None else zc.compress(
                    record("revisit", _int(row.id), ref, b"", row.digest, row.payload_bytes)))
                if out.size >= file_bytes:
                    done.append(out.close())
                    out = None
        if out:
            done.append(out.close())
        yield pd.DataFrame(done, columns=["name", "records", "size"])

    return records.mapInPandas(write, "name string, records long, size long")


def read_file(stream) -> Iterator[bytes]:
    """The raw records of one archive file, held one at a time."""
    import zstandard

    head = stream.read(8)
    zd, pending = None, head
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICT_MAGIC:
        zd = zstandard.ZstdCompressionDict(zstandard.decompress(stream.read(struct.unpack("<II", head)[1])))
        pending = b""
    zc = zstandard.ZstdDecompressor(dict_data=zd)
    one, parts = zc.decompressobj(), []
    while data := pending or stream.read(1 << 20):
        pending = b""
        parts.append(one.decompress(data))
        if one.eof:
            yield b"".join(parts)
            pending, one, parts = one.unused_data, zc.decompressobj(), []
    if parts and any(parts):
        raise ValueError("archive file ends inside a record")


def read_archive(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the listed files, its payload digest verified.

    Revisits take length and digest from their headers, as no payload is stored.
    """
    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["name"]:
                fs, base = _filesystem(folder)
                rows = []
                with fs.open_input_stream(f"{base}/{name}") as stream:
                    for raw in read_file(stream):
                        h, body = parse(raw)
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        kind, rid = h["WARC-Type"], h["WARC-Record-ID"][10:-1]
                        if kind == "response" and (hashlib.sha1(body).hexdigest() != digest
                                                   or len(body) != int(h["X-Payload-Length"])):
                            raise ValueError(f"payload of {rid} does not match its digest")
                        ref = h["WARC-Refers-To"][10:-1] if kind == "revisit" else None
                        rows.append((int(rid) if rid else None, int(h["X-Payload-Length"]), digest, kind,
                                     int(ref) if ref else None))
                        if len(rows) >= 5000:
                            yield _found(rows)
                            rows = []
                yield _found(rows)

    return manifest.select("name").mapInPandas(read, FOUND)


def _found(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def archive(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
            folder: str | None = None, min_bytes: int = 1000) -> tuple[DataFrame, str]:
    """Writes the archive of ``pages``; its stored manifest and its folder."""
    folder = folder or f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    fs, base = _filesystem(folder)
    fs.create_dir(base, recursive=True)
    rows = page_rows(pages, id_col, payload_col)
    dictionary = train_dictionary(rows)
    planned = plan_records(frames(rows, dictionary), revisits(rows, min_bytes))
    write_archive(planned, folder, dictionary).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest"), folder
