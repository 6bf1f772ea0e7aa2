"""WARC archives as seekable Zstandard bundles.

Each task writes one bundle: records in independent frames of a bounded size and a
seek table in a skippable frame at the end. Records of equal payloads are stored
once: the smallest page id is the response, the others are revisits that refer to
it. The manifest that the tasks return maps every record to its bundle, frame and
offset within the frame, and lists the bundles of successful tasks only.
"""

from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm._common import shared_dir, written

LEAST_BYTES = 100
#: Tasks over which the pages of one payload are dealt.
SALTS = 16
FRAME_BYTES = 1 << 18
#: Fixed values of the public seekable format: skippable frame, its table and the footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
MANIFEST = "bundle string, page_id long, frame long, frame_start long, frame_bytes long, offset long, length long"
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
)


def _record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC 1.1 record; header values are single lines."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode() + payload + b"\r\n\r\n"


def parse_record(data: bytes, offset: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, offset of the next record)."""
    end = data.index(b"\r\n\r\n", offset)
    lines = data[offset:end].decode().split("\r\n")
    headers = dict(line.partition(": ")[::2] for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where its length says")
    return headers, data[start:stop], stop + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for (compressed, plain) sizes."""
    body = b"".join(struct.pack("<II", *sizes) for sizes in frames) + FOOTER.pack(len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed, plain) of each frame, from the end of a bundle."""
    file.seek(size - FOOTER.size)
    number, flags, magic = FOOTER.unpack(file.read(FOOTER.size))
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table")
    file.seek(size - FOOTER.size - 8 * number)
    table, at, frames = file.read(8 * number), 0, []
    for packed, plain in struct.iter_unpack("<II", table):
        frames.append((at, packed, plain))
        at += packed
    return frames


def page_records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``pages`` with payload digest and, for a repeated payload, the page it refers to.

    Only (digest, smallest id) is aggregated. The pages meet it by digest and salt, so a
    payload shared by a third of the pages lies in ``SALTS`` tasks, and both sides of the
    join are plain shuffles, whose hot parts adaptive execution can split further.
    """
    keyed = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn(
        "digest", F.sha2(F.encode("html", "UTF-8"), 256)
    )
    first = (
        keyed.filter(F.octet_length("html") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return salted.join(first, ["digest", "salt"], "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        F.when(F.col("page_id").eqNullSafe(F.col("first_id")), None).otherwise(F.col("first_id")).alias("refers_to"),
    )


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write one bundle per task below ``folder`` and return the written manifest.

    A retried task writes a bundle of another name; the manifest names only those of
    tasks that succeeded. Records above ``frame_bytes`` have a frame of their own.
    """

    def write(batches):
        import zstandard
        from pyspark import TaskContext

        task = TaskContext.get()
        store, path = pyarrow.fs.FileSystem.from_uri(folder)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.zst"
        compressor = zstandard.ZstdCompressor(level=3)
        out, frames, start = None, [], 0
        pending: list[bytes] = []
        held: list[tuple] = []
        size = 0

        def flush():
            nonlocal start, size, out
            if out is None:
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}", compression=None)
            data = compressor.compress(b"".join(pending))
            out.write(data)
            frames.append((len(data), size))
            columns = [[name] * len(held), *([list(x) for x in zip(*held, strict=True)])]
            ids, offsets, lengths = columns[1:]
            n = len(held)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.string()),
                    pa.array(ids, pa.int64()),
                    pa.array([len(frames) - 1] * n, pa.int64()),
                    pa.array([start] * n, pa.int64()),
                    pa.array([len(data)] * n, pa.int64()),
                    pa.array(offsets, pa.int64()),
                    pa.array(lengths, pa.int64()),
                ],
                ["bundle", "page_id", "frame", "frame_start", "frame_bytes", "offset", "length"],
            )
            start, size = start + len(data), 0
            pending.clear()
            held.clear()
            return batch

        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(5)), strict=True):
                page_id, url, html, digest, refers_to = (x.as_py() for x in row)
                record = _record(page_id, url, html.encode(), digest, refers_to, refers_to is not None)
                if pending and size + len(record) > frame_bytes:
                    yield flush()
                pending.append(record)
                held.append((page_id, size, len(record)))
                size += len(record)
        if pending:
            yield flush()
        if out is not None:
            out.write(seek_table(frames))
            out.close()

    return written(page_records(pages).mapInArrow(write, MANIFEST), "manifest")


def read_bundles(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the manifest's bundles, frame by frame through the seek tables.

    A frame is one unit of work, so bundles of any size are read by many tasks. The
    digest of a response is taken from its payload and must equal its header.
    """
    frames = manifest.select("bundle", "frame").distinct()

    def read(batches):
        import zstandard

        store, path = pyarrow.fs.FileSystem.from_uri(folder)
        decompressor = zstandard.ZstdDecompressor()
        tables: dict[str, list] = {}
        for batch in batches:
            out = [[], [], [], [], [], []]
            for bundle, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                name = f"{path}/{bundle}"
                with store.open_input_file(name) as file:
                    if bundle not in tables:
                        if len(tables) > 64:
                            tables.clear()
                        tables[bundle] = read_seek_table(file, file.size())
                    start, packed, plain = tables[bundle][number]
                    file.seek(start)
                    data = decompressor.decompress(file.read(packed), max_output_size=plain)
                at = 0
                while at < len(data):
                    headers, block, at = parse_record(data, at)
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    revisit = headers["WARC-Type"] == "revisit"
                    if not revisit and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"payload digest differs in {bundle}")
                    own = headers["WARC-Record-ID"][len("<urn:page:") : -1]
                    for column, value in zip(
                        out,
                        (
                            int(own) if own else None,
                            int(headers["X-Payload-Length"]),
                            digest,
                            headers["WARC-Type"],
                            int(headers["WARC-Refers-To"][len("<urn:page:") : -1]) if revisit else None,
                            headers["WARC-Target-URI"],
                        ),
                        strict=True,
                    ):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"],
            )

    return frames.mapInArrow(read, RECORDS)


def fetch_records(manifest: DataFrame, folder: str, ids: DataFrame) -> DataFrame:
    """Headers and blocks of single records: one seek and one frame for each.

    ``ids`` has page_id; revisits come with their own empty block.
    """

    def fetch(batches):
        import zstandard

        store, path = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            got = []
            for bundle, start, packed, offset in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
                with store.open_input_file(f"{path}/{bundle}") as file:
                    file.seek(start)
                    data = zstandard.ZstdDecompressor().decompress(file.read(packed))
                headers, block, _ = parse_record(data, offset)
                got.append((headers["WARC-Type"], block.decode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.string())],
                ["page_id", "record_type", "payload"],
            )

    wanted = manifest.join(ids.select("page_id").distinct(), "page_id").select(
        "page_id", "bundle", "frame_start", "frame_bytes", "offset"
    )
    return wanted.mapInArrow(fetch, "page_id long, record_type string, payload string")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as bundles in the shared folder and read them all back.

    Null html is an empty payload; null ids and repeated rows have a record each. Of
    equal payloads the rows with the smallest id are responses. No pages, no bundles.
    """
    spark = pages.sparkSession
    folder = shared_dir(spark) + "/warc"
    manifest = write_bundles(pages, folder)
    return read_bundles(spark, manifest, folder)
