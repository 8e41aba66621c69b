"""WARC archives: written from pages, read back by boundary-chain
verification.

Writing: pages with equal payloads share one ``response`` record, the others
are ``revisit`` records that refer to it. Tasks write archives of bounded
size to the shared folder, each under a name of its attempt; the manifest is
a table that Spark commits, so files of failed or repeated attempts are never
listed.

Reading: archives are read in splits by independent tasks. A split cannot
know whether a ``WARC/1.1`` line starts a record or stands in a payload, so
tasks emit every candidate with the offset of its successor. Pointer jumping
from each file's start then keeps the reachable candidates: a round marks
what the marked ones jump to and doubles all jumps, so a file of ``n``
records takes ``log2(n)`` rounds, and magic inside payloads is never reached.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .util import join_counted

MAGIC = b"WARC/1.1\r\n"
FILE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
HEADER_BYTES = 1 << 16  # a longer head is no record
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; ``refers_to`` makes it a revisit without the payload.

    A null URL, and one of ``HEADER_BYTES // 2`` (32,768) bytes or more once
    escaped, is left out of the head and reads back as null.
    """
    revisit = refers_to is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload))),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        if len(safe.encode()) < HEADER_BYTES // 2:
            head.append(("WARC-Target-URI", safe))
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>"), ("X-Refers-To-Page", str(refers_to))]
    return MAGIC + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_head(data: bytes) -> tuple[dict[str, str], int] | None:
    """Fields and length of the head that ``data`` starts with, if it is one."""
    end = data.find(b"\r\n\r\n", 0, HEADER_BYTES)
    if not data.startswith(MAGIC) or end < 0:
        return None
    fields = {}
    for line in data[len(MAGIC):end].split(b"\r\n"):
        k, sep, v = line.partition(b": ")
        if not sep:
            return None
        fields[k.decode("utf-8", "replace").lower()] = v.decode("utf-8", "replace")
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
        return None
    return fields, end + 4


def decide(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: null for a response, else the page
    of the response. Equal payloads are told by SHA-1 and length.

    The largest page id of a group is its response; rows that repeat that id
    are responses too; a null id is below all others.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("payload"))
    keyed = keyed.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    groups = keyed.where(F.col("size") >= least).groupBy("sha", "size").agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
    groups = shared.written(groups.where("copies > 1").drop("copies"), "payload-groups")
    told = join_counted(keyed, groups, ["sha", "size"])
    other = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return told.select("page_id", "url", "payload", F.when(other, F.col("response")).alias("refers_to"))


def write(decided: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records; the manifest ``file, bytes, records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part, size, count, out, name, fs = 0, 0, 0, None, "", None

        def done():
            return pa.RecordBatch.from_pylist([{"file": name, "bytes": size, "records": count}], pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

        for batch in batches:
            for page_id, url, payload, refers in zip(*(batch.column(i) for i in range(4)), strict=True):
                if out is None:
                    name = f"pages-{task.partitionId()}-{task.taskAttemptId()}-{part}.warc"
                    fs, path = shared.filesystem(f"{folder}/{name}")
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out, size, count, part = fs.open_output_stream(path), 0, 0, part + 1
                raw = payload.as_py()
                data = record(page_id.as_py(), url.as_py(), raw, base32_sha1(raw), refers.as_py())
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield done()
        if out is not None:
            out.close()
            yield done()

    return shared.written(decided.mapInArrow(run, "file string, bytes long, records long"), "manifest", folder)


def candidates(manifest: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``file, at, next`` of every place that looks like a record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = shared.filesystem(f"{folder}/{row['file']}")
                with fs.open_input_file(path) as f:
                    data = f.read_at(min(row["hi"] + HEADER_BYTES, row["bytes"]) - row["lo"], row["lo"])
                at, found = data.find(MAGIC), []
                while 0 <= at < row["hi"] - row["lo"]:
                    head = parse_head(data[at:at + HEADER_BYTES])
                    if head:
                        after = row["lo"] + at + head[1] + int(head[0]["content-length"]) + 4
                        if after <= row["bytes"]:
                            found.append((row["lo"] + at, after))
                    at = data.find(MAGIC, at + 1)
                yield pa.RecordBatch.from_arrays([pa.array([row["file"]] * len(found), pa.string()), *(pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))], names=["file", "at", "next"])

    lo = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
    splits = manifest.where("bytes > 0").select("file", "bytes", lo.alias("lo")).withColumn("hi", F.least(F.col("lo") + split_bytes, F.col("bytes")))
    splits = splits.repartition(F.col("file"), F.col("lo"))
    return splits.mapInArrow(run, "file string, at long, next long")


def reachable(found: DataFrame, folder: str) -> DataFrame:
    """The candidates on the chain that starts at offset 0 of each file."""
    nodes = shared.written(found.select("file", "at", "next", F.col("next").alias("jump"), (F.col("at") == 0).alias("reached")), "chain-0", folder)
    k = 0
    while True:
        k += 1
        marked = nodes.where("reached").select("file", F.col("jump").alias("at"), F.lit(True).alias("mark"))
        onward = nodes.select("file", F.col("at").alias("jump"), F.col("jump").alias("further"))
        # jumps that leave the candidates (the end of the file) stay where they are
        step = nodes.join(marked, ["file", "at"], "left").join(onward, ["file", "jump"], "left")
        step = step.select("file", "at", "next", F.coalesce("further", "jump").alias("jump"), (F.col("reached") | F.col("mark").isNotNull()).alias("reached"), (~F.col("reached") & F.col("mark").isNotNull()).alias("new"))
        nodes = shared.written(step, f"chain-{k}", folder)
        if nodes.where("new").isEmpty():
            return nodes.where("reached").select("file", "at", "next")
        nodes = nodes.drop("new")


def read(chain: DataFrame, folder: str) -> DataFrame:
    """The records at the verified offsets: ``page_id, url, record_type,
    refers_to, payload_bytes, payload_digest`` and ``intact`` (a response's
    payload has the digest and length that its head names).

    A response's length and digest are taken from its payload, a revisit's
    from its head.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, f = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    fs, path = shared.filesystem(f"{folder}/{row['file']}")
                    name, f = row["file"], fs.open_input_file(path)
                data = f.read_at(row["next"] - row["at"], row["at"])
                fields, head = parse_head(data)
                number = lambda k, fields=fields: int(fields[k]) if k in fields else None
                told, length = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
                if fields["warc-type"] == "response":
                    block = data[head:head + int(fields["content-length"])]
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    digest, size = base32_sha1(payload), len(payload)
                else:
                    digest, size = told, length
                out.append({"page_id": number("x-page-id"), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "refers_to": number("x-refers-to-page"),
                            "payload_bytes": size, "payload_digest": digest, "intact": (digest, size) == (told, length)})
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_())])
    ordered = chain.repartitionByRange("file", "at").sortWithinPartitions("file", "at")
    return ordered.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, intact boolean")


def round_trip(pages: DataFrame, least: int = 0, file_bytes: int = FILE_BYTES, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives and read them back:
    one row per row of ``pages``.

    Null html is an empty payload, a null url or id is left out of the head;
    payloads of fewer than ``least`` bytes are all responses. Other columns
    are not read. An empty table writes no archive and gives no row.
    """
    folder = shared.new_folder(pages.sparkSession, "warc")
    decided = decide(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), least)
    manifest = write(decided, folder, file_bytes)
    return read(reachable(candidates(manifest, folder, split_bytes), folder), folder)
