"""Deterministic sharded WARC archives of pages, and their reader.

Records are split into shards at fixed page ids, sorted, and written one gzip member each.  A file is closed when its
compressed size reaches the limit.  Tasks write under temporary names and hand on manifest rows; Spark keeps the rows of one
attempt for each task, and only the files in the manifest are renamed to their final names, which a repeated task does again
without harm.  Names, headers, dates and ids follow from the rows alone, so a second run writes the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut, own, tidied

LEAST_REVISIT = 1000
ROLL_BYTES = 64 << 20
SHARD_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("7f2b0e6c-3a52-5d0e-9a51-0c8f4f0f6a11")
MANIFEST = "shard int, number int, temporary string, name string, records bigint, bytes bigint, sha256 string"
RECORD = "file string, position bigint, page_id bigint, url string, record_id string, record_type string, payload_bytes bigint, " \
         "payload_digest string, refers_to bigint, refers_to_id string, payload binary"


def roles(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Pages with payload, payload_bytes, payload_digest (SHA-1, hex), refers_to and refers_url: the page whose payload a page repeats.

    Of equal payloads of at least `least` bytes the row with the largest page_id stays a response (all rows, if that id
    repeats, or if all ids are null); a null id is smaller than any other.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = own(pages, "page_id", "url", "html").withColumn("h", place()[1]).withColumn("page_id", F.col("page_id").cast("long")) \
        .withColumn("payload", payload).drop("html") \
        .withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1("payload"))
    tops = cut(base.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
               .agg(F.max(F.struct("page_id", "url")).alias("top"), F.count("*").alias("c")).where("c > 1 and top.page_id is not null")
               .select("payload_digest", F.col("top.page_id").alias("top"), F.col("top.url").alias("top_url")), "tops")
    repeats = (F.col("payload_bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("top"))
    return base.join(tops, "payload_digest", "left").withColumn("refers_to", F.when(repeats, F.col("top"))) \
        .withColumn("refers_url", F.when(repeats, F.col("top_url"))).drop("top", "top_url") \
        .withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))


def place() -> list[Column]:
    """Where a row lies in the order of the shards: its id, null first, then a hash of its URL and html."""
    return [F.coalesce(F.col("page_id").cast("long"), F.lit(-(1 << 63))), F.xxhash64("url", F.coalesce("html", F.lit("")))]


def boundaries(pages: DataFrame, shards: int) -> np.ndarray:
    """Places that split the pages into about equal shards: quantiles of the 100 different places for each shard with the least hash."""
    at = [c.alias(n) for n, c in zip("ih", place(), strict=True)]
    found = pages.select(*at).distinct().orderBy(F.xxhash64("i", "h"), "i", "h").limit(100 * shards).collect()
    ends = np.array(sorted((r.i, r.h) for r in found), dtype=[("i", np.int64), ("h", np.int64)])
    return ends[[len(ends) * k // shards for k in range(1, shards)]] if len(ends) else ends


def record_id(kind: str, page_id, url, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{kind}|{page_id}|{url}|{digest}')}>"


def line(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def head(fields: list[tuple[str, object]], first: str) -> bytes:
    return "".join([first + "\r\n", *(f"{k}: {v}\r\n" for k, v in fields if v is not None), "\r\n"]).encode()


def base32(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(row: dict) -> bytes:
    """The uncompressed record of a page, with new headers and digests."""
    revisit = row["refers_to"] is not None
    payload = b"" if revisit else row["payload"]
    url = row["url"] or ""
    http = head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", row["payload_bytes"])], "HTTP/1.1 200 OK")
    block = http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id("page", row["page_id"], url, row["payload_digest"])),
        ("WARC-Date", DATE), ("WARC-Target-URI", line(url) or "about:blank"), ("WARC-Payload-Digest", base32(row["payload_digest"])),
        ("WARC-Block-Digest", base32(hashlib.sha1(block).hexdigest())), ("WARC-Page-ID", row["page_id"]),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", record_id("page", row["refers_to"], row["refers_url"] or "", row["payload_digest"]) if revisit else None),
        ("WARC-Refers-To-Target-URI", (line(row["refers_url"] or "") or "about:blank") if revisit else None), ("WARC-Refers-To-Page-ID", row["refers_to"]), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return head(fields, "WARC/1.1") + block + b"\r\n\r\n"


def info(name: str) -> bytes:
    body = b"software: deterministic page writer\r\nformat: WARC File Format 1.1\r\n"
    return head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", 0, name, "")), ("WARC-Date", DATE), ("WARC-Filename", name),
                 ("Content-Type", "application/warc-fields"), ("Content-Length", len(body))], "WARC/1.1") + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(pages: DataFrame, root: str | None = None, roll_bytes: int = ROLL_BYTES, least: int = LEAST_REVISIT) -> DataFrame:
    """Archive the pages below `root` and return the manifest: shard, number, name, records, bytes, sha256 of each file.

    `root` is a folder that all executors reach, by default a new one below the shared folder.  Its manifest, JSON lines with a
    _SUCCESS mark, is written last and what failed attempts left is removed then, so a folder without the mark is not finished;
    one that has a manifest is an error.  Null payloads are empty, null URLs become about:blank, a null page_id is left out of
    the record; repeated rows are written each; an empty table writes no file.  Rows of one page_id are split by URL and html;
    only rows equal in all three share a shard whatever their number.  Columns other than page_id, url and html are not read.
    """
    spark = pages.sparkSession
    root = (root or scratch_path(spark, "warc")).rstrip("/")
    if kept(spark, f"{root}/manifest"):
        raise ValueError(f"{root} already holds a finished archive")
    marked = roles(pages, least)
    volume = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // SHARD_BYTES), 1)
    ends = boundaries(own(pages, "page_id", "url", "html"), shards)
    fields = marked.schema.names

    def shard(batches):
        for batch in batches:
            at = np.empty(batch.num_rows, dtype=ends.dtype)
            at["i"] = [-(1 << 63) if x is None else x for x in batch.column("page_id").to_pylist()]
            at["h"] = batch.column("h").to_numpy()
            # compared field by field, as numpy does not search structures
            names = np.searchsorted(ends["i"], at["i"], side="left")
            upto = np.searchsorted(ends["i"], at["i"], side="right")
            for i in np.unique(at["i"][names < upto]):
                these = np.flatnonzero(at["i"] == i)
                names[these] += np.searchsorted(ends["h"][names[these[0]]:upto[these[0]]], at["h"][these], side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names.astype(np.int32))], names=[*fields, "shard"])

    # the shard is the number of the task, so no two of them meet in one
    dealt = marked.mapInArrow(tidied(shard), marked.withColumn("shard", F.lit(0)).schema).repartitionById(shards, "shard") \
        .sortWithinPartitions("shard", "page_id", "h", "url", "payload_digest")

    def archive(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        store.create_dir(f"{base}/temporary", recursive=True)
        attempt, out, done = uuid.uuid4().hex, None, []

        def close():
            nonlocal out
            if out:
                out["stream"].close()
                done.append((out["shard"], out["number"], out["temporary"], out["name"], out["records"], out["bytes"], out["sha"].hexdigest()))
            out = None

        def put(data: bytes):
            packed = member(data)
            out["stream"].write(packed)
            out["sha"].update(packed)
            out["bytes"] += len(packed)

        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in (*fields, "shard")}
                if out and (out["shard"] != row["shard"] or out["bytes"] >= roll_bytes):
                    number = out["number"] + 1 if out["shard"] == row["shard"] else 0
                    close()
                else:
                    number = 0
                if not out:
                    name = f"pages-{row['shard']:06d}-{number:05d}.warc.gz"
                    temporary = f"{base}/temporary/{name}.{attempt}"
                    out = {"shard": row["shard"], "number": number, "name": name, "temporary": temporary, "records": 0, "bytes": 0,
                           "sha": hashlib.sha256(), "stream": store.open_output_stream(temporary, compression=None)}
                    put(info(name))
                put(record(row))
                out["records"] += 1
        close()
        if done:
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)],
                                             names=["shard", "number", "temporary", "name", "records", "bytes", "sha256"])

    written = cut(dealt.mapInArrow(tidied(archive), MANIFEST), "manifest")

    def commit(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        for batch in batches:
            for temporary, name in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist(), strict=True):
                # moved already, if an attempt before this one was lost
                if store.get_file_info(temporary).type != fs.FileType.NotFound:
                    store.move(temporary, f"{base}/{name}")
            yield batch

    written.mapInArrow(tidied(commit), MANIFEST).drop("temporary").write.mode("overwrite").json(f"{root}/manifest")
    kept(spark, f"{root}/temporary", remove=True)
    return manifest_of(spark, root)


def kept(spark: SparkSession, folder: str, remove: bool = False) -> bool:
    """Whether a folder is there; removed with what it holds, if asked."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.exists(path) and (not remove or store.delete(path, True))


def manifest_of(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of a finished folder, names as full paths."""
    if not kept(spark, f"{root}/manifest/_SUCCESS"):
        raise ValueError(f"{root} is not finished")
    rows = spark.read.schema(MANIFEST).json(f"{root}/manifest")
    return rows.withColumn("name", F.concat(F.lit(root + "/"), "name")).drop("temporary")


def parse(stream, most: int = 1 << 20):
    """The records of a gzip stream as (headers, block), one member at a time."""
    unpacker, held = zlib.decompressobj(31), []
    while True:
        data = stream.read(most)
        if not data:
            return
        while data:
            held.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                whole = b"".join(held)
                top, _, rest = whole.partition(b"\r\n\r\n")
                headers = dict(x.split(": ", 1) for x in top.decode().split("\r\n")[1:])
                yield headers, rest[:int(headers["Content-Length"])]
                unpacker, held = zlib.decompressobj(31), []


def read(manifest: DataFrame) -> DataFrame:
    """The page records of the archives a manifest names, digests of payloads taken anew; a damaged payload is an error.

    A name that is there twice is read twice, an empty manifest gives no rows, a null name is an error; other columns are not read.
    """
    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for uri in batch.column("name").to_pylist():
                store, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for position, (h, block) in enumerate(parse(stream)):
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                        stated = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        fresh = h["WARC-Type"] == "response"
                        if fresh and (len(payload) != size or hashlib.sha1(payload).hexdigest() != stated):
                            raise ValueError(f"{uri}: record {position} is damaged")
                        number = lambda k: int(h[k]) if k in h else None
                        rows.append((uri, position, number("WARC-Page-ID"), h["WARC-Target-URI"], h["WARC-Record-ID"], h["WARC-Type"], size, stated,
                                     number("WARC-Refers-To-Page-ID"), h.get("WARC-Refers-To"), payload if fresh else None))
                        held += len(payload)
                        if held > 8 << 20:
                            yield table_of(rows)
                            rows, held = [], 0
                if rows:
                    yield table_of(rows)

    # a task for each file, whatever their names; given as a number, so that adaptive execution does not merge them
    return manifest.select("name").repartitionByRange(max(1, manifest.count()), "name").mapInArrow(tidied(run), RECORD)


def table_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["file", "position", "page_id", "url", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "refers_to_id", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def report(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return read(write(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
