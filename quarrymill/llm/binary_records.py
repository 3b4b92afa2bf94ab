"""Token ids as length-delimited binary records.

Record file: for each document, in order, an 8-byte little-endian payload length, the masked
CRC-32 of these 8 bytes, the payload and its masked CRC-32. Payload: 8-byte document id, one
flag byte (bit 0: the id is null; bit 1: ids take 4 bytes, else 2), then the token ids. Index
file: for each record its byte offset and its number of ids, 8 bytes each, so that any record
can be read alone. Files are written under an attempt's own name and renamed when complete;
a task that runs again writes the same bytes.

Ids are whole numbers or NULL. Null text counts as empty: its record holds the end id alone. Rows that share an id are
ordered by text. An empty table writes no files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import session, trimmed
from .tokens import encoder


def masked(data: bytes) -> int:
    """CRC-32 rotated and offset, so that checksums of data that holds checksums stay sound."""
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def pack(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join([size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))])


def unpack(stream) -> Iterator[bytes]:
    """Payloads of a record stream; a wrong checksum or a cut record is an error."""
    while head := stream.read(12):
        if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
            raise ValueError("damaged record length")
        n = struct.unpack("<Q", head[:8])[0]
        body = stream.read(n + 4)
        if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked(body[:n]):
            raise ValueError("damaged record")
        yield body[:n]


def payload(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    return struct.pack("<qB", doc_id or 0, (doc_id is None) | wide << 1) + ids


def parse(body: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = struct.unpack("<qB", body[:9])
    return None if flags & 1 else doc_id, np.frombuffer(body, "<u4" if flags & 2 else "<u2", offset=9)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write(docs: DataFrame, out: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> list[dict]:
    """Writes all documents in ascending id order below ``out``; returns one entry per file, in order: path, documents, ids."""
    session(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text").select("id", "text")

    @trimmed
    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        store, root = _open(out)
        own, data = f"part-{part:06d}-{uuid.uuid4().hex}", None
        name, index, at, total = f"{root}/{own}", [], 0, 0
        enc = encoder(vocabulary)
        end = np.array([end_id], enc.kind).tobytes()
        for pdf in batches:
            if data is None:
                store.create_dir(root, recursive=True)
                data = store.open_output_stream(f"{name}.rec")
            for key, ids in zip(pdf["id"], enc.encode(pdf["text"].tolist()), strict=True):
                body = payload(None if pd.isna(key) else int(key), ids.tobytes() + end, enc.wide)
                n = (len(body) - 9) // (4 if enc.wide else 2)
                index.append((at, n))
                at += data.write(pack(body))
                total += n
        if data is None:
            return
        data.close()
        with store.open_output_stream(f"{name}.idx") as f:
            f.write(np.array(index, "<i8").tobytes())
        yield pd.DataFrame({"part": [part], "name": [own], "docs": [len(index)], "ids": [total]})

    found = sorted(rows.mapInPandas(save, "part int, name string, docs long, ids long").collect())  # a row a file
    return [{"path": f"{out}/{name}", "docs": n, "ids": k} for _, name, n, k in found]


def read(spark: SparkSession, files: list[dict]) -> DataFrame:
    """Per record of the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32 (of 4-byte ids) and the ids."""
    base, start = [], 0
    for f in files:
        base.append((f["path"], start))
        start += f["ids"]
    listed = spark.createDataFrame(base or [("", 0)], "path string, base long").where("path != ''").repartition(max(len(base), 1))

    @trimmed
    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, at in zip(pdf["path"], pdf["base"], strict=True):
                store, name = _open(f"{path}.rec")
                out, held = [], 0
                with store.open_input_stream(name, buffer_size=1 << 20) as f:
                    for body in unpack(f):
                        doc_id, ids = parse(body)
                        out.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), body[9:]))
                        at += len(ids)
                        held += len(body)
                        if held > 8 << 20:
                            yield _frame(out)
                            out, held = [], 0
                yield _frame(out)

    return listed.mapInPandas(load, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def _frame(out: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
    return df.assign(doc_id=df["doc_id"].astype("Int64"))


def record(path: str, k: int) -> tuple[int | None, np.ndarray]:
    """The ``k``-th record of a file, through its index: what shuffled reads do."""
    store, name = _open(f"{path}.idx")
    with store.open_input_file(name) as f:
        f.seek(16 * k)
        at, _ = np.frombuffer(f.read(16), "<i8")
    store, name = _open(f"{path}.rec")
    with store.open_input_file(name) as f:
        f.seek(int(at))
        return parse(next(unpack(f)))
