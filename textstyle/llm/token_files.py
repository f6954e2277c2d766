"""Token ids as Arrow files of equal-length sequences, written and read by tasks.

All ids, in ascending order of documents, form one stream that is cut into
shards, a shard to a task. A shard is an Arrow file (the random-access format)
whose rows are sequences: ``ids`` and ``mask``, both fixed-size lists, in
batches of equal size, so that sequence ``i`` is at a known place and a view
of its buffers needs no copy. The last sequence of a shard is padded, with
false in the mask. A second file holds each document's place in the shard.

Files go to the shared folder by way of Arrow's own file systems. A task names
its files after its attempt and returns a manifest row; Spark commits the rows
of one attempt only, so files of failed or doubled attempts are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from textstyle.llm.encoding import ID_BYTES, encode_all
from textstyle.session import shared_folder, write_through

SEQUENCE = 2048
#: Sequences in a record batch, and documents in one of the index.
BATCH_ROWS, INDEX_ROWS = 256, 16_384

MANIFEST = "shard int, file string, n_docs bigint, n_tokens bigint"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """One shard: appends documents, cuts the stream into sequences."""

    def __init__(self, uri: str, id_type: pa.DataType, length: int, wide: bool):
        self.length, self.kind = length, np.dtype("<u4" if wide else "<u2")
        item = pa.uint32() if wide else pa.uint16()
        self.schema = pa.schema(
            [("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))]
        )
        self.index = pa.schema([("id", id_type), ("start", pa.int64()), ("n", pa.int64())])
        self.files, self.writers = [], []
        for suffix, schema in (("arrow", self.schema), ("docs.arrow", self.index)):
            system, path = place(f"{uri}.{suffix}")
            self.files.append(system.open_output_stream(path))
            self.writers.append(ipc.new_file(self.files[-1], schema))
        self.waiting, self.n_waiting, self.n_tokens, self.n_docs = [], 0, 0, 0
        self.rows: list[tuple] = []

    def add(self, key, ids: bytes) -> None:
        values = np.frombuffer(ids, "<u4").astype(self.kind)
        self.rows.append((key, self.n_tokens, len(values)))
        self.n_docs += 1
        self.n_tokens += len(values)
        self.waiting.append(values)
        self.n_waiting += len(values)
        if self.n_waiting >= self.length * BATCH_ROWS:
            self._sequences(last=False)
        if len(self.rows) >= INDEX_ROWS:
            self._index()

    def _sequences(self, last: bool) -> None:
        stream = np.concatenate([*self.waiting, np.empty(0, self.kind)])
        step = self.length * BATCH_ROWS
        done = len(stream) // step * step
        for at in range(0, done, step):
            self._batch(stream[at : at + step], step)
        rest = stream[done:]
        if last and len(rest):
            self._batch(rest, -(-len(rest) // self.length) * self.length)
            rest = rest[:0]
        self.waiting, self.n_waiting = [rest.copy()], len(rest)

    def _batch(self, values: np.ndarray, size: int) -> None:
        padded = np.zeros(size, self.kind)
        padded[: len(values)] = values
        flat = pa.array(padded), pa.array(np.arange(size) < len(values))
        arrays = [pa.FixedSizeListArray.from_arrays(x, self.length) for x in flat]
        self.writers[0].write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def _index(self) -> None:
        columns = list(zip(*self.rows)) or [(), (), ()]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, self.index)]
        self.writers[1].write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.index))
        self.rows = []

    def close(self) -> None:
        self._sequences(last=True)
        self._index()
        for writer, file in zip(self.writers, self.files):
            writer.close()
            file.close()


class Shard:
    """Random access to one shard's sequences."""

    def __init__(self, uri: str):
        system, path = place(uri)
        local = isinstance(system, fs.LocalFileSystem)
        source = pa.memory_map(path) if local else system.open_input_file(path)
        self.file = ipc.open_file(source)

    def batches(self) -> Iterator[pa.RecordBatch]:
        return (self.file.get_batch(k) for k in range(self.file.num_record_batches))

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view, not a copy) and mask of sequence ``i``."""
        batch = self.file.get_batch(i // BATCH_ROWS)
        ids, mask = batch.column("ids"), batch.column("mask")
        row, n = i % BATCH_ROWS, ids.type.list_size
        flat = ids.values.slice((ids.offset + row) * n, n)
        return flat.to_numpy(zero_copy_only=True), mask.values.slice((mask.offset + row) * n, n)


def write(
    docs: DataFrame,
    tokenizer: str,
    *,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = SEQUENCE,
    wide: bool = False,
    shards: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Writes the files; the manifest, one row to a shard, in stream order.

    Documents are dealt by ranges of their id, ties by content, so one id with
    many texts does not fill one task. ``shards`` is left to Spark by default;
    ``wide`` takes 32 bits an id instead of 16. A null text is empty (its end
    id alone), a null id comes first; repeated rows are written as often as
    they come. An empty table gives an empty manifest.
    """
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    end = end_id.to_bytes(ID_BYTES, "little")
    system, path = place(folder)
    system.create_dir(path, recursive=True)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*([shards] if shards else []), *order)

    def run(batches):
        shard = TaskContext.get().partitionId()
        uri, writer = f"{folder}/{shard:06d}-{uuid.uuid4().hex}", None
        for batch in batches:
            if batch.num_rows and writer is None:
                writer = ShardWriter(uri, id_type, length, wide)
            keys = batch.column(0).to_pylist()
            for key, ids in zip(keys, encode_all(tokenizer, batch.column(1))):
                writer.add(key, ids + end)
        if writer:
            writer.close()
            row = [[shard], [uri], [writer.n_docs], [writer.n_tokens]]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types)],
                ["shard", "file", "n_docs", "n_tokens"],
            )

    sorted_ = dealt.sortWithinPartitions(*order)
    return write_through(sorted_.mapInArrow(run, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame, id_field: StructField) -> DataFrame:
    """Every document as the files have it: ``id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it, over all shards.
    """
    along = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(along), F.lit(0)))
    made = StructType.fromDDL("start bigint, n_tokens bigint, ids_crc32 bigint")
    schema = StructType([id_field] + made.fields)
    names, id_type = schema.names, to_arrow_type(id_field.dataType)

    def run(batches):
        for batch in batches:
            for file, base in zip(*(batch.column(k).to_pylist() for k in range(2))):
                ids = _stream(Shard(f"{file}.arrow"))
                for index in Shard(f"{file}.docs.arrow").batches():
                    n = index.column("n").to_pylist()
                    start = pa.array(np.asarray(index.column("start")) + base, pa.int64())
                    crcs = pa.array([_crc(ids, k) for k in n], pa.int64())
                    key = index.column("id").cast(id_type)
                    yield pa.RecordBatch.from_arrays([key, start, index.column("n"), crcs], names)

    width = max(1, manifest.count())
    return shards.select("file", "base").repartition(width).mapInArrow(run, schema)


class _stream:
    """The ids of a shard in order, as 32-bit bytes, a batch at a time."""

    def __init__(self, shard: Shard):
        self.batches, self.left = shard.batches(), memoryview(b"")

    def take(self, size: int) -> Iterator[memoryview]:
        while size:
            if not self.left:
                batch = next(self.batches)
                values = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
                self.left = memoryview(values.astype("<u4").tobytes())
            part, self.left = self.left[:size], self.left[size:]
            size -= len(part)
            yield part


def _crc(ids: _stream, n: int) -> int:
    crc = 0
    for part in ids.take(n * ID_BYTES):
        crc = zlib.crc32(part, crc)
    return crc
