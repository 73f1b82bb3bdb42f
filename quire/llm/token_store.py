"""Token ids in binary shards: one zstandard frame per document, one shared dictionary.

A store is a folder with ``dictionary`` (one file named by its SHA-256), shard
files and a ``manifest`` table.  A shard holds, in ascending doc_id order:

    8 bytes   magic
    frames    one zstandard frame per document: its ids as little-endian uint32
    index     per document: doc_id int64, frame offset uint64, ids uint32, crc32 uint32
    footer    index offset uint64, documents uint32, 32 bytes dictionary hash, 8 bytes magic

so one document is read with the footer, a search in the index, and one range
read of its frame.  The dictionary is trained on the id arrays of a bounded
sample (``SAMPLE_DOCS`` documents with the smallest hashes, ``SAMPLE_CHARS``
characters of each); everything else covers all rows.

Tasks write their shards under names of their own attempt and return manifest
rows; Spark commits the manifest, so shards of lost or repeated attempts are
never referred to.  The text is shuffled once, by ranges of doc_id.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.util import ship_package
from ..sinks.files import qualified
from .common import among_smallest, text_or_empty
from .tokenization import load, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 4000
SHARD_BYTES = 64 << 20

MAGIC = b"QTOKENS1"
_FOOTER = struct.Struct("<QI32s8s")
_ENTRY = [("doc_id", "<i8"), ("offset", "<u8"), ("n", "<u4"), ("crc", "<u4")]
NO_ID = -(2**63)  # written for a null doc_id
_MANIFEST = "part int, seq int, shard string, first_doc bigint, last_doc bigint, n_docs bigint, n_tokens bigint, bytes bigint"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write(path: str, data: bytes) -> None:
    filesystem, inner = _open(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(inner) as f:
        f.write(data)


def train_dictionary(samples: Sequence[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary from serialized id arrays; empty when there is too little to learn from."""
    import zstandard

    samples = [s for s in samples if len(s) >= 8]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), list(samples)).as_bytes()
    except zstandard.ZstdError:
        return b""


def _codec(dictionary: bytes, level: int = LEVEL):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    kw = {"dict_data": known} if known else {}
    return zstandard.ZstdCompressor(level=level, **kw), zstandard.ZstdDecompressor(**kw)


class ShardWriter:
    """Collects frames and their index; ``finish`` gives the bytes of the shard."""

    def __init__(self, dictionary: bytes, level: int = LEVEL):
        self._compress = _codec(dictionary, level)[0].compress
        self._hash = hashlib.sha256(dictionary).digest()
        self.frames, self.index, self.at, self.tokens = [MAGIC], [], len(MAGIC), 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self._compress(ids)
        self.index.append((NO_ID if doc_id is None else doc_id, self.at, len(ids) // 4, zlib.crc32(ids)))
        self.frames.append(frame)
        self.at += len(frame)
        self.tokens += len(ids) // 4

    def finish(self) -> bytes:
        import numpy as np

        index = np.array(self.index, dtype=_ENTRY).tobytes()
        return b"".join([*self.frames, index, _FOOTER.pack(self.at, len(self.index), self._hash, MAGIC)])


def read_index(data: bytes):
    """``(index array, dictionary hash)`` of a shard's bytes, or of its tail when ``data`` starts later."""
    import numpy as np

    at, n, digest, magic = _FOOTER.unpack(data[-_FOOTER.size :])
    if magic != MAGIC:
        raise ValueError("not a token shard")
    width = np.dtype(_ENTRY).itemsize
    end = len(data) - _FOOTER.size
    return np.frombuffer(data[end - n * width : end], dtype=_ENTRY), digest.hex(), at


def read_shard(data: bytes, dictionary: bytes) -> Iterator[tuple[int | None, bytes]]:
    """``(doc_id, ids)`` of every document in a shard; checks dictionary and digests."""
    index, digest, end = read_index(data)
    if digest != hashlib.sha256(dictionary).hexdigest():
        raise ValueError("the shard was written with another dictionary")
    expand = _codec(dictionary)[1].decompress
    for k in range(len(index)):
        stop = int(index["offset"][k + 1]) if k + 1 < len(index) else end
        ids = expand(data[int(index["offset"][k]) : stop])
        if zlib.crc32(ids) != int(index["crc"][k]):
            raise ValueError("damaged frame")
        doc = int(index["doc_id"][k])
        yield (None if doc == NO_ID else doc), ids


def fetch(shard: str, dictionary: bytes, doc_id: int) -> bytes | None:
    """Ids of one document by range reads: footer, index, then its frame alone."""
    import numpy as np

    filesystem, inner = _open(shard)
    size = filesystem.get_file_info(inner).size
    with filesystem.open_input_file(inner) as f:
        at, n, _, _ = _FOOTER.unpack(f.read_at(_FOOTER.size, size - _FOOTER.size))
        index = np.frombuffer(f.read_at(n * np.dtype(_ENTRY).itemsize, at), dtype=_ENTRY)
        k = int(np.searchsorted(index["doc_id"], doc_id))
        if k == n or index["doc_id"][k] != doc_id:
            return None
        start, stop = int(index["offset"][k]), int(index["offset"][k + 1]) if k + 1 < n else at
        return _codec(dictionary)[1].decompress(f.read_at(stop - start, start))


def _encoder(path: str, kind: str, end_id: int):
    end = int(end_id).to_bytes(4, "little")

    def encode(texts) -> Iterator[bytes]:
        return (ids + end for ids in load(path, kind).encode_column(texts))

    return encode


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, kind: str = "byte", end_id: int = END_ID, level: int = LEVEL) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into a store at ``path``; returns its manifest.

    Null texts count as empty (the end id alone), a null doc_id comes first, and rows that repeat
    a doc_id are all kept, ordered by text.  Other columns are not read.  An empty table gives a
    store without shards.
    """
    spark = docs.sparkSession
    ship_package(spark)
    root = qualified(spark, path)
    encode = _encoder(tokenizer or tokenizer_path(TOKENIZER), kind, end_id)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))

    def sample_ids(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(list(encode(batch["text"])), pa.binary())], ["ids"])

    few = d.where(among_smallest(F.xxhash64("doc_id"), SAMPLE_DOCS, d.count()))
    some = few.select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    dictionary = train_dictionary([bytes(r.ids) for r in some.select("text").mapInArrow(sample_ids, "ids binary").collect()])
    # The magic comes first, so that the file of an empty dictionary is not an empty file, which scans pass over.
    _write(f"{root}/dictionary/{hashlib.sha256(dictionary).hexdigest()}", MAGIC + dictionary)

    def write_shards(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        seq, w, manifest = 0, None, []

        def close():
            nonlocal seq, w
            shard = f"{root}/shards/{part:06d}-{seq:05d}-{attempt}.qtok"
            data = w.finish()
            _write(shard, data)
            first, last = w.index[0][0], w.index[-1][0]
            manifest.append((part, seq, shard, first, last, len(w.index), w.tokens, len(data)))
            seq, w = seq + 1, None

        for batch in batches:
            for doc, ids in zip(batch["doc_id"].to_pylist(), encode(batch["text"]), strict=True):
                w = w or ShardWriter(dictionary, level)
                w.add(doc, ids)
                if w.at >= SHARD_BYTES:
                    close()
        if w:
            close()
        names = [c.split()[0] for c in _MANIFEST.split(", ")]
        types = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[c.split()[1]] for c in _MANIFEST.split(", ")]
        columns = zip(*manifest, strict=True) if manifest else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    ordered = d.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write_shards, _MANIFEST).write.parquet(f"{root}/manifest")
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    """The store's one dictionary; its name has to be its hash."""
    row = spark.read.format("binaryFile").load(f"{qualified(spark, path)}/dictionary").select("path", "content").first()
    data = bytes(row["content"]).removeprefix(MAGIC)
    if hashlib.sha256(data).hexdigest() != row["path"].rsplit("/", 1)[1]:
        raise ValueError("the dictionary file is damaged")
    return data


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document, read back from the shards.

    ``start`` counts the ids of all documents before it.  Only the manifest (one row per shard) is
    added up in order; each shard is then read by one task.
    """
    ship_package(spark)
    dictionary = read_dictionary(spark, path)
    shards = read_manifest(spark, path)
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One shard is one unit of reading: deal them one by one.
    n = max(1, shards.count())
    dealt = shards.withColumn("start", before).repartitionByRange(n, "part", "seq")

    def read(batches):
        import pandas as pd

        for pdf in batches:
            for shard, start in zip(pdf["shard"], pdf["start"], strict=True):
                filesystem, inner = _open(shard)
                with filesystem.open_input_file(inner) as f:
                    data = f.read()
                rows, at = [], int(start)
                for doc, ids in read_shard(data, dictionary):
                    rows.append((doc, at, len(ids) // 4, ids))
                    at += len(ids) // 4
                    if len(rows) == 256:
                        yield _frame(rows)
                        rows = []
                if rows:
                    yield _frame(rows)

    def _frame(rows):
        import pandas as pd

        out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids"])
        out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
        return out

    return dealt.select("shard", "start").mapInPandas(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def stored_tokens(docs: DataFrame, path: str) -> DataFrame:
    """Write a store, read it back, and digest it: ``(doc_id, start, n_tokens, ids_crc32)``."""
    write_store(docs, path)
    return read_store(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
