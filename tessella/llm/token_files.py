"""Token ids on disk: each document compressed on its own with one shared zstandard dictionary.

A file has documents in ascending id order: a head (magic, width of an id, SHA-256 of the dictionary), the compressed
documents, then the index (has an id, doc_id, offset, tokens, CRC) and a tail that tells where the index starts. Any
document can be read by its index entry and the dictionary alone. Files are written by a temporary name and renamed, so
a task that runs twice leaves one whole file.

Defined cases: null text is empty and has the end id alone; null ids come first; rows that repeat an id follow each
other by a hash of their text; an empty table writes no file and returns no row.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, new_path
from .tokens import encoder, public_path

END = 1
MAGIC = b"TOKZ0001"
#: The dictionary is fitted on about SAMPLE documents, encoded whole, of which it sees up to SLICES slices of SLICE_IDS ids
#: spread over the whole length.
SAMPLE, SLICES, SLICE_IDS, DICTIONARY_BYTES, LEVEL = 1000, 4, 500, 64 * 1024, 3
_HEAD, _ENTRY, _TAIL = "<8sB32s", "<BqQII", "<QI8s"


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def train_dictionary(docs: DataFrame, file: str, sample: int = SAMPLE, dtype: str = "<u2") -> bytes:
    """A dictionary from serialized id arrays of a bounded sample: documents whose hash falls in a share of the range."""
    import zstandard

    width = int(dtype[-1])

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for ids in encoder(file, dtype).many([x if isinstance(x, str) else None for x in pdf["text"]]):
                n = len(ids) // width
                step = max(-(-n // SLICES), SLICE_IDS)
                out += [ids[k * width : (k + SLICE_IDS) * width] for k in range(0, n, step)]
            yield pd.DataFrame({"ids": out})

    every = max(1, docs.count() // sample)
    rows = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(every)) == 0).select("text")
    arrays = sorted(bytes(r.ids) for r in rows.mapInPandas(slices, "ids binary").limit(2 * SLICES * sample).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little to train on: the arrays themselves are the dictionary
        return (b"".join(arrays) or bytes(8))[:DICTIONARY_BYTES]


def write_files(docs: DataFrame, folder: str, file: str, dictionary: bytes, dtype: str = "<u2") -> DataFrame:
    """One file a range of ids; returns (shard, path, n_docs, n_tokens)."""
    key = hashlib.sha256(dictionary).digest()
    width = int(dtype[-1])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        import zstandard

        shard = TaskContext.get().partitionId()
        store, root = filesystem(folder)
        end = np.array([END], dtype).tobytes()
        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True, write_checksum=False)
        sink, index, at, tokens = None, [], 0, 0
        temporary = f"{root}/.{shard}-{uuid.uuid4().hex}"
        for pdf in batches:
            for k in range(0, len(pdf), 200):
                part = pdf.iloc[k : k + 200]
                for doc_id, ids in zip(part["doc_id"], encoder(file, dtype).many([x if isinstance(x, str) else None for x in part["text"]]), strict=True):
                    if sink is None:
                        store.create_dir(root, recursive=True)
                        sink = store.open_output_stream(temporary)
                        sink.write(struct.pack(_HEAD, MAGIC, width, key))
                        at = struct.calcsize(_HEAD)
                    ids += end
                    small = press.compress(ids)
                    sink.write(small)
                    n = len(ids) // width
                    crc = zlib.crc32(np.frombuffer(ids, dtype).astype("<u4").tobytes())
                    index.append(struct.pack(_ENTRY, not pd.isna(doc_id), 0 if pd.isna(doc_id) else int(doc_id), at, n, crc))
                    at += len(small)
                    tokens += n
        if sink is not None:
            sink.write(b"".join(index))
            sink.write(struct.pack(_TAIL, at, len(index), MAGIC))
            sink.close()
            path = f"{root}/{shard:06d}.tokz"
            if store.get_file_info(path).is_file:  # of an attempt before; the same bytes
                store.delete_file(path)
            store.move(temporary, path)
            yield pd.DataFrame({"shard": [shard], "path": [f"{folder}/{shard:06d}.tokz"], "n_docs": [len(index)], "n_tokens": [tokens]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"))
    rows = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    return materialize(rows.mapInPandas(write, "shard int, path string, n_docs long, n_tokens long"), "token-shards")


def read_document(store, path: str, entry: tuple, dictionary: bytes, dtype: str = "<u2"):
    """Ids of one document by its index entry, without the rest of the file."""
    import numpy as np
    import zstandard

    _, _, at, size, n, _ = entry
    with store.open_input_file(path) as f:
        f.seek(at)
        blob = f.read(size)
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress(blob, max_output_size=n * int(dtype[-1])), dtype)


def read_index(store, path: str, dictionary: bytes) -> list[tuple]:
    """(has an id, doc_id, offset, compressed size, tokens, crc) of each document; checks the dictionary's hash."""
    with store.open_input_file(path) as f:
        magic, _, key = struct.unpack(_HEAD, f.read(struct.calcsize(_HEAD)))
        if magic != MAGIC or key != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} was not written with this dictionary")
        f.seek(f.size() - struct.calcsize(_TAIL))
        start, count, _ = struct.unpack(_TAIL, f.read(struct.calcsize(_TAIL)))
        f.seek(start)
        raw = [struct.unpack_from(_ENTRY, x) for x in (f.read(struct.calcsize(_ENTRY)) for _ in range(count))]
    ends = [r[2] for r in raw[1:]] + [start]
    return [(r[0], r[1], r[2], e - r[2], r[3], r[4]) for r, e in zip(raw, ends, strict=True)]


def read_files(shards: DataFrame, dictionary: bytes, dtype: str = "<u2") -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32 of what is decoded."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    based = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        import zstandard

        undo = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        width = int(dtype[-1])
        for pdf in batches:
            for path, base in zip(pdf["path"], pdf["base"], strict=True):
                store, local = filesystem(path)
                rows = []
                with store.open_input_file(local) as f:
                    for has, doc_id, at, size, n, _ in read_index(store, local, dictionary):
                        f.seek(at)
                        ids = np.frombuffer(undo.decompress(f.read(size), max_output_size=n * width), dtype)
                        rows.append((doc_id if has else None, base, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        base += len(ids)
                        if len(rows) == 20_000:
                            yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})
                            rows = []
                yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    tasks = max(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)  # rows are few, files are not small
    return based.repartition(tasks, "shard").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    file = public_path("word_bpe_49k.json")
    dictionary = train_dictionary(docs, file)
    shards = write_files(docs, new_path(spark, "token-files"), file, dictionary)
    return read_files(shards, dictionary)
