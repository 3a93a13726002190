"""Token-ID files: every document compressed on its own under one shared zstandard dictionary.

The dictionary is trained on the serialised ids of a bounded sample of
documents (``sample_docs``); every document is then written. A file set is a
folder with

* ``dictionary``: one row with the dictionary's bytes, its SHA-256, the width of an id and the end id;
* ``shards``: rows of about ``shard_bytes``, each the compressed documents one after another, with
  the documents' ids, token counts and offsets (the index for access to one document), the number
  of ids before it in its part, and the dictionary's hash;
* ``parts``: for each part, in order, the number of ids before it.

Spark writes all of it, so a lost executor's files are made again. Documents
lie in ascending ``doc_id`` order (null first; rows that share an id in order
of a hash of their text). A null text is an empty document, whose ids are the
end id alone. An empty table gives an empty file set.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import text_slices
from .units import encode_whole, tokenizer_store

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SAMPLE_DOCS = 400
SAMPLE_CHARS = 20_000
SAMPLE_STRETCHES = 4
DICTIONARY_BYTES = 32 * 1024
SHARD_BYTES = 1 << 20
LEVEL = 3

_SHARD = (
    "part int, seq int, ids_before long, first_doc long, last_doc long, doc_ids array<long>, "
    "n_tokens array<int>, offsets array<long>, payload binary, dictionary_sha256 string"
)

def encode_texts(texts: list[bytes], path: str, end_id: int = END_ID) -> list[np.ndarray]:
    """The ids of each text with the end id."""
    return [np.append(ids, np.uint32(end_id)) for ids in encode_whole(texts, tokenizer_store(path))]


def id_width(path: str, end_id: int) -> int:
    """Bytes that hold any id."""
    return 2 if max(Tokenizer.from_file(path).get_vocab_size() - 1, end_id) < 1 << 16 else 4


def train_dictionary(docs: DataFrame, path: str, width: int, end_id: int, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """A dictionary from stretches of at most ``sample_docs`` documents, those with the smallest hashes of id and text."""
    size = SAMPLE_CHARS // SAMPLE_STRETCHES
    # stretches from all over a text; of a short one all of it
    apart = F.greatest(F.lit(size), F.floor(F.length("text") / SAMPLE_STRETCHES)).cast("int")
    stretches = [F.substring("text", F.lit(k) * apart + 1, F.lit(size)) for k in range(SAMPLE_STRETCHES)]
    chosen = docs.where(F.col("text").isNotNull()).select(F.xxhash64("doc_id", "text").alias("draw"), F.concat(*stretches).alias("text"))
    # the numbers first, or each task would send so many texts
    last = chosen.select("draw").orderBy("draw").limit(sample_docs).agg(F.max("draw")).head()[0]
    rows = chosen.where(F.col("draw") <= last).orderBy("draw", "text").limit(sample_docs).collect()
    samples = [a.astype(f"<u{width}").tobytes() for a in encode_texts([r.text.encode() for r in rows], path, end_id)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        # too few or too small samples to train on: their own bytes serve as the dictionary
        return b"".join(samples)[-DICTIONARY_BYTES:]


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str | None = None,
    end_id: int = END_ID,
    sample_docs: int = SAMPLE_DOCS,
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Writes the documents (``doc_id``, ``text``; other columns are not read) as a file set."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path(TOKENIZER)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = id_width(path, end_id)
    dictionary = train_dictionary(docs, path, width, end_id, sample_docs)
    digest = hashlib.sha256(dictionary).hexdigest()
    head = spark.createDataFrame(
        [(bytearray(dictionary), digest, width, end_id)], "dictionary binary, sha256 string, id_width int, end_id int"
    )
    head.coalesce(1).write.parquet(f"{folder}/dictionary")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer = _compressor(dictionary)
        seq = before = size = 0
        held: list[tuple] = []
        for batch, texts in text_slices(batches):
            encoded = encode_texts(texts, path, end_id)
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                held.append((doc, len(ids), packer.compress(ids.astype(f"<u{width}").tobytes())))
                size += len(held[-1][2])
                if size >= shard_bytes:
                    yield _shard(part, seq, before, held, digest)
                    seq, before, held, size = seq + 1, before + sum(r[1] for r in held), [], 0
        if held:
            yield _shard(part, seq, before, held, digest)

    # in order before they are encoded, so that a text is encoded once
    order = ["doc_id", "tie", "text"]
    # with the hash, an id of very many rows is dealt over several tasks
    in_order = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions(*order)
    in_order.select("doc_id", "text").mapInArrow(shards, _SHARD).write.parquet(f"{folder}/shards")

    # one row for each task that wrote, whatever the number of documents
    written = spark.read.parquet(f"{folder}/shards")
    parts = written.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts.select("part", before.cast("long").alias("base")).coalesce(1).write.parquet(f"{folder}/parts")


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None, digest: bool = False) -> DataFrame:
    """The documents of a file set: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``
    and their ``ids``, or with ``digest`` the unsigned ``ids_crc32`` instead.

    With ``doc_ids`` only shards whose range holds one of them are read, and only those documents unpacked.
    """
    head = spark.read.parquet(f"{folder}/dictionary").head()
    dictionary, sha, width = bytes(head.dictionary), head.sha256, head.id_width
    if hashlib.sha256(dictionary).hexdigest() != sha:
        raise ValueError(f"the dictionary of {folder} does not have its hash")
    shards = spark.read.parquet(f"{folder}/shards")
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        ranges = [(F.col("first_doc") <= i) & (F.col("last_doc") >= i) for i in wanted]
        hit = F.lit(False)
        for one in ranges:
            hit = hit | one
        shards = shards.where(hit)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = _decompressor(dictionary)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_sha256"] != sha:
                    raise ValueError("a shard was written with another dictionary")
                yield _documents(row, opener, width, wanted, digest)

    parts = F.broadcast(spark.read.parquet(f"{folder}/parts"))
    last = "ids_crc32 long" if digest else "ids array<long>"
    return shards.join(parts, "part").mapInArrow(unpack, f"doc_id long, start long, n_tokens long, {last}")


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))


def _shard(part: int, seq: int, before: int, held: list[tuple], digest: str) -> pa.RecordBatch:
    ids = [r[0] for r in held]
    known = [i for i in ids if i is not None]
    offsets = np.cumsum([0, *(len(r[2]) for r in held)])
    row = {
        "part": part, "seq": seq, "ids_before": before, "first_doc": min(known, default=None),
        "last_doc": max(known, default=None), "doc_ids": ids, "n_tokens": [r[1] for r in held],
        "offsets": offsets.tolist(), "payload": b"".join(r[2] for r in held), "dictionary_sha256": digest,
    }
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    kinds += [pa.list_(pa.int64()), pa.binary(), pa.string()]
    return pa.RecordBatch.from_pylist([row], pa.schema(list(zip(row, kinds, strict=True))))


def _documents(row: dict, opener: zstandard.ZstdDecompressor, width: int, wanted: set | None, digest: bool) -> pa.RecordBatch:
    counts = row["n_tokens"]
    starts = row["base"] + row["ids_before"] + np.cumsum([0, *counts])
    kept, last = [], []
    for i, doc in enumerate(row["doc_ids"]):
        if wanted is not None and doc not in wanted:
            continue
        blob = row["payload"][row["offsets"][i] : row["offsets"][i + 1]]
        ids = np.frombuffer(opener.decompress(blob, max_output_size=counts[i] * width), f"<u{width}").astype("<u4")
        kept.append(i)
        last.append(zlib.crc32(ids.tobytes()) if digest else ids.astype("i8"))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row["doc_ids"][i] for i in kept], pa.int64()),
            pa.array([int(starts[i]) for i in kept], pa.int64()),
            pa.array([counts[i] for i in kept], pa.int64()),
            pa.array(last, pa.int64() if digest else pa.list_(pa.int64())),
        ],
        names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
    )
