"""Token-id output: frequency-ranked ids in byte-aligned variable-length code, control bytes apart from data bytes.

A file holds blocks of documents in ascending ``doc_id`` order. Ids are replaced by their rank (0: the most frequent id of
the whole corpus, ties by id), so the commonest 256 ids take one byte. Four values share one control byte, two bits each:
bytes of the value less one. Decoding looks the control bytes up in a 256-row table and gathers the data bytes, all in numpy.

The container is Parquet, one row per block with the two byte strings, so that any store Spark writes to will do and its
commit protocol covers lost executors. Folder ``ranks`` holds the id of each rank; folder ``blocks`` is partitioned by range.

Defined results: a null or empty text is a document with only the end id; rows with the same or a null ``doc_id`` are
documents of their own (nulls first, ties by text); an empty table gives empty folders and no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.bpe import encoder, stretches, tokenizer_file
from ledgerlens.llm.common import stored
from ledgerlens.session import scratch_path, task_count

#: Tokens after which a block is closed; the id that ends a document; range partitions for each shuffle task.
BLOCK_TOKENS, END_ID, RANGES = 1 << 17, 0, 3

_LENGTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], dtype=np.int64)
_RAW = "part int, block long, start long, n_tokens long, doc_ids array<long>, lengths array<long>, ids binary"
_BLOCKS = "part int, block long, start long, n_tokens long, doc_ids array<long>, lengths array<long>, controls binary, data binary"
_DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(ranks, dtype="<u4")
    code = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    padded[: len(values)] = code
    four = padded.reshape(-1, 4)
    controls = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4) <= code[:, None]
    return controls.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(controls: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values behind these bytes."""
    lengths = _LENGTHS[np.frombuffer(controls, dtype=np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths)
    if n and ends[-1] != len(data):
        raise ValueError("control bytes and data bytes do not agree")
    starts = ends - lengths
    raw = np.concatenate([np.frombuffer(data, dtype=np.uint8), np.zeros(3, dtype=np.uint8)])
    values = raw[starts].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(lengths > k)
        if not more.size:
            break
        values[more] |= raw[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def _tokenise(path: str, end_id: int, block_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, start, end = TaskContext.get().partitionId(), 0, 0, np.array([end_id], dtype="<u2").tobytes()
        docs: list = []
        lengths: list[int] = []
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            ids = b"".join(held)
            columns = [[part], [block], [start], [len(ids) // 2], [docs], [lengths], [ids]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "block", "start", "n_tokens", "doc_ids", "lengths", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, to in stretches(texts):
                for key, ids in zip(keys[first:to], encoder(path).encode(texts[first:to]), strict=True):
                    docs.append(key)
                    lengths.append(len(ids) + 1)
                    held.extend((ids.tobytes(), end))
                    size += lengths[-1]
                    if size >= block_tokens:
                        yield close()
                        docs, lengths, held, block, start, size = [], [], [], block + 1, start + size, 0
        if docs:
            yield close()

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, dtype=np.int64)
    for batch in batches:
        for ids in batch.column(0):
            total += np.bincount(np.frombuffer(ids.as_buffer(), dtype="<u2"), minlength=1 << 16)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])


def _encode(rank_of: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [encode_ranks(rank_of[np.frombuffer(x.as_buffer(), dtype="<u2")]) for x in batch.column("ids")]
            keep = ["part", "block", "start", "n_tokens", "doc_ids", "lengths"]
            columns = [batch.column(c) for c in keep] + [pa.array([c[k] for c in coded], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "controls", "data"])

    return run


def _decode(id_of: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, starts, sizes, sums = [], [], [], []
            for row in range(batch.num_rows):
                start, n, keys, lengths, controls, data = (batch.column(c)[row] for c in ("start", "n_tokens", "doc_ids", "lengths", "controls", "data"))
                ids = id_of[decode_ranks(controls.as_py(), data.as_py(), n.as_py())]
                at = 0
                for key, length in zip(keys.as_py(), lengths.as_py(), strict=True):
                    docs.append(key)
                    starts.append(start.as_py() + at)
                    sizes.append(length)
                    sums.append(ids_crc32(ids[at : at + length]))
                    at += length
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (docs, starts, sizes, sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Tokenise ``doc_id, text`` and write the corpus to ``path``.

    Texts are dealt by ranges of ``doc_id`` once; each is tokenised once. Two bounded tables pass the driver: counts
    of the ids (one row per id of the vocabulary) and tokens per range (one row per range).
    """
    spark = docs.sparkSession
    file = tokenizer or tokenizer_file()
    ranges = RANGES * task_count(spark)
    dealt = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(ranges, "doc_id", F.xxhash64("text"))
    raw = stored(dealt.sortWithinPartitions("doc_id", "text").mapInArrow(_tokenise(file, end_id, block_tokens), _RAW), "tokens-raw")
    counted = raw.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    order = [r["id"] for r in sorted(counted.collect(), key=lambda r: (-r["n"], r["id"]))]
    rank_of = np.zeros(1 << 16, dtype=np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = raw.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    coded = raw.mapInArrow(_encode(rank_of), _BLOCKS).join(F.broadcast(offsets), "part")
    blocks = coded.withColumn("start", F.col("start") + F.col("before")).drop("before")
    blocks.sortWithinPartitions("part", "block").write.partitionBy("part").parquet(f"{path}/blocks")
    ranks = [(k, int(i)) for k, i in enumerate(order)]
    spark.createDataFrame(ranks, "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start``, ``n_tokens`` and the checksum of its decoded ids."""
    ranks = spark.read.schema("rank long, id long").parquet(f"{path}/ranks").collect()
    id_of = np.zeros(max(1, len(ranks)), dtype=np.uint32)
    for row in ranks:
        id_of[row["rank"]] = row["id"]
    return read_blocks(spark, path).mapInArrow(_decode(id_of), _DOCS)


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.common import table

    path = scratch_path(spark, "token-file")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path)
