"""Training-order materialisation: a keyed Feistel permutation deals sequences to slots, written as fixed-stride shards.

1. Whole texts are tokenized; each partition joins its documents (each with an
   end id) to one stream and cuts it into sequences of ``size`` ids, the last one padded.
   Sequences are numbered across partitions by a running sum over the partitions' counts.
2. The slot of sequence i of n is a Feistel network's image of i over the next even number
   of bits, walked along its cycle until it falls below n. That is a permutation of 0 .. n-1 for any key,
   computed for each row on its own, and can be undone.
3. Slots are dealt to shards by range, sorted, and written as binary files
   by Spark's own writer: each record is the ids (16 or 32 bits, little-endian) and a fixed mark, so record r
   of shard s lies at byte r * stride and holds slot s * per_shard + r. A reader at slot t needs no index to go on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .common import materialize, scratch_path, text_or_empty

ROUNDS = 6
#: Ends each record, and lets a reader check that it stands at a border.
MARK = b"\x1e\n"
#: Texts that are tokenized at a time.
SLICE = 256


class RankTokens:
    """Ids of a tiktoken rank file by the public pattern."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_ordinary(text.encode("utf-8", "replace").decode()), np.uint32)


_LOADED: dict[str, RankTokens] = {}


# --- permutation ---------------------------------------------------------------

def _round_keys(key: str, rounds: int = ROUNDS) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:4], "little") for r in range(rounds)]


def half_bits(n: int) -> int:
    """Bits of each half of the network's block: the least block that holds n numbers."""
    return max(1, -(-max(1, n - 1).bit_length() // 2))


def _mix(x, k: int):
    """Round function: 32-bit multiplications and shifts."""
    x = (x ^ np.uint64(k)) * np.uint64(0x85EBCA6B) & np.uint64(0xFFFFFFFF)
    x = (x ^ (x >> np.uint64(15))) * np.uint64(0xC2B2AE35) & np.uint64(0xFFFFFFFF)
    return x ^ (x >> np.uint64(13))


def permute(i: np.ndarray, n: int, key: str, back: bool = False) -> np.ndarray:
    """Slots of the numbers ``i`` below n (or, with ``back``, the numbers of the slots)."""
    bits = np.uint64(half_bits(n))
    low = np.uint64((1 << int(bits)) - 1)
    keys = _round_keys(key)
    out = np.asarray(i, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        a, b = out[todo] >> bits, out[todo] & low
        for k in reversed(keys) if back else keys:
            a, b = (b ^ (_mix(a, k) & low), a) if back else (b, a ^ (_mix(b, k) & low))
        out[todo] = (a << bits) | b
        todo = todo[out[todo] >= n]  # outside: one more step along the cycle
    return out.astype(np.int64)


# --- sequences and shards --------------------------------------------------------

def sequences(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 50256,
              width: int = 2) -> DataFrame:
    """(part, nth, n_tokens, doc_ids, ids): the sequences of each partition's stream; ids is padded with ``end_id``."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    kind = f"<u{width}"
    schema = StructType([StructField("part", IntegerType()), StructField("nth", LongType()), StructField("n_tokens", IntegerType()),
                         StructField("doc_ids", ArrayType(narrow.schema["doc_id"].dataType)), StructField("ids", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _LOADED:
            _LOADED[tokenizer] = RankTokens(tokenizer)
        encoder, part, nth = _LOADED[tokenizer], TaskContext.get().partitionId(), 0
        held, docs_held, n_held, id_type = [], [], 0, None

        def out(rows: list) -> pa.RecordBatch:
            form = [pa.int32(), pa.int64(), pa.int32(), pa.list_(id_type), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), form)], schema.names)

        for b in batches:
            id_type = b.schema.field(0).type
            for k in range(0, len(b), SLICE):
                rows = []
                for doc_id, t in zip(*(c.slice(k, SLICE) for c in b.columns)):
                    ids = np.append(encoder.ids(t.as_py()), np.uint32(end_id)).astype(kind)
                    while len(ids):
                        piece, ids = ids[:size - n_held], ids[size - n_held:]
                        held.append(piece)
                        docs_held.append(doc_id.as_py())
                        n_held += len(piece)
                        if n_held == size:
                            rows.append((part, nth, size, docs_held, np.concatenate(held).tobytes()))
                            nth, held, docs_held, n_held = nth + 1, [], [], 0
                if rows:
                    yield out(rows)
        if n_held:
            full = np.concatenate([*held, np.full(size - n_held, end_id, kind)])
            yield out([(part, nth, n_held, docs_held, full.tobytes())])

    return narrow.mapInArrow(run, schema)


def slot_column(number: Column, n: int, key: str) -> Column:
    """The slot of a sequence number, as a vectorised function of the row alone."""
    @F.pandas_udf(LongType())
    def slot(i: pd.Series) -> pd.Series:
        return pd.Series(permute(i.to_numpy(), n, key))

    return slot(number)


@F.pandas_udf(BinaryType())
def packed(ids: pd.Series) -> pd.Series:
    return ids.map(zstandard.ZstdCompressor(level=3).compress)


@F.pandas_udf(BinaryType())
def unpacked(ids: pd.Series) -> pd.Series:
    return ids.map(zstandard.ZstdDecompressor().decompress)


def write_shards(docs: DataFrame, path: str, tokenizer: str, key: str = "epoch-0", id_col: str = "doc_id", text_col: str = "text",
                 size: int = 2048, per_shard: int = 4096, end_id: int = 50256, width: int = 2) -> DataFrame:
    """Writes the shards to ``path``/shards and the manifest to ``path``/manifest; returns the manifest.

    Manifest, a row for each sequence: slot, shard, byte_offset, n_tokens (others are padding), doc_ids (of its
    pieces in order) and ids_crc32 of its bytes.

    Defined cases: null and empty texts are an end id alone; repeated rows and null ids are taken one by one;
    long texts run over as many sequences as they need. An empty table gives an empty manifest. Other columns are ignored.
    """
    # ids are stored, dealt out and written, so the first two are packed better than by the session's defaults
    at = scratch_path(docs.sparkSession, "order-sequences")
    (sequences(docs, tokenizer, id_col, text_col, size, end_id, width).write.option("compression", "zstd")
     .option("parquet.compression.codec.zstd.level", "9").option("parquet.page.size", str(4 << 20)).parquet(at))
    staged = docs.sparkSession.read.parquet(at)
    counts = staged.groupBy("part").agg(F.count("*").alias("n"))
    first = materialize(counts.withColumn("first", F.sum("n").over(Window.orderBy("part")) - F.col("n")), "order-counts")
    n = first.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-n // per_shard))
    dealt = staged.join(F.broadcast(first.select("part", "first")), "part")  # a row for each partition
    dealt = dealt.withColumn("slot", slot_column(F.col("first") + F.col("nth"), n, key)).withColumn("shard", F.floor(F.col("slot") / per_shard))
    stride = size * width + len(MARK)
    dealt.select("slot", "shard", ((F.col("slot") % per_shard) * stride).alias("byte_offset"), "n_tokens", "doc_ids",
                 F.crc32("ids").alias("ids_crc32")).write.parquet(f"{path}/manifest")
    records = dealt.select("slot", "shard", packed("ids").alias("packed")).repartitionByRange(shards, "shard")
    records = records.select("slot", "shard", unpacked("packed").cast("string").alias("value"))
    (records.sortWithinPartitions("shard", "slot").select("value", "shard")
     .write.partitionBy("shard").option("lineSep", MARK.decode("latin-1")).text(f"{path}/shards"))
    return docs.sparkSession.read.parquet(f"{path}/manifest")


def read_slots(spark: SparkSession, path: str, start: int, count: int, size: int = 2048, per_shard: int = 4096, width: int = 2) -> DataFrame:
    """(slot, ids) of ``count`` slots from ``start`` on: opens only their shards and reads at fixed strides."""
    stride, last = size * width + len(MARK), start + count - 1
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards")
             .where(F.col("shard").between(start // per_shard, last // per_shard)))
    own = F.sequence(F.greatest(F.col("shard") * per_shard, F.lit(start)),
                     F.least((F.col("shard") + 1) * per_shard - 1, F.lit(last), F.col("shard") * per_shard + F.floor(F.col("length") / stride) - 1))
    rows = files.where(F.floor(F.col("length") / stride) + F.col("shard") * per_shard > start).select("content", F.explode(own).alias("slot"))
    return rows.select("slot", F.substring("content", ((F.col("slot") % per_shard) * stride + 1).cast("int"), F.lit(size * width)).alias("ids"))
