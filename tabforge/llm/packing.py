"""Bounded-space online packing of documents into training sequences.

One pass: each partition tokenizes its documents and keeps at most ``windows``
open sequences. A document is cut at full sequences; what is left of it goes
whole into the open window it fits best. If none fits, the fullest window is
emitted and a new one opened. At the end of the partition the open windows
are leftovers; these, and only these, carry their ids on. Leftovers of
``MERGE`` partitions meet in one task of bounded size, which joins them end to end,
cuts them at full sequences, and cuts the last one at powers of two, so that it
needs no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import materialize, text_or_empty
from .tokens import word_tokens

#: Partitions whose leftovers one task merges: at most MERGE * windows sequences.
MERGE = 64
#: Texts that are tokenized at a time.
SLICE = 256

_LONGS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]


class _Rows:
    """Pieces of closed sequences, column by column."""

    def __init__(self, id_type: pa.DataType):
        self.id_type, self.columns = id_type, [[] for _ in range(10)]

    def close(self, sequence: int, pieces: list, used: int, open_part: int | None = None) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            row = (doc_id, start, n, zlib.crc32(ids), total, sequence, at, used, ids if open_part is not None else None, open_part)
            for c, v in zip(self.columns, row):
                c.append(v)
            at += n

    def __len__(self) -> int:
        return len(self.columns[0])

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, schema)], schema=schema)
        self.columns = [[] for _ in range(10)]
        return out


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("doc_id", id_type), *((c, pa.int64()) for c in _LONGS), ("ids", pa.binary()), ("open_part", pa.int64())])


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 1,
         windows: int = 64) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens.

    ``tokenizer`` is the path of a tokenizers file that exists on every machine.
    Each document ends with ``end_id``. A sequence whose sequence_tokens is not
    ``size`` is to be padded to it, unless it is a power of two.

    Defined cases: null and empty texts are the end id alone; repeated rows and
    ids (null ones too) are packed one by one; long texts are cut at full
    sequences. An empty table gives an empty result. Other columns are ignored.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    end = end_id.to_bytes(4, "little")
    full = 4 * size
    schema = StructType([narrow.schema["doc_id"], *(StructField(c, LongType()) for c in _LONGS),
                         StructField("ids", BinaryType()), StructField("open_part", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = word_tokens(tokenizer)
        number = part << 32
        window: dict[int, list] = {}  # name: pieces
        room: list[tuple[int, int]] = []  # (free ids, name), ascending
        rows = form = None
        for b in batches:
            if rows is None:
                form = _arrow_schema(b.schema.field(0).type)
                rows = _Rows(form.field(0).type)
            for k in range(0, len(b), SLICE):
                names, texts = (c.slice(k, SLICE).to_pylist() for c in b.columns)
                for doc_id, ids in zip(names, encoder.ids(texts)):
                    ids += end
                    total, cut = len(ids) // 4, len(ids) // full * full
                    for s in range(0, cut, full):
                        rows.close(number, [(doc_id, s // 4, ids[s:s + full], total)], size)
                        number += 1
                    rest = ids[cut:]
                    if not rest:
                        continue
                    need = len(rest) // 4
                    at = bisect_left(room, (need, -1))
                    if at == len(room):
                        if len(room) == windows:
                            free, name = room.pop(0)
                            rows.close(name, window.pop(name), size - free)
                        free, name = size, number
                        number += 1
                        window[name] = []
                    else:
                        free, name = room.pop(at)
                    window[name].append((doc_id, cut // 4, rest, total))
                    if free == need:
                        rows.close(name, window.pop(name), size)
                    else:
                        insort(room, (free - need, name))
            if len(rows):
                yield rows.batch(form)
        if rows is not None:
            for free, name in room:
                rows.close(name, window[name], size - free, part)
            if len(rows):
                yield rows.batch(form)

    packed = materialize(narrow.mapInArrow(run, schema), "packing")

    def merge(table: pa.Table) -> pa.Table:
        order = sorted(range(len(table)), key=lambda i: (table["sequence_id"][i].as_py(), table["offset"][i].as_py()))
        doc, start, ids, total = (table[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))
        form = _arrow_schema(table.schema.field("doc_id").type)
        rows, number = _Rows(form.field(0).type), (1 << 62) + (table["open_part"][0].as_py() // MERGE << 32)
        left = sum(len(x) for x in ids) // 4
        goal = lambda: size if left >= size else 1 << left.bit_length() - 1
        now, free = [], goal()
        for i in order:
            s = 0
            while s < len(ids[i]):
                piece = ids[i][s:s + 4 * free]
                now.append((doc[i], start[i] + s // 4, piece, total[i]))
                s += len(piece)
                free -= len(piece) // 4
                left -= len(piece) // 4
                if not free:
                    rows.close(number, now, sum(len(p[2]) for p in now) // 4)
                    number, now, free = number + 1, [], left and goal()
        return pa.Table.from_batches([rows.batch(form)])

    merged = (packed.where(F.col("open_part").isNotNull())
              .groupBy(F.floor(F.col("open_part") / MERGE).alias("__merge")).applyInArrow(merge, schema))
    return packed.where(F.col("open_part").isNull()).unionByName(merged).drop("ids", "open_part")
