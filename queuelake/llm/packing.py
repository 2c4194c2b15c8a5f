"""Packing documents into sequences: first-fit decreasing on a tournament tree, in randomised groups.

Texts become token ids (plus one end id). A document longer than a sequence is cut at multiples of the sequence
length; the full pieces are sequences of their own and the rest is packed. Documents are dealt into groups by a hash
of their id and content; each group is packed by itself, so groups need nothing from each other. Within a group the
rests go, largest first, to the first open sequence with room, found in a tournament tree whose nodes hold the
largest room below them.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm import textbytes
from queuelake.session import prepare

SEQUENCE = 1024
#: Documents in a group on average; the group's rows are all that one task holds.
GROUP_DOCS = 8192
_PIECE = "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, spread bigint"


class Encoder:
    """Ids of the byte-level vocabulary, equal to those of library `tokenizers`, computed from its rank file.

    The rank file lists the same vocabulary. `tokenizers` spends about three times the CPU on the same ids
    (tests compare both); its special token is recognised in texts here as there.
    """

    def __init__(self, name: str = "byte_bpe_50k") -> None:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as ranks:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks)}
        self._encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={"<|endoftext|>": len(table)})

    def ids(self, text: str) -> np.ndarray:
        return np.array(self._encoding.encode(text, allowed_special="all"), "<u4")


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """One encoder per Python worker."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


def _cut(tokenizer: str, length: int, end_id: int, keep_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for rows, _, _ in textbytes.slices(batches, 1 << 20):
            out: list[list] = [[], [], [], [], [], [], []]
            for doc, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                raw = np.append(encode.ids(text or ""), np.uint32(end_id)).astype("<u4").tobytes()
                total = len(raw) // 4
                spread = zlib.crc32(raw, zlib.crc32(str(doc).encode()))
                for start in range(0, total, length):
                    piece = raw[4 * start : 4 * (start + length)]
                    for column, value in zip(out, (doc, start, len(piece) // 4, piece if keep_ids else None, zlib.crc32(piece), total, spread), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "spread"])

    return run


class Rooms:
    """Tournament tree over open sequences: leaves hold the room left, inner nodes the larger of two."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.leaves, self.used = capacity, 1, 0
        self.tree = [0, 0]

    def _open(self) -> int:
        if self.used == self.leaves:
            rooms = self.tree[self.leaves :] + [0] * self.leaves
            self.leaves *= 2
            self.tree = [0] * self.leaves + rooms
            for node in range(self.leaves - 1, 0, -1):
                self.tree[node] = max(self.tree[2 * node], self.tree[2 * node + 1])
        self.used += 1
        self._set(self.used - 1, self.capacity)
        return self.used - 1

    def _set(self, leaf: int, room: int) -> None:
        node = self.leaves + leaf
        self.tree[node] = room
        while node > 1:
            node >>= 1
            self.tree[node] = max(self.tree[2 * node], self.tree[2 * node + 1])

    def place(self, size: int) -> tuple[int, int]:
        """The first sequence with room for `size`, a new one if there is none, and the offset in it."""
        node = 1
        if self.tree[1] < size:
            leaf = self._open()
        else:
            while node < self.leaves:
                node *= 2
                if self.tree[node] < size:
                    node += 1
            leaf = node - self.leaves
        room = self.tree[self.leaves + leaf]
        self._set(leaf, room - size)
        return leaf, self.capacity - room


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for each length; ties in the order given."""
    rooms = Rooms(capacity)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        sequence[i], offset[i] = rooms.place(int(lengths[i]))
    return sequence, offset


def pack(pieces: DataFrame, groups: int, capacity: int = SEQUENCE) -> DataFrame:
    """Add sequence_id and offset to rows with doc_id, start, length and `spread` (any hash of the document)."""
    schema = pieces.schema

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        frame = table.select(["doc_id", "start", "length"]).to_pandas()
        # The order of arrival is not repeatable; that of the sorted rows is.
        order = frame.assign(crc=table.column("ids_crc32").to_pandas()).sort_values(["length", "doc_id", "start", "crc"], ascending=[False, True, True, True], kind="stable").index.to_numpy()
        table = table.take(pa.array(order))
        sequence, offset = first_fit_decreasing(table.column("length").to_numpy(), capacity)
        return table.drop_columns(["packing_group"]).append_column("sequence_id", pa.array((group << 40) + sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    named = pieces.withColumn("packing_group", F.pmod(F.xxhash64(F.lit(17), "spread"), F.lit(groups)).cast("bigint"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return named.groupBy("packing_group").applyInArrow(run, f"{out}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k", capacity: int = SEQUENCE, end_id: int = 0, group_docs: int = GROUP_DOCS, keep_ids: bool = True) -> DataFrame:
    """Every token of every document in exactly one piece, every piece in one sequence of at most `capacity`.

    Columns: doc_id, start (tokens of the document before the piece), length, ids (little-endian unsigned 32-bit;
    null without keep_ids), ids_crc32, doc_tokens (with the end id), sequence_id, offset (gapless from 0).
    Null and empty texts are one end id. Rows with equal ids are packed as separate documents. No rows give no rows;
    other columns are not read.
    """
    prepare(docs.sparkSession)
    groups = max(1, -(-docs.count() // group_docs))
    pieces = docs.select("doc_id", "text").mapInArrow(_cut(tokenizer, capacity, end_id, keep_ids), _PIECE)
    return pack(pieces if keep_ids else pieces.drop("ids"), groups, capacity).drop("spread")
