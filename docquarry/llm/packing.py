"""Packing token sequences by bounded-space online best fit.

Pieces arrive one by one. A fixed number of bins is open; the bins are found by
a bitset keyed by free space, whose lowest set bit at or above a piece's length
is the best fit. When a new bin would be one too many, the fullest closes first.

Documents are tokenised once, in place; only (doc_id, piece, start, length,
checksum) is written to the shared folder, counted, and dealt by a hash to
packers of about ``per_packer`` pieces. What a packer holds is bounded by its
open bins, and the space that its last bins leave is amortised over its pieces.
Pieces are put in an order that the written table fixes, so a packer that runs
again after a lost executor gives the same sequences; rows that are the same in
everything are dealt to packers like any others.

Cases: a null or empty text is the end-of-text id alone; a null doc_id is
passed on; repeated rows are packed each; an empty table gives an empty result;
a text of any length is cut into pieces of the full capacity, the first of
which may be shorter; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.llm import common

CAPACITY = 1024
END_ID = 2
OPEN_BINS = 4096
PER_PACKER = 60_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Bins of ``capacity``, at most ``most_open`` open; ``put`` gives (bin, offset)."""

    def __init__(self, capacity: int, most_open: int = OPEN_BINS):
        self.capacity, self.most_open = capacity, most_open
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def take(self, free: int) -> int:
        found = self.by_free[free]
        at = found.pop()
        if not found:
            self.bits &= ~(1 << free)
        return at

    def put(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = self.take(free)
        else:
            if self.open == self.most_open:
                self.take((self.bits & -self.bits).bit_length() - 1)  # the least free space: the fullest bin
                self.open -= 1
            at, free = self.made, self.capacity
            self.made += 1
            self.open += 1
        left = free - length
        if left:
            self.by_free[left].append(at)
            self.bits |= 1 << left
        else:
            self.open -= 1
        return at, self.capacity - free


class Ids:
    """Token ids of whole texts, as the vocabulary's library gives them by default: a special token's string is its id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.fast = None
        if path.endswith("byte_bpe_50k.json"):  # the same vocabulary as ranks, by a faster library
            import base64

            import tiktoken

            with open(path.removesuffix("json") + "tiktoken", "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not HARD.search(text):
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")


#: Very long runs, on which the fast library's pattern matcher could run out of stack.
HARD = re.compile(r"\s{5000}|\S{50000}")
_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece of each document: its place in the document's ids, its length and its ids' CRC-32."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode, end = ids_of(vocabulary), np.array([end_id], dtype="<u4")
        cols: tuple[list, ...] = ([], [], [], [], [])
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = np.concatenate([encode(text), end])
            first = len(ids) % capacity or capacity
            raw = ids.tobytes()
            for k, at in enumerate([0, *range(first, len(ids), capacity)]):
                stop = first if k == 0 else at + capacity
                for col, x in zip(cols, (doc, k, at, stop - at, zlib.crc32(raw[4 * at : 4 * stop])), strict=True):
                    col.append(x)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return common.map_batches(common.text_columns(docs), cut, PIECES)


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, open_bins: int = OPEN_BINS, per_packer: int = PER_PACKER) -> DataFrame:
    """``pieces`` with the sequence each lies in and its offset there."""
    # the number tells rows apart that are the same in everything; it is fixed once the table is written
    cut = scratch.materialize(pieces(docs, vocabulary, capacity, end_id).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    packers = max(1, -(-cut.count() // per_packer))
    scratch.ship(docs.sparkSession)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            at = [bins.put(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([base + x[0] for x in at], pa.int64()), pa.array([x[1] for x in at], pa.int64())], [*batch.schema.names[:5], "sequence_id", "offset"])

    order = F.xxhash64("doc_id", "piece", "ids_crc32", "_row")
    dealt = cut.withColumn("_order", order).repartition(packers, F.col("_order")).sortWithinPartitions("_order", "_row")
    return dealt.drop("_order", "_row").mapInArrow(place, PIECES + ", sequence_id long, offset long")
