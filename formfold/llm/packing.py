"""Sum-of-squares online packing.

Documents become token ids plus an end id, cut into full windows and a remainder.  A full
window is a sequence of its own.  Remainders are placed one by one: an array counts the
partly filled windows of each fill level, and a piece goes to the level (or a new window)
for which the sum of the squared counts becomes least, of equal ones to the fullest.  A
piece's place is final, so rows leave at once and a task keeps only its open windows.

Each task packs the documents it reads, without a shuffle; what it leaves open at its end is
all the padding there is.  Sequence numbers are the task's number times 2^32 plus a counter.
Null texts are empty: such a document is one piece with the end id alone.  Repeated rows are
packed once each, an empty table gives no rows, and columns other than doc_id and text are
not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.llm.tokens import encoder, slices

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


class Packer:
    """place(size) gives (window number, offset) of a piece."""

    def __init__(self, window: int):
        self.window, self.made = window, 0
        self.level = np.zeros(window + 1, np.int64)  # open windows by fill; level 0 stands for a new one
        self.open: list[list[int]] = [[] for _ in range(window)]

    def place(self, size: int) -> tuple[int, int]:
        if size == self.window:
            self.made += 1
            return self.made - 1, 0
        most = self.window - size
        change = 2 * self.level[size:self.window + 1] + 1  # by the level the piece comes from
        change[most] = 0  # a full window is closed
        change[1:] += 1 - 2 * self.level[1:most + 1]
        change[1:][self.level[1:most + 1] == 0] = np.iinfo(np.int64).max
        fill = most - int(change[::-1].argmin())
        if fill:
            number = self.open[fill].pop()
            self.level[fill] -= 1
        else:
            number, self.made = self.made, self.made + 1
        if fill + size < self.window:
            self.open[fill + size].append(number)
            self.level[fill + size] += 1
        return number, fill


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 1024, end: int = 0,
                   remembered: int = 1_600_000) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id
    and offset of every piece.  remembered: pieces of text whose ids a worker keeps."""

    def pack(batches):
        encode, packer = encoder(tokenizer, remembered), Packer(window)
        base = TaskContext.get().partitionId() << 32
        last = np.array([end], "<u4").tobytes()
        for b in batches:
            names, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for first, some in slices(texts):
                out: list[list] = [[] for _ in PIECES]
                for name, ids in zip(names[first:first + len(some)], encode.encode(some)):
                    ids += last
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        size = min(window, n - start)
                        number, offset = packer.place(size)
                        for column, value in zip(out, (name, start, size, ids[4 * start:4 * (start + size)], n,
                                                       base + number, offset)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, PIECES.types)], schema=PIECES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pack, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
