"""Sum-of-squares online packing of documents into sequences.

A document's ids are cut into full windows and one remainder.  A remainder goes
to the fill level whose choice leaves the smallest sum of squared counts of
partly filled windows; ``SumOfSquares`` keeps those counts in a level array.
Ties go to the fullest level.  Packing is online and local to an input
partition: ids are made, placed and checksummed while the partition streams by,
no text or id is shuffled, and what is held is the open windows only.

At the end of a partition the open windows, whose number SS keeps small, are
poured together and cut again into full windows; what is left after them
becomes windows whose lengths are powers of two, which need no padding.

A sequence id holds the partition's number and a counter, so a retried task
gives the same ids (partitions are file splits, in file order).

Defined results: a null or blank text is the end id alone; equal rows are
packed each; nothing is packed of an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from vigilo.llm.common import ship

CAPACITY = 4096
END_ID = 2

#: (doc_id, start, ids as bytes, doc_tokens)
Piece = tuple


class SumOfSquares:
    """Windows of ``capacity`` units; ``put`` returns a window when it is full."""

    def __init__(self, capacity: int = CAPACITY):
        import numpy as np

        self.np, self.capacity = np, capacity
        self.level = np.zeros(capacity + 1, dtype=np.int64)  # partly filled windows by fill
        self.open: dict[int, list[list[Piece]]] = {}

    def choose(self, size: int) -> int:
        """The fill level (0: a new window) with the smallest sum of squares."""
        np, n, top = self.np, self.level, self.capacity - size
        cost = 2 * n[size : self.capacity + 1] + 1  # a window arrives at fill + size
        cost[top] = 0  # or is full and leaves
        here = n[: top + 1]
        cost[1:] += 1 - 2 * here[1:]  # and leaves its level
        cost[1:][here[1:] == 0] = np.iinfo(np.int64).max  # no such window
        return top - int(np.argmin(cost[::-1]))

    def put(self, size: int, piece: Piece) -> list[Piece] | None:
        at = self.choose(size)
        if at:
            window = self.open[at].pop()
            self.level[at] -= 1
        else:
            window = []
        window.append(piece)
        if at + size == self.capacity:
            return window
        self.level[at + size] += 1
        self.open.setdefault(at + size, []).append(window)
        return None

    def rest(self) -> list[Piece]:
        """The pieces of all open windows, fullest first."""
        return [p for fill in sorted(self.open, reverse=True) for w in self.open[fill] for p in w]


def cut(pieces: list[Piece], lengths: Iterator[int]) -> Iterator[list[Piece]]:
    """Windows of the given lengths out of pieces laid end to end."""
    window, room = [], next(lengths, 0)
    for doc, start, ids, n in pieces:
        while ids:
            take = ids[: 4 * room]
            window.append((doc, start, take, n))
            start, ids, room = start + len(take) // 4, ids[len(take) :], room - len(take) // 4
            if not room:
                yield window
                window, room = [], next(lengths, 0)


def tail_lengths(total: int, capacity: int) -> Iterator[int]:
    """Full windows, then powers of two, largest first."""
    for _ in range(total // capacity):
        yield capacity
    rest = total % capacity
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            yield 1 << bit


def pack(documents: Iterator[tuple], capacity: int = CAPACITY) -> Iterator[list[Piece]]:
    """Windows of (doc_id, ids as bytes) documents."""
    levels = SumOfSquares(capacity)
    for doc, ids in documents:
        n = len(ids) // 4
        full = n - n % capacity
        for at in range(0, full, capacity):
            yield [(doc, at, ids[4 * at : 4 * (at + capacity)], n)]
        if n > full:
            window = levels.put(n - full, (doc, full, ids[4 * full :], n))
            if window:
                yield window
    rest = levels.rest()
    yield from cut(rest, tail_lengths(sum(len(p[2]) for p in rest) // 4, capacity))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and
    ids) of every piece."""

    def run(batches) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from vigilo.llm.tokens import encoder

        encode = encoder(tokenizer_path)
        first = TaskContext.get().partitionId() << 40

        def documents():
            for batch in batches:
                docs = iter(batch.column(0).to_pylist())
                for offsets, ids in encode.column(batch.column(1), end_id):
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                        yield next(docs), ids[a:b].tobytes()

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        rows, held = [], 0

        def batch_of(rows):
            cols = list(zip(*rows))
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(b, dtype="<i4") for b in cols[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for number, window in enumerate(pack(documents(), capacity)):
            offset = 0
            for doc, start, ids, n in window:
                length = len(ids) // 4
                rows.append((doc, start, length, zlib.crc32(ids), n, first + number, offset) + ((ids,) if with_ids else ()))
                offset += length
                held += length
            if held > 1 << 20:
                yield batch_of(rows)
                rows, held = [], 0
        if rows:
            yield batch_of(rows)

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return ship(docs.selectExpr("cast(doc_id as bigint) doc_id", "text")).mapInArrow(run, schema + ", ids array<int>" * with_ids)
