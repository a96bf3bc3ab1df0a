"""Packing token ids into sequences of one length by multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.llm.word_ids import word_ids

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp differencing: items dealt to windows with nearly equal sums.

    Every item begins as a partial partition that fills one window. The two
    partial partitions with the largest spread are merged, the fullest window of
    one with the emptiest of the other, until one partition is left.
    """
    order = 0
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size, order, [size] + [0] * (windows - 1), [[i]] + [[] for _ in range(windows - 1)]))
        order += 1
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, sums_a, items_a = heapq.heappop(heap)
        _, _, sums_b, items_b = heapq.heappop(heap)
        sums = [a + b for a, b in zip(sums_a, reversed(sums_b))]
        items = [a + b for a, b in zip(items_a, reversed(items_b))]
        by = sorted(range(windows), key=sums.__getitem__, reverse=True)
        sums = [sums[k] for k in by]
        heapq.heappush(heap, (sums[-1] - sums[0], order, sums, [items[k] for k in by]))
        order += 1
    return heap[0][3] if heap else []


def fill(sizes: list[int], capacity: int, finest: int) -> list[list[tuple[int, int, int]]]:
    """Windows of at most that capacity, each a list of (item, from, to).

    The number of windows begins at what the sum needs. If a window exceeds the capacity,
    items over ``finest`` are halved, three times at most, as smaller ones deal out more evenly;
    from then on the number of windows rises until none does.
    """
    windows = max(1, -(-sum(sizes) // capacity))
    parts = [(i, 0, size) for i, size in enumerate(sizes)]
    halvings = 0
    while True:
        dealt = [w for w in difference([z - a for _, a, z in parts], windows) if w]
        if all(sum(parts[p][2] - parts[p][1] for p in w) <= capacity for w in dealt):
            return [[parts[p] for p in w] for w in dealt]
        if halvings == 3:
            windows += 1
        else:
            halvings += 1
            parts = [h for i, a, z in parts for h in (((i, a, (a + z) // 2), (i, (a + z) // 2, z)) if z - a > finest else ((i, a, z),))]


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    tokenizer: str | None = None,
    end_id: int = 1,
    piece: int = 1024,
    windows: int = 16,
    finest: int = 64,
) -> DataFrame:
    """Cut the ids of every text into pieces and pack these into sequences.

    Returns one row per piece: doc_id, start, length, ids (unsigned 32-bit, little
    endian), doc_tokens, sequence_id, offset. A text's ids end with ``end_id``. Whole
    runs of ``capacity`` ids become sequences of their own; the rest of a text is cut
    into equal pieces of at most ``piece`` ids, and the pieces of a block (as many as
    fill ``windows`` sequences; the last is cut to fit) are dealt to sequences by
    :func:`fill`. Blocks follow one another within an input partition, so nothing is shuffled, memory is bounded by
    a block and the longest text, and a task run again gives the same pieces.

    A null text counts as empty (one piece with the end id); a null doc_id stays null;
    repeated rows are packed as often as they occur; an empty table gives no rows; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of = word_ids(tokenizer)
        base = TaskContext.get().partitionId() << 33
        number = 0
        block: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        size = 0
        # a small reserve lets the sums meet the capacity without another window
        room = windows * capacity - windows * capacity // 256
        out: list[tuple] = []

        def packed() -> None:
            nonlocal number, size
            for members in fill([len(p[2]) for p in block], capacity, finest):
                at = 0
                for i, a, z in members:
                    d, start, ids, total = block[i]
                    out.append((d, start + a, z - a, ids[a:z].tobytes(), total, base + number, at))
                    at += z - a
                number += 1
            block.clear()
            size = 0

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            made = pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=[c.split()[0] for c in SCHEMA.split(", ")])
            out.clear()
            return made

        for given in batches:
            texts = (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in given.column(1))
            for d, found in zip(given.column(0), ids_of.texts(texts)):
                ids = np.append(found, np.uint16(end_id)).astype("<u4")
                total, key = len(ids), d.as_py()
                whole = total // capacity * capacity
                for start in range(0, whole, capacity):
                    out.append((key, start, capacity, ids[start : start + capacity].tobytes(), total, base + number, 0))
                    number += 1
                if rest := total - whole:
                    parts = -(-rest // piece)
                    cuts = [whole + rest * k // parts for k in range(parts + 1)]
                    for a, z in zip(cuts, cuts[1:]):
                        if size + z - a > room:  # the block is filled up
                            m = a + room - size if room - size >= finest else a
                            if m > a:
                                block.append((key, a, ids[a:m], total))
                            packed()
                            a = m
                        block.append((key, a, ids[a:z], total))
                        size += z - a
                if len(out) >= 2000:
                    yield batch()
        if block:
            packed()
        if out:
            yield batch()

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return picked.mapInArrow(run, SCHEMA)


def query(spark, sf_dir):
    """All documents packed; ids given by their checksum."""
    from graticule.llm.common import table

    packed = pack(table(spark, sf_dir, "documents"))
    return digest(packed)


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
