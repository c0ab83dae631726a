"""Best-two-fit packing of tokenised documents into sequences.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt into
groups of about ``group_rows`` and each group is packed on its own, which
costs at most a sequence or so per group: fill a sequence greedily, largest
fitting piece first, then replace its smallest piece by two unpacked ones
that fill the widened gap more tightly.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import land, map_batches, utf8
from tillroll.llm.tokens import word_tokens

CAPACITY, END_ID, GROUP_ROWS = 4096, 1, 50_000


def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) per piece of each row.

    A document is its text's ids and then ``end_id``; only one longer than
    ``capacity`` is cut. A null or empty text has the one id ``end_id``.
    """
    end = np.array([end_id], np.uint32)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(tokenizer)
        texts = utf8(batch.column("text"))
        row, piece, start, length, crc, kept = [], [], [], [], [], []
        for k, found in enumerate(encoder.encode(texts)):
            ids = np.concatenate([found, end]).astype("<u4")
            for p, s in enumerate(range(0, len(ids), capacity)):
                own = ids[s:s + capacity]
                row.append(k)
                piece.append(p)
                start.append(s)
                length.append(len(own))
                crc.append(zlib.crc32(own.tobytes()))
                if keep_ids:
                    kept.append(own.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
             pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
             *([pa.array(kept, pa.list_(pa.int32()))] if keep_ids else [])],
            ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
                       + ", ids array<int>" * keep_ids)


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; every length is between 1 and capacity."""
    order = np.argsort(lengths, kind="stable")
    sizes, first = np.unique(lengths[order], return_index=True)
    waiting = {int(n): list(part) for n, part in zip(sizes, np.split(order, first[1:]))}
    left = [int(n) for n in sizes]  # lengths that still have pieces, ascending
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)

    def take(n: int) -> tuple[int, int]:
        own = waiting[n]
        piece = own.pop()
        if not own:
            del left[bisect_right(left, n) - 1]
        return n, piece

    def give(n: int, piece: int) -> None:
        if not waiting[n]:
            left.insert(bisect_right(left, n), n)
        waiting[n].append(piece)

    number = 0
    while left:
        bin_ = [take(left[-1])]
        gap = capacity - bin_[0][0]
        while gap and (k := bisect_right(left, gap)):
            bin_.append(take(left[k - 1]))
            gap -= bin_[-1][0]
        if gap and left and len(bin_) > 1:
            small = bin_[-1][0]  # pieces come in falling order
            room = gap + small
            have = np.array(left[:bisect_right(left, room)])
            if len(have):
                best = np.searchsorted(have, room - have, side="right") - 1
                pair = np.where(best >= 0, have + have[best], 0)
                single = np.array([len(waiting[int(n)]) < 2 for n in have]) & (best == np.arange(len(have)))
                for i in np.flatnonzero(single):  # a length with one piece can't be taken twice
                    pair[i] = have[i] + have[i - 1] if i else 0
                i = int(np.argmax(pair))
                if pair[i] > small:
                    a = int(have[i])
                    give(*bin_.pop())
                    bin_ += [take(a), take(int(pair[i]) - a)]
        at = 0
        for n, piece in bin_:
            sequence[piece], offset[piece] = number, at
            at += n
        number += 1
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (with a column length) and sequence_id, offset.

    No piece is longer than ``capacity``; each row, repeated or not, is one
    piece. The groups are dealt by row, so no key's rows meet in one.
    """
    landed = land(pieces, "pieces")
    groups = max(1, -(-landed.count() // group_rows))
    dealt = landed.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    names = list(pieces.columns)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = best_two_fit(rows["length"].to_numpy(np.int64), capacity)
        return rows[names].assign(sequence_id=(int(rows["_group"].iloc[0]) << 32) + sequence, offset=offset)

    return dealt.groupBy("_group").applyInPandas(run, f"{kind}, sequence_id long, offset long")
