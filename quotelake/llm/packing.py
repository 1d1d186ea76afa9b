"""Best-fit packing of token sequences with a bounded number of open bins.

Pieces arrive one by one. Each goes to the open bin with the least free space that still
takes it, found in a bit set keyed by free space: shift away the bins that are too
full, take the lowest bit left. A full bin closes. Where no open bin takes a piece and the fixed number of
bins is open, the fullest closes first.

Packing follows the order of its input, by file and row. Consecutive documents form blocks of a bounded
number of tokens and pieces, packed independently and in order, and the sequence ids of a block are above
those of the blocks before it. A block ends with a bounded number of open bins, a small share of its bins.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.llm.common import stored, text_of
from quotelake.llm.subwords import WordEncoder, tokenizer_path

WIDTH = 2048
OPEN_BINS = 1024

#: Tokens and pieces of a block, about: its rows are in one task's memory.
BLOCK_TOKENS = 1 << 24
BLOCK_PIECES = 200_000

#: Consecutive rows of a file that stay in one block.
STRETCH = 64

COLUMNS = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES = f"file string, row long, {COLUMNS}"
PACKED = f"{COLUMNS}, sequence_id long, offset long"


class BestFit:
    """Online best fit; ``place`` returns the bin and the offset of a piece."""

    def __init__(self, width: int = WIDTH, open_bins: int = OPEN_BINS):
        self.width, self.most = width, open_bins
        self.by_free: list[deque[int]] = [deque() for _ in range(width + 1)]
        self.bits = 0  # bit f: a bin with f free places is open
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.popleft()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def _put(self, number: int, free: int) -> None:
        if free:
            if not self.by_free[free]:
                self.bits |= 1 << free
            self.by_free[free].append(number)
            self.open += 1

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            number, free = self.made, self.width
            self.made += 1
        self._put(number, free - length)
        return number, self.width - free


def in_order(docs: DataFrame) -> DataFrame:
    """file, row, doc_id, text: a row's place in its file, or in its partition where it comes from no file."""
    own = [F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")]
    try:
        return docs.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), *own)
    except AnalysisException:
        at = docs.select(F.monotonically_increasing_id().alias("at"), *own)
        part = F.concat(F.lit("part-"), F.shiftright("at", 33).cast("string"))
        return at.select(part.alias("file"), F.col("at").bitwiseAND((1 << 33) - 1).alias("row"), "doc_id", "text")


def token_pieces(docs: DataFrame, width: int = WIDTH, path: str | None = None) -> DataFrame:
    """Pieces of at most ``width`` tokens: file, row, doc_id, piece, start, length, ids_crc32.

    A document is its subword ids and then id 0; a null text is empty, so has the one id 0.
    """
    path = path or tokenizer_path()

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for file, row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encoder.ids(text) + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * width)):
                    own = ids[at : at + 4 * width]
                    rows.append((file, row, doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            yield _batch(rows)

    return in_order(docs).mapInArrow(pieces, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        names=["file", "row", "doc_id", "piece", "start", "length", "ids_crc32"],
    )


def _file_order(path: str) -> tuple[str, int, str]:
    """Folder, then number of the part (which may have more digits than its padding), then name."""
    folder, _, name = path.rpartition("/")
    number = re.match(r"part-(\d+)", name)
    return folder, int(number[1]) if number else -1, name


def block_cuts(pieces: DataFrame) -> DataFrame:
    """file, stretch, number (of the file in the order), block of every stretch of rows.

    A piece costs its share of a block's tokens and of its pieces, so a block is within both bounds but for
    its last stretch. The driver holds one number per file."""
    # whole numbers: the same sums in any order
    cost = F.sum(F.col("length") * BLOCK_PIECES + BLOCK_TOKENS)
    sizes = stored(
        pieces.groupBy("file", F.floor(F.col("row") / STRETCH).alias("stretch")).agg(cost.alias("cost")), "stretches"
    )
    totals = {r.file: r.cost for r in sizes.groupBy("file").agg(F.sum("cost").alias("cost")).collect()}
    begins, rows = 0, []
    for number, file in enumerate(sorted(totals, key=_file_order)):
        rows.append((file, number, begins))
        begins += totals[file]
    files = pieces.sparkSession.createDataFrame(rows, "file string, number long, begins long")
    before = Window.partitionBy("file").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("begins") + F.coalesce("within", F.lit(0))
    return sizes.withColumn("within", F.sum("cost").over(before)).join(F.broadcast(files), "file").select(
        "file", "stretch", "number", F.floor(reached / (BLOCK_TOKENS * BLOCK_PIECES)).alias("block")
    )


def pack(pieces: DataFrame, width: int = WIDTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """Sequence and offset of every piece (columns of ``PIECES``), in their order. Repeated rows and null ids are
    packed like any others; an empty table gives an empty result."""

    def packed(block: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        block = block.sort_by([("number", "ascending"), ("row", "ascending"), ("piece", "ascending")])
        fit = BestFit(width, open_bins)
        places = [fit.place(n) for n in block.column("length").to_pylist()]
        bins, offsets = (np.array(c, dtype=np.int64) for c in zip(*places, strict=True))
        return (
            block.drop_columns(["block", "number", "row"])
            .append_column("sequence_id", pa.array(bins + (number << 32)))
            .append_column("offset", pa.array(offsets))
        )

    dealt = pieces.withColumn("stretch", F.floor(F.col("row") / STRETCH)).join(block_cuts(pieces), ["file", "stretch"])
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return dealt.select("block", "number", "row", *own).groupBy("block").applyInArrow(packed, PACKED)


def pack_documents(docs: DataFrame, width: int = WIDTH, path: str | None = None) -> DataFrame:
    return pack(stored(token_pieces(docs, width, path), "pieces"), width)
