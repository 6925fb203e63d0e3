"""Records of large text files, taken from the byte ranges that Spark deals a file out in.

A file is read as parts that a sign ends, and each byte range has whole parts. A format tells after which of them a record
ends, given how its range begins. The parts before a range's first end and after its last one are fragments of records
that reach over ranges: they meet in a small shuffle, as there are two a range at most, and become records there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import bounded

_FRAGMENT = "file string, block long, part int, first boolean, text binary"
_FRAGMENT_ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("first", pa.bool_()), ("text", pa.binary())])

#: For the parts of a range, as they come, whether a record ends after each.
Ender = Callable[[pa.Array], np.ndarray]
#: The ender of a range, given its file and where it begins, and whether it begins within a record.
Begin = Callable[[str, int], tuple[Ender, bool]]


def parts_of(spark: SparkSession, path: str | Sequence[str], sign: str) -> DataFrame:
    """(file, block, value): what stands between signs, as bytes, with the byte range that each belongs to."""
    bounded(spark)
    raw = spark.read.option("lineSep", sign).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


@dataclass
class Range:
    """What is known of a byte range while its parts come in."""

    file: str
    block: int
    ender: Ender
    within: bool
    sign: bytes
    held: list[bytes] = field(default_factory=list)
    #: Whether a record has ended here, and what stood before that if the range began within one.
    ended: bool = False
    head: bytes | None = None

    def records(self, values: pa.Array) -> list[bytes]:
        """The records that these parts complete."""
        ends, texts, low, out = self.ender(values), values.to_pylist(), 0, []
        for end in (np.flatnonzero(ends) + 1).tolist():
            record = texts[low] if end == low + 1 and not self.held else self.sign.join([*self.held, *texts[low:end]])
            self.held, low = [], end
            if self.within and not self.ended:
                self.head = record
            else:
                out.append(record)
            self.ended = True
        self.held += texts[low:]
        return out

    def fragments(self) -> Iterator[tuple]:
        """(file, block, part, first, text): the head, which an earlier range's record ends with, and the open rest. A range without an end is only one of these."""
        if self.within and not self.ended:
            yield self.file, self.block, 0, False, self.sign.join(self.held)
            return
        if self.head is not None:
            yield self.file, self.block, 0, False, self.head
        if self.held:
            yield self.file, self.block, 1, self.block == 0 and not self.ended, self.sign.join(self.held)


def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, block, values): stretches of rows of one range."""
    for batch in batches:
        file, block, values = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).cast(pa.binary())
        low = 0
        while low < batch.num_rows:
            other = block[low:] != block[low]
            high = low + int(np.argmax(other)) if other.any() else batch.num_rows
            if file[high - 1] != file[low]:
                high = next(i for i in range(low, high) if file[i] != file[low])
            yield file[low], int(block[low]), values.slice(low, high - low)
            low = high


def _ranges(batches: Iterable[pa.RecordBatch], begin: Begin, sign: bytes) -> Iterator[tuple[Range, list[bytes], bool]]:
    """(range, records, over) as parts come in; over: the range has no more of them."""
    now: Range | None = None
    for file, block, values in segments(batches):
        if now is None or (now.file, now.block) != (file, block):
            if now:
                yield now, [], True
            now = Range(file, block, *begin(file, block), sign)
        yield now, now.records(values), False
    if now:
        yield now, [], True


#: From (file, block, number of the first, whether that is the file's first record, records) to a record batch.
Parse = Callable[[str, int, int, bool, list[bytes]], pa.RecordBatch]
#: The number of a record that reaches over the end of its range, after all others of it.
OVER_END = (1 << 31) - 1


def records(parts: DataFrame, begin: Begin, sign: bytes, parse: Parse, schema: str) -> DataFrame:
    """All records of files, parsed where their ranges are; those that reach over ranges, where their fragments meet."""

    def within_ranges(batches):
        number = 0
        for r, found, over in _ranges(batches, begin, sign):
            if found:
                yield parse(r.file, r.block, number, r.block == 0 and number == 0, found)
            number = 0 if over else number + len(found)

    def fragments(batches):
        for r, _, over in _ranges(batches, begin, sign):
            if over and (found := list(r.fragments())):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _FRAGMENT_ARROW)], schema=_FRAGMENT_ARROW)

    def joined(batches):
        for batch in batches:
            for file, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield parse(file, pieces[0]["block"], OVER_END, pieces[0]["first"], [sign.join(p["text"] for p in pieces)])

    record = F.sum("part").over(Window.partitionBy("file").orderBy("block", "part"))
    pieces = parts.mapInArrow(fragments, _FRAGMENT).withColumn("record", record).groupBy("file", "record")
    over = pieces.agg(F.array_sort(F.collect_list(F.struct("block", "part", "first", "text"))).alias("pieces")).select("file", "pieces").mapInArrow(joined, schema)
    return parts.mapInArrow(within_ranges, schema).unionByName(over)
