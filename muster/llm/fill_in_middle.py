"""Fill-in-the-middle transformation by a secondary sort: texts travel as pieces keyed by document and output position."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The marks before prefix, suffix and middle, and their order in each form.
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
FORMS = {"psm": "PSM", "spm": "SPM"}
#: Sections in the order of the text.
TEXT_ORDER = "PMS"
SEED = "1"
#: Of a hundred texts, those from PLAIN on stay plain; of the others, those below SPM begin with the suffix.
PLAIN = 90
SPM = 20
#: Units in a piece.
UNITS = 4096
#: Bytes of text that a partition of the sort holds, about.
PARTITION_BYTES = 32 << 20
#: Code points looked at at once.
BLOCK = 1 << 20
_MARK = re.compile(b"|".join(MARKS.values()))

HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def _unit_starts(block: str, after_letter: bool) -> tuple[np.ndarray, bool]:
    """Where units (runs of ASCII letters, or any other code point) begin; whether the block ends in a letter."""
    codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), np.uint32)
    upper = codes & ~np.uint32(32)
    letter = (upper >= ord("A")) & (upper <= ord("Z"))
    before = np.concatenate(([after_letter], letter[:-1]))
    return np.flatnonzero(~(letter & before)), bool(letter[-1])


def unit_marks(text: str, units: int = UNITS) -> tuple[list[int], int]:
    """Offsets (code points) of every ``units``-th unit, and the number of units."""
    marks, n, letter = [], 0, False
    for low in range(0, len(text), BLOCK):
        starts, letter = _unit_starts(text[low : low + BLOCK], letter)
        marks.extend((starts[-n % units :: units] + low).tolist())
        n += len(starts)
    return marks, n


def unit_offset(text: str, marks: list[int], n: int, unit: int, units: int = UNITS) -> int:
    """The offset of a unit; that of unit ``n`` is the end of the text."""
    if unit >= n:
        return len(text)
    low = marks[unit // units]
    high = marks[unit // units + 1] if unit // units + 1 < len(marks) else len(text)
    if not unit % units:
        return low
    seen, letter = 0, False
    for at in range(low, high, BLOCK):
        starts, letter = _unit_starts(text[at : min(high, at + BLOCK)], letter)
        if unit % units < seen + len(starts):
            return at + int(starts[unit % units - seen])
        seen += len(starts)
    raise AssertionError(unit)


@dataclass(frozen=True)
class Cut:
    """How a text is cut: its units, form, and where prefix and middle end (code points)."""

    n: int
    form: str
    low: int
    high: int
    marks: list[int]


def cut(doc_id: int | None, text: str, units: int = UNITS) -> Cut:
    digest = hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    marks, n = unit_marks(text, units)
    if not text or h3 % 100 >= PLAIN or any(mark.decode() in text for mark in MARKS.values()):
        return Cut(n, "plain", 0, 0, marks)
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    low, high = (unit_offset(text, marks, n, unit, units) for unit in (first, last))
    return Cut(n, "spm" if h4 % 100 < SPM else "psm", low, high, marks)


def output_pieces(text: str, made: Cut) -> Iterator[bytes]:
    """The output in order, a unit chunk at a time; a section's first piece begins with its mark."""
    ranges = {"P": (0, made.low), "M": (made.low, made.high), "S": (made.high, len(text))}
    sections = [(MARKS[s], *ranges[s]) for s in FORMS[made.form]] if made.form in FORMS else [(b"", 0, len(text))]
    for mark, low, high in sections:
        inner = made.marks[bisect_right(made.marks, low) : bisect_left(made.marks, high)]
        ends = [low, *inner, high]
        for at, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            yield (b"" if at else mark) + text[a:b].encode("utf-8", "surrogatepass")


def sections(form: str, pieces: Iterable[bytes]) -> Iterator[tuple[str, bytes]]:
    """(section, bytes) of an output that comes in pieces cut anywhere; marks are found, not counted on at piece borders.

    A plain output is one section.
    """
    if form not in FORMS:
        yield from (("P", piece) for piece in pieces)
        return
    section, kept = "", b""
    longest = max(map(len, MARKS.values())) - 1
    for piece in chain(pieces, [None]):
        kept += piece or b""
        at = 0
        for found in _MARK.finditer(kept):
            if found.start() > at:
                yield section, kept[at : found.start()]
            section, at = found[0][1:2].decode(), found.end()
        # The last bytes may begin a mark.
        end = len(kept) if piece is None else max(at, len(kept) - longest)
        if end > at:
            yield section, kept[at:end]
        kept = kept[end:]


def _row(key: tuple) -> int:
    """Rows are dealt out by their number, whatever their doc_id: copies of a document go to different partitions."""
    return key[0]


def keyed_pieces(docs: DataFrame, units: int = UNITS) -> RDD:
    """((row, output position), piece) of every row; position 0 holds the row's head (``HEAD``)."""

    def emit(partition: int, rows: Iterator) -> Iterator:
        for at, (doc_id, text) in enumerate(rows):
            row, text = partition << 40 | at, text or ""
            made = cut(doc_id, text, units)
            chars = (None, None) if made.form == "plain" else (made.low, made.high - made.low)
            yield (row, 0), (doc_id, made.n, made.form, *chars)
            for position, piece in enumerate(output_pieces(text, made), start=1):
                yield (row, position), piece

    return docs.select("doc_id", "text").rdd.mapPartitionsWithIndex(emit)


def sort_partitions(docs: DataFrame) -> int:
    """As many partitions as the bytes of all texts ask for, so that a sort fits into a Python worker at any size."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(-(-total // PARTITION_BYTES), docs.sparkSession.sparkContext.defaultParallelism)


def assembled(docs: DataFrame, partitions: int | None = None, units: int = UNITS) -> RDD:
    """``keyed_pieces`` with each output's pieces one after the other, in order, in one partition."""
    return keyed_pieces(docs, units).repartitionAndSortWithinPartitions(partitions or sort_partitions(docs), _row)


def outputs(docs: DataFrame, partitions: int | None = None, units: int = UNITS) -> DataFrame:
    """The outputs as rows of at most a chunk: (doc_id, n, form, prefix_chars, middle_chars, row, position, piece).

    ``row`` tells rows of one doc_id apart; the pieces of a row, joined by position (from 1), are its output. Rows of a
    partition are in that order. An empty text gives one empty piece.
    """

    def rows(records: Iterator) -> Iterator:
        head = None
        for (row, position), value in records:
            if position == 0:
                head = value
            else:
                yield (*head, row, position, value.decode("utf-8", "replace"))

    schema = f"{HEAD}, row long, position long, piece string"
    return docs.sparkSession.createDataFrame(assembled(docs, partitions, units).mapPartitions(rows), schema, verifySchema=False)


def digests(docs: DataFrame, partitions: int | None = None, units: int = UNITS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row of ``docs`` (doc_id, text).

    Pieces are sorted by row and output position and stream into the output's digest. The output, read only as bytes and
    form, is parted at its marks, and the parts are sorted again by their place in the text and stream into the
    restored text's digest. The second sort keeps the first one's partitioning, so texts cross the network once. No task
    holds more of a text than the row that it read; sorting spills.

    Null texts are empty texts; an empty text is plain. A null doc_id counts as an empty number. Repeated rows are returned as often
    as they come, and an empty table gives no row. Other columns are not read. ``docs`` must give the same rows in the same
    order when a lost task is repeated, as a stored table does.
    """

    def part(records: Iterator) -> Iterator:
        for row, group in groupby(records, lambda record: _row(record[0])):
            (_, head) = next(group)
            digest = hashlib.sha256()

            def told(group=group, digest=digest) -> Iterator[bytes]:
                for _, piece in group:
                    digest.update(piece)
                    yield piece

            for at, (section, piece) in enumerate(sections(head[2], told())):
                yield (row, TEXT_ORDER.index(section) + 1, at), piece
            yield (row, 0, 0), (*head, digest.hexdigest())

    def restore(records: Iterator) -> Iterator:
        for _, group in groupby(records, lambda record: _row(record[0])):
            (_, head) = next(group)
            digest = hashlib.sha256()
            for _, piece in group:
                digest.update(piece)
            yield (*head, digest.hexdigest())

    sorted_pieces = assembled(docs, partitions, units)
    parts = sorted_pieces.mapPartitions(part, preservesPartitioning=True)
    restored = parts.repartitionAndSortWithinPartitions(sorted_pieces.getNumPartitions(), _row).mapPartitions(restore)
    schema = f"{HEAD}, output_sha256 string, restored_sha256 string"
    return docs.sparkSession.createDataFrame(restored, schema, verifySchema=False)
