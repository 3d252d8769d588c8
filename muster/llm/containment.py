"""Benchmark decontamination: short test items found inside long documents by size-partitioned MinHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import Stage, arrow_map, shingle_hashes, shingle_set, slices, words

CONTAINMENT = 75
#: Hash functions compared one by one. An item of which 75 % lies in a window of at most four times its size agrees with
#: the window in one function with a probability of 0.17 or more, in none of 64 with 5e-6 or less.
HASHES = 64
#: Bits of the marks that tell which shingles occur in items; 65,536 marks are a page. With a page for each size and function
#: they are all that is sent to the tasks, whatever the number of items.
SHINGLE_BITS = 24
_PAGE = 1 << 16

_rng = np.random.default_rng(11)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
#: Values are first looked up by their low bits.
_LOW = np.uint32(_PAGE - 1)
_KEY, _SHINGLE = 0, 1


def _values(shingles: np.ndarray, k: int) -> np.ndarray:
    values = shingles ^ _XOR[k]
    values *= _MUL[k]
    return values


def _short(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(32)).astype(np.uint32)


def _keys(power: int, k: int, values: np.ndarray) -> np.ndarray:
    """A smallest value with its function and size class, as one number."""
    return values.astype(np.int64) | (k << 32) | (power << 40)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    flat = np.concatenate([np.empty(0, np.int64), *[a.view(np.int64) for a in arrays]])
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def _item_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Items with their sets, partitioned by size: class ``power`` holds sets of more than 2^(power-1), at most 2^power."""
    sets = [shingle_set(text) for text in batch.column(1).to_pylist()]
    at = [i for i, s in enumerate(sets) if len(s)]
    sets = [sets[i] for i in at]
    powers = [(len(s) - 1).bit_length() for s in sets]
    least = [np.array([_keys(p, k, _values(_short(s), k).min()) for k in range(HASHES)], np.int64) for p, s in zip(powers, sets, strict=True)]
    columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(powers, pa.int32()), pa.array([len(s) for s in sets], pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, _lists(least), _lists(sets)], ["item_id", "power", "item_shingles", "keys", "shingles"])


def _marks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page, marks) of a task's items: pages of keys by class and function, then those of shingles."""
    pages: dict[int, np.ndarray] = {}

    def mark(numbers: np.ndarray, places: np.ndarray) -> None:
        for number in np.unique(numbers).tolist():
            page = pages.setdefault(number, np.zeros(_PAGE, bool))
            page[places[numbers == number]] = True

    for batch in batches:
        keys = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        mark((keys >> 40) * HASHES + (keys >> 32 & 0xFF), keys & int(_LOW))
        places = _shingle_places(batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
        mark(-1 - (places >> 16), places & int(_LOW))
    yield _paged(pages)


def _shingle_places(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SHINGLE_BITS)).astype(np.int64)


def _paged(pages: dict[int, np.ndarray]) -> pa.RecordBatch:
    marks = pa.array([np.packbits(page).tobytes() for page in pages.values()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(pages), pa.int32()), marks], ["page", "marks"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a page, from rows that come sorted by page."""
    number, page = None, None
    for batch in batches:
        for at, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            marks = np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool)
            if at == number:
                page |= marks
            else:
                if page is not None:
                    yield _paged({number: page})
                number, page = at, marks
    if page is not None:
        yield _paged({number: page})


class Marks:
    """Which low bits of smallest values occur, by size class and function, and which shingles."""

    def __init__(self, pages: dict[int, bytes]):
        self.pages = pages
        powers = sorted({number // HASHES for number in pages if number >= 0})
        self.least = powers[0] if powers else 0
        #: Places in the levels of windows: each is twice as wide as the one before.
        self.levels = [power - self.least for power in powers]

    def opened(self) -> Marks:
        """The same with marks as bytes, for looking up."""
        unpacked = {number: np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool) for number, raw in self.pages.items()}
        none = np.zeros(_PAGE, bool)
        self.occurs = {level: [unpacked.get((level + self.least) * HASHES + k, none) for k in range(HASHES)] for level in self.levels}
        self.shingles = np.concatenate([unpacked.get(-1 - part, none) for part in range(1 << (SHINGLE_BITS - 16))])
        return self

    def windows(self, shingles: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, key) of smallest values that may be an item's; ``shingles`` of several documents, that begin at ``starts``.

        A document is cut into windows of twice the largest size of the class, half overlapping, so a passage as long
        as an item lies whole in one of them.
        """
        docs, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        values = _short(shingles)
        size = 1 << self.least
        lengths = np.diff(np.append(starts, len(values)))
        tiles = -(-lengths // size)  # of the smallest size; wider ones are made of them
        owner = np.repeat(np.arange(len(starts)), tiles)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(tiles) - tiles, tiles)
        cuts = np.repeat(starts, tiles) + within * size
        levels = []
        for _ in range(max(self.levels) + 1):
            first = np.nonzero(within % 2 == 0)[0]
            levels.append((owner, owner[1:] != owner[:-1], first))
            owner, within = owner[first], within[first] // 2
        for k in range(HASHES):
            least = np.minimum.reduceat(_values(values, k), cuts)
            for level, (at, parted, first) in enumerate(levels):
                if level in self.occurs:
                    window = least.copy()
                    following = least[1:].copy()
                    following[parted] = ~np.uint32(0)
                    np.minimum(window[:-1], following, out=window[:-1])
                    maybe = np.nonzero(self.occurs[level][k][window & _LOW])[0]
                    docs.append(at[maybe])
                    keys.append(_keys(level + self.least, k, window[maybe]))
                if level < len(levels) - 1:  # pairs of neighbouring tiles make the next size
                    least = np.minimum.reduceat(least, first)
        return np.concatenate(docs), np.concatenate(keys)

    def hits(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, text, value): the keys of texts that have any, and their shingles that may be an item's."""
        hashes = [shingle_hashes(words(text)) for text in texts]
        full = [i for i, h in enumerate(hashes) if len(h)]
        low = 0
        while low < len(full):
            high, size = low, 0
            while high < len(full) and (high == low or size < 1 << 17):
                size += len(hashes[full[high]])
                high += 1
            group = [hashes[i] for i in full[low:high]]
            flat, starts = np.concatenate(group), np.cumsum([0, *map(len, group[:-1])])
            owners = np.array(full[low:high])
            docs, keys = self.windows(flat, starts)
            docs, keys = np.unique(np.stack([docs, keys]), axis=1)
            yield _KEY, owners[docs], keys
            found = np.isin(np.arange(len(group)), docs)
            marked = self.shingles[_shingle_places(flat)] & np.repeat(found, [len(h) for h in group])
            held = np.unique(np.stack([np.repeat(np.arange(len(group)), [len(h) for h in group])[marked], flat[marked].view(np.int64)]), axis=1)
            yield _SHINGLE, owners[held[0]], held[1]
            low = high


def contaminated(docs: DataFrame, benchmark: DataFrame, containment: int = CONTAINMENT, stage: Stage | None = None) -> DataFrame:
    """(doc_id, item_id, common, item_shingles): items of which a document holds ``containment`` percent or more.

    Containment is 100 * |item and document| / |item| over the sets of five-word shingles of whole texts. Tasks turn items into
    sets and smallest values; marks of bounded size tell documents which of their windows' values and shingles may be an
    item's. These meet the items by value: a common smallest value makes a candidate, the common shingles decide.
    Documents are scanned once, whatever the number of items, and neither shuffled nor cut.

    An item with fewer words than a shingle is one shingle and matches only a document that consists of the same words. Items
    and documents without words, and items without id, match nothing. Repeated rows of a document give their pairs once,
    and of several texts of one doc_id or item_id the fullest match stands; a null doc_id is returned as it is. An empty benchmark
    gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    stage = stage or Stage(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    rows = arrow_map(known.distinct(), _item_rows, "item_id long, power int, item_shingles long, keys array<long>, shingles array<long>")
    items = stage(rows.withColumn("item", F.monotonically_increasing_id()))
    pages = items.select("keys", "shingles").mapInArrow(_marks_of, "page int, marks binary")
    merged = pages.repartition(parts, "page").sortWithinPartitions("page").mapInArrow(_merged, "page int, marks binary")
    # A page for each class and function that occurs, and a fixed number for the shingles.
    sent = spark.sparkContext.broadcast(Marks({row.page: bytes(row.marks) for row in merged.collect()}))
    schema = "text_key binary, doc_id long, kind int, value long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not sent.value.levels:
            return
        marks = sent.value.opened()
        for batch in slices(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for kind, at, values in marks.hits(texts):
                some, which = np.unique(at, return_inverse=True)
                names = [xxhash.xxh3_128_digest(f"{ids[i].as_py()}:{texts[i]}".encode("utf-8", "surrogatepass")) for i in some.tolist()]
                columns = [pa.array(names, pa.binary()).take(pa.array(which)), ids.take(pa.array(at, pa.int64()))]
                kinds = pa.array(np.full(len(at), kind, np.int32))
                yield pa.RecordBatch.from_arrays([*columns, kinds, pa.array(values)], ["text_key", "doc_id", "kind", "value"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    found = stage(source.mapInArrow(run, schema))
    keys = items.select("item", F.explode("keys").alias("value"))
    met = found.filter(F.col("kind") == _KEY).join(keys, "value").select("text_key", "doc_id", "item").distinct()
    met = stage(met)
    wanted = met.join(items.select("item", F.explode("shingles").alias("value")), "item").select("text_key", "item", "value")
    held = found.filter(F.col("kind") == _SHINGLE).select("text_key", "value").distinct()
    common = wanted.join(held, ["text_key", "value"]).groupBy("text_key", "item").agg(F.count(F.lit(1)).alias("common"))
    whole = met.join(common, ["text_key", "item"]).join(items.select("item", "item_id", "item_shingles"), "item")
    # One item id may have several texts; the fullest match stands.
    best = F.max(F.struct((F.col("common") / F.col("item_shingles")).alias("share"), "common", "item_shingles"))
    return (
        whole.filter(100 * F.col("common") >= containment * F.col("item_shingles"))
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.common", "best.item_shingles")
    )
