"""Language-model scoring by online logistic mixing of hashed-context bit predictors."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import SLICE, Stage, slices
from muster.llm.language import held_out

#: Bytes before a bit that the hashed predictors look at, slots of each one's table, and the largest stretched probability.
#: A further predictor looks at one byte and needs no hash: the code's own tree holds its probabilities.
ORDERS, SLOT_BITS, CLAMP = (4, 6), 20, 7.9
#: Stretched probabilities are kept as whole sixteenths: small tables stay in the processor's cache.
SCALE = 16
#: Steps after which a text's weights begin anew, and bits of a step, after which they are refined.
SEGMENT, STEP = 32, 64
#: Sets of weights: which one mixes a step depends on the bits that the step before it has cost.
GATES, RATE, FIRST_WEIGHT = (0.35, 0.6), 0.02, 0.4
#: Counts of the most frequent tokens are sent to all tasks, as many as this at most; all others are joined.
SENT_TOKENS = 100_000
_END, _START, _SYMBOLS = 256, 257, 258
_PAD = max(ORDERS)
_SLOTS = 1 << SLOT_BITS
_CHUNK = 1 << 12
_TOKEN, _PAIR, _TEXT = 0, 1, 2
_FACTORS = [np.uint32(int(f) | 1) for f in np.random.default_rng(3).integers(1, 1 << 32, _PAD, dtype=np.uint64)]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one array, each after start symbols and with its end symbol; and which symbols are coded."""
    start, end = np.full(_PAD, _START, np.uint16), np.array([_END], np.uint16)
    parts = [p for t in texts for p in (start, np.frombuffer(t, np.uint8).astype(np.uint16), end)]
    symbols = np.concatenate(parts)
    return symbols, symbols != _START


#: Bytes worked on at once: what the steps on them pass on stays in the processor's cache.
_NEAR = 1 << 16


def _groups(texts: list[bytes], size: int = _NEAR) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(texts):
        high, total = low, 0
        while high < len(texts) and (high == low or total < size):
            total += len(texts[high])
            high += 1
        yield low, high
        low = high


def count(docs: DataFrame) -> DataFrame:
    """(kind, key, n) over the learned texts: tokens by hash, pairs of successive bytes, and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(_SYMBOLS * _SYMBOLS, np.int64)
        n = 0
        for batch in slices(batches, 4 * SLICE):
            texts = [_bytes(t) for t in batch.column(0).to_pylist()]
            n += len(texts)
            for low, high in _groups(texts, 1 << 24):
                found = [w for t in texts[low:high] for w in t.split()]
                keys = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
                yield rows(_TOKEN, *np.unique(keys.view(np.int64), return_counts=True))
                symbols, coded = _symbols(texts[low:high])
                pair = symbols[:-1].astype(np.int32) * _SYMBOLS + symbols[1:]
                pairs += np.bincount(pair[coded[1:]], minlength=len(pairs))
        used = np.nonzero(pairs)[0]
        yield rows(_PAIR, used, pairs[used])
        yield rows(_TEXT, np.zeros(1, np.int64), np.array([n]))

    def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(keys), kind, np.int32))
        return pa.RecordBatch.from_arrays([kinds, pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"])

    counted = docs.select("text").mapInArrow(run, "kind int, key long, n long")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _sixteenths(odds: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(odds, -CLAMP, CLAMP) * SCALE).astype(np.int8)


class Code:
    """A Huffman code of each byte by the byte before it: every byte as few yes-or-no decisions."""

    def __init__(self, pairs: dict[int, int]):
        size = _SYMBOLS * _SYMBOLS
        self.length = np.zeros(size, np.int32)
        nodes: list[list[int]] = [[]] * size
        bits: list[list[int]] = [[]] * size
        priors: list[list[float]] = [[]] * size
        for before in range(_SYMBOLS):
            # Every byte can follow; those never seen share what is left.
            heap = [(pairs.get(before * _SYMBOLS + s, 0) * 64 + 1, s, s) for s in range(_END + 1)]
            heapq.heapify(heap)
            number = 0
            while len(heap) > 1:
                x, y = heapq.heappop(heap), heapq.heappop(heap)
                heapq.heappush(heap, (x[0] + y[0], _SYMBOLS + number, (x[2], y[2], number, log(y[0] / x[0]))))
                number += 1
            todo = [(heap[0][2], [], [], [])]
            while todo:
                tree, path, answers, chances = todo.pop()
                if isinstance(tree, tuple):
                    path, chances = [*path, number - 1 - tree[2]], [*chances, tree[3]]
                    todo += [(tree[bit], path, [*answers, bit], chances) for bit in (0, 1)]
                else:
                    at = before * _SYMBOLS + tree
                    nodes[at], bits[at], priors[at] = path, answers, chances
        self.length = np.array([len(p) for p in nodes], np.int32)
        self.offset = np.cumsum(self.length) - self.length
        numbers = np.array([n for path in nodes for n in path], np.uint32)
        slots = (numbers + np.uint32(1)) * np.uint32(0x9E3779B1) >> np.uint32(32 - SLOT_BITS)
        #: By place in the codes: the decision's part of the slot, and the bit below it.
        self.nodes = (slots * 2).astype(np.int64) + np.array([b for answers in bits for b in answers], np.int64)
        #: By place: the stretched probability of a 1 by the byte before.
        self.priors = _sixteenths(np.array([p for chances in priors for p in chances]))

    def decisions(self, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Of every decision: its place in the codes, its slot in each predictor's table, and the bit; and the steps
        that each text takes.

        Each text's decisions are filled up to whole steps; where they are, the bit is 2.
        """
        symbols, coded = _symbols(texts)
        at = np.nonzero(coded)[0]
        pair = symbols[at - 1].astype(np.int32) * _SYMBOLS + symbols[at]
        lengths = self.length[pair]
        last = np.cumsum([len(t) + 1 for t in texts]) - 1
        per_text = np.add.reduceat(lengths, np.append(0, last[:-1] + 1))
        fill = -per_text % STEP
        lengths[last] += fill
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(at)), lengths)
        # A byte's places follow each other, and then it goes on at the next byte's first.
        offset = self.offset[pair]
        place = np.ones(len(owner), np.int64)
        place[ends[:-1]] = offset[1:] - offset[:-1] - lengths[:-1] + 1
        place[0] = offset[0]
        np.cumsum(place, out=place)
        starts = np.repeat(ends[last] - fill, fill)
        filled = starts + np.arange(len(starts)) - np.repeat(np.cumsum(fill) - fill, fill)
        place[filled] = 0
        node = self.nodes[place]
        bits = (node & 1).astype(np.uint8)
        bits[filled] = 2
        node >>= 1
        wide = symbols.astype(np.uint32)
        slots, hashed = [], np.zeros(len(at), np.uint32)
        for order in range(1, _PAD + 1):
            hashed = (hashed + wide[at - order]) * _FACTORS[order - 1]
            hashed ^= hashed >> np.uint32(15)
            if order in ORDERS:
                mixed = ((hashed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - SLOT_BITS)).astype(np.int64)[owner]
                mixed ^= node
                slots.append(mixed)
        return place, slots, bits, (per_text + fill) // STEP

    def inputs(self, texts: list[bytes], tables: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The predictors' stretched probabilities of every decision, the bits, and the steps of each text."""
        place, slots, bits, steps = self.decisions(texts)
        return [self.priors[place], *(table[slot] for table, slot in zip(tables, slots, strict=True))], bits, steps


class _Frequent:
    """log10(n + 1) of frequent tokens, each at the place that its hash's low bits name.

    Where two share a place, the more frequent one has it; the other is looked up as all further tokens are.
    """

    def __init__(self, keys: np.ndarray, ns: np.ndarray):
        self.mask = (1 << max(4, int(len(keys)).bit_length() + 3)) - 1
        self.keys, self.values = np.zeros(self.mask + 1, np.int64), np.zeros(self.mask + 1)
        order = np.argsort(ns, kind="stable")
        place = keys[order] & self.mask
        self.keys[place], self.values[place] = keys[order], np.log10(ns[order] + 1.0)

    def logs(self, hashes: np.ndarray) -> np.ndarray:
        """0 for tokens that are not held."""
        place = hashes & self.mask
        return np.where(self.keys[place] == hashes, self.values[place], 0.0)


def learn(docs: DataFrame, code: Code) -> np.ndarray:
    """The predictors' stretched probabilities by order and slot, from the bits of all learned texts.

    Each task adds up its texts' bits; its tables travel in compressed chunks that are added up in two steps, so no task
    reads what all others have found.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(code)
    zeros = np.zeros((len(ORDERS), _SLOTS, 2), np.int64)
    schema = "chunk int, part int, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = zeros.copy()
        for batch in slices(batches):
            texts = [_bytes(t) for t in batch.column(0).to_pylist()]
            for low, high in _groups(texts, 16 * _NEAR):
                seen: list[list[np.ndarray]] = [[] for _ in ORDERS]
                for start, end in _groups(texts[low:high]):
                    _, slots, bits, _ = sent.value.decisions(texts[low + start : low + end])
                    filled = np.nonzero(bits == 2)[0]
                    for found, slot in zip(seen, slots, strict=True):
                        slot *= 2
                        slot += bits
                        slot[filled] = 2 * _SLOTS
                        found.append(slot)
                for k, found in enumerate(seen):
                    total[k] += np.bincount(np.concatenate(found), minlength=2 * _SLOTS + 1)[:-1].reshape(-1, 2)
        chunks = total.reshape(-1, _CHUNK * 2)
        part = TaskContext.get().partitionId() % 64
        yield packed([(i, part, chunk) for i, chunk in enumerate(chunks) if chunk.any()])

    def packed(rows: list) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=3)
        columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32())]
        counts = pa.array([squeeze.compress(r[2].tobytes()) for r in rows], pa.binary())
        return pa.RecordBatch.from_arrays([*columns, counts], ["chunk", "part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of successive rows of one chunk and part."""
        reader = zstandard.ZstdDecompressor()
        key, total = None, None
        for batch in batches:
            for chunk, part, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                row = np.frombuffer(reader.decompress(counts), np.int64)
                if (chunk, part) == key:
                    total = total + row
                else:
                    if key is not None:
                        yield packed([(*key, total)])
                    key, total = (chunk, part), row
        if key is not None:
            yield packed([(*key, total)])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = docs.select("text").mapInArrow(run, schema)
    for one in (F.col("part"), F.lit(0)):
        dealt = tables.withColumn("part", one.cast("int")).repartition(parts, "chunk", "part")
        tables = dealt.sortWithinPartitions("chunk", "part").mapInArrow(add, schema)
    total = zeros.reshape(-1, _CHUNK * 2)
    for row in tables.collect():  # as many rows as the tables have chunks, whatever the input
        total[row.chunk] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row.counts)), np.int64)
    seen = total.reshape(len(ORDERS), _SLOTS, 2).astype(np.float64)
    odds = (seen[..., 1] + 0.4) / (seen[..., 0] + 0.4)
    return _sixteenths(np.log(odds))


def score(texts: list[bytes], code: Code, tables: np.ndarray) -> np.ndarray:
    """log10 probability of every text.

    Each bit's stretched predictions are mixed by a set of weights that the cost of the step before it chooses; after every
    step of ``STEP`` bits the weights of that set move against their error. Long texts are cut into segments of
    ``SEGMENT`` steps, which begin with the first weights; all segments move side by side.
    """
    out = np.zeros(len(texts))
    for low, high in _groups(texts, 8 * _NEAR):
        parts = [code.inputs(texts[low + a : low + b], tables) for a, b in _groups(texts[low:high])]
        bits, steps = (np.concatenate([part[i] for part in parts]) for i in (1, 2))
        inputs = [np.concatenate(column).reshape(-1, STEP) for column in zip(*(part[0] for part in parts), strict=True)]
        pieces = -(-steps // SEGMENT)
        owner = np.repeat(np.arange(high - low), pieces)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = (np.cumsum(steps) - steps)[owner] + within * SEGMENT
        length = np.minimum(steps[owner] - within * SEGMENT, SEGMENT)
        order = np.argsort(-length, kind="stable")
        first, length, owner = first[order], length[order], owner[order]
        # Against what really follows: 1 for a bit of 0, -1 for 1; 0 where a text's last step is filled up.
        against = np.array([1, -1, 0], np.int8)[bits].reshape(-1, STEP)
        weights = np.full((len(owner), len(GATES) + 1, len(inputs)), FIRST_WEIGHT, np.float32)
        bias = np.zeros((len(owner), len(GATES) + 1), np.float32)
        total = np.zeros(len(owner))
        gate = np.zeros(len(owner), np.int64)
        for step in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -step, "left"))  # segments that go on here
            rows, chosen, at = np.arange(n), gate[:n], first[:n] + step
            w = weights[rows, chosen]
            x = [column[at] * np.float32(1 / SCALE) for column in inputs]
            s = against[at].astype(np.float32)
            mixed = x[0] * w[:, :1]
            for k in range(1, len(x)):
                mixed += x[k] * w[:, k : k + 1]
            mixed += bias[rows, chosen][:, None]
            mixed *= s
            np.minimum(mixed, 20, out=mixed)
            wrong = np.exp(mixed, out=mixed)
            ratio = wrong + 1
            # The logarithm of products of four: none exceeds what a float holds.
            a, b, c, d = np.split(ratio, 4, axis=1)
            cost = np.log(a * b * (c * d)).sum(axis=1)
            total[:n] -= cost
            wrong /= ratio  # the probability of the other bit
            wrong *= s
            for k, column in enumerate(x):
                weights[rows, chosen, k] -= RATE * np.einsum("ij,ij->i", wrong, column)
            bias[rows, chosen] -= RATE * wrong.sum(axis=1)
            gate[:n] = np.searchsorted(GATES, cost / STEP)
        # What fills up the last steps cost one half each.
        filled = np.add.reduceat((bits == 2).astype(np.int64), (np.cumsum(steps) - steps) * STEP)
        out[low:high] = np.bincount(owner, total, high - low) + filled * np.log(2)
    return out / np.log(10)


def score_corpus(docs: DataFrame, stage: Stage | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) of every row of
    ``docs`` (doc_id, text).

    The model learns from the texts whose crc32(doc_id as text) mod 7 is not 2. Bytes, A-Z lower-cased, are coded
    by a Huffman code by the byte before; the byte before and hashed contexts of the last 4 and 6
    bytes predict each bit, and gated weights mix them, online within each text. ``score`` is the log10 probability of the bytes and the text's end.
    ``base_score`` is that of the tokens (words and one end) under their smoothed frequencies.

    Null texts are empty: one end. Rows without doc_id are scored, not learned from and not held out. Repeated rows are
    scored, and learned from, as often as they come. Without any text to learn from all tokens are unknown.
    """
    spark = docs.sparkSession
    stage = stage or Stage(spark)
    source = docs.select(F.col("doc_id"), F.col("text"), held_out(F.col("doc_id"), 7, 2).alias("held_out"))
    learned = source.filter("doc_id is not null and not held_out")
    counts = stage(count(learned))
    tokens = counts.filter(F.col("kind") == _TOKEN).select("key", "n")
    sums = {row.kind: row for row in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d")).collect()}
    n_texts = sums[_TEXT].n if _TEXT in sums else 0
    n_all = n_texts + (sums[_TOKEN].n if _TOKEN in sums else 0)
    n_kinds = (n_texts > 0) + (sums[_TOKEN].d if _TOKEN in sums else 0)
    # At most 258 * 258 pairs, and a bounded number of tokens.
    code = Code({row.key: row.n for row in counts.filter(F.col("kind") == _PAIR).collect()})
    frequent = tokens.orderBy(F.desc("n"), "key").limit(SENT_TOKENS).toArrow()
    known = _Frequent(frequent["key"].to_numpy(), frequent["n"].to_numpy())
    model = spark.sparkContext.broadcast((code, learn(learned, code), known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, tables, frequent = model.value
        for batch in slices(batches):
            texts = [_bytes(t) for t in batch.column(2).to_pylist()]
            split = [text.split() for text in texts]
            found = [word for part in split for word in part]
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)
            owner = np.repeat(np.arange(len(texts)), [len(part) for part in split])
            logs = frequent.logs(hashes)
            met = logs > 0
            rest = np.bincount(owner[~met], minlength=len(texts))
            tail = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(rest)), pa.int32()), pa.array(hashes[~met]))
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array([len(part) for part in split], pa.int64()),
                pa.array(np.bincount(owner[met], minlength=len(texts))),
                pa.array(np.bincount(owner, logs, len(texts))),
                tail,
                pa.array(score(texts, code, tables)),
                pa.array([len(t) for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, n_words long, head_known long, head_sum double, tail array<long>, "
        "score double, n_bytes long"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    scored = source.select("doc_id", "held_out", "text").mapInArrow(run, schema)
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()))
    rare = (
        scored.select("row", F.explode("tail").alias("key"))
        .join(tokens, "key")
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("rare_known"), F.sum(F.log10(F.col("n") + 1)).alias("rare_sum"))
    )
    whole = scored.drop("tail").join(rare, "row", "left")
    n_tokens = F.col("n_words") + 1
    ends = F.lit(float(np.log10(n_texts + 1)))
    base = F.col("head_sum") + F.coalesce("rare_sum", F.lit(0.0)) + ends - n_tokens * float(np.log10(n_all + n_kinds + 1))
    return whole.select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0)) + int(n_texts > 0)).alias("n_known"),
        F.lit(int(n_all)).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") / float(np.log10(2)) / F.when(F.col("n_bytes") > 0, F.col("n_bytes"))).alias("bits_per_byte"),
    )
