"""MinHash near-duplicates by an LSH forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from muster.llm.common import Stage, arrow_map, binary, matrix, shingle_set
from muster.llm.graph import components

#: Sorted orders, hashes in each order's label, and the shortest common prefix that makes neighbours candidates.
#: Two sets of similarity 0.75 share a prefix of 3 in an order with probability 0.42, in none of 24 with 2e-6.
TREES, DEPTH, MIN_DEPTH = 24, 8, 3
#: Neighbours looked at in a sorted order, and from which common prefix on only the two nearest are taken. Runs of a common
#: prefix longer than what these always cover are crowds: their rows are compared in blocks where still unconnected.
WINDOW, DEEP, COVERED = 6, 5, 3
#: Rows and shingles that a block of a crowd holds on average, and columns of a block that are multiplied at once.
BLOCK_ROWS, BLOCK_SHINGLES, BLOCK_COLUMNS = 256, 1 << 17, 2048
SIMILARITY = 75
#: Share of agreeing hashes, of 192, below which no pair is confirmed on its sets: 4.8 deviations under 0.75.
ESTIMATE = 0.60

_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)


def minhashes(sets: list[np.ndarray], functions: list[int] | range = range(TREES * DEPTH)) -> np.ndarray:
    """The low 16 bits of each set's smallest hash under every one of the functions; sets must not be empty."""
    out = np.zeros((len(sets), len(functions)), np.uint16)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 1 << 16):
            size += len(sets[end])
            end += 1
        values = (np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *map(len, sets[at : end - 1])])
        for column, k in enumerate(functions):
            out[at:end, column] = np.minimum.reduceat((values ^ _XOR[k]) * _MUL[k], starts).astype(np.uint16)
        at = end
    return out


def _planes(labels: np.ndarray) -> pa.Array:
    """Each row's high bytes, then its low ones."""
    return binary(np.hstack([labels >> 8, labels & 255]).astype(np.uint8))


def _labels(column: pa.Array) -> np.ndarray:
    """The inverse of ``_planes``."""
    planes = matrix(column, "u1").astype(np.uint16)
    return planes[:, : TREES * DEPTH] << 8 | planes[:, TREES * DEPTH :]


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column(1).to_pylist()
    sets = [shingle_set(text) for text in texts]
    full = [i for i, s in enumerate(sets) if len(s)]
    labels = np.zeros((len(sets), TREES * DEPTH), np.uint16)
    if full:
        labels[full] = minhashes([sets[i] for i in full])
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array([len(s) for s in sets], pa.int64()),
            _keys(sets),
            _planes(labels),
        ],
        ["doc_id", "n_shingles", "set_key", "labels"],
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of rows that lie near each other in one order and share a long enough prefix, and the rows
    (a, crowd) of longer runs of one prefix. A task's first and last run may go on in other tasks and are crowds."""
    kept_ids = np.empty(0, np.int64)
    kept_labels = np.empty((0, DEPTH + 1), np.uint16)
    open_run: list[np.ndarray] = []
    open_key: bytes | None = None
    opened_first = True

    def crowd(key: bytes, ids: list[np.ndarray]) -> pa.RecordBatch:
        a = pa.array(np.concatenate(ids))
        return pa.RecordBatch.from_arrays([a, pa.nulls(len(a), pa.int64()), pa.array([key] * len(a), pa.binary())], ["a", "b", "crowd"])

    for batch in batches:
        if not batch.num_rows:
            continue
        new = len(kept_ids)
        fresh = batch.column(1).to_numpy(zero_copy_only=False)
        big = matrix(batch.column(0), ">u2")
        ids = np.concatenate([kept_ids, fresh])
        labels = np.concatenate([kept_labels, big.astype(np.uint16)])
        left, right = [], []
        for lag in range(1, min(WINDOW, len(ids) - 1) + 1):
            # The first column is the order's number; rows before ``new`` met each other in the batch before.
            same = labels[lag:] == labels[:-lag]
            prefix = np.cumprod(same, axis=1).sum(axis=1) - 1
            hit = (prefix >= MIN_DEPTH) & ((lag <= 2) | (prefix < DEEP)) & (np.arange(lag, len(ids)) >= new)
            at = np.nonzero(hit)[0]
            left.append(ids[at])
            right.append(ids[at + lag])
        kept_ids, kept_labels = ids[-WINDOW:], labels[-WINDOW:]
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
        if len(pairs):
            columns = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(len(pairs), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "crowd"])
        keys = big[:, : MIN_DEPTH + 1]
        cuts = [0, *(np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if low == 0 or high == len(keys) or high - low > COVERED:
                key = keys[low].tobytes()
                if key == open_key:
                    open_run.append(fresh[low:high])
                    continue
                if open_key is not None:
                    if opened_first or sum(map(len, open_run)) > COVERED:
                        yield crowd(open_key, open_run)
                    opened_first = False
                open_key, open_run = key, [fresh[low:high]]
    if open_key is not None:
        yield crowd(open_key, open_run)


def _orders(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Every document once per order, with the order's number and label."""
    labels = _labels(batch.column(1)).reshape(-1, DEPTH)
    trees = np.tile(np.arange(TREES, dtype=">u2"), batch.num_rows)[:, None]
    ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), TREES)
    return pa.RecordBatch.from_arrays([binary(np.hstack([trees, labels]).astype(">u2")), pa.array(ids)], ["label", "id"])


def candidates(representatives: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """(a, b, estimate) of neighbours in the forest whose hashes agree often enough, and the crowds (crowd, id);
    ``representatives``: (id, labels). Only the low bytes of the hashes travel with the pairs: what agrees agrees in them."""
    spark = representatives.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = arrow_map(representatives.select("id", "labels"), _orders, "label binary, id long")
    met = stage(
        orders.repartitionByRange(parts, "label", "id")
        .sortWithinPartitions("label", "id")
        .mapInArrow(_neighbours, "a long, b long, crowd binary")
        .distinct()
    )
    signed = representatives.select("id", F.substring("labels", TREES * DEPTH + 1, TREES * DEPTH).alias("labels"))
    both = (
        met.filter("crowd is null")
        .select("a", "b")
        .join(signed.withColumnsRenamed({"id": "a", "labels": "left"}), "a")
        .join(signed.withColumnsRenamed({"id": "b", "labels": "right"}), "b")
        .select("a", "b", "left", "right")
    )

    def estimate(batch: pa.RecordBatch) -> pa.RecordBatch:
        share = (matrix(batch.column(2), "u1") == matrix(batch.column(3), "u1")).mean(axis=1)
        keep = pa.array(share >= ESTIMATE)
        columns = [batch.column(0), batch.column(1), pa.array(share)]
        return pa.RecordBatch.from_arrays([c.filter(keep) for c in columns], ["a", "b", "estimate"])

    crowds = met.filter("crowd is not null").select("crowd", F.col("a").alias("id"))
    return stage(arrow_map(both, estimate, "a long, b long, estimate double")), crowds


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingle_set(text) for text in batch.column(1).to_pylist()]
    offsets = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
    array = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets).view(np.int64)))
    return pa.RecordBatch.from_arrays([batch.column(0), _keys(sets), array], ["first_id", "set_key", "shingles"])


def _keys(sets: list[np.ndarray]) -> pa.Array:
    """Equal keys for equal sets; none for empty sets."""
    return pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())


def _confirm(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose full sets are similar: 100 * intersection >= similarity * union."""
    common = F.size(F.array_intersect("left", "right"))
    return (
        pairs.select("a", "b")
        .join(sets.withColumnsRenamed({"id": "a", "shingles": "left"}), "a")
        .join(sets.withColumnsRenamed({"id": "b", "shingles": "right"}), "b")
        .select("a", "b", common.alias("common"), (F.size("left") + F.size("right")).alias("sizes"))
        .filter(100 * F.col("common") >= similarity * (F.col("sizes") - F.col("common")))
        .select("a", "b")
    )


def _prefixes(sets: list[np.ndarray], orders: int) -> np.ndarray:
    """Each set's prefix of ``MIN_DEPTH`` hashes in every one of the first orders, as one number each."""
    functions = [order * DEPTH + depth for order in range(orders) for depth in range(MIN_DEPTH)]
    hashes = minhashes(sets, functions).reshape(len(sets), orders, MIN_DEPTH).astype(np.int64)
    numbers = np.zeros((len(sets), orders), np.int64)
    for depth in range(MIN_DEPTH):
        numbers = numbers << 16 | hashes[:, :, depth]
    return numbers


def _met_before(sets: list[np.ndarray], order: int) -> np.ndarray:
    """Pairs of sets that share a prefix in an order before this one: they are compared there."""
    prefixes = _prefixes(sets, order)
    met = np.zeros((len(sets), len(sets)), bool)
    for earlier in range(order):
        met |= prefixes[:, None, earlier] == prefixes[None, :, earlier]
    return met


def _compared(similarity: int):
    """Links between the rows of two blocks of a crowd that lie in different groups, as many as connect them. A pair is
    compared in the first order in which it meets."""

    def links(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        ids, groups, blocks = (rows.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5))
        same = groups[:, None] == groups[None, :]
        due = ~same
        if blocks.min() != blocks.max():
            due &= blocks[:, None] != blocks[None, :]
        lists = rows.column(6)
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        if due.any():
            shingles = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            due &= ~_met_before(np.split(shingles, np.cumsum(sizes)[:-1]), int.from_bytes(rows.column(0)[0].as_py()[:2], "big"))
        if not due.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(ids)), sizes)
        _, column, times = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
        # A shingle of one row only is common to no pair.
        place = np.cumsum(times > 1) - 1
        shared = times[column] > 1
        owner, column = owner[shared], place[column[shared]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((len(ids), len(ids)), np.int64)
        for low in range(0, int((times > 1).sum()), BLOCK_COLUMNS):
            some = slice(*np.searchsorted(column, [low, low + BLOCK_COLUMNS]))
            holds = np.zeros((len(ids), BLOCK_COLUMNS), np.float32)
            holds[owner[some], column[some] - low] = 1
            common += (holds @ holds.T).astype(np.int64)
        linked = due & (100 * common >= similarity * (sizes[:, None] + sizes[None, :] - common))
        near = linked | same
        a, b = [], []
        unseen = np.ones(len(ids), bool)
        for seed in range(len(ids)):
            front = np.array([seed]) if unseen[seed] else np.empty(0, np.int64)
            unseen[front] = False
            while len(front):
                reached = np.nonzero(near[front].any(axis=0) & unseen)[0]
                # Rows of a group already reached need no link of their own.
                parent = front[linked[np.ix_(front, reached)].argmax(axis=0)]
                by_link = linked[parent, reached] & ~same[np.ix_(front, reached)].any(axis=0)
                a.append(ids[parent[by_link]])
                b.append(ids[reached[by_link]])
                unseen[reached] = False
                front = reached
        return np.concatenate([np.empty(0, np.int64), *a]), np.concatenate([np.empty(0, np.int64), *b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            if not rows.num_rows:
                continue
            low, high = (rows.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            crowd = np.array(rows.column(0).to_pylist(), object)
            cut = (np.diff(low) != 0) | (np.diff(high) != 0) | (crowd[1:] != crowd[:-1])
            cuts = [0, *(np.nonzero(cut)[0] + 1).tolist()]
            held = rows.slice(cuts[-1])
            for start, end in zip(cuts, cuts[1:], strict=False):
                yield out(rows.slice(start, end - start))
        if held is not None and held.num_rows:
            yield out(held)

    def out(rows: pa.RecordBatch) -> pa.RecordBatch:
        a, b = links(rows)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    return run


def _crowd_links(crowds: DataFrame, groups: DataFrame, sets: DataFrame, stage: Stage, similarity: int) -> DataFrame:
    """Links (a, b) that connect all groups of a crowd that any link of its rows connects.

    Every pair of a crowd's rows is compared on the full sets unless both are in one group or met in an earlier order. A crowd
    that fits a block is one, so that each of its rows travels once; of larger ones, the largest group's rows meet only others.
    """
    parts = int(crowds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = stage(
        crowds.join(groups, "id", "left")
        .join(sets.select("id", F.size("shingles").cast("long").alias("size")), "id")
        .select("crowd", "id", F.coalesce("component_id", "id").alias("group"), "size")
    )
    by_group = members.groupBy("crowd", "group").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("shingles"))
    largest = F.max_by(F.struct("group", "rows", "shingles"), F.struct("rows", "group"))
    crowded = by_group.groupBy("crowd").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"), largest.alias("largest")
    )

    def blocks(rows, shingles):
        return F.ceil(F.greatest(rows / BLOCK_ROWS, shingles / BLOCK_SHINGLES)).cast("int")

    fits = (F.col("rows") <= BLOCK_ROWS) & (F.col("shingles") <= BLOCK_SHINGLES)
    crowded = stage(
        crowded.filter("groups > 1").select(
            "crowd",
            F.col("largest.group").alias("first_group"),
            F.when(fits, 0).otherwise(blocks(F.col("largest.rows"), F.col("largest.shingles"))).alias("inner"),
            F.when(fits, 1)
            .otherwise(blocks(F.col("rows") - F.col("largest.rows"), F.col("shingles") - F.col("largest.shingles")))
            .alias("outer"),
        )
    )
    inside = (F.col("inner") > 0) & (F.col("group") == F.col("first_group"))
    spread = F.xxhash64("id", F.lit("block"))
    block = F.when(inside, F.pmod(spread, F.greatest("inner", F.lit(1)))).otherwise(F.col("inner") + F.pmod(spread, "outer")).cast("int")
    others = F.sequence(F.when(inside, F.col("inner")).otherwise(F.lit(0)), F.col("inner") + F.col("outer") - 1)
    dealt = (
        members.join(crowded, "crowd")
        .select("crowd", "id", "group", block.alias("block"), F.explode(others).alias("other"))
        .select("crowd", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "id", "group", "block")
    )
    keys = ["crowd", "low", "high"]
    # Renamed as in ``_confirm``, whose shuffle of the sets serves here too.
    rows = dealt.withColumnRenamed("id", "member").join(sets.withColumnsRenamed({"id": "member", "shingles": "held"}), "member")
    rows = rows.select(*keys, "member", "group", "block", "held")
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(_compared(similarity), "a long, b long")


def near_duplicates(docs: DataFrame, stage: Stage | None = None, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text; other columns are ignored).

    Documents link when 100 * intersection >= ``similarity`` * union of their sets of five-word shingles; the group is
    named by its smallest doc_id, whose row is kept. Equal sets are one class, compared once; classes meet
    in an LSH forest and are confirmed on their full sets. A first pass confirms each class's two best candidates; the rest
    is confirmed where the two sides are not yet connected. Where more classes share a prefix than are looked at as
    neighbours, all of them are compared in blocks, each pair in the first order in which it meets and only if it is not yet in
    one group. So every pair that shares a prefix in any order is either confirmed, refuted or between classes already in one
    group.

    Null and empty texts have an empty set and link with nothing. Rows without doc_id link with nothing, have no
    component and are kept. Repeated rows are copies of each other; each of them is returned. Rows of one doc_id
    with different texts share the id's group, and so do the copies of each of these texts. An empty table gives no row.
    """
    stage = stage or Stage(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    features = stage(
        arrow_map(source, _features, "doc_id long, n_shingles long, set_key binary, labels binary")
    )
    known = features.filter("doc_id is not null and set_key is not null")
    classes = known.groupBy("set_key").agg(F.min("doc_id").alias("first_id"))
    # Classes have numbers of their own: an id may come with several texts.
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()))
    # Rows of one class and id are told apart where the join has brought them together, without another shuffle.
    representatives = stage(
        known.join(classes.withColumnRenamed("first_id", "doc_id"), ["set_key", "doc_id"])
        .dropDuplicates(["set_key", "doc_id"])
        .select("id", "labels")
    )
    key = F.xxhash64("set_key")
    several = known.groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high")).filter("low <> high")
    held = known.join(several, "doc_id", "left_semi").select("doc_id", "set_key").distinct().join(classes, "set_key")
    one_id = stage(held.select("id", F.min("id").over(Window.partitionBy("doc_id")).alias("b")).filter("id <> b").withColumnRenamed("id", "a"))

    pairs, crowds = candidates(representatives, stage)
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).union(crowds.select("id")).distinct()
    wanted = stage(classes.join(wanted, "id", "left_semi"))
    texts = source.join(wanted.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = stage(
        arrow_map(texts.select("doc_id", "text"), _sets, "first_id long, set_key binary, shingles array<long>")
        .join(wanted, ["first_id", "set_key"])
        .dropDuplicates(["first_id", "set_key"])
        .select("id", "shingles")
    )

    ends = pairs.select(F.col("a").alias("id"), "a", "b", "estimate").unionByName(
        pairs.select(F.col("b").alias("id"), "a", "b", "estimate")
    )
    best = Window.partitionBy("id").orderBy(F.desc("estimate"), "a", "b")
    first = stage(
        ends.withColumn("place", F.row_number().over(best)).filter("place <= 2").select("a", "b").distinct()
    )
    links = stage(_confirm(first, sets, similarity).unionByName(one_id))
    groups = stage(components(links, stage))
    a = groups.select(F.col("id").alias("a"), F.col("component_id").alias("group_a"))
    b = groups.select(F.col("id").alias("b"), F.col("component_id").alias("group_b"))
    left = (
        pairs.join(first, ["a", "b"], "left_anti")
        .join(a, "a", "left")
        .join(b, "b", "left")
        .filter(~F.coalesce(F.col("group_a") == F.col("group_b"), F.lit(False)))
        .select("a", "b")
    )
    crowded = _crowd_links(crowds, groups, sets, stage, similarity)
    more = stage(_confirm(left, sets, similarity).unionByName(crowded).distinct())
    if not more.isEmpty():
        groups = components(links.unionByName(more), stage)
    members = stage(classes.join(groups, "id", "left").withColumn("group", F.coalesce("component_id", "id")).drop("component_id"))
    # A group is named by its smallest id; minima are written before they are joined, so a large group can be split.
    smallest = stage(members.groupBy("group").agg(F.min("first_id").alias("component_id")))
    named = stage(members.join(smallest, "group").select("set_key", "component_id"))
    return (
        features.select("doc_id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
