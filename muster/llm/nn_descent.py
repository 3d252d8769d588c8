"""Embedding near-duplicates by NN-descent: a neighbour graph refined through neighbours of neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from muster.llm.common import Stage, arrow_map, binary
from muster.llm.graph import components

SIMILARITY = 0.98
#: Neighbours a list begins with, and how often a saturated list is doubled in one run.
LIST, MOST_DOUBLINGS = 10, 4
#: The first graph: orders by random hyperplanes, signs in each order's key, and rows compared in one stretch of an order.
ORDERS, SIGNS, STRETCH = 8, 24, 96
#: Descent at one width of the lists ends when a round changes fewer than this share of list places, or after so many rounds.
CHANGED, MOST_ROUNDS = 0.01, 6
#: The recall that the audit asks for, and how often the graph is widened by new orders until it is reached.
RECALL, MOST_WIDENINGS = 0.999, 3
#: Seeds of the audit's orders begin here.
AUDIT_SEED = 500
#: Vectors of one block when the links inside a group are counted, and when all vectors of a label are compared.
GROUP_BLOCK, LABEL_BLOCK = 128, 512

#: Rows for the lists, and links (``link`` = 1) that connect what any computed pair connects.
_EDGE = "v long, u long, cos double, link int"
_NAMES = ["v", "u", "cos", "link"]


def _valid(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows whose vectors have a direction, as unit vectors in double precision."""
    rows, units = [], []
    for i, vector in enumerate(batch.column(2).to_pylist()):
        if vector and None not in vector:
            x = np.array(vector, np.float64)
            with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                largest = np.abs(x).max()
                scaled = x / largest if np.isfinite(largest) and largest > 0 else None
            if scaled is not None and np.isfinite(x).all():
                rows.append(i)
                units.append((scaled / np.linalg.norm(scaled)).tobytes())
    at = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(at), batch.column(1).take(at), pa.array(units, pa.binary())], ["vec_id", "label", "unit"]
    )


def _units(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(unit, np.float64) for unit in column.to_pylist()]


def _planes(seed: int, dims: int) -> np.ndarray:
    return np.random.default_rng([seed, dims]).standard_normal((dims, SIGNS))


def _orders(seed: int):
    """Every vector once per order, with the signs of its projections as the order's key."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        units = _units(batch.column(2))
        keys = np.zeros((len(units), ORDERS, 4), np.uint8)
        dims = np.array([len(u) for u in units])
        for size in set(dims.tolist()):
            rows = np.nonzero(dims == size)[0]
            some = np.stack([units[i] for i in rows])
            for order in range(ORDERS):
                keys[rows, order, 0] = order
                keys[rows, order, 1:] = np.packbits(some @ _planes(1000 * seed + order, size) > 0, axis=1)
        again = pa.array(np.repeat(np.arange(len(units)), ORDERS))
        columns = [binary(keys.reshape(-1, 4)), *(batch.column(i).take(again) for i in range(3))]
        return pa.RecordBatch.from_arrays(columns, ["sort_key", "id", "label", "unit"])

    return run


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in stretches of ``size``, each beginning with the second half of the one before."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        rows = batch if held is None else pa.concat_batches([held, batch])
        at = 0
        while rows.num_rows - at >= size:
            yield rows.slice(at, size)
            at += size // 2
        held = rows.slice(at)
    if held is not None and held.num_rows:
        yield held


def _top(ids: np.ndarray, cosines: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's ``width`` best columns; a cosine of -2 is no neighbour."""
    width = min(width, len(ids) - 1)
    best = np.argpartition(-cosines, width - 1, axis=1)[:, :width]
    found = np.take_along_axis(cosines, best, 1)
    v = np.repeat(ids, width)
    keep = found.reshape(-1) > -2
    return v[keep], ids[best].reshape(-1)[keep], found.reshape(-1)[keep]


def _cosines(units: list[np.ndarray], labels: pa.Array | None = None) -> np.ndarray:
    """Cosines of all rows; -2 with itself, other labels and other dimensions."""
    sizes = np.array([len(u) for u in units])
    out = np.full((len(units), len(units)), -2.0)
    for size in set(sizes.tolist()):
        rows = np.nonzero(sizes == size)[0]
        some = np.stack([units[i] for i in rows])
        out[np.ix_(rows, rows)] = some @ some.T
    if labels is not None:
        # Places in the list of different labels: equal where, and only where, the labels are.
        kinds = labels.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        out[kinds[:, None] != kinds[None, :]] = -2
    np.fill_diagonal(out, -2)
    return out


def _spanning(ids: np.ndarray, cosines: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs with a cosine of ``similarity`` or more, as many as connect all rows that they connect."""
    near = cosines >= similarity
    v, u = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    unseen = near.any(axis=1)
    for seed in range(len(ids)):
        front = np.array([seed] if unseen[seed] else [], np.int64)
        unseen[front] = False
        while len(front):
            reached = np.nonzero(near[front].any(axis=0) & unseen)[0]
            v.append(front[near[np.ix_(front, reached)].argmax(axis=0)])
            u.append(reached)
            unseen[reached] = False
            front = reached
    a, b = np.concatenate(v), np.concatenate(u)
    return ids[a], ids[b], cosines[a, b]


def _both(ids: np.ndarray, cosines: np.ndarray, width: int, similarity: float) -> list:
    """The rows' best neighbours, then the links."""
    return [(*_top(ids, cosines, width), 0), (*_spanning(ids, cosines, similarity), 1)]


def _stretches(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, STRETCH):
            if rows.num_rows > 1:
                cosines = _cosines(_units(rows.column(2)), rows.column(1))
                yield _edges(_both(rows.column(0).to_numpy(zero_copy_only=False), cosines, LIST // 2, similarity))

    return run


def _first_graph(vectors: DataFrame, seed: int, similarity: float) -> DataFrame:
    """Neighbours that lie near each other in orders by random hyperplanes."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = vectors.schema["label"].dataType.simpleString()
    orders = arrow_map(vectors.select("id", "label", "unit"), _orders(seed), f"sort_key binary, id long, label {kind}, unit binary")
    # The row's own hash breaks ties, so equal keys spread over tasks and stretches.
    tie = F.xxhash64("id", F.lit(seed))
    keys = [F.col("label"), F.col("sort_key"), tie]
    return (
        orders.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select("id", "label", "unit")
        .mapInArrow(_stretches(similarity), _EDGE)
    )


def _lists(edges: DataFrame, widths: DataFrame | None) -> DataFrame:
    """Each vector's best neighbours, as many as its list holds."""
    best = Window.partitionBy("v").orderBy(F.desc("cos"), "u")
    ranked = edges.groupBy("v", "u").agg(F.max("cos").alias("cos"), F.max("fresh").alias("fresh"))
    ranked = ranked.withColumn("place", F.row_number().over(best))
    if widths is None:
        return ranked.filter(F.col("place") <= LIST)
    ranked = ranked.join(widths, "v", "left")
    return ranked.filter(F.col("place") <= F.coalesce("width", F.lit(LIST))).drop("width")


def _around(similarity: float):
    """Among the neighbours of one vector, each one's best few and the links that connect them; rows come sorted by that vector."""

    def joined(rows: pa.RecordBatch) -> list:
        if rows.num_rows < 2:
            return []
        cosines = _cosines(_units(rows.column(2)))
        return _both(rows.column(1).to_numpy(zero_copy_only=False), cosines, LIST // 2, similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            centres = rows.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.nonzero(np.diff(centres))[0] + 1).tolist()]
            held = rows.slice(cuts[-1])
            found = [e for low, high in zip(cuts, cuts[1:], strict=False) for e in joined(rows.slice(low, high - low))]
            if found:
                yield _edges(found)
        if held is not None:
            found = joined(held)
            if found:
                yield _edges(found)

    return run


def _edges(found: list) -> pa.RecordBatch:
    v, u, c = (np.concatenate(x) for x in list(zip(*found, strict=True))[:3])
    link = np.repeat([e[3] for e in found], [len(e[0]) for e in found]).astype(np.int32)
    order = np.lexsort((u, v, link))
    first = np.append(True, (np.diff(v[order]) != 0) | (np.diff(u[order]) != 0) | (np.diff(link[order]) != 0))[: len(v)]
    at = order[first]
    return pa.RecordBatch.from_arrays([pa.array(v[at]), pa.array(u[at]), pa.array(c[at]), pa.array(link[at])], _NAMES)


def _descend(lists: DataFrame, vectors: DataFrame, widths: DataFrame | None, round_: int, similarity: float) -> DataFrame:
    """Neighbours of neighbours: both directions of each list, where one side of a pair is fresh, compared around
    each vector. A vector that is in many lists is joined through a draw of them, twice as wide as its own list."""
    both = lists.select("v", "u", "fresh").unionByName(lists.select(F.col("u").alias("v"), F.col("v").alias("u"), "fresh"))
    both = both.groupBy("v", "u").agg(F.max("fresh").alias("fresh"))
    draw = Window.partitionBy("v").orderBy(F.desc("fresh"), F.xxhash64("u", "v", F.lit(round_)))
    drawn = both.withColumn("place", F.row_number().over(draw))
    if widths is None:
        drawn = drawn.filter(F.col("place") <= 2 * LIST)
    else:
        drawn = drawn.join(widths, "v", "left").filter(F.col("place") <= 2 * F.coalesce("width", F.lit(LIST))).drop("width")
    fresh = drawn.groupBy("v").agg(F.max("fresh").alias("any")).filter("any = 1").select("v")
    wanted = drawn.join(fresh, "v", "left_semi").select("v", "u")
    units = vectors.select(F.col("id").alias("u"), "unit")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    around = wanted.join(units, "u").select("v", "u", "unit").repartition(parts, "v").sortWithinPartitions("v", "u")
    return around.mapInArrow(_around(similarity), _EDGE)


def _audit(fresh: DataFrame, groups: DataFrame) -> tuple[float, int]:
    """Of the links that fresh orders find by themselves, the share whose ends the graph connects, and their number.

    Orders are independent: what the graph misses, they meet with the same chance as what it holds. Without any link there
    is nothing to judge by; the share is 1 and its evidence 0.
    """
    a = groups.select(F.col("id").alias("a"), F.col("component_id").alias("group_a"))
    b = groups.select(F.col("id").alias("b"), F.col("component_id").alias("group_b"))
    met = F.coalesce((F.col("group_a") == F.col("group_b")).cast("int"), F.lit(0))
    row = fresh.join(a, "a", "left").join(b, "b", "left").agg(F.count(F.lit(1)), F.sum(met)).first()
    return (row[1] / row[0] if row[0] else 1.0), row[0]


def _count_inside(vectors: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """(id, linked): copies behind all classes that an id links with, counted over pairs of blocks of its group."""
    sizes = groups.groupBy("component_id").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("blocks"))
    placed = groups.join(sizes, "component_id").withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")
    )
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = vectors.select("id", "label", "copies", "unit").join(
        placed.select("id", "component_id", "block", F.explode(others).alias("other")), "id"
    )
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    dealt = dealt.select("component_id", low, high, "block", "id", "copies", "unit", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            keys = np.stack([rows.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            cuts = [0, *(np.nonzero((np.diff(keys, axis=0) != 0).any(axis=1))[0] + 1).tolist()]
            held = rows.slice(cuts[-1])
            for start, end in zip(cuts, cuts[1:], strict=False):
                yield counted(rows.slice(start, end - start))
        if held is not None and held.num_rows:
            yield counted(held)

    def counted(rows: pa.RecordBatch) -> pa.RecordBatch:
        blocks = rows.column(3).to_numpy(zero_copy_only=False)
        one_block = rows.column(1)[0].as_py() == rows.column(2)[0].as_py()
        copies = rows.column(5).to_numpy(zero_copy_only=False)
        linked = _cosines(_units(rows.column(6)), rows.column(7)) >= similarity
        if not one_block:
            linked &= blocks[:, None] != blocks[None, :]
        return pa.RecordBatch.from_arrays([rows.column(4), pa.array((linked * copies[None, :]).sum(axis=1).astype(np.int64))], ["id", "linked"])

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["component_id", "low", "high"]
    return (
        dealt.repartition(parts, *keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(run, "id long, linked long")
        .groupBy("id")
        .agg(F.sum("linked").alias("linked"))
    )


def _compare_all(vectors: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """Links (v, u) that connect all that is linked: every pair of a label's vectors is compared, in blocks, unless both
    are in the label's largest group."""
    members = vectors.select("id", "label").join(groups, "id", "left").select("id", "label", F.coalesce("component_id", "id").alias("group"))
    sizes = members.groupBy("label", "group").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max_by(F.struct("group", "n"), F.struct("n", "group")).alias("largest")
    labels = sizes.groupBy("label").agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"), largest).filter("groups > 1")
    labels = labels.select(
        "label",
        F.col("largest.group").alias("first_group"),
        F.ceil(F.col("largest.n") / LABEL_BLOCK).cast("int").alias("inner"),
        F.ceil((F.col("n") - F.col("largest.n")) / LABEL_BLOCK).cast("int").alias("outer"),
    )
    inside, spread = F.col("group") == F.col("first_group"), F.xxhash64("id", F.lit("all"))
    block = F.when(inside, F.pmod(spread, "inner")).otherwise(F.col("inner") + F.pmod(spread, "outer")).cast("int")
    others = F.sequence(F.when(inside, F.col("inner")).otherwise(F.lit(0)), F.col("inner") + F.col("outer") - 1)
    dealt = members.join(labels, "label").select("id", block.alias("block"), F.explode(others).alias("other"))
    pair = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    rows = dealt.select("id", *pair).join(vectors.select("id", "label", "unit"), "id").select("label", "low", "high", "id", "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            keys = list(zip(*(rows.column(i).to_pylist() for i in range(3)), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1])]
            held = rows.slice(cuts[-1])
            for start, end in zip(cuts, cuts[1:], strict=False):
                yield linked(rows.slice(start, end - start))
        if held is not None and held.num_rows:
            yield linked(held)

    def linked(rows: pa.RecordBatch) -> pa.RecordBatch:
        cosines = _cosines(_units(rows.column(4)))
        v, u, _ = _spanning(rows.column(3).to_numpy(zero_copy_only=False), cosines, similarity)
        return pa.RecordBatch.from_arrays([pa.array(v), pa.array(u)], ["v", "u"])

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["label", "low", "high"]
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, "v long, u long")


def near_duplicates(embeddings: DataFrame, stage: Stage | None = None, similarity: float = SIMILARITY) -> DataFrame:
    """(vec_id, n_links, component_id, kept, audit_recall, audit_links) of every row of ``embeddings`` (vec_id, label, embedding).

    Two vectors link if their labels are equal and not null and their cosine in double precision is ``similarity`` or more.
    Equal vectors of a label are one class, compared once. Classes get neighbour lists from stretches of random
    orders; rounds of neighbours of neighbours refine them; lists full of links are doubled and the rounds go on;
    then edges under the threshold go. Whatever tasks compare, links that connect the same vectors are kept beside the
    lists. An audit finds links in orders that the graph has not seen: while it does not connect them, these and new orders widen
    it, and at last each label is compared in full. ``audit_recall`` is the share that was connected before the audit's own links
    came in, ``audit_links`` the number of links it is judged by. Inside each connected group links are counted over all its
    pairs in blocks, so lists never bound the count.

    Vectors that are null, empty, zero or have null or non-finite components, those without label and those without id
    link with nothing; they are kept, and without id their component is null. Vectors of different dimensions do not
    link. Repeated rows are linked copies. Where one id comes with several vectors, each row counts its own links and all share
    one component. Other columns are not read; an empty table gives no row. A vector is held whole, a few hundred at a time.
    """
    spark = embeddings.sparkSession
    stage = stage or Stage(spark)
    source = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    kind = source.schema["label"].dataType.simpleString()
    valid = source.filter("vec_id is not null and label is not null and embedding is not null")
    units = stage(arrow_map(valid, _valid, f"vec_id long, label {kind}, unit binary"))
    classes = units.groupBy("label", "unit").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    # Classes have numbers of their own: an id may come with several vectors.
    vectors = stage(classes.withColumn("id", F.monotonically_increasing_id()))
    held = stage(units.join(vectors.select("label", "unit", "id"), ["label", "unit"]).select("vec_id", "id").distinct())
    of_one_id = held.groupBy("vec_id").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    same_id = stage(held.join(of_one_id, "vec_id").filter("id <> b").select(F.col("id").alias("a"), "b"))

    widths = None
    links, recall, evidence = same_id, 0.0, 0

    def links_of(made: DataFrame) -> DataFrame:
        return made.filter("link = 1").select(F.greatest("v", "u").alias("a"), F.least("v", "u").alias("b")).distinct()

    def kept_links(made: DataFrame) -> DataFrame:
        return stage(links.unionByName(links_of(made)).distinct())

    made = stage(_first_graph(vectors, 0, similarity))
    links = kept_links(made)
    first = made.filter("link = 0").drop("link").withColumn("fresh", F.lit(1))
    lists = stage(_lists(first, widths))
    doublings = rounds = 0
    while True:
        old = lists.select("v", "u", "cos", F.lit(0).alias("fresh"))
        made = stage(_descend(lists, vectors, widths, rounds + MOST_ROUNDS * doublings, similarity))
        links = kept_links(made)
        new = made.filter("link = 0").drop("link").withColumn("fresh", F.lit(1))
        # What a list already holds is not fresh: the old row wins.
        known = old.unionByName(new).groupBy("v", "u").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh"))
        merged = stage(_lists(known, widths))
        counts = merged.agg(F.count(F.lit(1)), F.sum("fresh")).first()
        lists = merged
        rounds += 1
        if (counts[1] or 0) <= CHANGED * (counts[0] or 1) or rounds == MOST_ROUNDS:
            full = lists.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("cos").alias("least"))
            if widths is not None:
                full = full.join(widths, "v", "left")
            width = F.coalesce("width", F.lit(LIST)) if widths is not None else F.lit(LIST)
            saturated = full.filter((F.col("n") >= width) & (F.col("least") >= similarity))
            grown = stage(saturated.select("v", (2 * width).cast("int").alias("width")))
            if doublings == MOST_DOUBLINGS or grown.isEmpty():
                break
            widths = grown if widths is None else stage(
                widths.unionByName(grown).groupBy("v").agg(F.max("width").alias("width"))
            )
            lists = lists.withColumn("fresh", F.lit(1))
            doublings, rounds = doublings + 1, 0
    edges = lists.filter(F.col("cos") >= similarity).select(F.col("v").alias("a"), F.col("u").alias("b"))
    links = stage(links.unionByName(edges).distinct())
    groups = stage(components(links, stage))
    for widening in range(1 + MOST_WIDENINGS):
        fresh = stage(links_of(_first_graph(vectors, AUDIT_SEED + widening, similarity)))
        recall, evidence = _audit(fresh, groups)
        if recall < 1:
            links = stage(links.unionByName(fresh).distinct())
            groups = stage(components(links, stage))
        if recall >= RECALL:
            break
    else:
        rest = _compare_all(vectors, groups, similarity).select(F.col("v").alias("a"), F.col("u").alias("b"))
        groups = stage(components(stage(links.unionByName(rest)), stage))
        recall = 1.0

    linked = _count_inside(vectors, groups, similarity)
    members = stage(
        vectors.select("id", "label", "unit", "copies", "first_id")
        .join(groups, "id", "left")
        .join(linked, "id", "left")
        .select(
            "label",
            "unit",
            "first_id",
            F.coalesce("component_id", "id").alias("group"),
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    # A group is named by its smallest id; minima are written before they are joined, so a large group can be split.
    smallest = stage(members.groupBy("group").agg(F.min("first_id").alias("component_id")))
    named = stage(members.join(smallest, "group").select("label", "unit", "component_id", "n_links"))
    found = units.join(named, ["label", "unit"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    # All other rows stand alone.
    alone = arrow_map(
        source.select("vec_id", "label", "embedding"), _invalid, "vec_id long"
    ).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).select(
        "vec_id",
        "n_links",
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        F.lit(float(recall)).alias("audit_recall"),
        F.lit(int(evidence)).cast("long").alias("audit_links"),
    )


def _invalid(batch: pa.RecordBatch) -> pa.RecordBatch:
    labels, ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
    numbered = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(1), batch.column(2)], ["n", "label", "embedding"])
    ok = set(_valid(numbered).column(0).to_pylist())
    rows = [i for i in range(batch.num_rows) if i not in ok or labels[i] is None or ids[i] is None]
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64()))], ["vec_id"])
