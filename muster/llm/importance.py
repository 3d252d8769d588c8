"""Importance resampling towards a target: hashed n-grams counted with Arrow kernels, Gumbel keys, a distributed top-k."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from muster.llm.common import Stage

#: Characters that part words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = "7"
#: Rows and bytes of text that a task works on at once; a longer text is a slice of its own.
SLICE_ROWS = 2000
SLICE_BYTES = 4 << 20


def portions(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut by rows and by bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        # A portion ends where its bytes or rows would pass the limit.
        low, held = 0, 0
        for at, size in enumerate(sizes.tolist()):
            if at > low and (held + size > SLICE_BYTES or at - low >= SLICE_ROWS):
                yield batch.slice(low, at - low)
                low, held = at, 0
            held += size
        if batch.num_rows > low:
            yield batch.slice(low)


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, bucket of each feature) of all runs of one or two words.

    Words are told apart once: a pair is two indices of the dictionary, and the digest of a pair goes on from that of its
    first word, once for every different pair.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    flat = pc.list_flatten(lists)
    parents = pc.list_parent_indices(lists)
    # Separators at the ends of a text leave empty words.
    full = pc.greater(pc.binary_length(flat), 0)
    flat, parents = flat.filter(full), parents.filter(full).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    indices = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary = coded.dictionary.cast(pa.binary()).to_pylist()
    single = np.fromiter(map(crc32, vocabulary), np.uint32, len(vocabulary))

    inside = parents[1:] == parents[:-1]
    pairs, which = np.unique((indices[:-1] * len(vocabulary) + indices[1:])[inside], return_inverse=True)
    first, second = np.divmod(pairs, max(len(vocabulary), 1))
    begun = [crc32(b" ", digest) for digest in single.tolist()]
    double = np.fromiter((crc32(vocabulary[b], begun[a]) for a, b in zip(first.tolist(), second.tolist(), strict=True)), np.uint32, len(pairs))

    counts = np.bincount(parents, minlength=len(texts)).astype(np.int64)
    owners = np.concatenate((parents, parents[1:][inside])).astype(np.int64)
    found = np.concatenate((single.take(indices), double.take(which))) % np.uint32(buckets)
    return counts, owners, found.astype(np.int64)


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, count) over all texts. A task adds its texts up first and gives at most one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in portions(batches):
            total += np.bincount(features(batch.column("text"), buckets)[2], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "count"])

    counted = docs.select("text").mapInArrow(run, "bucket int, count long")
    return counted.groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket: how much likelier the target's features fall into it. ``buckets`` numbers reach the driver."""

    def collected(df: DataFrame) -> np.ndarray:
        counts = np.zeros(buckets, np.float64)
        for row in bucket_counts(df, buckets).collect():
            counts[row["bucket"]] = row["count"]
        return counts

    s, t = collected(docs), collected(target)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row: the floored mean of its features' gains."""
    buckets = len(gain)
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            counts, owners, found = features(batch.column("text"), buckets)
            # Pairs come after single words: a stable sort brings the features of a text together.
            order = np.argsort(owners, kind="stable")
            each = np.bincount(owners, minlength=len(counts))
            sums = np.zeros(len(counts), np.int64)
            some = np.flatnonzero(each)
            if len(some):
                starts = np.concatenate(([0], np.cumsum(each[some])[:-1]))
                sums[some] = np.add.reduceat(sent.value.take(found[order]), starts)
            weight = np.where(each > 0, sums // np.maximum(each, 1), 0)
            arrays = [batch.column("doc_id"), *map(pa.array, (counts, each.astype(np.int64), weight))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u in (0, 1) from the id's digest; null counts as an empty number."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, stage: Stage) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ...) by falling ``score``, ties to the smaller ``doc_id``, null last.

    Rows are dealt out by ranges; equal keys are parted by a number of their own, so no range is one key's. A rank is the
    place within a range plus the rows of all ranges before, of which there is one sum a range.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("nth")]
    dealt = rows.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(dealt.drop("nth").withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33).cast("int")
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sums = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("count"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    return placed.withColumn("part", part).join(sums, "part").withColumn("rank", F.col("before") + within + 1).drop("part", "before", "place")


def resample(docs: DataFrame, target: DataFrame, stage: Stage | None = None, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text); ``target`` has texts.

    Drawn are ``percent`` in a hundred of the rows with ``least_words`` or more, those of highest score; others have no rank.
    Adding Gumbel noise to a log weight and taking the highest is sampling without replacement by weight.

    Null and empty texts have no feature, weight 0 and no rank. A null doc_id counts as an empty number and is the last of its
    ties. Repeated rows are scored and drawn apart. An empty table gives no row; an empty target gives all
    buckets the weight of an unseen one. Other columns are not read.
    """
    stage = stage or Stage(docs.sparkSession)
    scored = weighted(docs, gains(docs, target)).withColumn("score", F.col("weight") + gumbel(F.col("doc_id")))
    scored = stage(scored)
    eligible = F.col("n_words") >= least_words
    quota = scored.filter(eligible).count() * percent // 100
    drawn = ranked(scored.filter(eligible), stage)
    rank = F.when(F.col("rank") <= quota, F.col("rank"))
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return drawn.withColumn("rank", rank).unionByName(rest)
