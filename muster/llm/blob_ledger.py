"""Secret scans with a ledger: every version of a text is content-addressed, and only unseen pairs of blob and rule
version are scanned. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from muster.llm.common import Stage


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches count if their ``group`` has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0


#: The three base patterns and their lengths. A match of the last two takes its whole run of characters, so runs that are
#: too short are left out by the pattern itself; a match of the first that is too short still takes its text.
BASE = (
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        2,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 16),
)
#: Further kinds, after the base ones: the head of a private key, and a password inside an address.
FURTHER = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 1),
    Rule("url", 1, r"://[A-Za-z0-9._-]{1,64}:[^\x00-\x20@/:]{6,128}@", 1),
)
RULES = BASE + FURTHER

LEDGER = "blob binary, kind string, version int, spans array<struct<start:int,rank:int,end:int,kind:string>>"
_NO_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


_MATCHES = "array<struct<gap:int,length:int,part:int>>"


def matches(text: Column, rule: Rule) -> Column:
    """A rule's matches in order: code points between it and the one before, its own, and those of the group that counts.

    Splitting at the pattern gives the texts between the matches. Texts without any match are told by one search.
    """
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    found = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(whole)), F.length).alias("gap"),
        F.transform(whole, F.length).alias("length"),
        F.transform(part, F.length).alias("part"),
    )
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(_MATCHES))


def placed(scanned: DataFrame) -> DataFrame:
    """``scanned`` (blob, kind, version, rank, least, matches) with the spans of the matches that count.

    A match begins where the lengths of all that lies before it add up to: a running sum over a text's matches, as long as they
    are many.
    """
    key = ["blob", "kind", "version"]
    none = scanned.filter(F.size("matches") == 0).select(*key, F.array().cast(_NO_SPANS).alias("spans"))
    each = scanned.select(*key, "rank", "least", F.posexplode("matches").alias("place", "match")).select(
        *key, "rank", "least", "place", "match.*"
    )
    so_far = Window.partitionBy(*key).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("length")).over(so_far).cast("int")
    span = F.struct((F.col("end") - F.col("length")).alias("start"), "rank", "end", "kind")
    found = each.withColumn("end", end).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.when(F.col("part") >= F.col("least"), span))).cast(_NO_SPANS).alias("spans")
    )
    return none.unionByName(found)


def address(text: Column) -> Column:
    """The content address of a text; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan(versions: DataFrame, paths: list[str], ledger: str, rules: tuple[Rule, ...] = RULES, stage: Stage | None = None) -> DataFrame:
    """``paths`` of every row of ``versions`` (text among its columns) with the spans found in its text.

    ``ledger`` is a folder in shared storage that grows with each run. A blob is scanned by a rule only if the ledger has no
    row for the blob, the rule's kind and its version; one row with that blob is read for it, whatever number of rows
    hold it. Findings are then joined to all paths.

    Null texts are empty texts. Null ids are paths like any other. Repeated rows are returned as often as they come, an empty table
    gives no row, and a path column may have any name but ``text``. Spans are sorted by start, then by the rule's place in ``rules``. A
    text's work grows with its length, however many matches it has.
    """
    spark = versions.sparkSession
    stage = stage or Stage(spark)
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(ledger)
    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])

    named = F.xxhash64(*[F.col(f"`{c}`") for c in paths])
    addressed = versions.select(named.alias("name"), F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", address(F.col("text")))
    held = addressed.groupBy("blob").agg(F.min("name").alias("name"))
    seen = spark.read.schema(LEDGER).parquet(ledger).groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
    due = F.array_except(current, F.coalesce("seen", F.array().cast("array<struct<kind:string,version:int>>")))
    unseen = stage(held.join(seen, "blob", "left").select("blob", "name", due.alias("due")).filter(F.size("due") > 0))

    # One row for each unseen blob: joined by blob and row, so copies spread over all tasks.
    texts = addressed.join(unseen, ["blob", "name"])
    rows = [
        F.struct(
            F.lit(r.kind).alias("kind"),
            F.lit(r.version).alias("version"),
            F.lit(rank).alias("rank"),
            F.lit(r.least).alias("least"),
            F.when(F.array_contains(F.transform(F.col("due"), lambda d: d["kind"]), r.kind), matches(F.col("text"), r)).alias("matches"),
        )
        for rank, r in enumerate(rules)
    ]
    scanned = texts.select("blob", F.explode(F.array(*rows)).alias("row")).select("blob", "row.*").filter("matches is not null")
    placed(stage(scanned.dropDuplicates(["blob", "kind", "version"]))).write.mode("append").parquet(ledger)

    wanted = reduce(or_, [(F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules])
    found = (
        spark.read.schema(LEDGER)
        .parquet(ledger)
        .filter(wanted & (F.size("spans") > 0))
        # A run that was repeated may have written a pair twice.
        .dropDuplicates(["blob", "kind", "version"])
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )
    found = stage(found.select("blob", F.array_sort(_ranked(F.col("spans"), rules)).alias("spans")))
    rows = versions.select(F.struct(*[F.col(f"`{c}`") for c in paths]).alias("row"), address(F.col("text")).alias("blob"))
    return rows.join(found, "blob", "left").select("row.*", F.coalesce("spans", F.array().cast(_NO_SPANS)).alias("spans"))


def _ranked(found: Column, rules: tuple[Rule, ...]) -> Column:
    """Ranks in ``rules``, which need not be the list that a ledger row was written with."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.transform(
        found,
        lambda s: F.struct(s["start"], (F.array_position(kinds, s["kind"]) - 1).cast("int").alias("rank"), s["end"], s["kind"]),
    )


def joined(found: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(found: DataFrame) -> DataFrame:
    """``found`` of ``scan`` with counts of the base kinds, the digest of the base spans and all spans as text."""
    base = F.filter(F.col("spans"), lambda s: s["rank"] < len(BASE))
    count = lambda kind: F.size(F.filter(F.col("spans"), lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        *[c for c in found.columns if c != "spans"],
        *[count(rule.kind).alias(f"n_{rule.kind}") for rule in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
