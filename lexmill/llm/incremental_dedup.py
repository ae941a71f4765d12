"""New batches against all history: a segment index for edit distance over the string of an act.

The string of a record is ``date | number | figures``: the clean date, the clean decision number, and the figures of the
sentence of its summary that holds the most of them (they stay when sentences move, change words or go). Two strings
are of one act if

- date and number are equal, or
- one of date and number is lost in one of them and the other part and the figures are equal, or
- they are at most ``EDITS`` edits apart and all edits lie in the date or all in the number (mistyped). Edits in both are
  another act: a series of acts keeps its figures and goes on in number and day.

The index stores, for each accepted string, its number cut into ``EDITS + 1`` segments, each with its position and the
number's length, beside the unedited rest of the string; the date likewise; and the pairs of parts that must be equal where a
part is lost. A batch probes only the substrings of its own strings that can match a segment (the multi-match-aware
selection for edit distance, for all lengths within ``EDITS``), verifies what it meets with a bounded edit distance, and appends
its own segments. One of ``EDITS + 1`` segments is always left unedited, so no pair within the bound is missed.

The index is kept in a folder: entries partitioned by a hash of their key, of which a batch reads the partitions of its own keys
only; strings and the links between them are appended. What is accepted is never rewritten. (As the rest of the string is part of the key, strings
that share a key differ in the free part of one number or date alone: no key is shared by many.)

Equal strings are one entry, however many rows repeat them, so a hot act makes no hot group; strings that share a pair of
parts are linked to the earliest of them, never to each other.

Defined results: a row with fewer than two parts is never a repeat and is not indexed; a row that lost its number and one that
lost its date are not compared (they share the figures only); a row that is repeated within the batch counts as accepted once
the first is; ties cannot occur, as record ids are unique (of rows with an equal id one is kept); empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.registry_text import base, clean_date, clean_decision_number
from lexmill.llm.graph import components
from lexmill.session import scratch_path

PARTS = ("date", "number", "figures")
#: Greatest edit distance of two strings of one act; a mistyped part is cut into one segment more.
EDITS = 2
#: Partitions of the entries on disk; a parameter of the index, to be raised with its size.
BUCKETS = 16
#: Kinds of keys: pairs of parts, and segments of the number and of the date.
PAIRS = {0: ("date", "number"), 1: ("date", "figures"), 2: ("number", "figures")}
SLIPS = {3: ("number", "date"), 4: ("date", "number")}
ENTRY = "kind int, key long, part string, first long, load int, bucket int"
STRING = "date string, number string, figures string, first long, load int"
LINK = "a long, b long, load int"


def figures_of(summary: Column) -> Column:
    """The figures of the sentence that holds the most (the first of equals), in order: ``316.36``. Null where there is none."""

    def read(t: Column) -> Column:
        sentences = F.transform(F.split(t, r"[.!?](?=\s|$)"), lambda s: F.regexp_extract_all(s, F.lit(r"(\d+)"), F.lit(1)))
        most = F.aggregate(sentences, F.array().cast("array<string>"), lambda a, b: F.when(F.size(b) > F.size(a), b).otherwise(a))
        return F.when(F.size(most) > 0, F.array_join(most, "."))

    # digits of other kinds are folded only where there are any
    return F.when(summary.rlike(r"[\p{Nd}\p{No}&&[^0-9]]"), read(base(summary))).otherwise(read(summary))


def act_parts(df: DataFrame, rec: str = "rec_id", number: str = "decision_number", date: str = "decision_date", summary: str = "violation_summary") -> DataFrame:
    """``rec, date, number, figures`` of each record."""
    q = lambda c: F.col(f"`{c}`")
    return df.select(q(rec).alias("rec"), clean_date(q(date)).alias("date"), clean_decision_number(q(number)).alias("number"), figures_of(q(summary)).alias("figures"))


def strings(parts: DataFrame) -> DataFrame:
    """Distinct strings of at least two parts with ``first``, the least record that has it: map-side combined."""
    n = sum((F.col(p).isNotNull().cast("int") for p in PARTS), F.lit(0))
    return parts.filter(n >= 2).groupBy(*PARTS).agg(F.min("rec").alias("first"))


# -- segments and probes ----------------------------------------------------------------------------------


def cut(length: Column, i: Column, segments: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment ``i`` (from 1) of a text of ``length`` in even segments, the longer ones last."""
    size, short = F.floor(length / segments).cast("int"), F.lit(segments) - (length % segments).cast("int")
    return F.lit(1) + (i - 1) * size + F.greatest(F.lit(0), i - 1 - short), size + F.when(i > short, 1).otherwise(0)


def _each(strs: DataFrame, **values: list[int]) -> DataFrame:
    """Each whole string for each kind of slip and each combination of ``values``: ``part`` (the one that may be mistyped), ``rest`` and its length ``n``."""
    rows = [()]
    for v in ({"kind": list(SLIPS)} | values).values():
        rows = [(*r, x) for r in rows for x in v]
    names = ["kind", *values]
    literal = F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip(names, r)]) for r in rows])
    whole = reduce(lambda a, b: a & b, [F.col(p).isNotNull() for p in PARTS])
    out = strs.filter(whole).select(*PARTS, "first", F.explode(literal).alias("_v")).select(*PARTS, "first", "_v.*")
    pick = lambda at: F.when(F.col("kind") == 3, F.col(SLIPS[3][at])).otherwise(F.col(SLIPS[4][at]))
    return out.withColumn("part", pick(0)).withColumn("rest", pick(1)).withColumn("n", F.length("part"))


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))


def _keyed(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows with ``i, m, text`` (number of the segment, length of the indexed part, the segment) as entries."""
    return _bucketed(rows.select("kind", F.xxhash64("kind", "rest", "figures", "m", "i", "text").alias("key"), "part", "first"), buckets)


def segments(strs: DataFrame, edits: int = EDITS, buckets: int = BUCKETS) -> DataFrame:
    """Entries of the segments of each whole string's number and date, each with the rest of the string in its key."""
    rows = _each(strs, i=list(range(1, edits + 2))).filter(F.col("n") > edits)
    return _keyed(rows.withColumn("m", F.col("n")).withColumn("text", F.substring(F.col("part"), *cut(F.col("n"), F.col("i"), edits + 1))), buckets)


def probes(strs: DataFrame, edits: int = EDITS, buckets: int = BUCKETS, shorter: bool = False) -> DataFrame:
    """Entries to look up: the substrings of each whole string that can match a segment of a string within ``edits`` of it.

    Clean dates have one length. ``shorter``: only segments of strings that are not longer, enough where strings are compared among themselves.
    """
    rows = _each(strs, delta=list(range(0 if shorter else -edits, edits + 1)), i=list(range(1, edits + 2))).filter("kind = 3 or delta = 0")
    rows = rows.withColumn("m", F.col("n") - F.col("delta")).filter(F.col("m") > edits)
    start, size = cut(F.col("m"), F.col("i"), edits + 1)
    rows = rows.withColumn("start", start).withColumn("size", size)
    before, after = F.col("i") - 1, F.lit(edits + 1) - F.col("i")
    low = F.greatest(F.col("start") - before, F.col("start") + F.col("delta") - after, F.lit(1))
    high = F.least(F.col("start") + before, F.col("start") + F.col("delta") + after, F.col("n") - F.col("size") + 1)
    rows = rows.withColumn("low", low).withColumn("high", high).filter("low <= high").withColumn("at", F.explode(F.sequence("low", "high")))
    return _keyed(rows.withColumn("text", F.substring(F.col("part"), F.col("at"), F.col("size"))), buckets)


def pairs(strs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Entries of the pairs of parts that each string has; ``part`` is the third one (for date and number, which are enough, the number)."""
    third = {0: "number", 1: "number", 2: "date"}
    each = F.array(*[F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.struct(F.lit(k).alias("kind"), F.xxhash64(F.lit(k), x, y).alias("key"), F.col(third[k]).alias("part"))) for k, (x, y) in PAIRS.items()])
    return _bucketed(strs.select(F.explode(F.array_compact(each)).alias("_e"), "first").select("_e.*", "first"), buckets)


# -- links ------------------------------------------------------------------------------------------------
# Keys are 64-bit hashes of the kind and all that must be equal; what may differ is verified.


def slips(looked_up: DataFrame, near: DataFrame, edits: int = EDITS) -> DataFrame:
    """Verified links ``a, b`` between the strings of a batch and strings that are a mistyped part apart."""
    p, e = looked_up.alias("p"), near.alias("e")
    met = p.join(e, (F.col("p.key") == F.col("e.key")) & (F.col("p.kind") == F.col("e.kind")) & (F.col("p.first") != F.col("e.first")))
    return met.filter(F.levenshtein("p.part", "e.part", edits) >= 0).select(F.col("p.first").alias("a"), F.col("e.first").alias("b")).distinct()


def shared_pairs(near: DataFrame) -> DataFrame:
    """Links ``a, b`` of pair entries that share their key (``new`` tells those of the batch).

    Date and number: every string to the earliest. A pair with the figures: strings without the third part to the earliest string
    that has it, or to the earliest of themselves. The earliest ones are aggregates, so no group is expanded into pairs.
    """
    full = F.col("part").isNotNull()
    rows = near.select("key", full.alias("full"), ((F.col("kind") == 0) | ~full).alias("ties"), "first", "new")
    least = lambda c: F.min(F.when(c, F.col("first")))
    g = rows.groupBy("key").agg(least(F.col("full")).alias("full_first"), least(~F.col("full")).alias("lost_first"), least(~F.col("new") & F.col("ties")).alias("old"), F.count_if("ties").alias("tied"), F.count("*").alias("n"))
    g = g.filter("tied > 0 and n > 1").select("key", F.coalesce("full_first", "lost_first").alias("top"), "old")
    mine = rows.filter("new and ties").select("key", "first").join(g, "key").select(F.col("first").alias("a"), F.col("top").alias("b"))
    return mine.unionByName(g.select(F.col("old").alias("a"), F.col("top").alias("b"))).filter("a <> b").distinct()


class SegmentIndex:
    """Accepted strings by segment, in a folder that outlives the run; batches are judged and appended one after the other."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        """``path``: folder of the index (an existing one is opened); by default a new one in the shared scratch folder."""
        self.spark, self.buckets = spark, buckets
        self.path = path or scratch_path(spark, "segment-index")

    def _marks(self, name: str):
        """A path in the folder of marks, one for each accepted batch, and its file system."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/accepted/{name}")
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def loads(self) -> int:
        """Batches accepted so far."""
        at, fs = self._marks("*")
        return len(fs.globStatus(at) or [])

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def entries(self, of: list[int] | None = None) -> DataFrame:
        """All entries, or those of some buckets: a filter on the folders, so nothing else is read."""
        e = self._read("entries", ENTRY)
        return e if of is None else e.filter(F.col("bucket").isin(of))

    def accept(self, batch: DataFrame) -> None:
        """Find the links of a batch (see :func:`act_parts`) to the index and within itself, and append it.

        Each batch has folders of its own and a mark once it is accepted; one that broke off is written anew in its place.
        """
        k = self.loads()
        own_strings, own_entries = f"{self.path}/strings/load={k}", f"{self.path}/entries/load={k}"
        strings(batch).write.mode("overwrite").parquet(own_strings)
        strs = self.spark.read.schema("date string, number string, figures string, first long").parquet(own_strings)
        both = pairs(strs, self.buckets).unionByName(segments(strs, buckets=self.buckets))
        both.repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(own_entries)
        own = self.spark.read.schema("kind int, key long, part string, first long, bucket int").parquet(own_entries)
        asked = probes(strs, buckets=self.buckets, shorter=k == 0)
        shared, segs = own.filter("kind <= 2").withColumn("new", F.lit(True)), own.filter("kind > 2")
        if k:
            of = sorted(r.bucket for r in own.select("bucket").unionByName(asked.select("bucket")).distinct().collect())  # at most ``buckets`` numbers
            held = self.entries(of).filter(F.col("load") < k).drop("load")
            shared = shared.unionByName(held.filter("kind <= 2").join(shared.select("key"), "key", "left_semi").withColumn("new", F.lit(False)))
            segs = segs.unionByName(held.filter("kind > 2"))
        shared_pairs(shared).unionByName(slips(asked, segs)).write.mode("overwrite").parquet(f"{self.path}/links/load={k}")
        at, fs = self._marks(str(k))
        fs.create(at).close()
        # the context cleaner drops the broadcasts and shuffle files of a batch only once its plans are collected
        self.spark.sparkContext._jvm.System.gc()

    def acts(self) -> DataFrame:
        """``date, number, figures, act``: the least record of the act of each string."""
        roots = components(self._read("links", LINK))
        strs = self._read("strings", STRING)
        return strs.join(roots, F.col("first") == F.col("node"), "left").groupBy(*PARTS).agg(F.min(F.coalesce("root", "first")).alias("act"))

    def repeats(self, batch: DataFrame) -> DataFrame:
        """``rec_id_first, rec_id_dup`` of the rows of accepted batches whose act has an earlier record."""
        same = [F.col(f"r.{p}").eqNullSafe(F.col(f"s.{p}")) for p in PARTS]
        # two parts are always there, so the null-safe keys hash apart
        return batch.alias("r").join(self.acts().alias("s"), same).filter("act < rec").select(F.col("act").alias("rec_id_first"), F.col("rec").alias("rec_id_dup")).distinct()
