"""Exact deduplication with a log-structured merge index of text digests [native].

The table arrives in memtables. A memtable is reduced to one row per digest (partial aggregation inside
each task first, so a group of copies of any size arrives as one row a task) and flushed as a run of
level 0: sorted by digest, with a Bloom filter. Before that, the filters of all runs are asked for its
digests: only digests that a filter lets pass are looked up in that run, and a run is not read at all
if none does. When a level has FAN_IN runs, they are compacted into one run of the next level, which keeps
for each digest the identifier that stays and the number of members; filters are merged by OR.

Digests found in an older run, or several times in their memtable, are hits. The bytes of their documents
are compared before they count as copies; documents that are not among them are not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filter_words, forget, join_counted, materialize, may_be_among, ruled_out, scratch_path, table

#: Memtables that a table is fed in, and runs of a level that are merged into one.
MEMTABLES, FAN_IN = 4, 2


class Run:
    """A sorted run (digest binary, keep_id, members) and its filter, both written."""

    def __init__(self, rows: DataFrame, words: DataFrame):
        self.rows, self.words = rows, words


class DigestIndex:
    """levels[i] holds the runs of level i; asked and read count the runs whose filter was asked, and
    those that were read then."""

    def __init__(self, spark: SparkSession, keep: str = "max"):
        if keep not in ("min", "max"):
            raise ValueError("keep is min or max")
        self.spark, self.pick = spark, F.max if keep == "max" else F.min
        self.levels: list[list[Run]] = []
        self.asked = self.read = 0

    def _write(self, level: int, rows: DataFrame, words: DataFrame | None = None) -> Run:
        run = materialize(rows.sortWithinPartitions("digest"), f"digest-run-{level}")
        words = filter_words(run.select(F.xxhash64("digest").alias("h"))) if words is None else words
        return Run(run, materialize(words, f"digest-filter-{level}"))

    def add(self, memtable: DataFrame) -> DataFrame:
        """Flush (digest, doc_id) as a run. Returns the hits: digests that the index held already, or
        that the memtable holds several times."""
        new = self._write(0, memtable.groupBy("digest").agg(self.pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("members")))
        hits = new.rows.filter("members > 1").select("digest")
        for old in (r for level in self.levels for r in level):
            self.asked += 1
            passed = materialize(may_be_among(new.rows.select("digest"), F.xxhash64("digest"), old.words), "digest-passed")
            if not passed.isEmpty():
                self.read += 1
                hits = hits.unionByName(passed.join(old.rows.select("digest").hint("merge"), "digest", "left_semi"))
        hits = materialize(hits.distinct(), "digest-hits")
        self._place(new, 0)
        return hits

    def _place(self, run: Run, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) < FAN_IN:
            return
        old, self.levels[level] = self.levels[level], []
        rows, words = old[0].rows, old[0].words
        for r in old[1:]:
            rows, words = rows.unionByName(r.rows), words.unionByName(r.words)
        merged = rows.groupBy("digest").agg(self.pick("keep_id").alias("keep_id"), F.sum("members").alias("members"))
        merged = self._write(level + 1, merged, words.groupBy("word").agg(F.bit_or("bits").alias("bits")))
        forget(*(t for r in old for t in (r.rows, r.words)))
        self._place(merged, level + 1)

    def lookup(self, digests: DataFrame) -> DataFrame:
        """digest, keep_id, members of the given digests (unique) that the index holds: the filter of them
        goes over all runs first."""
        words = materialize(filter_words(digests.select(F.xxhash64("digest").alias("h"))), "digest-asked")
        found = None
        for r in (r for level in self.levels for r in level):
            part = may_be_among(r.rows, F.xxhash64("digest"), words)
            found = part if found is None else found.unionByName(part)
        found = found.groupBy("digest").agg(self.pick("keep_id").alias("keep_id"), F.sum("members").alias("members"))
        return found.join(digests.hint("merge"), "digest", "left_semi")


def exact_groups(docs: DataFrame, keep: str = "max") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of docs.

    Null text counts as empty. Equal means equal bytes, at any length of the text; the largest (keep="min":
    smallest) doc_id of a group stays. Rows that repeat a doc_id with the same text are members of one group
    and all carry kept = true if that doc_id stays; a null doc_id stays only in a group of nulls.
    Only doc_id and text of docs are read, so other columns may have any name.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    path = scratch_path(spark, "digests")
    rows.select("doc_id", "digest", F.pmod(F.xxhash64("doc_id"), F.lit(MEMTABLES)).cast("int").alias("memtable")).write.partitionBy("memtable").parquet(path)
    digested = spark.read.schema("doc_id long, digest binary, memtable int").parquet(path)
    index = DigestIndex(spark, keep)
    hits = [index.add(digested.filter(F.col("memtable") == i)) for i in range(MEMTABLES)]
    for more in hits[1:]:
        hits[0] = hits[0].unionByName(more)
    groups = materialize(index.lookup(materialize(hits[0].distinct(), "digest-hits")), "digest-groups")
    words = materialize(filter_words(groups.select(F.xxhash64("digest").alias("h"))), "digest-filter")
    h = F.xxhash64("digest")
    # Byte verification: grouping by the bytes collapses copies inside each task before any shuffle.
    # A digest with two different texts would show up here as two rows.
    pick = F.max if keep == "max" else F.min
    verified = may_be_among(rows, h, words).groupBy("digest", "text").agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("members"))
    verified = materialize(verified, "digest-verified")
    clash = materialize(verified.groupBy("digest").count().filter("count > 1").select("digest"), "digest-clash")
    narrow = digested.select("doc_id", "digest")
    total = groups.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    likely = join_counted(may_be_among(narrow, h, words), groups, ["digest"], "members", total, "left")
    single = ruled_out(narrow, h, words).select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("members"))
    found = likely.select("doc_id", "digest", F.coalesce("keep_id", "doc_id").alias("keep_id"), F.coalesce("members", F.lit(1).cast("long")).alias("members")).unionByName(single)
    if not clash.isEmpty():  # different texts with one digest: match those by their bytes
        odd = may_be_among(rows, h, words).join(clash, "digest", "left_semi").join(verified, ["digest", "text"]).select("doc_id", "digest", "keep_id", "members")
        found = found.join(clash, "digest", "left_anti").unionByName(odd)
    return found.select(
        "doc_id", "keep_id", F.col("members").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH g AS (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.t) AS text_sha256
FROM documents d JOIN g ON coalesce(d.text, '') = g.t
"""
