"""Exact deduplication over a log-structured merge index of text digests.  DataFrame functions only.

Documents are dealt to memtables of bounded size; each memtable flushes a run of (digest, smallest and largest id,
count), sorted by digest, with a Parquet Bloom filter and row-group bounds as the run's filters.  Further flushes add
runs; compaction merges all runs and the level before into a new level.  Digests that occur more than once are hits:
the bytes of their documents are compared by grouping on the text itself, so a digest collision never merges two texts.
Documents that are no hit are kept out of that comparison by a Bloom filter over the hits, as large as their number
asks for, and then by the compacted index.  A lookup of a few digests reads only the runs whose filters let them pass.

Defined cases: a null text counts as empty; null ids take part (they lose to any other id, and a
group of null ids only keeps one row); repeated rows are copies like any other; other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, ascii_lower, bloom_words, might_contain, pieces, unused

#: Rows of one memtable.
MEMTABLE_ROWS = 1 << 17
#: Longs of the filter over the hits: a quarter of a long a hit, between these bounds; beyond the upper one (8 MiB) more
#: documents pass it that are no hits, and only the compacted index stops them.
FEWEST_WORDS, MOST_WORDS = 1 << 14, 1 << 20


class DigestIndex:
    """One index under ``scratch``: ``flush`` adds runs, ``compact`` merges them into the next level, ``lookup`` reads."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.batches, self.merged, self.levels, self.schema = scratch, 0, 0, 0, None

    def flush(self, keyed: DataFrame, rows: int) -> None:
        """Add the runs of one batch of (doc_id, digest[, row]) rows; a memtable is filled and sorted in one task."""
        own = [c for c in ("doc_id", "row") if c in keyed.columns]
        flushed = (
            keyed.withColumn("run", F.pmod(F.xxhash64(*own), F.lit(pieces(rows, MEMTABLE_ROWS))).cast("int"))
            .repartition("run")
            .groupBy("run", "digest")
            .agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest"), F.count("*").alias("n"))
            .sortWithinPartitions("run", "digest")
        )
        self.schema = T.StructType([*flushed.schema.fields, T.StructField("batch", T.IntegerType())])
        self.scratch.save(flushed, f"runs/batch={self.batches}", partition_by="run", options=_bloom(min(rows, MEMTABLE_ROWS)))
        self.batches += 1

    def runs(self) -> DataFrame:
        """The runs of all flushes."""
        return self.scratch.load("runs", self.schema)

    def entries(self) -> DataFrame:
        """(digest, smallest, largest, n) of the level and the runs that are not merged into it; a digest may have several."""
        columns = ["digest", "smallest", "largest", "n"]
        new = self.runs().where(F.col("batch") >= self.merged) if self.merged < self.batches else None
        found = [new.select(*columns)] if new is not None else []
        if self.levels:
            level = self.scratch.spark.read.parquet(f"{self.scratch.path}/level-{self.levels}").select(*columns)
            found.append(level)
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def compact(self) -> DataFrame:
        """Merge level and runs; of equal digests the smallest and the largest id and the count stay."""
        merged = (
            self.entries()
            .groupBy("digest")
            .agg(F.min("smallest").alias("smallest"), F.max("largest").alias("largest"), F.sum("n").alias("n"))
            .sortWithinPartitions("digest")
        )
        level = self.scratch.save(merged, f"level-{self.levels + 1}", options=_bloom(1 << 20))
        if self.levels:
            self.scratch.drop(f"level-{self.levels}")
        self.levels, self.merged = self.levels + 1, self.batches
        return level

    def lookup(self, digests: list[bytes]) -> DataFrame:
        """The runs' entries of a few digests; row-group bounds and Bloom filters of the runs prune the scan."""
        return self.runs().where(F.col("digest").isin([bytearray(d) for d in digests]))


def _bloom(rows: int) -> dict:
    return {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.expected.ndv#digest": str(max(rows, 1024))}


@dataclass
class ExactDedup:
    """``assignments``: a row per document (doc_id, digest, keep_id, group_size, kept).  ``keep`` filters a table."""

    assignments: DataFrame
    hits: DataFrame
    words: int
    digest: Callable[[Column], Column]
    id_col: str
    text_col: str

    def keep(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that stay; only documents that may have a copy are shuffled."""
        may = might_contain(self.hits, F.col(self.id_col), self.words)
        alone = docs.where(~may)
        digest, own_id, own_digest, same = (unused(docs, c) for c in ("digest", "own_id", "own_digest", "same"))
        some = docs.where(may).withColumn(digest, self.digest(ascii_lower(self.text_col)))
        stay = self.assignments.where("kept").select(F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest), F.col("same_id").alias(same))
        found = some.join(stay, some[self.id_col].eqNullSafe(stay[own_id]) & (some[digest] == stay[own_digest]))
        once = found.where(F.col(same) == 1).select(*docs.columns)
        again = found.where(F.col(same) > 1).dropDuplicates([own_id, own_digest]).select(*docs.columns)
        return alone.unionByName(once).unionByName(again)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_dedup(
    spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", digest: Callable[[Column], Column] = sha256,
) -> ExactDedup:
    """Group equal normalised texts; the row with the smallest (or largest) id of each group stays."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    best = F.min if keep == "smallest" else F.max
    scratch = Scratch(spark, "exact-dedup")
    text = ascii_lower(text_col)
    keyed = scratch.save(docs.select(F.col(id_col).alias("doc_id"), digest(text).alias("digest"), F.monotonically_increasing_id().alias("row")), "keyed")
    index = DigestIndex(scratch)
    index.flush(keyed, keyed.count())
    repeated = scratch.save(index.compact().where("n > 1").select("digest", "n"), "repeated")
    hit_ids = scratch.save(keyed.join(repeated, "digest", "left_semi").select("doc_id"), "hit-ids")
    number = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = min(MOST_WORDS, max(FEWEST_WORDS, 1 << (number // 4).bit_length()))
    hits = scratch.save(bloom_words(hit_ids, F.col("doc_id"), words), "hit-filter")

    # Byte verification: documents behind hits are grouped by digest and text.
    variants = (
        docs.where(might_contain(hits, F.col(id_col), words))
        .select(F.col(id_col).alias("doc_id"), text.alias("text"))
        .withColumn("digest", digest(F.col("text")))
        .join(repeated.select("digest"), "digest", "left_semi")
        .groupBy("digest", "text")
        .agg(best("doc_id").alias("keep_id"), F.count("*").alias("n"))
    )
    return ExactDedup(_assign(scratch, docs, keyed, variants, id_col, text, digest), hits, words, digest, id_col, text_col)


def _assign(scratch: Scratch, docs: DataFrame, keyed: DataFrame, variants: DataFrame, id_col: str, text: Column, digest: Callable[[Column], Column]) -> DataFrame:
    verdicts = scratch.save(
        variants.groupBy("digest")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count("*").alias("texts"))
        .where("n > 1"),
        "verdicts",
    )
    plain = keyed.join(verdicts.where("texts = 1").drop("texts"), "digest", "left")
    if not verdicts.where("texts > 1").isEmpty():
        # A digest with several texts: those groups are formed by the text instead.
        clash = verdicts.where("texts > 1").select("digest")
        apart = variants.join(clash, "digest", "left_semi")
        there = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("digest", digest(F.col("text")))
        own = there.join(clash, "digest", "left_semi").join(apart, ["digest", "text"]).select("doc_id", "digest", F.col("keep_id").alias("own_keep"), F.col("n").alias("own_n"))
        plain = plain.join(own.dropDuplicates(["doc_id", "digest"]), ["doc_id", "digest"], "left").withColumns({"keep_id": F.coalesce("own_keep", "keep_id"), "n": F.coalesce("own_n", "n")})
    rows = scratch.save(plain.select("doc_id", "digest", "row", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size")), "rows")
    # Repeated ids: of the rows that carry the kept id only the first one stays.
    ties = scratch.save(
        rows.where("group_size > 1 AND doc_id <=> keep_id").groupBy("digest", "keep_id").agg(F.min("row").alias("first_row"), F.count("*").alias("same")).where("same > 1"),
        "ties",
    )
    if ties.isEmpty():
        return rows.select("doc_id", "digest", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.lit(1).cast("long").alias("same_id"))
    ties = ties.select(F.col("digest").alias("d"), F.col("keep_id").alias("k"), "first_row", "same")
    joined = rows.join(ties, (rows["digest"] == ties["d"]) & rows["keep_id"].eqNullSafe(ties["k"]), "left")
    return joined.select(
        "doc_id", "digest", "keep_id", "group_size",
        (F.expr("doc_id <=> keep_id") & (F.coalesce("first_row", "row") == F.col("row"))).alias("kept"),
        F.coalesce("same", F.lit(1)).alias("same_id"),
    )
