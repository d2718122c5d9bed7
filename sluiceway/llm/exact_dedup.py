"""Exact deduplication against a persistent index of digests.

The index is a table of one row per distinct text, bucketed and sorted by digest. New
documents are reduced to one row per digest before any shuffle of theirs ends, matched
to the index by a sort-merge anti-join that reads the index without shuffling it, and
the digests that are new are appended. Lookups join on the digest again.

Defined results: texts are equal when they agree after all ASCII blanks are deleted;
null counts as empty. Of equal new texts the one with the most code points stays, then
the one with the smallest id (nulls last). A text that the index holds already is kept
by the indexed document. Repeated rows are separate members of their group; the operator
keeps all rows that tie in length and id. An empty table leaves the index as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.shared import BLANKS, free_name, shared_folder, text_of, written

INDEX_ROW = "digest string, keep_id long, n_chars long"


def normalised(text: Column) -> Column:
    """The text without ASCII blanks."""
    return F.translate(text, BLANKS, "")


def digests(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``digest`` and ``n_chars`` of every document."""
    whole = text_of(text)
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.sha2(normalised(whole).cast("binary"), 256).alias("digest"),
        F.length(whole).cast("long").alias("n_chars"),
    )


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: who stays, its length and the size of the group.

    Aggregated before the shuffle, so a group of any size sends one row per task.
    """
    best = F.min(F.struct(
        (-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id")))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")).select(
        "digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.shorter")).alias("n_chars"), "group_size")


@dataclass(frozen=True)
class DigestIndex:
    """A catalog table of known digests. The catalog and ``path`` are shared by all executors."""

    spark: SparkSession
    table: str
    path: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, table: str, path: str, buckets: int = 64) -> DigestIndex:
        """The index at ``path``, created empty if the table is not there."""
        if not spark.catalog.tableExists(table):
            cls._append(spark.createDataFrame([], INDEX_ROW), table, path, buckets)
        return cls(spark, table, path, buckets)

    @staticmethod
    def _append(rows: DataFrame, table: str, path: str, buckets: int) -> None:
        # Dealt by the bucketing hash first, each bucket gets one file per append.
        (rows.repartition(buckets, "digest").write.format("parquet").bucketBy(buckets, "digest")
         .sortBy("digest").option("path", path).mode("append").saveAsTable(table))

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def new_groups(self, found: DataFrame) -> DataFrame:
        """Groups whose digest the index lacks."""
        known = self.rows().select("digest").hint("merge")
        return found.repartition(self.buckets, "digest").join(known, "digest", "left_anti")

    def append(self, found: DataFrame) -> None:
        """Add the groups that are new. Adding the same groups again changes nothing.

        What is new is written to a folder of its own before the index changes, so a
        lost executor during the append can't read an index that is half appended to.
        """
        fresh = written(self.new_groups(found).select("digest", "keep_id", "n_chars"), "digests-new")
        self._append(fresh, self.table, self.path, self.buckets)

    def compacted(self, table: str, path: str) -> DigestIndex:
        """The same digests under a new name, as one sorted file per bucket.

        Every append adds a file to each bucket, and only a bucket of one file is sorted as a
        whole. This index is left to its readers; the caller drops it once they are done.
        """
        if self.spark.catalog.tableExists(table):
            raise ValueError(f"{table} exists")
        # Read by path: over the bucketed table the planner leaves the shuffle out, and then the buckets.
        rows = self.spark.read.schema(INDEX_ROW).parquet(self.path)
        self._append(rows, table, path, self.buckets)
        return DigestIndex(self.spark, table, path, self.buckets)


def deduplicate(
    docs: DataFrame, index: DigestIndex, *, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Add ``docs`` to the index and say of each document which one stays in its place.

    One row per document: ``doc_id``, ``keep_id``, ``group_size`` (within ``docs``),
    ``kept``, ``text_sha256``. Texts are read once; what follows moves digests only. The
    last join is shuffled on both sides so that adaptive execution can split a digest
    that a third of all rows share.
    """
    return _decisions(docs, index, doc_id=doc_id, text=text).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def _decisions(docs: DataFrame, index: DigestIndex, *, doc_id: str, text: str) -> DataFrame:
    """The rows of ``deduplicate`` with their ``digest`` and ``n_chars``."""
    rows = written(digests(docs, doc_id=doc_id, text=text), "digests")
    found = written(groups(rows), "digest-groups")
    index.append(found)
    sizes = found.select("digest", "group_size").join(
        index.rows().select("digest", "keep_id", F.col("n_chars").alias("keep_chars")), "digest")
    joined = rows.join(written(sizes, "digest-keepers"), "digest")
    return joined.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
        "digest", "n_chars",
    )


def fresh_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index under a name of its own in the shared folder."""
    path = shared_folder(spark, "digest_index")
    name = path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    return DigestIndex.open(spark, name, path, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))


def keep_first(
    docs: DataFrame, index: DigestIndex, *, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The documents that stay, each row once, with the columns of ``docs``.

    Documents go to the decisions by id. Rows that share an id are told apart by their
    digest and length, and rows that agree in all three are one document that is kept once.
    """
    mark, size = free_name(docs.columns, "_digest"), free_name(docs.columns, "_size")
    kept_mark, kept_size, kept_id = (free_name(docs.columns, f"_kept_{name}") for name in ("digest", "size", "id"))
    whole = text_of(text)
    marked = docs.withColumn(mark, F.sha2(normalised(whole).cast("binary"), 256)).withColumn(size, F.length(whole))
    decisions = _decisions(docs, index, doc_id=doc_id, text=text)
    stay = decisions.where("kept").select(
        F.col("digest").alias(kept_mark), F.col("n_chars").alias(kept_size), F.col("doc_id").alias(kept_id)).distinct()
    same = ((F.col(mark) == F.col(kept_mark)) & (F.col(size) == F.col(kept_size))
            & F.col(doc_id).eqNullSafe(F.col(kept_id)))
    joined = marked.join(stay, same, "left_semi")
    return joined.dropDuplicates([mark, doc_id]).select(*docs.columns)
