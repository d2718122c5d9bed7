"""How filters of documents overlap: what each removes, in every order, by incremental counters.

1. The files of a table are a stream that is taken in micro-batches until all are done. Each
   document becomes a mask of the filters that its own text fails, a digest of the text, its
   part and its labels; texts go no further.
2. State keyed by digest (a key holds a few texts) has for each text the smallest id so far
   and the rows with it. A row above that id fails the filter on repeated texts. When a smaller id arrives, the rows held
   are retracted from the counters of their mask and added to those of the mask with that
   filter, and the new rows take their place.
3. The changes of the counters are summed within tasks and appended to a file sink, which
   takes each batch once; a sink and a checkpoint of an audit that died can be carried on.
4. Their sums, at most 32 masks a part, give every order and step of the filters.

A text that many rows share is one row per Arrow batch and label before anything is keyed by
it, and its state is a number per part and label. Ids and labels meet in an ordinary join.
State takes some 70 bytes a text, in the store that the session names: executors' memory by
default, disk with the RocksDB provider.

Defined results: null texts count as empty, a null part as the empty string. A null id is
neither larger nor smaller than another one: such rows never fail on repeats and make no
other row fail. Rows that repeat the smallest id don't fail either. Repeated labels of an id
count if any of them is 1; missing and null ones are not 1. An empty table gives no rows.
Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
import json
import string
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sluiceway.llm.shared import shared_folder, text_of

CAPITALS = string.ascii_uppercase.encode()

ROW = ("digest", "mask", "part", "good", "toxic", "id", "kind", "n")
KEYED = "digest string, mask int, part string, good int, toxic int, id long, kind int, n long"
HELD = "texts string"
CHANGE = "part string, mask int, good int, toxic int, n long"

#: Rows without an id, with the smallest id of their text in an Arrow batch, and the others.
NO_ID, LEAST, ABOVE = 0, 1, 2


@dataclass(frozen=True)
class Filters:
    """Limits of the filters A to D, and the sizes of the work.

    A micro-batch takes ``core_bytes`` of files for each core. A key of the state holds
    ``texts`` texts on average, as each costs some milliseconds whenever it is touched.
    """

    min_words: int = 100
    distinct_share: int = 80
    capital_share: int = 10
    symbols: str = "#$%&*|"
    core_bytes: int = 64 << 20
    texts: int = 128
    letters: str = field(default="ABCDE", init=False)

    @property
    def repeat_bit(self) -> int:
        return 1 << self.letters.index("E")


def text_facts(text: str, rules: Filters) -> tuple[int, str]:
    """Bits of the filters A to D that a text fails, by whole-number comparisons, and its digest."""
    whole = text.encode()
    words = whole.split()
    fails = (
        len(words) < rules.min_words,
        100 * len(set(words)) < rules.distinct_share * len(words),
        100 * (len(whole) - len(whole.translate(None, CAPITALS))) > rules.capital_share * len(text),
        len(whole.translate(None, rules.symbols.encode())) < len(whole),
    )
    return sum(fail << bit for bit, fail in enumerate(fails)), hashlib.blake2b(whole, digest_size=16).hexdigest()


def marked(docs: DataFrame, labels: DataFrame, rules: Filters) -> DataFrame:
    """Part, mask, digest and labels of every document."""

    @F.pandas_udf("mask int, digest string")
    def facts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([text_facts(text, rules) for text in texts], columns=["mask", "digest"])

    own = docs.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        facts.asNondeterministic()(text_of("text")).alias("facts"))
    known = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return own.join(known, "doc_id", "left").select(
        "facts.digest", "facts.mask", "part", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("no_id"))


def combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per text, part, label and kind in each Arrow batch; ``id`` is the text's least one there."""
    for rows in batches:
        least = rows["id"].where(~rows["no_id"], (1 << 63) - 1).groupby(rows["digest"]).transform("min")
        kind = (rows["id"] > least).map({False: LEAST, True: ABOVE}).where(~rows["no_id"], NO_ID)
        keys = ["digest", "mask", "part", "good", "toxic", "id", "kind"]
        yield rows.assign(id=least, kind=kind).groupby(keys, sort=False).size().rename("n").reset_index()


def changed(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState, repeat: int) -> Iterator[pd.DataFrame]:
    """Changes of the part counters that new rows of a few texts bring, and their new state.

    The state is, for each digest, the smallest id and the rows that have it, by part and labels.
    """
    held = json.loads(state.get[0]) if state.exists else {}
    out: Counter = Counter()
    came = [row for chunk in chunks for row in zip(*(chunk[name].tolist() for name in ROW), strict=True)]
    for digest, mask, _, _, _, one, kind, _ in came:
        if kind != LEAST:
            continue
        known = held.get(digest)
        if known is None or one < known[0]:
            for part, good, toxic, n in known[1] if known else ():
                out[part, mask, good, toxic] -= n
                out[part, mask | repeat, good, toxic] += n
            held[digest] = [one, []]
    for digest, mask, part, good, toxic, one, kind, n in came:
        fails = kind == ABOVE or kind == LEAST and one > held[digest][0]
        out[part, mask | repeat if fails else mask, good, toxic] += n
        if kind == LEAST and not fails:
            rows = held[digest][1]
            same = next((row for row in rows if row[:3] == [part, good, toxic]), None)
            if same:
                same[3] += n
            else:
                rows.append([part, good, toxic, n])
    state.update((json.dumps(held),))
    yield pd.DataFrame([(*counter, n) for counter, n in out.items()], columns=["part", "mask", "good", "toxic", "n"])


def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Changes of each counter in an Arrow batch, added up."""
    for rows in batches:
        yield rows.groupby(["part", "mask", "good", "toxic"], sort=False)["n"].sum().reset_index()


def as_glob(path: str) -> str:
    """A pattern for just this path: a file stream takes single files by pattern only."""
    path = path.rstrip("/")
    return path if set(path) & set("*?[{") else f"{path[:-1]}[{path[-1]}]"


def count_masks(
    spark: SparkSession, path: str, labels: DataFrame, *, rules: Filters = Filters(), sink: str | None = None,
    checkpoint: str | None = None, keys: int | None = None, **source,
) -> DataFrame:
    """Documents of the Parquet table at ``path`` by ``part``, ``mask``, ``good`` and ``toxic``.

    Given the ``sink`` and ``checkpoint`` of an earlier call, files that came since are
    added to its counters; ``keys``, the number of state keys, must be as before then. By default
    there is one for so many ``rules.texts`` rows as the footers tell. Otherwise both are new, in the
    shared folder. ``source`` are options of the file stream; ``maxFilesPerTrigger`` replaces the
    bound in bytes.
    """
    sink = sink or shared_folder(spark, "mask-counters")
    checkpoint = checkpoint or shared_folder(spark, "mask-checkpoint")
    options = source or {"maxBytesPerTrigger": str(rules.core_bytes * spark.sparkContext.defaultParallelism)}
    table = spark.read.parquet(path).select("doc_id", "text", "lang")
    keys = keys or table.count() // rules.texts + 1
    docs = spark.readStream.schema(table.schema).options(**options).parquet(as_glob(path))
    changes = (
        marked(docs, labels, rules).mapInPandas(combined, KEYED)
        .withColumn("key", F.pmod(F.xxhash64("digest"), F.lit(keys))).groupBy("key")
        .applyInPandasWithState(partial(changed, repeat=rules.repeat_bit), CHANGE, HELD, "append", GroupStateTimeout.NoTimeout)
        .mapInPandas(summed, CHANGE))
    changes.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start(sink).awaitTermination()
    return spark.read.schema(CHANGE).parquet(sink).groupBy("part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n")).where("n != 0")


def all_steps(letters: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """Every order of the filters with each of its steps: order, step, bits before it, own bit."""
    bits = {letter: 1 << i for i, letter in enumerate(letters)}
    return [
        ("".join(order), i + 1, sum(bits[one] for one in order[:i]), bits[letter])
        for order in permutations(letters) for i, letter in enumerate(order)]


def report(counters: DataFrame, letters: Sequence[str] = "ABCDE") -> DataFrame:
    """What each filter does at each step of each order, by part."""
    by_mask = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    steps = F.array(*[
        F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step"), F.lit(before).alias("before"), F.lit(own).alias("own"))
        for order, step, before, own in all_steps(letters)])
    # The array of steps is made once a row; as an expression it would be code of 600 structs.
    spread = by_mask.withColumn("at", F.explode(steps)).select("*", "at.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition: Column, column: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0)).cast("long")

    counted = spread.groupBy("part", "filter_order", "step", "own").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"))
    share = counted.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return counted.join(share, ["part", "own"]).drop("own")
