"""Quotation linking: from quoted replies to reply-ordered conversations without quotes.

Each message is split into lines, and the run of ``>`` marks at a line's start gives its
quote level. Lines of one level that follow each other are a passage. Passages are
normalised and hashed, quoted ones whole, line by line and by sentences, a message's own
ones as well, so a reply that rewraps a passage or quotes one sentence of it is linked. A quoted passage belongs to the first message of the conversation that has it as its own.
The parent of a message is the original of its least deeply quoted passages; of several,
the one that most quoted characters come from, then the latest. Messages that quote
nothing known start a thread. Threads are ordered by their messages' turns, replies
directly below what they answer. Depths, sizes of subtrees and places come out of pointer
doubling, in rounds that grow with the logarithm of the longest chain; a row holds a few
numbers, never its chain.

Defined results: a null text has no lines, a null conversation or turn is a value of its
own, ordered last, and links to nothing. A passage that no earlier message has links to
nothing. Where several messages share conversation and turn they are one message to their
replies, which stand below all of them; they are ordered by text. Lines introducing a
quote are dropped with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import text_of, with_rank, written

#: Marks at the start of a line, blanks between them allowed.
MARKS = r"^[ \t]*(>[ \t]?)+"
#: Control characters that mark passages while a message is taken apart.
OPEN, CLOSE = "\x01", "\x02"
#: A line such as ``On Monday, Ann wrote:`` that introduces a quote.
INTRODUCTION = r"(?i)^[ \t]*(on\b.*\bwrote|.*\bsaid|quoting\b.*)[ \t]*:[ \t\r]*$"


#: Where a sentence ends, and the words that one has at least to be looked for by itself.
END = r"(?<=[.!?]) "
SENTENCE = 3


def quote_level(line: Column) -> Column:
    """How many marks a line starts with."""
    return F.length(F.translate(F.regexp_extract(line, MARKS, 0), " \t", ""))


def normalised(text: Column) -> Column:
    """Lower case, blanks as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def coded_lines(text: Column) -> Column:
    """Lines with their level, without marks. An introduction directly above a quote has level null."""
    coded = F.transform(F.split(text, "\n", -1), lambda line: F.struct(
        quote_level(line).alias("level"), F.regexp_replace(line, MARKS, "").alias("line")))
    return F.element_at(F.transform(F.array(coded), lambda lines: F.transform(lines, lambda one, place: F.when(
        one["line"].rlike(INTRODUCTION) & (F.get(lines, place + 1)["level"] > one["level"]),
        one.withField("level", F.lit(None).cast("int"))).otherwise(one))), 1)


def passages(lines: Column) -> Column:
    """Runs of lines of one level, as ``level`` and ``text``.

    The lines are joined with a mark before each that opens a run and split at the marks,
    which takes time in proportion to the text.
    """
    opened = F.transform(lines, lambda one, place: F.concat(
        F.when((place > 0) & one["level"].eqNullSafe(F.get(lines, place - 1)["level"]), F.lit("\n"))
        .otherwise(F.concat(F.lit(OPEN), F.coalesce(one["level"].cast("string"), F.lit("")), F.lit(CLOSE))),
        F.translate(one["line"], OPEN + CLOSE, "  ")))
    parts = F.filter(F.split(F.array_join(opened, ""), OPEN), lambda part: part != "")
    return F.transform(parts, lambda part: F.struct(
        F.substring_index(part, CLOSE, 1).try_cast("int").alias("level"),
        F.substring_index(part, CLOSE, -1).alias("text")))


def link_messages(
    messages: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per message: ``conv_id, turn, role``, its own text without quotes, links and place.

    ``parent_turn`` is the turn it replies to or null, ``depth`` its distance from the start
    of its thread, ``n_quotes`` its quoted passages, ``n_linked`` the distinct quoted
    passages, lines and sentences whose original was found, ``position`` its place in the
    reply-ordered conversation, from 0.
    """
    coded = messages.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        text_of(text).alias("text")).withColumn("lines", coded_lines(F.col("text"))).withColumn("runs", passages(F.col("lines")))
    own_text = F.array_join(F.transform(F.filter("lines", lambda one: one["level"] == 0), lambda one: one["line"]), "\n")

    def units(wanted) -> Column:
        """Level and normalised text of the wanted passages and lines, each once."""
        def leveled(name: str, field: str) -> Column:
            return F.transform(F.filter(name, wanted), lambda one: F.struct(
                one["level"].alias("level"), normalised(one[field]).alias("unit")))

        def sentences(run: Column) -> Column:
            parts = F.filter(F.split(normalised(run["text"]), END), lambda part: F.size(F.split(part, " ")) >= SENTENCE)
            return F.transform(parts, lambda part: F.struct(run["level"].alias("level"), part.alias("unit")))

        parts = [leveled("runs", "text"), leveled("lines", "line"), F.flatten(F.transform(F.filter("runs", wanted), sentences))]
        return F.array_distinct(F.filter(F.concat(*parts), lambda one: one["unit"] != ""))

    rows = written(coded.select(
        "conv_id", "turn", "role", F.xxhash64("text").alias("text_hash"),
        F.regexp_replace(own_text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "").alias("own_text"),
        F.array_union(F.transform(units(lambda one: one["level"] == 0), lambda one: one["unit"]),
                      F.array(normalised(own_text))).alias("own"),
        units(lambda one: one["level"] > 0).alias("quoted"),
        F.size(F.filter("runs", lambda one: one["level"] > 0)).alias("n_quotes"),
    ), "messages")

    linked = links(rows)
    found = linked.groupBy("conv_id", "turn", "text_hash").agg(F.count("*").alias("n_linked"))
    same = ["conv_id", "turn"]
    nodes = null_safe(rows.groupBy(*same).agg(F.count("*").alias("weight")), best_parent(linked), same)
    tree = thread_places(written(nodes, "threads"))
    placed = null_safe(rows.drop("own", "quoted"), found, [*same, "text_hash"])
    placed = null_safe(placed, tree, same).withColumn("n_linked", F.coalesce("n_linked", F.lit(0)))
    # Messages that share conversation and turn stand side by side at the place of their node.
    ranked = with_rank(placed.withColumn("_node", node_key("conv_id", "turn")), ["own_text", "role"], group="_node", rank="beside")
    return ranked.select(
        "conv_id", "turn", "role", "own_text", "parent_turn", F.col("depth").cast("int").alias("depth"),
        "n_quotes", F.col("n_linked").cast("long").alias("n_linked"), (F.col("place") + F.col("beside")).cast("long").alias("position"))


def node_key(*columns: str) -> Column:
    """A text that tells values apart, nulls included."""
    return F.concat_ws(":", *(F.coalesce(F.concat(F.lit("0"), F.col(one).cast("string")), F.lit("1")) for one in columns))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which nulls of the keys are equal."""
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_{key}")
    on = [left[key].eqNullSafe(renamed[f"_{key}"]) for key in keys]
    condition = on[0]
    for one in on[1:]:
        condition = condition & one
    return left.join(renamed, condition, "left").drop(*[f"_{key}" for key in keys])


def links(rows: DataFrame) -> DataFrame:
    """Quoted passages and lines with the turn of their original: one row per unit that was found.

    An original is the first message of a conversation with that unit, so one row per
    unit meets any number of quotes.
    """
    known = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    own = known.select("conv_id", "turn", F.explode("own").alias("unit")).where("unit != ''")
    originals = own.select("conv_id", "turn", F.sha2("unit", 256).alias("digest")).groupBy("conv_id", "digest").agg(
        F.min("turn").alias("original"))
    quotes = known.select("conv_id", "turn", "text_hash", F.explode("quoted").alias("q")).select(
        "conv_id", "turn", "text_hash", "q.level", F.length("q.unit").alias("chars"), F.sha2("q.unit", 256).alias("digest"))
    return written(quotes.join(originals, ["conv_id", "digest"]).where("original < turn").drop("digest"), "quote-links")


def best_parent(linked: DataFrame) -> DataFrame:
    """``conv_id, turn, parent_turn`` of every message with a known quote."""
    votes = linked.groupBy("conv_id", "turn", "level", "original").agg(F.sum("chars").alias("chars"))
    best = F.min(F.struct(F.col("level"), (-F.col("chars")).alias("fewer"), (-F.col("original")).alias("earlier")))
    return votes.groupBy("conv_id", "turn").agg(best.alias("best")).select(
        "conv_id", "turn", (-F.col("best.earlier")).alias("parent_turn"))


def climbed(nodes: DataFrame, grown: str, seen: str) -> DataFrame:
    """One round of doubling: each node takes over the ancestor of its ancestor, and adds its ``grown`` number.

    ``seen`` is left as it is. A node that many others point at is one row on its side of the join.
    """
    above = nodes.select(
        F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("above").alias("_next"), F.col(grown).alias("_more"))
    joined = nodes.join(above, (F.col("conv_id") == F.col("_conv")) & (F.col("above") == F.col("_turn")), "left")
    return joined.select(
        "conv_id", "turn", "weight", "parent_turn", F.col("_next").alias("above"),
        (F.col(grown) + F.coalesce("_more", F.lit(0))).alias(grown), seen)


def thread_places(nodes: DataFrame) -> DataFrame:
    """``conv_id, turn, parent_turn, depth, place`` of nodes with a ``weight`` (messages) and a ``parent_turn``.

    First round after round: a node's size grows by the sizes of those whose ancestor, twice as far
    away each time, it is, and depths add up on the way. A node then stands behind its parent's
    messages and its earlier siblings' subtrees, and the sums of these numbers over all its
    ancestors are its place. Parents have earlier turns, so there are no cycles.
    """
    current = nodes.select(
        "conv_id", "turn", "weight", "parent_turn", F.col("parent_turn").alias("above"),
        F.col("parent_turn").isNotNull().cast("long").alias("depth"), F.col("weight").alias("size"))
    current = written(current, "sizes")
    while not current.where("above IS NOT NULL").isEmpty():
        sent = written(current.where("above IS NOT NULL").groupBy(
            F.col("conv_id").alias("_conv"), F.col("above").alias("_turn")).agg(F.sum("size").alias("_sent")), "sent")
        larger = current.join(sent, (F.col("conv_id") == F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left").withColumn(
            "size", F.col("size") + F.coalesce("_sent", F.lit(0))).drop("_conv", "_turn", "_sent")
        current = written(climbed(larger, "depth", "size"), "sizes")
    # Threads of a conversation are siblings, too.
    known = current.withColumn("_siblings", F.when(F.col("parent_turn").isNull(), node_key("conv_id")).otherwise(
        node_key("conv_id", "parent_turn")))
    behind = with_rank(known, ["turn"], group="_siblings", rank="behind", weight="size")
    parents = nodes.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("weight").alias("_weight"))
    behind = behind.join(parents, (F.col("conv_id") == F.col("_conv")) & (F.col("parent_turn") == F.col("_turn")), "left")
    current = written(behind.select(
        "conv_id", "turn", "weight", "parent_turn", F.col("parent_turn").alias("above"),
        (F.col("behind") + F.coalesce("_weight", F.lit(0))).alias("place"), "depth"), "places")
    while not current.where("above IS NOT NULL").isEmpty():
        current = written(climbed(current, "place", "depth"), "places")
    return current.select("conv_id", "turn", "parent_turn", "depth", "place")
