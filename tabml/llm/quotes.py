"""Quotation linking in conversations: quote levels, links to the original messages, and reply order without quotes.

Native: DataFrame functions only. The level of a line is the number of `>` marks before it. Lines of level 0 are the message's own
text, without a line of attribution (ending in `wrote:`) right before a quotation; the others are quoted. Consecutive
quoted lines of one level are a passage. Passages, lines and whole messages are normalised (case, white space) and hashed. A passage is
joined to the first message of its conversation whose whole text or line it is, if that came earlier; of a passage without such a
message each line is joined on its own. So everything quoted has one original however often it occurs, and the joins add no rows.
Neighbouring lines without an original may be a part of a message or wrapped anew. Their original is the first message, if it came earlier, that holds
all their words in a row, whichever messages hold their pieces: windows of their words (up to 16) are joined to those of all messages, a part
without a message for one of its windows is out, and each message that holds the rarest window is a candidate whose words are then compared. Equal parts of a
conversation are searched once. Lines found together nowhere are tried one by one: each of them may be such a part.
A message replies to the message that most lines of its level-1 quotes come from (of
equal ones the later); a thread is the message that its replies lead back to.

The reply order of a conversation is `(thread, turn)`: threads by their first message, each with its replies behind what they reply to. Roots are found by
pointer doubling, with a checkpoint per round. No group is gathered in one task.

Defined results: a NULL text has no lines. Messages that agree in conversation, turn, role and text are one. A NULL
conversation is one of its own. Messages without a turn neither quote nor are quoted. Several messages at one turn share their links. An empty table gives an
empty result. Only the four columns named are read, so others can't clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabml.sources.scratch import checkpointed, stored

MARKS = r"^((?:[ \t]*>)*)"
#: Windows of words by which parts are looked up: the longest that fits, so that parts of up to four words are one window.
WINDOWS = (1, 2, 3, 4, 6, 8, 12, 16)


def _bare(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[ \t\x0B\f\r]+", " "))


def _lines(text: Column) -> Column:
    """Array of structs: number, quote level, the line without its marks, and whether it is one of attribution."""
    given = F.split(F.coalesce(text, F.lit("")), "\n")

    def line(x: Column, i: Column) -> Column:
        return F.struct(
            i.alias("at"),
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), r"[^>]", "")).alias("level"),
            F.regexp_replace(F.regexp_replace(x, MARKS, ""), r"^ ", "").alias("text"),
            x.alias("raw"),
        )

    return F.transform(given, line)


def _own(lines: Column) -> Column:
    def stays(x: Column, i: Column) -> Column:
        told = x["raw"].rlike(r"wrote:[ \t\r]*$") & F.coalesce(F.get(lines, i + 1)["level"] > 0, F.lit(False))
        return (x["level"] == 0) & ~told

    return F.filter(lines, stays)


def _links(messages: DataFrame) -> DataFrame:
    """`(conv, turn, level, n, origin)`: `n` quoted lines with the turn of their original, or NULL."""
    own_lines = F.transform("own", lambda x: x["text"])
    own = messages.select("conv", "turn", F.explode(F.array_append(own_lines, F.array_join(own_lines, " "))).alias("part"))
    own = own.select("conv", "turn", _bare(F.col("part")).alias("part")).where("part <> ''")
    firsts = own.groupBy(F.col("conv").alias("its_conv"), F.xxhash64("part").alias("its_h")).agg(F.min("turn").alias("origin"))

    quoted = messages.select("mid", "conv", "turn", F.explode(F.filter("lines", lambda x: x["level"] > 0)).alias("l"))
    quoted = quoted.select("mid", "conv", "turn", F.col("l.level").alias("level"), F.col("l.at").alias("at"), _bare(F.col("l.text")).alias("line"))
    # Consecutive lines of a level have the same difference of line number and rank.
    run = F.col("at") - F.row_number().over(W.partitionBy("mid", "level").orderBy("at"))
    passages = quoted.withColumn("run", run).groupBy("mid", "conv", "turn", "level", "run").agg(F.array_sort(F.collect_list(F.struct("at", "line")))["line"].alias("lines"))
    passages = passages.withColumn("h", F.xxhash64(_bare(F.array_join("lines", " "))))

    def traced(parts: DataFrame) -> DataFrame:
        met = parts.join(firsts, (F.col("h") == F.col("its_h")) & F.col("conv").eqNullSafe(F.col("its_conv")), "left")
        return met.withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin"))).drop("its_h", "its_conv")

    whole = stored(traced(passages), "passages")
    rest = whole.where("origin is null").select("mid", "conv", "turn", "level", "run", F.posexplode(F.filter("lines", lambda x: x != "")).alias("k", "line"))
    by_line = stored(traced(rest.withColumn("h", F.xxhash64("line"))), "lines")
    found = [
        whole.where("origin is not null").select("conv", "turn", "level", F.size("lines").cast("long").alias("n"), "origin"),
        by_line.where("origin is not null").select("conv", "turn", "level", F.lit(1).cast("long").alias("n"), "origin"),
    ]
    lost = by_line.where("origin is null").drop("origin")
    if not lost.isEmpty():
        next_to = F.col("k") - F.row_number().over(W.partitionBy("mid", "level", "run").orderBy("k"))
        runs = lost.withColumn("next_to", next_to).groupBy("mid", "conv", "turn", "level", "run", "next_to").agg(F.array_sort(F.collect_list(F.struct("k", "line")))["line"].alias("lines"))
        together = stored(_contained(runs.select("conv", "turn", "level", "lines"), messages), "together")
        alone = together.where("origin is null and size(lines) > 1").select("conv", "turn", "level", F.explode("lines").alias("line"))
        alone = _contained(alone.select("conv", "turn", "level", F.array("line").alias("lines")), messages)
        found += [x.where("origin is not null").select("conv", "turn", "level", F.size("lines").cast("long").alias("n"), "origin") for x in (together, alone)]
    return reduce(DataFrame.unionByName, found)


def _contained(parts: DataFrame, messages: DataFrame) -> DataFrame:
    """`parts` (`conv, turn, level, lines`) with `origin`: the turn of the first message that holds their words in a row, or NULL unless it is earlier."""
    parts = stored(parts.withColumn("text", F.array_join("lines", " ")), "parts")
    words = F.split("text", " ")
    texts = parts.select("conv", "text").distinct().select(F.monotonically_increasing_id().alias("part"), "conv", "text", words.alias("words"))
    fitting = F.filter(F.array(*(F.lit(n) for n in WINDOWS)), lambda n: n <= F.size("words"))
    texts = stored(texts.withColumn("size", F.array_max(fitting)), "texts")

    def windows(words: Column, size: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(words) - size + 1)
        return F.explode(F.array_distinct(F.transform(at, lambda i: F.xxhash64(size, F.array_join(F.slice(words, i, size), " ")))))

    asked = stored(texts.select("part", F.col("conv").alias("its_conv"), windows(F.col("words"), F.col("size")).alias("its_h")), "asked")
    said = messages.select("conv", "turn", _bare(F.array_join(F.transform("own", lambda x: x["text"]), " ")).alias("said"))
    needed = texts.groupBy(F.col("conv").alias("its_conv")).agg(F.collect_set("size").alias("sizes"))
    opened = said.join(needed, F.col("conv").eqNullSafe(F.col("its_conv"))).select("conv", "turn", F.split("said", " ").alias("words"), F.explode("sizes").alias("size"))
    opened = opened.where(F.size("words") >= F.col("size")).select("conv", "turn", windows(F.col("words"), F.col("size")).alias("h"))
    same = (F.col("h") == F.col("its_h")) & F.col("conv").eqNullSafe(F.col("its_conv"))
    held = stored(opened.join(asked.select("its_conv", "its_h").distinct(), same, "left_semi"), "held")

    spread = held.groupBy("conv", "h").agg(F.min("turn").alias("first"), F.count(F.lit(1)).alias("n"))
    rarest = asked.join(spread, same, "left").groupBy("part").agg(
        F.count(F.lit(1)).alias("windows"), F.count("n").alias("known"), F.min(F.struct("n", "h"))["h"].alias("its_h"), F.max("first").alias("since")
    )
    rarest = stored(texts.join(rarest.where("windows = known"), "part").withColumnRenamed("conv", "its_conv"), "rarest")
    alike = rarest.where("size(words) = size").select("part", F.col("since").alias("origin"))
    told = held.join(rarest.where("size(words) > size"), same).where(F.col("turn") >= F.col("since")).select("part", "text", "its_conv", F.col("turn").alias("its_turn"))
    told = told.join(said, (F.col("turn") == F.col("its_turn")) & F.col("conv").eqNullSafe(F.col("its_conv")))
    sure = told.where(F.contains(F.concat(F.lit(" "), "said", F.lit(" ")), F.concat(F.lit(" "), "text", F.lit(" "))))
    firsts = alike.unionByName(sure.groupBy("part").agg(F.min("turn").alias("origin")))
    found = texts.join(firsts, "part").select(F.col("conv").alias("its_conv"), F.col("text").alias("its_text"), "origin")
    met = parts.join(found, (F.col("text") == F.col("its_text")) & F.col("conv").eqNullSafe(F.col("its_conv")), "left")
    return met.select("conv", "turn", "level", "lines", F.when(F.col("origin") < F.col("turn"), F.col("origin")).alias("origin"))


def _roots(replies: DataFrame) -> DataFrame:
    """`(conv, turn, root)` from `(conv, turn, parent)`: follow parents in steps of doubled length."""
    now = checkpointed(replies.select("conv", "turn", F.col("parent").alias("root")))
    while True:
        up = now.select(F.col("conv").alias("up_conv"), F.col("turn").alias("up_turn"), F.col("root").alias("up_root"))
        met = now.join(up, (F.col("root") == F.col("up_turn")) & F.col("conv").eqNullSafe(F.col("up_conv")), "left")
        met = checkpointed(met.select("conv", "turn", F.coalesce("up_root", "root").alias("root"), F.col("up_root").isNotNull().alias("moved")))
        now = met.drop("moved")
        if met.where("moved").isEmpty():
            return now


def threaded(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per distinct message: `conv_id, turn, role, text` (without quotes), `n_passages`, `n_quoted`, `n_linked` lines, `reply_to` and
    `thread` (turns; the thread of a message that replies to none is its own turn), and `formatted`, the message with its role."""
    given = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")).distinct()
    lined = given.withColumn("lines", _lines(F.col("text")))
    messages = stored(lined.withColumn("own", _own(F.col("lines"))).withColumn("mid", F.monotonically_increasing_id()), "messages")
    links = stored(_links(messages.where("turn is not null")), "links")
    votes = links.where("level = 1 and origin is not null").groupBy("conv", "turn", "origin").agg(F.sum("n").alias("n"))
    replies = votes.groupBy("conv", "turn").agg(F.max(F.struct("n", "origin"))["origin"].alias("parent"))
    replies = checkpointed(replies)
    counts = links.groupBy("conv", "turn").agg(F.sum(F.when(F.col("origin").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked"))
    known = counts.join(replies, counts["conv"].eqNullSafe(replies["conv"]) & (counts["turn"] == replies["turn"]), "left").select(counts["conv"], counts["turn"], "n_linked", "parent")
    if not replies.isEmpty():
        roots = _roots(replies)
        known = known.join(roots, known["conv"].eqNullSafe(roots["conv"]) & (known["turn"] == roots["turn"]), "left").select(known["conv"], known["turn"], "n_linked", "parent", "root")
    else:
        known = known.withColumn("root", F.lit(None).cast("long"))
    known = known.select(F.col("conv").alias("its_conv"), F.col("turn").alias("its_turn"), "n_linked", "parent", "root")
    joined = messages.join(known, (F.col("turn") == F.col("its_turn")) & F.col("conv").eqNullSafe(F.col("its_conv")), "left")
    begins = F.filter("lines", lambda x, i: (x["level"] > 0) & (F.coalesce(F.get("lines", i - 1)["level"], F.lit(0)) != x["level"]))
    quoted = F.filter("lines", lambda x: x["level"] > 0)
    plain = F.trim(F.array_join(F.transform("own", lambda x: x["text"]), "\n"))
    return joined.select(
        F.col("conv").alias("conv_id"),
        "turn",
        "role",
        plain.alias("text"),
        F.size(begins).cast("long").alias("n_passages"),
        F.size(quoted).cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.col("parent").alias("reply_to"),
        F.coalesce("root", "turn").alias("thread"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), plain).alias("formatted"),
    )
