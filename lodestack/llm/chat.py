"""Operator 6: chat formatting by quotation linking.

Quoted lines start with one or more `>`. Each run of quoted lines of one level in a message is a passage. Its words,
normalised, are hashed as a whole and joined to what earlier messages of the conversation say; a passage that nobody
said as a whole is joined by its shingles. Conversations are then ordered by reply, depth first, without the quotes.
All of it is SQL functions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arrays import let
from .common import cut, remove, table

QUOTE = r"^[ \t]*((?:>[ \t]?)+)"
#: turns whose messages are compared in one window; what a cell takes from those before it comes from a table with a row a cell
CELL = 64
#: words of a shingle, and the share of a passage's shingles that its original must say
WIDTH, SAID = 5, 0.8


def normal(text: Column) -> Column:
    """Lower-case words with single spaces between them; white space and punctuation only separate."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\p{Punct}]+", " "))


def lines_of(text: Column) -> Column:
    """Array of (level, line): level counts the `>` marks, line is without them."""

    def line(raw: Column) -> Column:
        marks = F.regexp_extract(raw, QUOTE, 1)
        level = F.length(F.regexp_replace(marks, r"[^>]", ""))
        return F.struct(level.alias("level"), F.when(level > 0, F.regexp_replace(raw, QUOTE, "")).otherwise(raw).alias("line"))

    return F.transform(F.split(text, r"\r?\n", -1), line)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, uid, body (the text without quoted lines), max_level, quoted (its lines, if any is quoted), said (the unquoted text, quotes leaving a blank line).

    Repeated rows of one (conv_id, turn, role, text) count once; `uid` tells apart messages that share a turn.
    conv_id is wrapped in a struct, in which a null is a value that equals itself.
    """
    rows = messages.select(F.struct("conv_id").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("uid", F.xxhash64("role", "text"))
    some = F.regexp_like("text", F.lit("(?m)" + QUOTE))
    rows = rows.withColumn("lines", F.when(some, lines_of(F.col("text"))))
    own = F.filter("lines", lambda x: x["level"] == 0)
    body = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["line"]), "\n"), r"^\s+|\s+$", "")
    said = F.array_join(F.transform("lines", lambda x: F.when(x["level"] == 0, x["line"]).otherwise("")), "\n")
    parsed = rows.select(
        "conv_id", "turn", "role", "uid",
        F.when(some, body).otherwise(F.col("text")).alias("body"),
        F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).alias("max_level"),
        F.col("lines").alias("quoted"),
        F.when(some, said).otherwise(F.col("text")).alias("said"),
    )
    return parsed.dropDuplicates(["conv_id", "turn", "uid"])


def passages(parsed: DataFrame) -> DataFrame:
    """(conv_id, position, turn, passage, level, words): the quoted passages, each by the number of its first line, with their normalised words; those without a word are left out."""
    lines = parsed.filter("quoted is not null").select("conv_id", "position", "turn", F.posexplode("quoted").alias("no", "q"))
    lines = lines.select("conv_id", "position", "turn", "no", "q.level", "q.line")
    order = Window.partitionBy("conv_id", "position").orderBy("no")  # the lines of one message
    starts = F.when(F.col("level") != F.coalesce(F.lag("level").over(order), F.lit(-1)), F.col("no"))
    runs = lines.withColumn("starts", starts).withColumn("passage", F.last("starts", ignorenulls=True).over(order)).filter("level > 0")
    runs = runs.groupBy("conv_id", "position", "turn", "passage", "level").agg(F.array_sort(F.collect_list(F.struct("no", "line"))).alias("own"))
    return runs.select("conv_id", "position", "turn", "passage", "level", normal(F.array_join("own.line", " ")).alias("words")).filter("words <> ''")


def shingles(words: Column) -> Column:
    """Distinct hashes of each WIDTH successive words of normalised text; of all words where there are fewer; none of an empty text."""

    def rolled(w: Column) -> Column:
        n = F.greatest(F.size(w) - WIDTH, F.lit(0))
        return F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, F.lit(WIDTH)), " ")))

    return F.when(words == "", F.array().cast("array<bigint>")).otherwise(F.array_distinct(let(F.split(words, " "), rolled)))


def units(said: Column) -> Column:
    """Distinct hashes of what can be quoted as a whole: each line, each paragraph and the whole text."""

    def hashes(texts: Column) -> Column:
        return F.array_distinct(F.transform(F.filter(F.transform(texts, normal), lambda x: x != ""), lambda x: F.xxhash64(x)))

    return hashes(F.concat(F.split(said, r"\r?\n", -1), F.split(said, r"\n\s*\n", -1), F.array(said)))


def latest_earlier(asked: DataFrame, said: DataFrame) -> DataFrame:
    """The rows of `asked` (conv_id, hash, turn, ask) with `message`, the last of `said` (conv_id, hash, turn, message) of
    an earlier turn with the same hash, or null.

    One window in cells of CELL turns, so neither a common line nor a long conversation comes to one task, and no pair
    of one asked and one said row is made.
    """
    kind = dict(said.dtypes)["message"]
    every = said.select("conv_id", "hash", "turn", "message", F.lit(None).cast(dict(asked.dtypes)["ask"]).alias("ask"))
    every = every.unionByName(asked.select("conv_id", "hash", "turn", F.lit(None).cast(kind).alias("message"), "ask"))
    every = every.filter("turn is not null").withColumn("cell", F.expr(f"turn div {CELL}") - F.when(F.col("turn") < 0, 1).otherwise(0))
    cells = every.groupBy("conv_id", "hash", "cell").agg(F.max("message").alias("last"))
    before = Window.partitionBy("conv_id", "hash").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("conv_id", "hash", "cell", F.max("last").over(before).alias("_last"))
    inside = Window.partitionBy("conv_id", "hash", "cell").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = every.withColumn("_own", F.max("message").over(inside)).filter("ask is not null")
    return found.join(cells, ["conv_id", "hash", "cell"]).select("conv_id", "hash", "turn", "ask", F.coalesce("_own", "_last").alias("message"))


def link_quotes(parsed: DataFrame) -> DataFrame:
    """(conv_id, position, passage, level, original, share): the quoted passages with the message each is from, if any.

    The original is the last message of an earlier turn that says the passage as a whole: as one of its lines, its
    paragraphs or its whole text, however the lines are wrapped. Where there is none, each shingle of the passage names
    the last earlier message that says it, and of those named the one that says the greatest share of the passage's
    distinct shingles is the original, if that is SAID or more (ties: the later turn, then the larger uid).
    """
    asked = passages(parsed).withColumn("ask", F.struct("position", "passage", "level"))
    asked = cut(asked, "passages")
    own = parsed.join(asked.select("conv_id").distinct(), "conv_id", "left_semi").filter("said <> ''")
    own = own.select("conv_id", "turn", F.struct("turn", "uid", "position").alias("message"), "said")
    whole = own.select("conv_id", "turn", "message", F.explode(units(F.col("said"))).alias("hash"))
    exact = latest_earlier(asked.withColumn("hash", F.xxhash64("words")), whole)
    exact = cut(exact.select("conv_id", "ask.position", "ask.passage", "ask.level", F.col("message.position").alias("original")), "exact")

    left = asked.join(exact.filter("original is null"), ["conv_id", "position", "passage"], "left_semi")
    left = cut(left.select("conv_id", "turn", "ask", shingles(F.col("words")).alias("shingles")), "left")
    talk = own.join(left.select("conv_id").distinct(), "conv_id", "left_semi")
    talk = cut(talk.select("conv_id", "turn", "message", F.array_union(shingles(normal(F.col("said"))), units(F.col("said"))).alias("shingles")), "talk")
    named = latest_earlier(left.select("conv_id", "turn", "ask", F.explode("shingles").alias("hash")), talk.select("conv_id", "turn", "message", F.explode("shingles").alias("hash")))
    named = named.filter("message is not null").select("conv_id", "ask", "message").distinct()
    pairs = named.join(left.select("conv_id", "ask", F.col("shingles").alias("_asked")), ["conv_id", "ask"]).join(talk.select("conv_id", "message", F.col("shingles").alias("_said")), ["conv_id", "message"])
    pairs = pairs.withColumn("share", F.size(F.array_intersect("_asked", "_said")) / F.size("_asked")).filter(F.col("share") >= SAID)
    best = pairs.groupBy("conv_id", "ask").agg(F.max(F.struct("share", "message")).alias("best"))
    best = best.select("conv_id", "ask.position", "ask.passage", F.col("best.message.position").alias("_original"), F.col("best.share").alias("_share"))
    linked = exact.join(best, ["conv_id", "position", "passage"], "left")
    return linked.select("conv_id", "position", "passage", "level", F.coalesce("original", "_original").alias("original"), F.when(F.col("original").isNotNull(), 1.0).otherwise(F.col("_share")).alias("share"))


def reply_parents(linked: DataFrame) -> DataFrame:
    """(conv_id, position, original, linked_quotes): a message that quotes replies to the original of its first linked
    passage of the least level."""
    own = linked.filter("original is not null").groupBy("conv_id", "position")
    own = own.agg(F.min(F.struct("level", "passage", "original")).alias("to"), F.count("*").alias("linked_quotes"))
    return own.select("conv_id", "position", F.col("to.original").alias("original"), "linked_quotes")


def _placed(parsed: DataFrame) -> DataFrame:
    """Adds position, from 0 in (turn, uid) order of the conversation, and prev_turn, the turn of the message before.

    Windows run inside cells of CELL turns, so a conversation of any length isn't brought to one task: the first of a
    cell takes what the cells before it leave, from a table with one row a cell.
    """
    dealt = parsed.withColumn("cell", F.floor(F.col("turn") / CELL))
    cells = cut(dealt.groupBy("conv_id", "cell").agg(F.count("*").alias("n"), F.max(F.struct("turn", "uid")).alias("last")), "cells")
    order = Window.partitionBy("conv_id").orderBy(F.col("cell").asc_nulls_first())
    cells = cells.select("conv_id", "cell", (F.sum("n").over(order) - F.col("n")).alias("_skip"), F.lag("last").over(order).alias("_last"))
    inside = Window.partitionBy("conv_id", "cell").orderBy(F.col("turn").asc_nulls_first(), "uid")
    rows = dealt.withColumn("_k", F.row_number().over(inside) - 1).withColumn("_prev", F.lag(F.struct("turn", "uid")).over(inside))
    rows = rows.join(cells.select(F.col("conv_id").alias("_c"), F.col("cell").alias("_e"), "_skip", "_last"), (F.col("conv_id") == F.col("_c")) & F.col("cell").eqNullSafe(F.col("_e")))
    return rows.select(*parsed.columns, (F.col("_skip") + F.col("_k")).alias("position"), F.coalesce("_prev", "_last")["turn"].alias("prev_turn"))


def _runs(rows: DataFrame) -> DataFrame:
    """Adds run, the position of the last start at or before a message, and run_turn, its turn: the same cells again."""
    dealt = rows.withColumn("cell", F.floor(F.col("position") / CELL)).withColumn("_start", F.when(F.col("starts"), F.struct("position", "turn")))
    every = cut(dealt.groupBy("conv_id", "cell").agg(F.max("_start").alias("last")), "cells")
    order = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    every = every.select("conv_id", "cell", F.last("last", ignorenulls=True).over(order).alias("_last"))
    inside = Window.partitionBy("conv_id", "cell").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    joined = dealt.withColumn("_own", F.last("_start", ignorenulls=True).over(inside)).join(every, ["conv_id", "cell"])
    start = F.coalesce("_own", "_last")
    return joined.select(*rows.columns, start["position"].alias("run"), start["turn"].alias("run_turn"))


def reply_order(rows: DataFrame) -> DataFrame:
    """(conv_id, run, before, base): of each run of messages that follow each other, the messages before it in depth-first
    order and the replies from the conversation's first message to its own first.

    A message that replies to the one before it is that one's first child, so a run stays together and the branches off
    it come after it: the later they leave, the earlier they come. The Euler tour of the tree of runs is a linked list,
    whose sums from each place to the end come by pointer doubling: a number of joins in the logarithm of the branches.
    Conversations without a branch need none.
    """
    runs = rows.groupBy("conv_id", "run").agg(F.count("*").alias("n"), F.max(F.when(F.col("starts"), F.col("parent"))).alias("leaves"))
    forked = runs.filter("leaves is not null")
    owner = rows.select("conv_id", F.col("position").alias("leaves"), F.col("run").alias("of"))
    forked = forked.join(owner, ["conv_id", "leaves"])
    siblings = Window.partitionBy("conv_id", "of").orderBy(F.desc("leaves"), "run")
    forked = forked.select("conv_id", "run", "n", "of", (F.col("leaves") - F.col("of") + 1).alias("down"), F.lead("run").over(siblings).alias("next"), (F.row_number().over(siblings) == 1).alias("eldest"))
    forked = cut(forked, "forked")
    plain = runs.filter("leaves is null").select("conv_id", "run", "n")
    if forked.isEmpty():
        return plain.select("conv_id", "run", F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("base"))
    roots = cut(plain.join(forked.select("conv_id").distinct(), "conv_id", "left_semi"), "roots")
    tree = roots.select("conv_id", "run", "n", F.lit(None).cast("long").alias("of"), F.lit(0).cast("long").alias("down"), F.lit(None).cast("long").alias("next")).unionByName(forked.drop("eldest"))
    child = forked.filter("eldest").select("conv_id", F.col("of").alias("run"), F.col("run").alias("child"))
    tree = tree.join(child, ["conv_id", "run"], "left")
    place = lambda run, leaving: F.when(run.isNotNull(), run * 2 + leaving)  # noqa: E731 - a run is entered and left
    enter = tree.select("conv_id", (F.col("run") * 2).alias("at"), F.coalesce(place(F.col("child"), 0), place(F.col("run"), 1)).alias("to"), "n", "down")
    leave = tree.select("conv_id", (F.col("run") * 2 + 1).alias("at"), F.coalesce(place(F.col("next"), 0), place(F.col("of"), 1)).alias("to"), F.lit(0).cast("long").alias("n"), (-F.col("down")).alias("down"))
    tour = cut(enter.unionByName(leave), "tour")
    while not tour.filter("to is not null").isEmpty():
        ahead = tour.select("conv_id", F.col("at").alias("to"), F.col("to").alias("_to"), F.col("n").alias("_n"), F.col("down").alias("_down"))
        further = tour.join(ahead, ["conv_id", "to"], "left")
        new = cut(further.select("conv_id", "at", F.col("_to").alias("to"), (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"), (F.col("down") + F.coalesce("_down", F.lit(0))).alias("down")), "tour")
        remove(tour)
        tour = new
    first = roots.select("conv_id", (F.col("run") * 2).alias("at")).join(tour, ["conv_id", "at"]).select("conv_id", F.col("n").alias("total"))
    sums = tour.filter("at % 2 = 0").join(first, "conv_id")
    # from an entry to the end, what is entered on the way to it and not left again counts with a minus
    own = tree.select("conv_id", "run", F.col("down").alias("_own"))
    placed = sums.select("conv_id", F.expr("at div 2").alias("run"), (F.col("total") - F.col("n")).alias("before"), "down").join(own, ["conv_id", "run"])
    placed = placed.select("conv_id", "run", "before", (F.col("_own") - F.col("down")).alias("base"))
    rest = plain.join(forked.select("conv_id").distinct(), "conv_id", "left_anti")
    return placed.unionByName(rest.select("conv_id", "run", F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("base")))


def format_chats(messages: DataFrame) -> DataFrame:
    """Per message, once: conv_id, turn, role, text (without quotes), quote_depth, linked_quotes, reply_to (turn, null for
    the first), thread (turn of the first message of its run), depth (replies from the conversation's first message),
    position (in turn order), reply_position (in reply order: depth first, the replies to a message in turn order).

    Sorting a conversation by reply_position gives it as a tree of replies. A message that quotes an earlier one replies
    to it, any other to the message before it. A null text counts as empty; a null conv_id is a value like any other;
    messages with a null turn come first and neither quote nor are quoted; a message of only quotes has an empty text
    and stays. Repeated rows count once; other columns are ignored; an empty table gives an empty result.
    """
    parsed = cut(_placed(parse_messages(messages)), "messages")
    linked = reply_parents(link_quotes(parsed))
    rows = parsed.join(linked, ["conv_id", "position"], "left")
    original = parsed.select("conv_id", F.col("position").alias("original"), F.col("turn").alias("original_turn"))
    rows = rows.join(original, ["conv_id", "original"], "left")
    last = F.col("position") - 1
    parent = F.coalesce("original", F.when(last >= 0, last))
    rows = rows.select("conv_id", "position", "turn", "role", "body", "max_level", F.coalesce("linked_quotes", F.lit(0)).cast("int").alias("linked_quotes"), parent.alias("parent"), F.when(F.col("original").isNotNull(), F.col("original_turn")).otherwise(F.col("prev_turn")).alias("reply_to"), (~parent.eqNullSafe(last)).alias("starts"))
    rows = cut(_runs(rows), "replies")
    placed = rows.join(cut(reply_order(rows), "order"), ["conv_id", "run"])
    inside = F.col("position") - F.col("run")
    return placed.select("conv_id.conv_id", "turn", "role", F.col("body").alias("text"), F.col("max_level").alias("quote_depth"), "linked_quotes", "reply_to", F.col("run_turn").alias("thread"), (F.col("base") + inside).alias("depth"), "position", (F.col("before") + inside).alias("reply_position"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))
