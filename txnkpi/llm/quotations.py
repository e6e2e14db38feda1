"""Quotation linking: conversations in the order of replies, without quotes.

A line's level is the number of ``>`` before it. Lines of level 0 are a message's own, but for
the line that announces a quote. A quoted line is normalised (lower case, runs of other than
letters and digits as one space) and hashed, and so are all own lines. Each quoted line is
joined to the last earlier message of its conversation whose own lines hold that hash, by one
pass over the lines of a hash in order of turns. Quoted lines without such a message may be
wrapped anew or hold parts of lines: the lines of a level are joined to one passage, and the
hashes of its word n-grams are looked up in the same way among those of the own passages of
earlier messages; such a line counts for the message that holds most of its n-grams (the last
of equals). The message that holds most lines of the
lowest quoted level that was found (the last of equals) is what a message replies to.
Following these links by doubling gives each message the root of its thread and its depth;
ordered by root, depth and turn, every reply stands after its original.

Native: DataFrame functions only. N-grams are made for conversations with such lines alone. Own lines take part only if their hash is quoted at all;
nothing is paired beyond a quoted line and its one original.

Defined cases: NULL text has no lines; its own text is NULL. Quotes without an original, also
those of later turns, link nothing; neither do passages of fewer than ``GRAM`` words that are
no whole lines; a message without links is its own root at depth 0. Lines
without letters or digits are never matched. Repeated rows (equal conversation and turn) are
one message whose lines are all lines; each row keeps its own text. Rows with a NULL
conversation or turn stay alone. An empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnkpi.llm.common import written

# Possessive repetition: Java's regular expressions repeat other groups by recursion.
_PREFIX = r"^(?:[ \t]*+>)++"
_ANNOUNCED = r"(?i)^[ \t]*(?:on|am|le|el)\b.*(?:wrote|schrieb|écrit|escribió)\b.*:[ \t\r]*$"
MOST_ROUNDS = 64
#: Words of an n-gram.
GRAM = 4


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _PREFIX, 0), "[^>]", ""))


def _normal(line: Column) -> Column:
    body = F.lower(F.regexp_replace(line, _PREFIX, ""))
    return F.trim(F.regexp_replace(body, r"[^\p{L}\p{N}]+", " "))


def parsed(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, own, lines): own text, and (level, hash, body) of every line with words."""
    lines = F.split(F.col(text_col), "\n")
    df = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), lines.alias("l")
    )
    levels = F.transform("l", _level)
    df = df.withColumn("v", levels)
    own = F.filter(
        F.transform("l", lambda x, i: F.when(
            (F.get("v", i) == 0) & ~(x.rlike(_ANNOUNCED) & (F.coalesce(F.get("v", i + 1), F.lit(0)) > 0)), x
        )),
        lambda x: x.isNotNull(),
    )
    hashed = F.filter(
        F.transform("l", lambda x, i: F.struct(F.get("v", i).alias("level"), F.when(_normal(x) != "", F.md5(_normal(x))).alias("hash"), _normal(x).alias("body"))),
        lambda s: s["hash"].isNotNull(),
    )
    return df.select("conv", "turn", "role", F.trim(F.array_join(own, "\n")).alias("own"), hashed.alias("lines"))


def _last_holders(rows: DataFrame) -> DataFrame:
    """Adds ``parent``: the last earlier turn of the conversation that holds the hash at no level."""
    before = Window.partitionBy("conv", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("parent", F.max(F.when(F.col("level").isNull(), F.col("turn"))).over(before))


def _grams(lines: DataFrame, levels: Column) -> DataFrame:
    """(conv, turn, level, hash, line) for each n-gram of a level's words and each line it touches."""

    def passage(level: Column) -> Column:
        words = F.transform(
            F.filter("lines", lambda s: s["level"] == level),
            lambda s: F.transform(F.split(s["body"], " "), lambda w: F.struct(w.alias("word"), s["hash"].alias("line"))),
        )
        return F.struct(level.alias("level"), F.flatten(words).alias("words"))

    # Exploded first: lambdas then read the words, not the expression that makes them.
    p = lines.select("conv", "turn", F.explode(F.transform(levels, passage)).alias("p")).select("conv", "turn", "p.level", "p.words")
    p = p.filter(F.size("words") >= GRAM)
    starts = F.sequence(F.lit(1), F.size("words") - (GRAM - 1))

    def gram(i: Column) -> Column:
        part = F.slice("words", i, GRAM)
        return F.struct(F.md5(F.array_join(F.transform(part, lambda x: x["word"]), " ")).alias("hash"), F.array_distinct(F.transform(part, lambda x: x["line"])).alias("lines"))

    each = p.select("conv", "turn", "level", F.explode(F.transform(starts, gram)).alias("g"))
    return each.select("conv", "turn", "level", "g.hash", F.explode("g.lines").alias("line"))


def _passage_votes(lines: DataFrame, lost: DataFrame) -> DataFrame:
    """(conv, turn, level, parent, n): lines without an original, by their passages' n-grams."""
    quoting = lines.join(lost.select("conv", "turn").distinct(), ["conv", "turn"], "left_semi")
    levels = F.array_distinct(F.transform(F.filter("lines", lambda s: s["level"] > 0), lambda s: s["level"]))
    unmatched = lost.select("conv", "turn", "level", F.col("hash").alias("line"), F.col("n").alias("times"))
    quoted = _grams(quoting, levels).distinct().join(unmatched.drop("times"), ["conv", "turn", "level", "line"], "left_semi")
    quoted = written(quoted, "quoted_grams")
    own = _grams(lines.join(lost.select("conv").distinct(), "conv", "left_semi"), F.array(F.lit(0)))
    own = own.join(quoted.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi").select("conv", "turn", "hash").distinct()
    both = quoted.unionByName(own.withColumn("level", F.lit(None).cast("int")).withColumn("line", F.lit(None).cast("string")))
    found = _last_holders(both).filter("level is not null and parent is not null")
    held = found.groupBy("conv", "turn", "level", "line", "parent").agg(F.count("*").alias("n"))
    best = held.groupBy("conv", "turn", "level", "line").agg(F.max(F.struct("n", "parent")).alias("b"))
    return best.join(unmatched, ["conv", "turn", "level", "line"]).select(
        "conv", "turn", "level", F.col("b.parent").alias("parent"), F.col("times").alias("n")
    )


def reply_links(lines: DataFrame) -> DataFrame:
    """(conv, turn, parent) from rows (conv, turn, lines); written."""
    each = lines.select("conv", "turn", F.explode("lines").alias("s")).select("conv", "turn", "s.level", "s.hash")
    each = each.filter("conv is not null and turn is not null")
    quoted = each.filter("level > 0").groupBy("conv", "turn", "level", "hash").agg(F.count("*").alias("n"))
    quoted = written(quoted, "quoted")
    wanted = quoted.select("conv", "hash").distinct()
    originals = each.filter("level = 0").join(wanted, ["conv", "hash"], "left_semi").select("conv", "turn", "hash").distinct()
    nothing = F.lit(None)
    both = quoted.select("conv", "hash", "turn", "level", "n").unionByName(
        originals.select("conv", "hash", "turn", nothing.cast("int").alias("level"), nothing.cast("bigint").alias("n"))
    )
    found = _last_holders(both)
    quotes = found.filter("level is not null")
    votes = (
        quotes.filter("parent is not null")
        .groupBy("conv", "turn", "level", "parent").agg(F.sum("n").alias("n"))
    )
    lost = written(quotes.filter("parent is null").select("conv", "turn", "level", "hash", "n"), "unmatched")
    if not lost.isEmpty():
        more = _passage_votes(lines, lost)
        votes = votes.unionByName(more).groupBy("conv", "turn", "level", "parent").agg(F.sum("n").alias("n"))
    best = votes.groupBy("conv", "turn").agg(F.max(F.struct(-F.col("level"), F.col("n"), F.col("parent"))).alias("b"))
    return written(best.select("conv", "turn", F.col("b.parent").alias("parent")), "replies")


def threads(replies: DataFrame) -> DataFrame:
    """(conv, turn, parent, root, depth) for every reply, by doubling the steps taken."""
    state = replies.select("conv", "turn", "parent", F.col("parent").alias("root"), F.lit(1).cast("bigint").alias("depth"))
    for _ in range(MOST_ROUNDS):
        up = state.select("conv", F.col("turn").alias("root"), F.col("root").alias("r2"), F.col("depth").alias("d2"))
        moved = state.join(up, ["conv", "root"], "left").select(
            "conv", "turn", "parent", F.coalesce("r2", "root").alias("root"),
            (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), F.col("r2").isNotNull().alias("moved"),
        )
        moved = written(moved, "threads")
        state = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return state
    raise RuntimeError(f"threads not resolved in {MOST_ROUNDS} rounds")


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per row of ``messages``: own text, quoted lines, and its place among replies.

    ``order by conv_id, root_turn, depth, turn`` reads each conversation in reply order.
    """
    lines = parsed(messages, conv_col, turn_col, role_col, text_col)
    found = threads(reply_links(lines.select("conv", "turn", "lines")))
    found = found.select(F.col("conv").alias("c"), F.col("turn").alias("t"), "parent", "root", "depth")
    joined = lines.join(found, (F.col("conv") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    levels = F.transform("lines", lambda s: s["level"])
    quoted = F.size(F.filter(F.coalesce(levels, F.array().cast("array<int>")), lambda v: v > 0))
    return joined.select(
        F.col("conv").alias("conv_id"), F.col("turn"), F.col("role"), F.col("own").alias("text"),
        quoted.cast("bigint").alias("n_quoted"),
        F.coalesce(F.array_max(levels), F.lit(0)).cast("bigint").alias("max_level"),
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"),
    )
