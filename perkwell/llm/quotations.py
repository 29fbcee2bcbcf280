"""Conversations from messages that quote each other.

A line that starts with ``>`` signs is quoted, as many levels deep as there are signs.
Consecutive quoted lines of one level, up to a blank line, are a passage. Passages are
normalised (case, blanks) and hashed, and joined within the conversation to the
earliest message whose own words contain them: as a whole message, a paragraph or a
line. A message replies to the original of its least nested passage (the latest one if
there are several); deeper levels are what that message quoted in turn. Following
replies back gives the thread. Rows ordered by conv_id, thread and turn have
every message after the one it answers, with its own text only. All of it is column expressions and joins; a
run of lines is a slice between a line that begins one and the next line that ends one.

Edge cases: a NULL or empty text has no passages and an empty own text; a passage
nobody wrote before stays unlinked but is removed as well; a message without a
linked quote starts a thread; repeated rows stay, and messages with the same
conv_id and turn share what they reply to; conv_id may be of any type; NULL keys are never linked; other
columns are not read. Blanks are those of ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from perkwell.llm.common import let, salted_join
from perkwell.sources.checkpoints import cut

SALTS = 8
_BLANK = r"[ \t\r\n\f\x0B]"
_MARK = r"^[ \t\r\f\x0B]*(?:>[ \t\r\f\x0B]?)+"


def normal(text: Column) -> Column:
    """Lower case, with single blanks between words."""
    return F.trim(F.regexp_replace(F.lower(text), f"{_BLANK}+", " "))


def key_of(text: Column) -> Column:
    """Hash of a passage, whatever its case, blanks and line breaks."""
    return F.unhex(F.md5(normal(text)))


def lines_of(text: Column) -> Column:
    """(level, line, filled) of every line: quote level, content, whether there is more than blanks."""
    def one(line: Column) -> Column:
        return let(F.regexp_extract(line, _MARK, 0), lambda mark: F.struct(
            F.length(F.regexp_replace(mark, "[^>]", "")).alias("level"), F.substr(line, F.length(mark) + 1).alias("line"),
            F.rlike(F.substr(line, F.length(mark) + 1), F.lit(r"[^ \t\r\n\f\x0B]")).alias("filled"),
        ))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), one)


def runs_of(lines: Column) -> Column:
    """The runs of filled lines of one level as (level, lines): where a run begins and where one ends alternate."""
    def bounds(all_lines: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(all_lines) - 1)

        def goes_on(line: Column, beside: Column) -> Column:
            return F.coalesce(beside["filled"] & (beside["level"] == line["level"]), F.lit(False))

        def edges(step: int) -> Column:
            return F.filter(places, lambda i: F.get(all_lines, i)["filled"] & ~goes_on(F.get(all_lines, i), F.get(all_lines, i + step)))

        return F.zip_with(edges(-1), edges(1), lambda first, last: F.struct(
            F.get(all_lines, first)["level"].alias("level"),
            F.transform(F.slice(all_lines, first + 1, last - first + 1), lambda x: x["line"]).alias("lines"),
        ))

    return let(lines, bounds)


def own_text(lines: Column) -> Column:
    own = F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["line"])
    return F.btrim(F.array_join(own, "\n"), F.lit(" \t\r\n\f\x0b"))


def parsed(messages: DataFrame) -> DataFrame:
    """The hashes of the quoted passages and those under which the own words can be quoted."""
    def joined(lines: Column) -> Column:
        return key_of(F.array_join(lines, " "))

    quotes = F.transform(F.filter("_runs", lambda r: r["level"] > 0), lambda r: F.struct(
        r["level"].alias("level"), joined(r["lines"]).alias("whole"), F.transform(r["lines"], key_of).alias("lines"),
    ))
    mine = F.filter("_runs", lambda r: r["level"] == 0)
    every = F.flatten(F.transform(mine, lambda r: r["lines"]))
    keys = F.when(F.size(every) > 0, F.array_distinct(F.concat(
        F.array(joined(every)), F.transform(mine, lambda r: joined(r["lines"])), F.transform(every, key_of)
    ))).otherwise(F.array().cast("array<binary>"))
    return messages.select("conv_id", "turn", runs_of(lines_of(F.col("text").cast("string"))).alias("_runs")).select(
        "conv_id", "turn", quotes.alias("quotes"), keys.alias("own_keys")
    )


def linked_quotes(rows: DataFrame) -> DataFrame:
    """conv_id, turn, level, place of each passage with the turn of its original, where there is one."""
    originals = rows.select("conv_id", "turn", F.explode("own_keys").alias("key")).groupBy("conv_id", "key").agg(
        F.min("turn").alias("original")
    )
    quoted = rows.select("conv_id", "turn", F.posexplode("quotes").alias("place", "q"))
    # Whole passages first; a passage no message has as such is looked up line by line.
    asked = quoted.select("conv_id", "turn", "place", "q.level", F.explode(F.concat(
        F.array(F.struct(F.lit(0).alias("rank"), F.col("q.whole").alias("key"))),
        F.transform("q.lines", lambda k: F.struct(F.lit(1).alias("rank"), k.alias("key"))),
    )).alias("a")).select("conv_id", "turn", "place", "level", "a.rank", "a.key")
    met = salted_join(asked, originals, ["conv_id", "key"], "turn", SALTS).filter("original < turn")
    return met.groupBy("conv_id", "turn", "place", "level").agg(F.min_by("original", F.struct("rank", "original")).alias("original"))


def replies(rows: DataFrame) -> DataFrame:
    """conv_id, turn, the turn it replies to and how many of its passages are linked."""
    return linked_quotes(rows).groupBy("conv_id", "turn").agg(
        F.max_by("original", F.struct(-F.col("level"), "original")).alias("reply_to"), F.count("*").alias("n_linked")
    )


def threads(linked: DataFrame) -> DataFrame:
    """conv_id, turn, thread (turn of the first message) and depth, by following replies twice as far each round."""
    state = cut(linked.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")))
    while True:
        above = state.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("_up"), F.col("depth").alias("_more"))
        stepped = cut(salted_join(state, above, ["conv_id", "thread"], "turn", SALTS, "left").select(
            "conv_id", "turn", F.coalesce("_up", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"), F.col("_up").isNotNull().alias("_moved"),
        ))
        state = stepped.drop("_moved")
        if stepped.filter("_moved").isEmpty():
            return state


def link_quotations(messages: DataFrame) -> DataFrame:
    """Every message with its own text, what it replies to, its thread and its depth there."""
    # Only hashes are written; own texts are taken from the messages at the end.
    linked = cut(replies(cut(parsed(messages))))
    placed = linked.join(threads(linked), ["conv_id", "turn"])
    lines = lines_of(F.col("text").cast("string"))
    told = messages.select(
        "conv_id", "turn", F.col("role").cast("string").alias("role"), own_text(lines).alias("_own"),
        F.size(F.filter(runs_of(lines), lambda r: r["level"] > 0)).cast("long").alias("n_quotes"),
    )
    return told.join(placed, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "reply_to", F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "n_quotes",
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("_own").alias("text"),
    )
