"""Conversations rebuilt from messages that quote each other.

A line's quote level is the number of ``>`` marks it begins with. Every quoted line is normalised (case, white space),
hashed and joined to the latest earlier message of its conversation whose own, unquoted lines hold it; runs of lines of
one level are passages, and a passage comes from the message that most of its lines come from, the latest of equals. A
message replies to the source of its outermost quotes, the passage with most linked lines first; without any it
replies to the message before it. Messages come without their quotes, in an order that puts each behind the one
it replies to.

Everything is column expressions, joins and windows. Looking up what came before is done in two steps, inside
stretches of ``STRETCH`` turns and between them, so that neither a long conversation nor a line that all its messages
repeat meets in one task, and no pairs of messages are listed.

Defined cases: a null text has no lines; its text stays null. A row with a null conversation or turn is no reply, has no
position and is found by no quote. Rows that repeat a conversation and turn share the position; each keeps its own text.
Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, read_table
from churnkit.llm.registry import query

STRETCH = 64
_MARKS = r"^(?:[ \t]*>)*"
_QUOTED = r"^[ \t]*>"


def _before(df: DataFrame, keys: list[str], order: str, value: Column, name: str) -> DataFrame:
    """Adds the latest ``value`` that is not null in rows of the same keys with a smaller ``order``.

    ``order`` must rise with the value. Rows of a key meet stretch by stretch; what each stretch ends with is handed on.
    """
    df = df.withColumn("_value", value).withColumn("_stretch", F.floor(F.col(order) / STRETCH))
    inside = Window.partitionBy(*keys, "_stretch").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.last("_value", ignorenulls=True).over(inside))
    ends = df.groupBy(*keys, "_stretch").agg(F.max("_value").alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_earlier", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    joined = local.join(ends, [*keys, "_stretch"], "left")
    return joined.withColumn(name, F.coalesce("_local", "_earlier")).drop("_value", "_stretch", "_local", "_earlier")


def _parsed(messages: DataFrame) -> DataFrame:
    """Each message with its lines as (level, hash of the normalised content, null if blank), and its text without quotes.

    Lines are read inside their message; to find where they come from, only hashes move.
    """
    lines = F.split("text", "\n", -1)
    marked = F.transform(lines, lambda l: F.struct(l.alias("line"), F.regexp_extract(l, _MARKS, 0).alias("marks")))

    def entry(m: Column) -> Column:
        level = F.length(m["marks"]) - F.length(F.translate(m["marks"], ">", ""))
        plain = F.lower(F.trim(F.regexp_replace(F.substr(m["line"], F.length(m["marks"]) + 1), r"\s+", " ")))
        return F.struct(level.alias("level"), F.when(plain != "", F.xxhash64(plain)).alias("hash"))

    bare = F.array_join(F.filter(lines, lambda l: ~l.rlike(_QUOTED)), "\n")
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    return messages.select(
        "conv_id",
        "turn",
        "role",
        F.xxhash64("text").alias("digest"),
        F.when(placed, F.transform(marked, entry)).alias("lines"),
        F.when(placed, bare).otherwise(F.col("text")).alias("text"),
    )


def link_quotations(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, position, reply_to, n_quoted and n_linked lines, and text without quotes."""
    ws = Workspace(messages.sparkSession)
    own = ws.write(_parsed(messages))
    placed = own.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    lines = placed.select("conv_id", "turn", "digest", "lines").distinct()
    lines = lines.select("conv_id", "turn", "digest", F.posexplode("lines").alias("number", "line"))
    lines = ws.write(lines.select("conv_id", "turn", "digest", "number", "line.level", "line.hash"))

    # Originals and quotes of the same line, in the order of turns; the latest original before each quote.
    known = lines.where(F.col("hash").isNotNull())
    seen = known.groupBy("conv_id", "hash", "turn").agg(F.max(F.col("level") == 0).alias("original"))
    seen = _before(seen, ["conv_id", "hash"], "turn", F.when(F.col("original"), F.col("turn")), "source").drop("original")
    quoted = lines.where(F.col("level") > 0).join(seen, ["conv_id", "hash", "turn"], "left")
    message = ["conv_id", "turn", "digest"]
    # Lines of one level in a row have the same difference of number and rank.
    run = F.col("number") - F.row_number().over(Window.partitionBy(*message, "level").orderBy("number"))
    quoted = ws.write(quoted.withColumn("run", run))
    ws.drop(lines)
    votes = quoted.where(F.col("source").isNotNull()).groupBy(*message, "level", "run", "source").agg(
        F.count("*").alias("votes"), F.min("number").alias("first")
    )
    best = F.max(F.struct("votes", "source")).alias("best")
    passages = votes.groupBy(*message, "level", "run").agg(best, F.sum("votes").alias("linked"), F.min("first").alias("first"))
    outer = F.max(F.struct(-F.col("level"), F.col("best.votes"), -F.col("first"), F.col("best.source"))).alias("outer")
    linked = passages.groupBy(*message).agg(outer, F.sum("linked").alias("n_linked"))
    linked = linked.select(*message, F.col("outer.source").alias("answers"), "n_linked")

    # Positions: how many turns of the conversation come before, counted in the same two steps.
    turns = placed.select("conv_id", "turn").distinct()
    turns = _before(turns, ["conv_id"], "turn", F.col("turn"), "previous")
    turns = turns.withColumn("_stretch", F.floor(F.col("turn") / STRETCH))
    sizes = turns.groupBy("conv_id", "_stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("skipped", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("conv_id", "_stretch").orderBy("turn"))
    turns = turns.withColumn("rank", rank).join(sizes, ["conv_id", "_stretch"])
    turns = turns.select("conv_id", "turn", "previous", (F.col("rank") + F.col("skipped") - 1).alias("position"))

    done = own.join(turns, ["conv_id", "turn"], "left").join(linked, message, "left")
    none = F.lit(0).cast("long")
    quotes = F.size(F.filter("lines", lambda l: l["level"] > 0)).cast("long")
    return done.select(
        "conv_id",
        "turn",
        "role",
        F.col("position").cast("long").alias("position"),
        F.coalesce("answers", "previous").alias("reply_to"),
        F.when(F.col("lines").isNull(), none).otherwise(quotes).alias("n_quoted"),
        F.coalesce("n_linked", none).alias("n_linked"),
        "text",
    )


DEPTH = 2
_BACK = 3


def answered(turn: Column) -> Column:
    """The turn that a turn is taken to answer: one, two or three before it, by a rule that mixes conversation and turn."""
    return turn - 1 - F.pmod(F.col("conv_id") * 31 + turn * 17, F.lit(_BACK))


def as_mail(messages: DataFrame) -> DataFrame:
    """Turns as mail would carry them: above its own text each quotes the turn it answers, and what that answered.

    Quotes are up to ``DEPTH`` levels deep, the deepest first. A turn whose answered one is not there quotes nothing. Each
    text goes to the turns that quote it, so that all levels meet by conversation and turn.
    """
    mail, there, quotes = messages, F.lit(True), []
    for level in range(1, DEPTH + 1):
        near = F.sequence(F.col("turn") + level, F.col("turn") + _BACK * level)
        later = F.filter(near, lambda t: reduce(lambda x, _: answered(x), range(level), t) == F.col("turn"))
        marked = F.regexp_replace("text", "(?m)^", ">" * level + " ")
        earlier = messages.select("conv_id", F.explode(later).alias("turn"), marked.alias(f"_quote{level}"), F.lit(True).alias(f"_has{level}"))
        mail = mail.join(earlier, ["conv_id", "turn"], "left")
        there = there & F.coalesce(f"_has{level}", F.lit(False))
        quotes.insert(0, F.when(there, F.col(f"_quote{level}")))
    text = F.concat_ws("\n", *quotes, "text")
    return mail.select(*[text.alias(c) if c == "text" else F.col(c) for c in messages.columns])


_SQL = r"""
with recursive chain as (
  select n.conv_id, n.turn, 1 as level, a.turn as at, a.text
  from conversations n join conversations a on a.conv_id = n.conv_id and a.turn = n.turn - 1 - (n.conv_id * 31 + n.turn * 17) % 3
  union all
  select c.conv_id, c.turn, c.level + 1, a.turn, a.text
  from chain c join conversations a on a.conv_id = c.conv_id and a.turn = c.at - 1 - (c.conv_id * 31 + c.at * 17) % 3
  where c.level < 2
), line as (
  select conv_id, turn, lower(trim(regexp_replace(l, '\s+', ' ', 'g'))) as l
  from (select conv_id, turn, unnest(string_split(text, chr(10))) as l from conversations)
), quoted as (
  select conv_id, turn, level, lower(trim(regexp_replace(l, '\s+', ' ', 'g'))) as l
  from (select conv_id, turn, level, unnest(string_split(text, chr(10))) as l from chain)
), source as (
  select q.conv_id, q.turn, q.level, q.l, count(distinct q.l) as n, max(o.turn) as source
  from (select distinct conv_id, turn, level, l from quoted where l <> '') q
    join line o on o.conv_id = q.conv_id and o.l = q.l and o.turn < q.turn
  group by q.conv_id, q.turn, q.level, q.l
), vote as (
  select q.conv_id, q.turn, q.level, s.source, count(*) as votes
  from quoted q join source s on s.conv_id = q.conv_id and s.turn = q.turn and s.level = q.level and s.l = q.l
  group by q.conv_id, q.turn, q.level, s.source
), answers as (
  select conv_id, turn, source
  from (select *, row_number() over (partition by conv_id, turn order by level, votes desc, source desc) as place from vote)
  where place = 1
), counted as (
  select conv_id, turn, count(*) as lines, count(*) filter (l <> '') as filled from quoted group by conv_id, turn
)
select n.conv_id, n.turn, n.role,
  (row_number() over (partition by n.conv_id order by n.turn) - 1)::bigint as position,
  coalesce(a.source, lag(n.turn) over (partition by n.conv_id order by n.turn)) as reply_to,
  coalesce(c.lines, 0)::bigint as n_quoted, coalesce(c.filled, 0)::bigint as n_linked, n.text
from conversations n left join answers a on a.conv_id = n.conv_id and a.turn = n.turn
  left join counted c on c.conv_id = n.conv_id and c.turn = n.turn
"""


@query(_SQL)
def op2_chat_formatting(spark, sf_dir):
    """All conversations, given the quotes that mail would carry, and rebuilt from these.

    The table has no quote marks of its own, so its turns are first written the way mail quotes them: each answers one of
    the three turns before it, and only its quotes tell which.
    """
    return link_quotations(as_mail(read_table(spark, sf_dir, "conversations")))
