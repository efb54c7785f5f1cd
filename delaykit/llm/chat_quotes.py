r"""Conversations from messages that quote each other.

Lines that begin with marks (``>``) are quotations, nested as deep as they have marks. A message's own text
is its lines without marks, less the line that announces a quotation. Taking one mark off every quoted line
gives the quoted passage, which is normalised (marks spaced alike, A-Z lower-cased, white space joined) and
hashed, and so are its paragraphs. A whole passage is looked for among whole messages and own texts, its
paragraphs among those of own texts, first of messages that themselves quote what the passage quotes. Of all
earlier messages that hold a text, the latest is the candidate, and a whole passage goes before paragraphs in
the same context, and these before other paragraphs.

Holders and askers of a hash are laid in the order of ids, and each asker takes the last holder so far. A
hash that many messages share is cut into ranges of ids, each of which starts from the last holder of the
ranges before it, so no pairs are made and every message stays a candidate. Roots are found by following
parents in doubling steps, in as many rounds as the logarithm of the deepest thread; a row keeps its root and
depth, never the way there. Messages are then numbered by root and id.

Corner cases: a null or empty message has no text and no parent; a message without a match begins its own
conversation, and so does one with a null id; equal messages are each kept, and replies go to the last before
them;
rows that share an id and have different parents follow the first; an empty table gives no rows; columns
other than id, role and text are not read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.common import let, stored
from delaykit.operators.numbering import numbered

MARKS = r"^[\t ]*((?:>[\t ]?)+)"
ANNOUNCEMENT = r"(?i)^on .* wrote:[\t ]*$"


def level(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 1)
    found = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
    return F.when(F.contains(line, F.lit(">")), found).otherwise(F.lit(0))


def unmarked(line: Column) -> Column:
    """The line with one mark less."""
    return F.regexp_replace(line, r"^[\t ]*>[\t ]?", "")


def normalised(text: Column) -> Column:
    """Text for comparing: marks apart from words, A-Z lower-cased, white space as single spaces."""
    spaced = F.regexp_replace(text, r"(?m)^[\t ]*((?:>[\t ]?)+)", "$1 ")
    spaced = F.replace(spaced, F.lit(">"), F.lit("> "))
    joined = F.trim(F.regexp_replace(spaced, r"[\x20\x09-\x0D]+", " "))
    return F.translate(joined, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hashed(text: Column) -> Column:
    """Hash of a normalised text; null if nothing is left of it."""
    return let(normalised(text), lambda t: F.when(t != "", F.unhex(F.sha2(t, 256))))


def levelled(lines: Column) -> Column:
    """(level, line) of each line, so that marks are counted once."""
    return F.transform(lines, lambda line: F.struct(level(line).alias("level"), line.alias("line")))


def own_text(lines: Column) -> Column:
    """Text of levelled lines without quotations and their announcements."""
    follows = lambda i: F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0
    stay = F.filter(lines, lambda line, i: (line["level"] == 0) & ~(line["line"].rlike(ANNOUNCEMENT) & follows(i)))
    return F.trim(F.array_join(stay["line"], "\n"), F.lit(" \t\n\r"))


def quoted_lines(lines: Column) -> Column:
    """The quoted ones of levelled lines with one mark less, levelled."""
    return levelled(F.transform(F.filter(lines, lambda line: line["level"] > 0), lambda line: unmarked(line["line"])))


def paragraphs(text: Column) -> Column:
    return F.split(text, r"\n[\t ]*\n")


def parse(messages: DataFrame, id_col: str, role_col: str, text_col: str) -> DataFrame:
    """(id, role, own, quote_depth, wholes, parts, context, quote, quote_parts, quote_context): texts and hashes of each message.

    The context of a text is the own text of what it quotes.
    """
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("\r\n"), F.lit("\n"))
    step = lambda **columns: F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    lines = messages.select(
        F.col(id_col).alias("id"), F.col(role_col).alias("role"), text.alias("body"),
        F.explode(F.array(levelled(F.split(text, "\n")))).alias("lines"),
    )
    outer = lines.select(
        "id", "role", "body",
        step(
            own=own_text(F.col("lines")), depth=F.array_max(F.col("lines.level")), quoted=quoted_lines(F.col("lines"))
        ).alias("t"),
    )
    texts = outer.select(
        "id", "role", "body", "t",
        step(
            text=F.array_join("t.quoted.line", "\n"), own=own_text(F.col("t.quoted")), deeper=quoted_lines(F.col("t.quoted"))
        ).alias("q"),
    )
    each = lambda text: F.array_compact(F.array_distinct(F.transform(paragraphs(text), hashed)))
    return texts.select(
        "id", "role", "t.own", F.col("t.depth").alias("quote_depth"),
        F.array_compact(F.array_distinct(F.array(hashed(F.col("body")), hashed(F.col("t.own"))))).alias("wholes"),
        each(F.col("t.own")).alias("parts"), hashed(F.col("q.own")).alias("context"),
        hashed(F.col("q.text")).alias("quote"), F.when(F.col("t.depth") > 0, each(F.col("q.own"))).alias("quote_parts"),
        hashed(own_text(F.col("q.deeper"))).alias("quote_context"),
    )


def last_holders(held: DataFrame, asked: DataFrame) -> DataFrame:
    """(id, kind, found) of each row of ``asked`` (kind, hash, id): the last lower id in ``held`` with its kind and hash."""
    both = held.withColumn("holds", F.lit(True)).union(asked.withColumn("holds", F.lit(False)))
    rows = both.groupBy("kind", "hash", "id").agg(F.max("holds").alias("holds"), F.min("holds").alias("only_holds"))
    ranged = stored(rows.repartitionByRange("kind", "hash", "id").withColumn("range", F.spark_partition_id()), "ranged")
    holder = F.when(F.col("holds"), F.col("id"))
    ends = ranged.groupBy("kind", "hash", "range").agg(F.max(holder).alias("last"))
    ranges = Window.partitionBy("kind", "hash").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.max("last").over(ranges)).filter("carried is not null").drop("last")
    before = Window.partitionBy("range", "kind", "hash").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    near = ranged.withColumn("near", F.max(holder).over(before)).filter("not only_holds")
    return (
        near.join(carried, ["range", "kind", "hash"], "left")
        .select("id", "kind", F.coalesce("near", "carried").alias("found"))
        .filter("found is not null")
    )


def link_parents(parsed: DataFrame) -> DataFrame:
    """(id, parent) of the messages that quote another, earlier one."""
    known = parsed.filter("id is not null")

    def texts(wholes: Column, parts: Column, context: Column) -> DataFrame:
        """(kind, hash, id): 0 for whole texts, 1 for paragraphs in their context, 2 for paragraphs."""
        entry = lambda kind: lambda h: F.struct(F.lit(kind).alias("kind"), h.alias("hash"))
        placed = F.when(context.isNotNull(), F.transform(parts, lambda h: F.unhex(F.sha2(F.concat(h, context), 256))))
        lists = F.transform(wholes, entry(0)), F.transform(placed, entry(1)), F.transform(parts, entry(2))
        each = F.flatten(F.array_compact(F.array(*lists)))
        return known.select("id", F.explode(each).alias("e")).select("e.kind", "e.hash", "id")

    held = texts(F.col("wholes"), F.col("parts"), F.col("context"))
    asked = texts(F.array_compact(F.array("quote")), F.col("quote_parts"), F.col("quote_context"))
    # A paragraph may have been quoted on: the latest message that it leads to is the one replied to.
    best = F.max(F.struct((-F.col("kind")).alias("order"), F.col("found")))
    return last_holders(held, asked).groupBy("id").agg(best.alias("best")).select("id", F.col("best.found").alias("parent"))


def conversations(messages: DataFrame, id_col: str = "message_id", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: ``root_id``, ``place``, ``depth``, ``message_id``, ``parent_id``, ``role``, ``text``, ``quote_depth``.

    ``text`` has no quotations. Rows of one ``root_id`` in the order of ``place`` are a conversation in which
    each reply follows its parent. Ids must be whole numbers that grow with time.
    """
    parsed = stored(parse(messages, id_col, role_col, text_col), "messages")
    nodes = parsed.filter("id is not null").select("id").distinct().join(link_parents(parsed), "id", "left")
    threads = stored(
        nodes.select(
            "id", "parent", F.col("parent").alias("up"), F.coalesce("parent", "id").alias("root"),
            F.when(F.col("parent").isNotNull(), 1).otherwise(0).alias("depth"),
        ),
        "threads",
    )
    # Each round doubles the way from a message to ``up``, the one it has been followed to.
    while not threads.filter("up is not null").isEmpty():
        above = threads.select(
            F.col("id").alias("up"), F.col("up").alias("further"), F.col("root").alias("above_root"), F.col("depth").alias("above_depth")
        )
        # Those that have reached their root wait, and are joined no more.
        followed = threads.filter("up is not null").join(above, "up").select(
            "id", "parent", F.col("further").alias("up"), F.col("above_root").alias("root"), (F.col("depth") + F.col("above_depth")).alias("depth")
        )
        threads = stored(threads.filter("up is null").unionByName(followed), "threads")
    # A parent has a lower id than its replies, so ids order the replies of a conversation.
    placed = numbered(threads.select("id", "parent", "root", "depth"), ["root", "id"], "place")
    return parsed.join(placed, "id", "left").select(
        F.col("root").alias("root_id"), "place", "depth", F.col("id").alias("message_id"), F.col("parent").alias("parent_id"),
        "role", F.col("own").alias("text"), "quote_depth",
    )
