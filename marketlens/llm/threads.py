"""Quotation linking: from messages that quote one another to reply-ordered conversations without quotes.

Lines that begin with ``>`` marks are quoted, as deep as there are marks. Quoted passages (lines) are
normalised and hashed and joined to the messages that wrote them, that is, hold the same passage
unquoted. The message whose passages are quoted most at the first level is the parent. Only DataFrame
functions are used; nothing is gathered by conversation but narrow rows for numbering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, private, table

MARKS = r"^(?:>[ \t]?)+"
KEY = ("scope", "msg")


def parse(text: Column) -> Column:
    """Lines as (level, line): the number of quote marks, and the line without them. A null text has none."""

    def one(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.substring(line, F.length(marks) + 1, F.length(line)).alias("line"),
        )

    return F.when(text.isNull(), F.array().cast("array<struct<level:int,line:string>>")).otherwise(F.transform(F.split(text, "\r?\n"), one))


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def _hash(passage: Column) -> Column:
    """128 bits."""
    return F.struct(F.xxhash64(F.lit(1), passage).alias("a"), F.xxhash64(F.lit(2), passage).alias("b"))


def link_quotes(
    messages: DataFrame, *, scope_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text", min_chars: int = 1
) -> DataFrame:
    """Rows (scope, msg, role, parent, thread, depth, position, n_quoted, n_linked, body), one per row.

    ``scope`` bounds where quotes are looked for (a mailbox, a list, a conversation), ``msg`` is the
    message's place in time in it. A passage's original is the earliest message of the scope that holds
    it unquoted; it is linked when that is earlier than the quoting message. ``parent`` is the message
    with most first-level links (ties: the latest), null where there is none; ``thread`` is the message
    at the end of the parents, ``depth`` the steps to it, and ``position`` the place in the thread by
    depth, then time, from 0. ``body`` is the text without quoted lines, ``n_quoted`` and ``n_linked``
    count quoted passages. Passages shorter than ``min_chars`` after normalisation link nothing.

    A null text has an empty body. Messages without a scope or a time link nothing and are threads of
    their own. Rows of one message id count as one message for linking, and each keeps its own body.
    """
    rows = private(messages, scope=scope_col, msg=order_col, role=role_col, text=text_col)
    rows = rows.withColumn("lines", parse(F.col("text")))
    quoted = F.filter("lines", lambda p: (p.level > 0) & (F.length(normal(p.line)) >= min_chars))
    own = F.filter("lines", lambda p: p.level == 0)
    rows = keep(
        rows.select(
            *KEY, "role",
            F.transform(quoted, lambda p: F.struct(p.level.alias("level"), _hash(normal(p.line)).alias("hash"))).alias("quotes"),
            F.array_distinct(F.transform(F.filter(own, lambda p: F.length(normal(p.line)) >= min_chars), lambda p: _hash(normal(p.line)))).alias("passages"),
            F.trim(F.array_join(F.transform(own, lambda p: p.line), "\n"), F.lit("\n")).alias("body"),
        )
    )
    placed = rows.where("scope IS NOT NULL AND msg IS NOT NULL").select(*KEY, "quotes", "passages").distinct()
    originals = placed.select("scope", "msg", F.explode("passages").alias("hash")).groupBy("scope", "hash").agg(F.min("msg").alias("original"))
    links = (
        placed.select("scope", "msg", F.explode("quotes").alias("q"))
        .groupBy("scope", "msg", F.col("q.hash").alias("hash"), F.col("q.level").alias("level")).agg(F.count("*").alias("n"))
        .join(originals, ["scope", "hash"]).where("original < msg")
        .groupBy("scope", "msg", "original").agg(F.sum(F.when(F.col("level") == 1, F.col("n"))).alias("first"), F.sum("n").alias("n"))
    )
    parents = links.groupBy("scope", "msg").agg(
        F.max(F.when(F.col("first") > 0, F.struct("first", "original"))).getField("original").alias("parent"),
        F.sum("n").alias("n_linked"),
    )
    nodes = placed.select(*KEY).distinct().join(parents, [*KEY], "left")
    rooted = _roots(nodes)

    out = rows.alias("r").join(rooted.alias("t"), (F.col("r.scope") == F.col("t.scope")) & (F.col("r.msg") == F.col("t.msg")), "left")
    out = out.select(
        "r.scope", "r.msg", "role", "parent",
        F.coalesce("thread", "r.msg").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.size("quotes").cast("long").alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "body",
    )
    return _positions(out)


def _roots(nodes: DataFrame) -> DataFrame:
    """(scope, msg, parent, n_linked) with ``thread`` and ``depth``, by doubling the steps taken. A parent
    is earlier than its child, so there are no rings. A row is done when it has reached a message without
    a parent; only the others are joined again."""
    columns = [*KEY, "parent", "n_linked", "thread", "depth"]
    done, at = None, keep(nodes.select("*", F.coalesce("parent", "msg").alias("thread"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth"), F.col("parent").isNotNull().alias("open")))
    while True:
        closed = at.where("NOT open").select(*columns)
        done = closed if done is None else done.unionByName(closed)
        open_ = at.where("open")
        if not open_.limit(1).count():
            return done
        # Where the open rows have come to: another open row, or one that is done.
        above = done.select(*KEY, "thread", "depth", F.lit(False).alias("open")).unionByName(open_.select(*KEY, "thread", "depth", "open"))
        above = above.select(F.col("scope").alias("s"), F.col("msg").alias("m"), F.col("thread").alias("t"), F.col("depth").alias("d"), F.col("open").alias("o"))
        went = open_.drop("open").join(above, (F.col("scope") == F.col("s")) & (F.col("thread") == F.col("m")))
        at = keep(went.select(*KEY, "parent", "n_linked", F.col("t").alias("thread"), (F.col("depth") + F.col("d")).alias("depth"), F.col("o").alias("open")))


def _positions(rows: DataFrame, span: int = 4096) -> DataFrame:
    """Numbers a thread by (depth, msg). Windows hold ``span`` neighbouring message times of one depth;
    what lies before comes from counts."""
    part = [F.col(c) for c in ("scope", "thread", "depth", "part")]
    rows = rows.withColumn("part", F.floor(F.col("msg") / span))
    before = rows.groupBy(*part).agg(F.count("*").alias("n"))
    order = Window.partitionBy("scope", "thread").orderBy("depth", "part")
    before = before.select(*part, (F.sum("n").over(order) - F.col("n")).alias("before"))
    rows = rows.withColumn("within", F.row_number().over(Window.partitionBy(*part).orderBy("msg", F.xxhash64("role", "body"))))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("scope", "thread", "depth", "part")]
    joined = rows.alias("a").join(before.alias("b"), same[0] & same[1] & same[2] & same[3])
    return joined.select(
        *(f"a.{c}" for c in ("scope", "msg", "role", "parent", "thread", "depth")),
        (F.col("before") + F.col("within") - 1).cast("long").alias("position"),
        "n_quoted", "n_linked", "body",
    )


def to_chat(threads: DataFrame) -> DataFrame:
    """Adds ``turn_text``: the message as a chat turn, its role in a header line."""
    return threads.withColumn("turn_text", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "body"))


def as_mail(conversations: DataFrame) -> DataFrame:
    """Conversations as mail that quotes: a turn answers the one before it (every third one the one before
    that) and opens with that turn's lines quoted, under the first line of what that one answers, quoted
    twice. ``conversations`` holds no quotes itself."""
    turns = private(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    back = lambda t: F.when(t % 3 == 2, t - 2).otherwise(t - 1)
    turns = turns.withColumn("answers", back(F.col("turn"))).withColumn("upper", back(F.col("answers")))
    earlier = lambda name, column: turns.select(F.col("conv_id").alias(f"{name}_c"), F.col("turn").alias(column), F.col("text").alias(name))
    mail = turns.join(earlier("parent_text", "p"), (F.col("conv_id") == F.col("parent_text_c")) & (F.col("answers") == F.col("p")), "left")
    mail = mail.join(earlier("upper_text", "u"), (F.col("conv_id") == F.col("upper_text_c")) & (F.col("upper") == F.col("u")), "left")
    twice = F.concat(F.lit("> > "), F.split("upper_text", "\n")[0], F.lit("\n"))
    once = F.concat(F.lit("> "), F.regexp_replace("parent_text", "\n", "\n> "), F.lit("\n\n"))
    return mail.select("conv_id", "turn", "role", F.concat(F.coalesce(twice, F.lit("")), F.coalesce(once, F.lit("")), "text").alias("text"))


def op3_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_quotes(as_mail(table(spark, sf_dir, "conversations")))
    return linked.select(
        F.col("scope").alias("conv_id"), F.col("msg").alias("turn"), "role", F.coalesce("parent", F.lit(-1)).alias("parent"), "thread", F.col("depth").cast("long").alias("depth"),
        "position", "n_quoted", "n_linked", "body",
    )


_NORMAL = r"lower(trim(regexp_replace({0}, '\s+', ' ', 'g')))"
_BACK = "CASE WHEN {0} % 3 = 2 THEN {0} - 2 ELSE {0} - 1 END"

ORACLE = f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, role, text, {_BACK.format("turn")} AS answers FROM conversations),
m AS (SELECT c.conv_id, c.turn, c.role,
    coalesce('> > ' || split_part(u.text, chr(10), 1) || chr(10), '') ||
    coalesce('> ' || replace(p.text, chr(10), chr(10) || '> ') || chr(10) || chr(10), '') || c.text AS text
  FROM c LEFT JOIN c p ON c.conv_id = p.conv_id AND c.answers = p.turn
  LEFT JOIN c u ON c.conv_id = u.conv_id AND ({_BACK.format("c.answers")}) = u.turn),
l AS (SELECT conv_id, turn, i, length(regexp_replace(regexp_extract(line, '{MARKS}'), '[^>]', '', 'g')) AS level,
    substr(line, length(regexp_extract(line, '{MARKS}')) + 1) AS line
  FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m)),
o AS (SELECT conv_id, {_NORMAL.format("line")} AS h, min(turn) AS original FROM l WHERE level = 0 AND length({_NORMAL.format("line")}) >= 1 GROUP BY ALL),
q AS (SELECT conv_id, turn, level, {_NORMAL.format("line")} AS h FROM l WHERE level > 0 AND length({_NORMAL.format("line")}) >= 1),
k AS (SELECT q.conv_id, q.turn, original, sum(CASE WHEN level = 1 THEN 1 ELSE 0 END) AS f, count(*) AS n
  FROM q JOIN o ON q.conv_id = o.conv_id AND q.h = o.h WHERE original < q.turn GROUP BY ALL),
p AS (SELECT conv_id, turn, original AS parent FROM k WHERE f > 0
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY f DESC, original DESC) = 1),
t AS (SELECT m.conv_id, m.turn, m.turn AS thread, 0 AS depth FROM m LEFT JOIN p ON m.conv_id = p.conv_id AND m.turn = p.turn WHERE parent IS NULL
  UNION ALL SELECT p.conv_id, p.turn, t.thread, t.depth + 1 FROM p JOIN t ON p.conv_id = t.conv_id AND p.parent = t.turn),
b AS (SELECT conv_id, turn, trim(string_agg(line, chr(10) ORDER BY i), chr(10)) AS body FROM l WHERE level = 0 GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, coalesce(p.parent, -1) AS parent, t.thread, CAST(t.depth AS BIGINT) AS depth,
  row_number() OVER (PARTITION BY m.conv_id, t.thread ORDER BY t.depth, m.turn) - 1 AS position,
  (SELECT count(*) FROM q WHERE q.conv_id = m.conv_id AND q.turn = m.turn) AS n_quoted,
  CAST(coalesce((SELECT sum(n) FROM k WHERE k.conv_id = m.conv_id AND k.turn = m.turn), 0) AS BIGINT) AS n_linked,
  coalesce(b.body, '') AS body
FROM m JOIN t ON m.conv_id = t.conv_id AND m.turn = t.turn LEFT JOIN p ON m.conv_id = p.conv_id AND m.turn = p.turn
LEFT JOIN b ON m.conv_id = b.conv_id AND m.turn = b.turn
"""
