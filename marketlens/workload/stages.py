"""Stage files and tables: round trips, states that landings fold into, bucketed joins, reconciliation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import latest_state as L
from ..operators.columns import require_columns
from ..operators.digests import reconcile_rows
from ..operators.latest import latest_columns
from ..operators.merge import merge_history
from ..session import shared_folder
from ..sources import files
from ..sources.buckets import merge_bucketed, write_bucketed
from ..sources.csv_blocks import read_csv_blocks
from .registry import query

_DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
_DOCUMENTS_SQL = """SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang, nullif(source, '') AS source,
  CAST(n_chars AS BIGINT) AS n_chars FROM documents"""


def _landed_csv(t) -> str:
    path = shared_folder(t.spark, "csv")
    files.write_csv(t.documents.select("doc_id", "text", "lang", "source", "n_chars"), path)
    return path


@query("csv_round_trip", _DOCUMENTS_SQL)
def csv_round_trip(t):
    """Texts with quotes and newlines, written as CSV and read back, a file a task."""
    rows = files.read_csv(t.spark, _landed_csv(t), _DOCUMENTS)
    return require_columns(rows, ["doc_id", "text"])


@query("csv_blocks_round_trip", _DOCUMENTS_SQL)
def csv_blocks_round_trip(t):
    """The same, by many tasks per file."""
    return read_csv_blocks(t.spark, _landed_csv(t), _DOCUMENTS)


@query("table_round_trip", "SELECT * FROM orders")
def table_round_trip(t):
    """A full reload: the second load replaces the first."""
    name = f"orders_{uuid.uuid4().hex}"
    path = shared_folder(t.spark, "table")
    files.load_table(t.orders.limit(10), name, path=path)
    files.load_table(t.orders, name, path=path)
    return t.spark.table(name)


_BUCKETS = 16
_KEYED = "l_partkey, l_shipdate AS date, l_extendedprice AS price, CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS qty, l_orderkey AS t1, l_linenumber AS t2, l_suppkey AS t3"
_LATEST_SQL = f"""WITH h AS (SELECT {_KEYED} FROM lineitem),
  o AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY date, t1, t2, t3) AS r FROM h)
  SELECT l_partkey, max(date) AS date, arg_max(price, r) AS price, arg_max(qty, r) FILTER (WHERE qty IS NOT NULL) AS qty FROM o {{where}} GROUP BY l_partkey"""
_TIES = ["t1", "t2", "t3"]


def _history(t):
    return t.lineitem.selectExpr(*_KEYED.split(", "))


@query("latest_incremental", _LATEST_SQL.format(where=""))
def latest_incremental(t):
    """History that landed in three parts, one of them twice, folded into a stored state."""
    path, rows = shared_folder(t.spark, "state"), _history(t)
    part = F.pmod(F.xxhash64("t1", "t2"), F.lit(3))
    for k in (0, 2, 1, 2):
        L.fold(rows.where(part == k), path, "l_partkey", "date", _TIES, _BUCKETS)
    state = L.stored_state(t.spark, path, "l_partkey", buckets=_BUCKETS)
    return L.state_values(state, "l_partkey").select("l_partkey", "date", "price", "qty")


@query(
    "latest_touched",
    _LATEST_SQL.format(where="WHERE l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 30 DAY)"),
)
def latest_touched(t):
    """The snapshot of the products in the last 30 days' landing, from their buckets of the state alone."""
    path, rows = shared_folder(t.spark, "state"), _history(t)
    last = rows.agg(F.max("date").alias("d")).first().d
    new = rows.where(F.col("date") >= F.lit(last) - F.expr("INTERVAL 30 DAYS"))
    L.fold(rows.where(F.col("date") < F.lit(last) - F.expr("INTERVAL 30 DAYS")), path, "l_partkey", "date", _TIES, _BUCKETS)
    L.fold(new, path, "l_partkey", "date", _TIES, _BUCKETS)
    state = L.stored_state(t.spark, path, "l_partkey", touched_by=new, buckets=_BUCKETS)
    found = L.state_values(state, "l_partkey").select("l_partkey", "date", "price", "qty")
    return found.join(new.select("l_partkey").distinct(), "l_partkey", "left_semi")


_MERGED_SQL = """SELECT h.asin, h.date, h.note AS note_x, p.note AS note_y, p.title, h.asin AS asin_group
  FROM (SELECT nullif(l_partkey, 7) AS asin, l_shipdate AS date, l_returnflag AS note FROM lineitem) h
  LEFT JOIN (SELECT CASE WHEN p_size <= 5 THEN -p_partkey ELSE nullif(p_partkey, 11) END AS asin, p_name AS title, p_brand AS note FROM part) p
    ON h.asin IS NOT DISTINCT FROM p.asin"""


def _sides(t):
    history = t.lineitem.selectExpr("nullif(l_partkey, 7) AS asin", "l_shipdate AS date", "l_returnflag AS note")
    details = t.part.selectExpr("CASE WHEN p_size <= 5 THEN -p_partkey ELSE nullif(p_partkey, 11) END AS asin", "p_name AS title", "p_brand AS note")
    return history, details


def _bucketed(t, df, name, key):
    return write_bucketed(df, f"{name}_{uuid.uuid4().hex}", key, _BUCKETS, shared_folder(t.spark, name))


@query("merge_bucketed", _MERGED_SQL)
def merge_bucketed_query(t):
    """History and details bucketed alike: no exchange under the join."""
    history, details = _sides(t)
    return merge_bucketed(_bucketed(t, history, "history", "asin"), _bucketed(t, details, "details", "asin"))


@query("latest_bucketed", _LATEST_SQL.format(where=""))
def latest_bucketed(t):
    """The latest values of a bucketed history: neither grouping nor join needs an exchange."""
    rows = _bucketed(t, _history(t), "history", "l_partkey")
    return latest_columns(rows, "l_partkey", "date", _TIES).select("l_partkey", "date", "price", "qty")


@query(
    "merge_hot_key",
    """SELECT h.asin, h.date, p.title, h.asin AS asin_group
      FROM (SELECT CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_partkey END AS asin, l_shipdate AS date FROM lineitem) h
      LEFT JOIN (SELECT p_partkey AS asin, p_name AS title FROM part) p ON h.asin = p.asin""",
)
def merge_hot_key(t):
    """A third of the history and more is one product's: its rows are spread and only its details are copied."""
    history = t.lineitem.selectExpr("CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_partkey END AS asin", "l_shipdate AS date")
    return merge_history(history, t.part.selectExpr("p_partkey AS asin", "p_name AS title"), salts=8)


_SENT = "l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag"
_LOADED_SQL = f"""SELECT * REPLACE (CASE WHEN l_orderkey % 1000 = 7 THEN l_extendedprice + 1 ELSE l_extendedprice END AS l_extendedprice)
  FROM sent WHERE l_orderkey % 1000 <> 11 UNION ALL SELECT * FROM sent WHERE l_orderkey % 1000 = 13
  UNION ALL SELECT * REPLACE (-l_orderkey AS l_orderkey) FROM sent WHERE l_orderkey % 1000 = 17"""


@query(
    "reconcile_rows",
    f"""WITH sent AS (SELECT {_SENT} FROM lineitem), loaded AS ({_LOADED_SQL}),
      s AS (SELECT *, count(*) AS n FROM sent GROUP BY ALL), d AS (SELECT *, count(*) AS n FROM loaded GROUP BY ALL),
      u AS (SELECT coalesce(s.l_orderkey, d.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, d.l_linenumber) AS l_linenumber, coalesce(s.n, 0) AS a, coalesce(d.n, 0) AS b
        FROM s FULL JOIN d ON {' AND '.join(f's.{c} IS NOT DISTINCT FROM d.{c}' for c in _SENT.split(', '))}),
      k AS (SELECT l_orderkey, l_linenumber, sum(greatest(a - b, 0)) AS only_source, sum(greatest(b - a, 0)) AS only_loaded, max(a) FILTER (WHERE a <> b) AS had
        FROM u WHERE a <> b GROUP BY ALL)
      SELECT l_orderkey, l_linenumber, CASE WHEN only_source > 0 AND only_loaded > 0 THEN 'changed' WHEN only_source > 0 THEN 'lost'
        WHEN had > 0 THEN 'repeated' ELSE 'added' END AS verdict, CAST(only_source AS BIGINT) AS only_source, CAST(only_loaded AS BIGINT) AS only_loaded FROM k""",
)
def reconcile_rows_query(t):
    """A load that changed, lost, repeated and added some rows."""
    sent, order = t.lineitem.selectExpr(*_SENT.split(", ")), F.col("l_orderkey") % 1000
    changed = sent.withColumn("l_extendedprice", F.when(order == 7, F.col("l_extendedprice") + 1).otherwise(F.col("l_extendedprice")))
    added = sent.where(order == 17).withColumn("l_orderkey", -F.col("l_orderkey"))
    loaded = changed.where(order != 11).unionAll(sent.where(order == 13)).unionAll(added)
    return reconcile_rows(sent, loaded, ["l_orderkey", "l_linenumber"])
