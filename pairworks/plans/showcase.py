"""One query per covered SQL function, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pg
from ..operators import windows
from .tables import query, table

FLAGS = ["l_returnflag", "l_linestatus"]
MONEY = "decimal(18,2)"


def _by_flag(name, make, sql):
    @query(f"fn_{name}", f"SELECT l_returnflag, l_linestatus, {sql} FROM lineitem GROUP BY ALL")
    def run(spark, sf_dir):
        return table(spark, sf_dir, "lineitem").groupBy(*FLAGS).agg(*make())


_by_flag("count", lambda: [F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("n_orders")],
         "count(*) AS n, count(DISTINCT l_orderkey) AS n_orders")
_by_flag("sum", lambda: [F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double").alias("total")],
         "sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total")
_by_flag("avg", lambda: [F.round(F.avg("l_quantity"), 6).alias("mean")], "round(avg(l_quantity), 6) AS mean")
_by_flag("min", lambda: [F.min("l_extendedprice").alias("least"), F.min("l_orderkey").alias("first_order")],
         "min(l_extendedprice) AS least, min(l_orderkey) AS first_order")
_by_flag("max", lambda: [F.max("l_extendedprice").alias("most"), F.max("l_orderkey").alias("last_order")],
         "max(l_extendedprice) AS most, max(l_orderkey) AS last_order")


def _per_row(name, source, key, make, sql):
    """A column function over every row of a table, with the row's key."""
    @query(f"fn_{name}", f"SELECT {key}, {sql} FROM {source}")
    def run(spark, sf_dir):
        return table(spark, sf_dir, source).select(key, *make())


_per_row("coalesce", "customer", "c_custkey",
         lambda: [F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), "c_name").alias("label")],
         "coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) AS label")
_per_row("nullif", "orders", "o_orderkey", lambda: [F.nullif("o_orderstatus", F.lit("F")).alias("status")],
         "nullif(o_orderstatus, 'F') AS status")
_per_row("concat", "customer", "c_custkey",
         lambda: [pg.concat(F.col("c_name"), F.nullif("c_mktsegment", F.lit("BUILDING")), F.col("c_nationkey")).alias("label")],
         "concat(c_name, nullif(c_mktsegment, 'BUILDING'), c_nationkey) AS label")
_per_row("length", "documents", "doc_id", lambda: [F.length("text").cast("long").alias("chars")], "length(text) AS chars")
_per_row("substring", "documents", "doc_id",
         lambda: [pg.substring(F.col("text"), 3, 20).alias("part"), F.md5(pg.substring(F.col("text"), 5)).alias("rest")],
         "substring(text, 3, 20) AS part, md5(substring(text, 5)) AS rest")
_per_row("lower", "part", "p_partkey", lambda: [F.lower("p_brand").alias("brand")], "lower(p_brand) AS brand")
_per_row("upper", "part", "p_partkey", lambda: [F.upper("p_name").alias("name")], "upper(p_name) AS name")
_per_row("trim", "documents", "doc_id", lambda: [F.md5(pg.trim(F.concat(F.lit("  "), "text", F.lit(" ")))).alias("digest")],
         "md5(trim('  ' || text || ' ', ' ')) AS digest")
_per_row("replace", "documents", "doc_id", lambda: [F.md5(F.replace("text", F.lit("e"), F.lit("<e>"))).alias("digest")],
         "md5(replace(text, 'e', '<e>')) AS digest")
_per_row("extract", "events", "event_id",
         lambda: [pg.extract(p, F.col("ts")).cast("long").alias(p) for p in ("year", "month", "day", "hour", "dow", "isodow", "doy", "week")]
         + [pg.extract("epoch", F.col("ts")).alias("epoch")],
         ", ".join(f"extract({p} FROM ts)::BIGINT AS {p}" for p in ("year", "month", "day", "hour", "dow", "isodow", "doy", "week"))
         + ", extract(epoch FROM ts) AS epoch")
_per_row("age", "orders", "o_orderkey",
         lambda: [pg.age(F.lit("2002-03-31").cast("date"), F.col("o_orderdate").cast("date"))[f].cast("long").alias(f) for f in ("months", "days")],
         "date_part('year', age(DATE '2002-03-31', o_orderdate)) * 12 + date_part('month', age(DATE '2002-03-31', o_orderdate)) AS months, "
         "date_part('day', age(DATE '2002-03-31', o_orderdate)) AS days")
_per_row("to_char_number", "orders", "o_orderkey", lambda: [pg.to_char(F.col("o_totalprice"), "9,999,990.99").alias("price"), pg.to_char(-F.col("o_custkey"), "FM099999MI").alias("customer"),
                                                            pg.to_char(F.col("o_orderkey"), "FM999999999th").alias("nth")],
         """lpad(format('{:,.2f}', o_totalprice), 13, ' ') AS price, lpad(o_custkey::VARCHAR, 6, '0') || CASE WHEN o_custkey > 0 THEN '-' ELSE '' END AS customer,
o_orderkey || CASE WHEN o_orderkey % 100 IN (11, 12, 13) THEN 'th' WHEN o_orderkey % 10 = 1 THEN 'st' WHEN o_orderkey % 10 = 2 THEN 'nd' WHEN o_orderkey % 10 = 3 THEN 'rd' ELSE 'th' END AS nth""")
_per_row("to_char", "events", "event_id", lambda: [pg.to_char(F.col("ts"), "YYYY-MM-DD HH24:MI").alias("at")],
         "strftime(ts, '%Y-%m-%d %H:%M') AS at")
_per_row("round", "orders", "o_orderkey", lambda: [F.round("o_totalprice").alias("price"), F.round(F.col("o_totalprice").cast(MONEY), 1).cast("double").alias("tenths")],
         "round(o_totalprice) AS price, round(o_totalprice::DECIMAL(18,2), 1)::DOUBLE AS tenths")
_per_row("ceil", "orders", "o_orderkey", lambda: [F.ceil("o_totalprice").cast("long").alias("price")], "ceil(o_totalprice)::BIGINT AS price")
_per_row("floor", "customer", "c_custkey", lambda: [F.floor("c_acctbal").cast("long").alias("balance")], "floor(c_acctbal)::BIGINT AS balance")
_per_row("mod", "orders", "o_orderkey", lambda: [((F.col("o_custkey") - 500) % 7).alias("rest"), pg.integer_divide(F.col("o_custkey") - 500, F.lit(7)).alias("whole")],
         "(o_custkey - 500) % 7 AS rest, (o_custkey - 500) // 7 AS whole")
_per_row("abs", "customer", "c_custkey", lambda: [F.abs("c_acctbal").alias("size"), F.abs(F.col("c_custkey") - 700).alias("distance")],
         "abs(c_acctbal) AS size, abs(c_custkey - 700) AS distance")


@query("fn_date_trunc", "SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month, count(*) AS n FROM lineitem GROUP BY 1")
def date_trunc(spark, sf_dir):
    month = F.date_format(F.date_trunc("month", "l_shipdate"), "yyyy-MM-dd").alias("month")
    return table(spark, sf_dir, "lineitem").groupBy(month).agg(F.count(F.lit(1)).alias("n"))


def _past(name, now, sql):
    """The current time differs per run; that every event lies before it does not."""
    @query(f"fn_{name}", f"SELECT event_type, count(*) FILTER (ts <= {sql}) AS past, count(*) AS n FROM events GROUP BY 1")
    def run(spark, sf_dir):
        past = F.count_if(F.col("ts").cast("timestamp") <= now())
        return table(spark, sf_dir, "events").groupBy("event_type").agg(past.alias("past"), F.count(F.lit(1)).alias("n"))


_past("now", F.now, "now()::TIMESTAMP")
_past("current_timestamp", F.current_timestamp, "current_timestamp::TIMESTAMP")
_past("current_date", lambda: F.current_date().cast("timestamp"), "current_date")


def _windowed(name, make, sql):
    """A ranking function per customer; ascending order puts nulls last, and a customer may own most orders."""
    spec = ("OVER (PARTITION BY o_custkey ORDER BY nullif(o_orderpriority, '1-URGENT') ASC NULLS LAST"
            + ("" if name == "rank" else ", o_orderkey") + ")")
    @query(f"fn_{name}", f"SELECT o_orderkey, {sql} {spec} AS v FROM orders")
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("p"))
        return make(orders).select("o_orderkey", "v")


CUSTOMER = (["o_custkey"], ["p"])
_windowed("row_number", lambda df: windows.row_number(df, *CUSTOMER, "o_orderkey", "v"), "row_number()")
_windowed("rank", lambda df: windows.rank(df, *CUSTOMER, "v"), "rank()")
_windowed("lag", lambda df: windows.shift(df, *CUSTOMER, "o_orderkey", "o_orderkey", 1, "v"), "lag(o_orderkey)")
_windowed("lead", lambda df: windows.shift(df, *CUSTOMER, "o_orderkey", "o_orderkey", -2, "v"), "lead(o_orderkey, 2)")
