"""One registered query per operator, on the tables of a folder, with the same result as ANSI SQL.

The event types of ``events`` play the sensor feeds (minutes stand for seconds), ``lineitem`` and ``orders``
the tables with repeated times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelane import operators as op, plans, sources as src
from tidelane.functions import add_corrected_ph, micros, normalize_time, time_shift
from tidelane.session import new_shared_path

TS = "datetime_utc"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None, flags: str = "", **types: str):
    """Register a query with its SQL; ``flags`` names one-byte columns, other keywords give a column's type."""
    types = {**{f: "tinyint" for f in flags.split()}, **types}

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            casts = ", ".join(f"cast({c} as {t}) as {c}" for c, t in types.items())
            ORACLES[key] = f"select * replace ({casts}) from ({sql})" if casts else sql
        return fn

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def events(spark: SparkSession, d: str) -> DataFrame:
    """All events as one series: datetime_utc, event_id, user_id, event_type, value."""
    return table(spark, d, "events").select(
        F.col("ts").alias(TS), "event_id", "user_id", "event_type", "value"
    )


def feed(spark: SparkSession, d: str, kind: str, prefix: str) -> DataFrame:
    """One event type as a feed; the value is missing on every seventh row."""
    return events(spark, d).where(F.col("event_type") == kind).select(
        TS,
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias(f"{prefix}_value"),
        F.col("user_id").alias(f"{prefix}_user"),
    )


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


# SQL building blocks

EV = "ev as (select ts as datetime_utc, event_id, user_id, event_type, value from events)"


def feed_sql(name: str, kind: str, prefix: str) -> str:
    return (
        f"{name} as (select datetime_utc, case when event_id % 7 <> 0 then value end as {prefix}_value, "
        f"user_id as {prefix}_user from ev where event_type = '{kind}')"
    )


def asof_sql(name: str, left: str, right: str, tol: str, left_cols: str, right_cols: list[tuple[str, str]]) -> str:
    picks = ", ".join(
        f"case when r.datetime_utc >= l.datetime_utc - interval '{tol}' then r.{c} end as {n}" for c, n in right_cols
    )
    return (
        f"{name} as (select {left_cols}, {picks} from {left} l "
        f"asof left join {right} r on l.datetime_utc >= r.datetime_utc)"
    )


def grid_sql(name: str, tables: list[str], step: str) -> str:
    both = " union all ".join(f"select min(datetime_utc) as lo, max(datetime_utc) as hi from {t}" for t in tables)
    return (
        f"{name} as (select unnest(generate_series(lo, hi, interval '{step}')) as datetime_utc "
        f"from (select min(lo) as lo, max(hi) as hi from ({both})))"
    )


def with_sql(*ctes: str, final: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + final


# Alignment

#: The kinds of events, each of which plays a feed.
KINDS = ["view", "click", "purchase", "signup", "error"]


def _align_sql() -> str:
    steps, left = [EV, *[feed_sql(f"f_{k}", k, k) for k in KINDS], grid_sql("g", [f"f_{k}" for k in KINDS], "10 minutes")], "g"
    for k in KINDS:
        steps.append(asof_sql(f"a_{k}", left, f"f_{k}", "30 minutes", "l.*", [(f"{k}_value",) * 2, (f"{k}_user",) * 2]))
        left = f"a_{k}"
    return with_sql(*steps, final=f"select * from {left}")


@query(_align_sql())
def asof_align(spark, d):
    return op.align_series([(k, feed(spark, d, k, k)) for k in KINDS], "10m", tolerance="30m")


@query(
    with_sql(
        EV, feed_sql("v", "view", "view"), feed_sql("c", "click", "click"),
        asof_sql("a", "v", "c", "5 minutes", "l.*", [("click_value", "click_value"), ("click_user", "click_user")]),
        final="select * from a",
    )
)
def asof_join(spark, d):
    return op.asof_join(feed(spark, d, "view", "view"), feed(spark, d, "click", "click"), TS, "5m")


@query(
    """with l as (select event_id, ts, user_id % 50 as vessel, value from events where event_type = 'view'),
       r as (select ts, user_id % 50 as vessel, event_id as r_id from events where event_type = 'click')
       select l.event_id, l.vessel, l.ts as datetime_utc, l.value,
         case when r.ts >= l.ts - interval '3 hours' then r.r_id end as r_id
       from l asof left join r on l.vessel = r.vessel and l.ts >= r.ts"""
)
def asof_join_by_key(spark, d):
    ev = events(spark, d).withColumn("vessel", F.col("user_id") % 50)
    left = ev.where("event_type = 'view'").select("event_id", "vessel", TS, "value")
    right = ev.where("event_type = 'click'").select(TS, "vessel", F.col("event_id").alias("r_id"))
    return op.asof_join(left, right, TS, "3h", keys=["vessel"])


@query(
    """with l as (select o_orderkey, o_orderdate as datetime_utc from orders),
       r as (select l_shipdate as datetime_utc, max(l_orderkey * 10 + l_linenumber) as line from lineitem group by 1),
       a as (select l.o_orderkey, l.datetime_utc,
               case when r.datetime_utc >= l.datetime_utc - interval '2 days' then r.line end as line
             from l asof left join r on l.datetime_utc >= r.datetime_utc)
       select * from a"""
)
def asof_join_ties(spark, d):
    left = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias(TS))
    right = table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias(TS), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line")
    )
    return op.asof_join(left, right, TS, "2 days", tie=["line"])


REGULAR = [
    EV, feed_sql("v", "view", "view"), grid_sql("g", ["v"], "5 minutes"),
    asof_sql("a", "g", "v", "4 minutes", "l.*", [("view_value", "view_value"), ("view_user", "view_user")]),
]


@query(with_sql(*REGULAR, final="select * from a"))
def regularize(spark, d):
    return op.regularize(feed(spark, d, "view", "view"), TS, "5m", "4m")


@query(
    with_sql(
        *REGULAR, feed_sql("c", "click", "view"),
        asof_sql("f", "a", "c", "12 minutes", "l.*", [("view_value", "vs"), ("view_user", "us")]),
        final="""select datetime_utc, coalesce(view_value, vs) as view_value, coalesce(view_user, us) as view_user,
                 case when view_value is null then 'ship' else 'uw' end as source from f""",
    )
)
def fill_secondary(spark, d):
    regular = op.regularize(feed(spark, d, "view", "view"), TS, "5m", "4m")
    return op.fill_from_secondary(regular, feed(spark, d, "click", "view"), TS, tolerance="12m", labels=("uw", "ship"))


@query(
    """select unnest(generate_series(lo, hi, interval '7 minutes')) as datetime_utc
       from (select min(ts) as lo, max(ts) as hi from events)"""
)
def time_grid(spark, d):
    return op.time_grid(op.time_bounds(events(spark, d)), "7m")


@query(
    """select vessel, unnest(generate_series(lo, hi, interval '1 hour')) as datetime_utc
       from (select user_id % 5 as vessel, min(ts) as lo, max(ts) as hi from events group by 1)"""
)
def time_grid_by_key(spark, d):
    ev = events(spark, d).withColumn("vessel", F.col("user_id") % 5)
    return op.time_grid(op.time_bounds(ev, keys=["vessel"]), "1h", keys=["vessel"])


@query(
    """select unnest(generate_series(time_bucket(interval '15 minutes', lo), hi + interval '15 minutes',
         interval '15 minutes')) as datetime_utc
       from (select min(ts) as lo, max(ts) as hi from events)"""
)
def time_grid_floored(spark, d):
    return op.time_grid(op.time_bounds(events(spark, d)), "15m", floored=True)


@query(
    """select min(lo) as lo, max(hi) as hi from (select min(ts) as lo, max(ts) as hi from events
       union all select min(o_orderdate), max(o_orderdate) from orders)"""
)
def time_bounds(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderdate").alias(TS))
    return op.time_bounds([events(spark, d), orders])


def _grid_join_sql() -> str:
    means = ",\n".join(
        f"""m_{k} as (select time_bucket(interval '1 hour', ts) as b, round(avg(value), 6) as {k}_mean
             from events where event_type = '{k}' group by 1)""" for k in KINDS
    )
    joins = " ".join(f"left join m_{k} on g.datetime_utc = m_{k}.b" for k in KINDS)
    return f"""with g as (select unnest(generate_series(time_bucket(interval '1 hour', lo), hi + interval '1 hour',
                    interval '1 hour')) as datetime_utc from (select min(ts) as lo, max(ts) as hi from events)),
       {means} select g.datetime_utc, {", ".join(f"{k}_mean" for k in KINDS)} from g {joins}"""


@query(_grid_join_sql())
def grid_left_join(spark, d):
    ev = events(spark, d)
    grid = op.time_grid(op.time_bounds(ev), "1h", floored=True)
    parts = []
    for kind in KINDS:
        rows = ev.where(F.col("event_type") == kind).select(TS, F.col("value").alias(f"{kind}_mean"))
        parts.append(rounded(op.bucket_mean(rows, "1h"), f"{kind}_mean"))
    return op.join_on_grid(grid, parts)


# Flags, projections and filters


@query("select event_id, value, case when value > 90 then 4 else 2 end as value_flag, 2 as time_flag from events", flags="value_flag time_flag")
def threshold_flags(spark, d):
    df = op.threshold_flag(events(spark, d).select("event_id", "value"), "value", ">", 90.0, "value_flag")
    return op.default_flag(df, "time_flag")


@query(
    """select l_orderkey, l_linenumber, l_discount * 400 as temperature, l_quantity as salinity, 2 as temperature_flag,
       case when l_quantity < 30 then 4 else 2 end as salinity_flag from lineitem""",
    flags="temperature_flag salinity_flag",
)
def flag_tsg(spark, d):
    df = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_discount") * 400).alias("temperature"), F.col("l_quantity").alias("salinity")
    )
    return op.flag_tsg(df)


@query(
    """select event_id, case when event_id % 5 <> 0 then value end as v,
         case when event_id % 5 = 0 then null when value > 90 then 4 else 2 end as v_flag
       from events""",
    flags="v_flag",
)
def null_flags(spark, d):
    df = op.threshold_flag(events(spark, d), "value", ">", 90.0, "v_flag")
    df = df.select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("v"), "v_flag")
    return op.null_flag_where_missing(df, {"v": "v_flag"})


@query(
    """select event_id, case when event_id % 6 = 0 then null when value > 90 then 4 else 2 end as v_flag
       from events""",
    flags="v_flag",
)
def nan_flags(spark, d):
    nan = F.lit(float("nan"))
    v = F.when(F.col("event_id") % 6 == 0, nan).when(F.col("event_id") % 6 != 1, F.col("value"))
    df = op.threshold_flag(events(spark, d), "value", ">", 90.0, "v_flag").withColumn("v", v)
    return op.null_flag_where_nan(df, "v", "v_flag").select("event_id", "v_flag")


@query(
    """with f as (select event_id, case when event_id % 5 = 0 then null when value > 90 then 4 else 2 end as a,
         case when user_id % 10 = 3 then 3 else 2 end as b from events)
       select * from f where a not in (3, 4) and b not in (3, 4)"""
)
def drop_flagged(spark, d):
    flag = F.when(F.col("event_id") % 5 == 0, F.lit(None)).when(F.col("value") > 90, 4).otherwise(2)
    df = events(spark, d).select(
        "event_id", flag.alias("a"), F.when(F.col("user_id") % 10 == 3, 3).otherwise(2).alias("b")
    )
    return op.drop_flagged(df, ["a", "b"])


@query(
    """select event_id, coalesce(case when event_id % 3 <> 0 then value end, user_id) as value from events"""
)
def coalesce_columns(spark, d):
    df = events(spark, d).select(
        "event_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"), F.col("user_id").cast("double").alias("spare")
    )
    return op.coalesce_columns(df, {"value": "spare"}).drop("spare")


@query("select event_id, ts + interval '46 seconds' as later, ts - interval '20 minutes' as earlier from events")
def time_shifts(spark, d):
    ev = events(spark, d).select("event_id", F.col(TS).alias("later"), F.col(TS).alias("earlier"))
    return time_shift(time_shift(ev, "later", "46s"), "earlier", "20m", back=True)


_A, _B = "2024-01-05 00:00:00", "2024-01-20 12:30:00"


@query(f"select event_id, ts as datetime_utc from events where ts > timestamp '{_A}' and ts < timestamp '{_B}'")
def slice_time_open(spark, d):
    return op.slice_time(events(spark, d).select("event_id", TS), _A, _B)


@query(
    """select o_orderkey, o_orderdate as datetime_utc from orders
       where o_orderdate between timestamp '1996-01-01' and timestamp '1997-01-01'"""
)
def slice_time_closed(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias(TS))
    return op.slice_time(df, "1996-01-01 00:00:00", "1997-01-01 00:00:00", "both")


@query("select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity > 30")
def filter_value(spark, d):
    return op.filter_value(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", ">", 30)


@query(
    """select event_id as id, cast(user_id as varchar) as who, cast(value as bigint) as whole,
       try_cast(event_type as double) as number from (select event_id, user_id, floor(value) as value, event_type from events)"""
)
def select_and_cast(spark, d):
    df = events(spark, d).withColumn("value", F.floor("value").cast("double")).withColumn("number", F.col("event_type"))
    df = op.cast_columns(df, {"user_id": "string", "value": "bigint"})
    df = op.cast_columns(df, {"number": "double"}, errors="coerce")
    return op.select_as(df, {"event_id": "id", "user_id": "who", "value": "whole", "number": "number"})


@query("select ts as datetime_utc, cast(null as double) as depth, value from events where value is not null")
def ensure_columns(spark, d):
    df = op.drop_any_null_rows(events(spark, d), ["value"])
    return op.ensure_columns(df, {TS: "timestamp_ntz", "depth": "double", "value": "double"})


@query(
    """with f as (select event_id, case when event_id % 2 = 0 then value end as a,
         case when event_id % 3 = 0 then user_id end as b from events)
       select * from f where a is not null or b is not null"""
)
def drop_all_null(spark, d):
    df = events(spark, d).select(
        "event_id", F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("a"),
        F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("b"),
    )
    return op.drop_all_null_rows(df, ["a", "b"])


@query(
    """select event_id, datetime_utc, stage from (
         (select event_id, ts as datetime_utc, 'first' as stage from events order by ts limit 10)
         union all (select event_id, ts, 'last' from events order by ts desc limit 10))"""
)
def first_last_rows(spark, d):
    ev = events(spark, d).select("event_id", TS)
    first = op.first_rows(ev, 10).withColumn("stage", F.lit("first"))
    return first.unionByName(op.last_rows(ev, 10).withColumn("stage", F.lit("last")))


@query("select event_id, ts as datetime_utc, value from events order by ts")
def sort_by_time(spark, d):
    return op.sort_by_time(events(spark, d).select("event_id", TS, "value"))


@query(
    """select datetime_utc, o_orderkey, o_totalprice from (select o_orderdate as datetime_utc, o_orderkey, o_totalprice,
         row_number() over (partition by o_orderdate order by o_orderkey) as rn from orders) where rn = 1"""
)
def first_per_time(spark, d):
    df = table(spark, d, "orders").select(F.col("o_orderdate").alias(TS), "o_orderkey", "o_totalprice")
    return op.first_per_time(df, ["o_orderkey"])


@query(
    """select event_id, date_trunc('second', ts) as whole, date_trunc('millisecond', ts) as ms,
       case when event_id % 4 = 0 then null else date_trunc('second', ts) end as parsed from events"""
)
def time_normalize(spark, d):
    us = micros(F.col(TS))
    text = F.when(F.col("event_id") % 4 == 0, F.lit("not a time")).otherwise(F.date_format(TS, "yyyy-MM-dd HH:mm:ss"))
    df = events(spark, d).select(
        "event_id", F.expr("0L").alias("whole"), F.expr("0L").alias("ms"), text.alias("parsed"), us.alias("us")
    )
    df = df.withColumns({"whole": F.floor(F.col("us") / 1000000), "ms": F.floor(F.col("us") / 1000)}).drop("us")
    df = normalize_time(normalize_time(df, "whole"), "ms", unit="ms")
    return normalize_time(df, "parsed", errors="coerce")


# Intervals


def error_periods(spark: SparkSession, d: str, least: float, minutes: int, keyed: bool = False) -> DataFrame:
    """Periods around strong errors, some of zero length, many overlapping; ``keyed`` with the vessel they are of."""
    e = (vessels(events(spark, d)) if keyed else events(spark, d)).where((F.col("event_type") == "error") & (F.col("value") > least))
    length = F.when(F.col("event_id") % 4 == 0, F.lit(0)).otherwise(F.lit(minutes))
    return e.select(
        *(["vessel"] if keyed else []),
        F.col(TS).alias("start_time"),
        (F.col(TS) + F.make_dt_interval(mins=length)).alias("end_time"),
        F.lit(4).alias("qc_flag"),
        F.col("event_id").cast("string").alias("comment"),
    )


def periods_sql(least: float, minutes: int) -> str:
    return (
        "iv as (select ts as lo, case when event_id % 4 = 0 then ts else "
        f"ts + interval '{minutes} minutes' end as hi from events where event_type = 'error' and value > {least})"
    )


def flags_sql(test: str) -> str:
    return with_sql(
        periods_sql(60, 25),
        final=f"""select event_id, ts as datetime_utc, case when exists (select 1 from iv where {test})
                  then 4 when value > 90 then 3 else 2 end as flag from events""",
    )


def _flagged(spark, d, closed):
    df = op.threshold_flag(events(spark, d).select("event_id", TS, "value"), "value", ">", 90.0, "flag", bad=3)
    return op.flag_intervals(df, error_periods(spark, d, 60, 25), ["flag"], closed).drop("value")


CLOSED, OPEN = "lo <= ts and ts <= hi", "lo < ts and ts < hi"
query(flags_sql(CLOSED), "flag_intervals_closed", flags="flag")(lambda spark, d: _flagged(spark, d, "both"))
query(flags_sql(OPEN), "flag_intervals_open", flags="flag")(lambda spark, d: _flagged(spark, d, "neither"))
query(flags_sql(CLOSED), "flag_intervals_closed_swept", flags="flag")(lambda spark, d: _flagged(spark, d, "both"))
query(flags_sql(OPEN), "flag_intervals_open_swept", flags="flag")(lambda spark, d: _flagged(spark, d, "neither"))

EXTRACTS = with_sql(
    periods_sql(120, 30),
    "n as (select lo - interval '20 minutes' as lo, hi + interval '20 minutes' as hi, "
    "row_number() over (order by lo, hi) as period_no from iv)",
    final="select event_id, ts as datetime_utc, period_no from events join n on ts >= lo and ts <= hi",
)


def _extracts(spark, d):
    return op.period_extracts(
        events(spark, d).select("event_id", TS), error_periods(spark, d, 120, 30), "20m"
    )


query(EXTRACTS, "period_extracts")(lambda spark, d: _extracts(spark, d))
query(EXTRACTS, "period_extracts_joined")(lambda spark, d: _extracts(spark, d))


@query(
    with_sql(
        periods_sql(120, 30).replace("select ts as lo", "select event_id as listed, ts as lo"),
        "n as (select lo - interval '20 minutes' as lo, hi + interval '20 minutes' as hi, cast(listed as varchar) as comment, "
        "row_number() over (order by listed) as period_no from iv)",
        final="select event_id, ts as datetime_utc, period_no, comment from events join n on ts >= lo and ts <= hi",
    )
)
def period_extracts_listed(spark, d):
    """Numbered in the order in which the periods are listed, with their comments."""
    listed = error_periods(spark, d, 120, 30).withColumn("listed", F.col("comment").cast("long"))
    return op.period_extracts(
        events(spark, d).select("event_id", TS), listed, "20m", order_by="listed", carry=["comment"]
    )


# Buckets


@query(
    """select time_bucket(interval '10 minutes', ts) as datetime_utc,
         arg_min_null(case when event_id % 7 <> 0 then value end, ts) as value, arg_min_null(event_type, ts) as source
       from events group by 1"""
)
def bucket_first(spark, d):
    df = events(spark, d).select(
        TS, F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"), F.col("event_type").alias("source")
    )
    return op.bucket_first(df, "10m", ["value", "source"])


@query(
    """select time_bucket(interval '10 minutes', ts) as datetime_utc, round(avg(value), 6) as value,
         round(avg(user_id), 6) as user_id, arg_min(event_type, ts) as source from events group by 1"""
)
def bucket_mean_first(spark, d):
    df = events(spark, d).select(TS, "value", "user_id", F.col("event_type").alias("source"))
    return rounded(op.bucket_mean_first(df, "10m"), "value", "user_id")


@query(
    """select time_bucket(interval '10 minutes', ts) as datetime_utc, round(avg(value), 6) as value,
         round(avg(user_id), 6) as user_id from events group by 1"""
)
def bucket_mean(spark, d):
    return rounded(op.bucket_mean(events(spark, d), "10m", exclude=["event_id", "event_type"]), "value", "user_id")


@query(
    """select time_bucket(interval '30 minutes', ts) as datetime_utc, min(ts) as datetime_utc_first,
         round(avg(value), 6) as value, round(avg(user_id), 6) as user_id, arg_min(event_type, ts) as event_type_first,
         max(case when value > 90 then '4' else '2' end) as ph_flag
       from events group by 1"""
)
def bucket_by_type(spark, d):
    df = op.threshold_flag(events(spark, d), "value", ">", 90.0, "ph_flag").drop("event_id")
    df = df.withColumn("ph_flag", F.col("ph_flag").cast("string")).withColumn("timestamp", F.lit("raw"))
    return rounded(op.bucket_by_type(df, "30m"), "value", "user_id")


@query(
    """with u as (select o_orderdate as t, o_totalprice as p, o_orderpriority as pr from (select *,
         row_number() over (partition by o_orderdate order by o_orderkey) as rn from orders) where rn = 1),
       w as (select l_shipdate as t, l_quantity as q from (select *,
         row_number() over (partition by l_shipdate order by l_orderkey, l_linenumber) as rn from lineitem) where rn = 1),
       a as (select time_bucket(interval '5 days', t, timestamp '1970-01-01') as b, avg(p) as price,
               arg_min(pr, t) as priority from u group by 1),
       c as (select time_bucket(interval '5 days', t, timestamp '1970-01-01') as b, avg(q) as quantity from w group by 1)
       select coalesce(a.b, c.b) as datetime_utc, round(price, 6) as price, priority, round(quantity, 6) as quantity,
         cast(null as double) as depth from a full join c on a.b = c.b"""
)
def resample_mean_join(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_orderdate").alias(TS), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderkey").alias("okey"),
    )
    lines = table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias(TS), F.col("l_quantity").alias("quantity"), F.col("l_orderkey").alias("lkey"), "l_linenumber"
    )
    out = op.resample_mean_join(
        [("orders", orders), ("lines", lines)], "5 days",
        expected={TS: "timestamp_ntz", "price": "double", "priority": "string", "quantity": "double", "depth": "double"},
        ties={"orders": ["okey"], "lines": ["lkey", "l_linenumber"]},
    )
    return rounded(out, "price", "quantity")


# Order


@query(
    """select event_id, ts as datetime_utc,
         (epoch_us(ts) - lag(epoch_us(ts)) over (order by ts)) / 1000000.0::double as time_diff from events"""
)
def lag_diff(spark, d):
    return op.lag_diff(events(spark, d).select("event_id", TS), TS)


@query(
    """select o_orderkey, o_orderdate as datetime_utc,
         lag(o_orderkey) over (order by o_orderdate, o_orderkey) as prev_key,
         lag(o_totalprice) over (order by o_orderdate, o_orderkey) as prev_price from orders"""
)
def previous_row(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias(TS), "o_totalprice")
    out = op.with_previous(df, TS, {"prev_key": "o_orderkey", "prev_price": "o_totalprice"}, tie=["o_orderkey"])
    return out.drop("o_totalprice")


@query(
    """select o_orderkey, o_orderdate as datetime_utc,
         lag(o_orderkey) over (order by o_orderdate, 'order number ' || o_orderkey, o_orderkey) as prev_key from orders"""
)
def previous_row_text_tie(spark, d):
    """Ties in text order, of which the first bytes are all alike."""
    df = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias(TS), F.concat(F.lit("order number "), F.col("o_orderkey")).alias("name")
    )
    return op.with_previous(df, TS, {"prev_key": "o_orderkey"}, tie=["name"]).drop("name")


@query(
    """select * from (select lag(ts) over (order by ts) as prev_ts, ts as curr_ts,
         epoch_us(ts) - lag(epoch_us(ts)) over (order by ts) as gap from events) where gap > 60000000"""
)
def find_gaps(spark, d):
    return op.find_gaps(events(spark, d), TS, "1m")


@query(
    """select * from (select user_id % 50 as vessel, lag(ts) over (partition by user_id % 50 order by ts) as prev_ts,
         ts as curr_ts, epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id % 50 order by ts) as gap from events)
       where gap > 7200000000"""
)
def find_gaps_by_key(spark, d):
    return op.find_gaps(events(spark, d).withColumn("vessel", F.col("user_id") % 50), TS, "2h", keys=["vessel"])


@query(
    """select * from (select o_orderkey, o_orderdate as datetime_utc, lag(o_orderdate) over (order by o_orderkey) as prev_ts
         from orders) where datetime_utc < prev_ts"""
)
def non_monotonic(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias(TS))
    return op.non_monotonic(df, "o_orderkey")


def irregular_sql(source: str) -> str:
    return f"""with g as (select lag(ts) over (order by ts) as start_ts, ts as end_ts,
         (epoch_us(ts) - lag(epoch_us(ts)) over (order by ts)) / 1000000.0::double as seconds from {source})
       select start_ts, end_ts, seconds, count(*) as n from g
       where abs(seconds - (select avg(seconds) from g)) > 2 * (select stddev_samp(seconds) from g) group by 1, 2, 3"""


@query(irregular_sql("events"))
def irregular_intervals(spark, d):
    return op.irregular_intervals(events(spark, d), TS)


def regularity_sql(ts: str, source: str, median: str = "median(s)", digits: int = 6) -> str:
    return f"""with g as (select (epoch_us({ts}) - lag(epoch_us({ts})) over (order by {ts})) / 1000000.0::double as s from {source}),
       m as (select avg(s) as a, stddev_samp(s) as b, count(s) as n from g)
       select (select count(*) from {source}) as rows, n as intervals, round(a, {digits}) as mean_s, round(b, {digits}) as std_s,
         (select {median} from g) as median_s, (select min(s) from g) as min_s, (select max(s) from g) as max_s,
         (select count(*) - count(distinct {ts}) from {source}) as duplicates,
         (select count(*) from g where abs(s - a) > 2 * b) as irregular,
         round(100.0 * (select count(*) from g where abs(s - a) > 2 * b) / n, {digits}) as irregular_pct from m"""


@query(regularity_sql("ts", "events"))
def regularity_report(spark, d):
    return rounded(op.regularity_report(events(spark, d), TS), "mean_s", "std_s", "irregular_pct")


@query(regularity_sql("l_shipdate", "lineitem"))
def regularity_with_ties(spark, d):
    df = table(spark, d, "lineitem").select(F.col("l_shipdate").alias(TS))
    return rounded(op.regularity_report(df, TS), "mean_s", "std_s", "irregular_pct")


@query(
    """select median(s) as median_s from (select cast(trunc((epoch_us(ts) - lag(epoch_us(ts)) over (order by ts)) / 1000000.0) as bigint) as s,
         case when event_id % 7 <> 0 then value end as v from events) where s is not null and v is not null"""
)
def sampling_interval(spark, d):
    df = events(spark, d).select(TS, F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"))
    return op.sampling_interval(df, TS)


def completeness_sql(ts: str, source: str, median: str = "median(s)", digits: int = 6) -> str:
    return f"""with g as (select (epoch_us({ts}) - lag(epoch_us({ts})) over (order by {ts})) / 1000000.0::double as s from {source}),
       m as (select {median} as med from g),
       t as (select (epoch_us(max({ts})) - epoch_us(min({ts}))) / 1000000.0::double as span, count(*) as n from {source})
       select span as time_range_s, med as median_s, round(span / med, {digits}) as expected_points, n as actual_points,
         round(100.0 * n / (span / med), {digits}) as completeness_pct, (select count(*) from g, m where s > 5 * med) as large_gaps
       from t, m where med > 0"""


@query(completeness_sql("ts", "events"))
def series_completeness(spark, d):
    return rounded(op.series_completeness(events(spark, d)), "expected_points", "completeness_pct")


#: Vessels of the reports by key; the last one has no name.
VESSELS = range(4)


def vessels(df: DataFrame) -> DataFrame:
    number = F.col("user_id") % len(VESSELS)
    return df.withColumn("vessel", F.when(number != VESSELS[-1], number))


def by_vessel_sql(report: Callable[[str], str]) -> str:
    """A report in SQL for each vessel by itself."""
    one = lambda v: f"(select * from events where user_id % {len(VESSELS)} = {v})"
    name = lambda v: f"cast({'null' if v == VESSELS[-1] else v} as bigint) as vessel"
    return " union all ".join(f"select {name(v)}, * from ({report(one(v))})" for v in VESSELS)


#: The median of whole microseconds, which is exact for an even number of steps too.
EXACT_MEDIAN = "median(cast(round(s * 1000000) as bigint)) / 1000000.0::double"


@query(by_vessel_sql(lambda source: regularity_sql("ts", source, EXACT_MEDIAN)))
def regularity_by_key(spark, d):
    return rounded(op.regularity_report(vessels(events(spark, d)), TS, keys=["vessel"]), "mean_s", "std_s", "irregular_pct")


@query(by_vessel_sql(lambda source: completeness_sql("ts", source, EXACT_MEDIAN)))
def completeness_by_key(spark, d):
    out = op.series_completeness(vessels(events(spark, d)), keys=["vessel"])
    return rounded(out, "expected_points", "completeness_pct")


@query(by_vessel_sql(lambda source: irregular_sql(source)))
def irregular_by_key(spark, d):
    return op.irregular_intervals(vessels(events(spark, d)), TS, keys=["vessel"])


@query(
    """select user_id, median(s) as median_s from (select user_id, cast(trunc((epoch_us(ts) - lag(epoch_us(ts))
         over (partition by user_id order by ts)) / 1000000.0) as bigint) as s,
         case when event_id % 7 <> 0 then value end as v from events) where s is not null and v is not null group by 1"""
)
def sampling_interval_by_key(spark, d):
    """A median for every user: as many series as there are users."""
    df = events(spark, d).select("user_id", TS, F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"))
    return op.sampling_interval(df, TS, keys=["user_id"])


@query(
    """select * from (select lag(ts) over (order by ts) as prev_ts, ts as datetime_utc, value / 10 as latitude,
         user_id / 10.0::double as longitude,
         round(sqrt(pow(value / 10 - lag(value / 10) over (order by ts), 2)
                    + pow(user_id / 10.0::double - lag(user_id / 10.0::double) over (order by ts), 2)) * 111, 6) as distance_km
       from events where value is not null) where distance_km > 1000"""
)
def position_jumps(spark, d):
    df = events(spark, d).select(
        TS, (F.col("value") / 10).alias("latitude"), (F.col("user_id") / 10.0).alias("longitude")
    )
    return rounded(op.position_jumps(df, km=1000), "distance_km")


@query(
    """with r as (select ts, event_id, value, avg(value) over w as m, stddev_samp(value) over w as s,
         avg(user_id) over w as um, stddev_samp(user_id) over w as us, user_id from events
         window w as (order by ts rows between 2 preceding and 2 following)),
       c as (select count(*) as n, count(*) filter (abs(value - m) > 1.5 * nullif(s, 0)) as v,
         count(*) filter (abs(user_id - um) > 1.5 * nullif(us, 0)) as u from r)
       select 'value' as "column", v as outliers, round(100.0 * v / n, 6) as percent from c
       union all select 'user_id', u, round(100.0 * u / n, 6) from c"""
)
def rolling_outliers(spark, d):
    df = events(spark, d).select(TS, "value", "user_id")
    return rounded(op.rolling_outliers(df, TS, ["value", "user_id"], window=5, k=1.5), "percent")


@query(
    """select l_orderkey, l_linenumber, round(avg(l_quantity) over w, 6) as mean_q,
         round(stddev_samp(l_quantity) over w, 6) as std_q from lineitem
       window w as (order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice rows between 3 preceding and 3 following)"""
)
def rolling_deviation(spark, d):
    df = table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias(TS), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.col("l_quantity").alias("q")
    )
    out = op.rolling_deviation(df, ["q"], TS, 7, tie=["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", r6("q_mean").alias("mean_q"), r6("q_std").alias("std_q"))


@query(
    """select l_orderkey, l_linenumber, round(avg(l_quantity) over w, 6) as mean_q,
         round(stddev_samp(l_quantity) over w, 6) as std_q from lineitem
       window w as (partition by nullif(l_returnflag, 'R') order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice
         rows between 2 preceding and 2 following)"""
)
def rolling_deviation_by_key(spark, d):
    """Windows stay within a key, of which one is null."""
    df = table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias(TS), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.col("l_quantity").alias("q"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag"),
    )
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    out = op.rolling_deviation(df, ["q"], TS, 5, tie=tie, keys=["flag"])
    return out.select("l_orderkey", "l_linenumber", r6("q_mean").alias("mean_q"), r6("q_std").alias("std_q"))


@query(
    with_sql(
        *REGULAR,
        feed_sql("c", "click", "view"),
        asof_sql("f", "a", "c", "12 minutes", "l.*", [("view_value", "vs"), ("view_user", "us")]),
        "t as (select min(datetime_utc) as t0 from a where view_value is null)",
        """z as (select datetime_utc, coalesce(view_value, vs) as view_value, coalesce(view_user, us) as view_user,
                 case when view_value is null then 'ship' else 'uw' end as source from f)""",
        final="""select datetime_utc, view_value, view_user, null as source, 'before' as stage from a, t
                 where datetime_utc between t0 - interval '1 hour' and t0 + interval '1 hour'
                 union all select datetime_utc, view_value, view_user, source, 'after' from z, t
                 where datetime_utc between t0 - interval '1 hour' and t0 + interval '1 hour'""",
    )
)
def gap_context(spark, d):
    regular = op.regularize(feed(spark, d, "view", "view"), TS, "5m", "4m")
    filled = op.fill_from_secondary(regular, feed(spark, d, "click", "view"), TS, tolerance="12m", labels=("uw", "ship"))
    return op.gap_context(regular, filled, "view_value", pad="1h")


# Reports


@query("select value_flag, count(*) as count from (select case when value > 90 then 4 else 2 end as value_flag from events) group by 1", flags="value_flag")
def flag_counts(spark, d):
    return op.flag_counts(op.threshold_flag(events(spark, d), "value", ">", 90.0, "value_flag"), "value_flag")


@query("select count(*) as null_count from events where event_id % 7 = 0 or value is null")
def null_count(spark, d):
    df = events(spark, d).select(F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"))
    return op.null_count(df, "v")


@query("select count(*) as row_count, min(ts) as first_time, max(ts) as last_time from events")
def row_range(spark, d):
    return op.row_range(events(spark, d))


@query("select count(*) - count(distinct o_orderdate) as duplicates from orders")
def duplicate_times(spark, d):
    return op.duplicate_times(table(spark, d, "orders"), "o_orderdate")


@query(
    """select n, round(c, 6) as correlation, c < 0.5 as low from (select count(*) as n, corr(l_quantity, l_extendedprice) as c
       from lineitem where l_quantity is not null and l_extendedprice is not null and l_discount is not null) where n > 10"""
)
def correlation(spark, d):
    out = op.correlation(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", ["l_discount"])
    return rounded(out, "correlation")


@query(
    """with f as (select event_id, case when event_id % 7 <> 0 then value end as v, case when event_id % 3 = 0 then event_type end as w
         from events), n as (select count(*) as n from f)
       select 'event_id' as "column", count(*) - count(event_id) as missing, round(100.0 * (count(*) - count(event_id)) / count(*), 6) as percent from f
       union all select 'v', count(*) - count(v), round(100.0 * (count(*) - count(v)) / count(*), 6) from f
       union all select 'w', count(*) - count(w), round(100.0 * (count(*) - count(w)) / count(*), 6) from f"""
)
def missing_report(spark, d):
    df = events(spark, d).select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("w"),
    )
    return rounded(op.missing_report(df), "percent")


@query(
    """with f as (select l_discount, l_tax, l_returnflag, case when l_linenumber = 1 then l_quantity end as q from lineitem),
       t as (select count(*) as n, sum((l_discount is null)::int + (l_tax is null)::int + (l_returnflag is null)::int + (q is null)::int) as m from f),
       u as (select count(*) as k from (select distinct * from f))
       select n as rows, 4 * n as total_cells, m as missing_cells, n - k as duplicate_rows,
         round(100.0 * (4 * n - m) / (4 * n), 6) as completeness, round(100.0 * k / n, 6) as uniqueness from t, u""",
    missing_cells="bigint",
)
def quality_scores(spark, d):
    df = table(spark, d, "lineitem").select(
        "l_discount", "l_tax", "l_returnflag", F.when(F.col("l_linenumber") == 1, F.col("l_quantity")).alias("q")
    )
    return rounded(op.quality_scores(df), "completeness", "uniqueness")


def describe_sql(col: str, name: str, source: str) -> str:
    pick = lambda q: f"(list_sort(list({col})))[cast(floor((count({col}) - 1) * {q} + 0.5) as bigint) + 1]"
    return (
        f"select '{name}' as \"column\", count({col}) as count, count(*) - count({col}) as null_count, round(avg({col}), 6) as mean, "
        f"round(stddev_samp({col}), 6) as std, min({col}) as min, {pick(0.25)} as q25, {pick(0.5)} as q50, {pick(0.75)} as q75, "
        f"max({col}) as max from {source}"
    )


@query(
    " union all ".join(
        [
            describe_sql("value", "value", "events"),
            describe_sql("u", "user_id", "(select user_id::double as u from events)"),
            describe_sql("p", "price", "(select case when event_id % 7 <> 0 then value * 1000 end as p from events)"),
        ]
    )
)
def describe_series(spark, d):
    df = events(spark, d).select(
        "value", "user_id", F.when(F.col("event_id") % 7 != 0, F.col("value") * 1000).alias("price")
    )
    return rounded(op.describe_series(df), "mean", "std")


@query(
    f"""select *, cast(null as varchar) as min_text, cast(null as varchar) as max_text from ({describe_sql("value", "value", "events")})
        union all select 'event_type', count(event_type), count(*) - count(event_type), null, null, null, null, null, null, null,
          min(event_type), max(event_type) from events"""
)
def describe_with_text(spark, d):
    return rounded(op.describe_series(events(spark, d).select("value", "event_type")), "mean", "std")


# Validation

RULE_COLUMNS = {
    "gps": {"latitude": "l_quantity * 2", "longitude": "l_quantity * 4 - 50"},
    "tsg": {"temperature": "l_quantity - 5", "salinity": "l_quantity"},
    "ph": {"vrse": "l_discount * 20 - 1", "ph_flag": "l_linenumber"},
    "rho": {"rho_ppb": "l_quantity * 11 - 5"},
    "oxygen": {"oxygen_umol_kg": "l_quantity * 3 + 180"},
}


def rules_sql() -> str:
    rows, cols = [], []
    for name, rules in op_rules().items():
        rows.append(f"select '{name}' as feed, 'required' as rule, 'datetime_utc' as \"column\", 'error' as severity, 0 as violations, true as passed")
        for c, (lo, hi) in rules.ranges.items():
            e = f"({RULE_COLUMNS[name][c]})"
            strict = c in rules.strict
            bad = f"(select count(*) from lineitem where {e} < {lo} or {e} > {hi})"
            rows.append(f"select '{name}', 'required', '{c}', 'error', 0, true")
            rows.append(f"select '{name}', 'type', '{c}', 'error', 0, true")
            rows.append(
                f"select '{name}', 'range', '{c}', '{'error' if strict else 'warning'}', {bad}, {f'{bad} = 0' if strict else 'true'}"
            )
    return " union all ".join(rows)


def op_rules():
    from tidelane.operators.validate import RULES

    return RULES


@query(rules_sql())
def validate_ranges(spark, d):
    lines = table(spark, d, "lineitem")
    out = None
    for name, cols in RULE_COLUMNS.items():
        df = lines.select(F.col("l_shipdate").alias(TS), *[F.expr(e).alias(c) for c, e in cols.items()])
        report = op.validate_feed(df, name)
        out = report if out is None else out.unionByName(report)
    return out


@query(
    """with f as (select l_quantity as temperature, l_discount * 100 + 30 as salinity, l_tax + 7.45 as ph from lineitem)
       select 'temperature' as "column", 10.0 as lo, 25.0 as hi, count(*) filter (temperature < 10 or temperature > 25) as out_of_range,
         min(temperature) as min_value, max(temperature) as max_value from f
       union all select 'Salinity', 25.0, 37.0, count(*) filter (salinity < 25 or salinity > 37), min(salinity), max(salinity) from f
       union all select 'ph', 7.5, 9.5, count(*) filter (ph < 7.5 or ph > 9.5), min(ph), max(ph) from f""",
    lo="double", hi="double",
)
def range_report(spark, d):
    df = table(spark, d, "lineitem").select(
        F.col("l_quantity").alias("temperature"), (F.col("l_discount") * 100 + 30).alias("Salinity"), (F.col("l_tax") + 7.45).alias("ph")
    )
    return op.range_report(df)


@query(
    """with b as (select 'events' as t, 1 as i, min(ts) as lo, max(ts) as hi from events
         union all select 'orders', 2, min(o_orderdate), max(o_orderdate) from orders
         union all select 'lines', 3, min(l_shipdate), max(l_shipdate) from lineitem)
       select a.t as table1, c.t as table2,
         case when greatest(a.lo, c.lo) < least(a.hi, c.hi) then greatest(a.lo, c.lo) end as overlap_start,
         case when greatest(a.lo, c.lo) < least(a.hi, c.hi) then least(a.hi, c.hi) end as overlap_end,
         case when greatest(a.lo, c.lo) < least(a.hi, c.hi)
           then (epoch_us(least(a.hi, c.hi)) - epoch_us(greatest(a.lo, c.lo))) / 1000000.0::double else 0 end as overlap_s
       from b a join b c on a.i < c.i"""
)
def table_overlap(spark, d):
    tables = {
        "events": events(spark, d),
        "orders": table(spark, d, "orders").withColumnRenamed("o_orderdate", TS),
        "lines": table(spark, d, "lineitem").withColumnRenamed("l_shipdate", TS),
    }
    return op.table_overlap(tables)


# Chemistry


def ph_sql(v: str, t: str, s: str, k0: float, k2: float) -> str:
    tk = f"({t} + 273.15)"
    i = f"(19.924 * {s} / (1000.0 - 1.005 * {s}))"
    dil = f"(1.0 - 0.001005 * {s})"
    ks = (
        f"exp(-4276.1 / {tk} + 141.328 - 23.093 * ln({tk}) + (-13856.0 / {tk} + 324.57 - 47.986 * ln({tk})) * sqrt({i})"
        f" + (35474.0 / {tk} - 771.54 + 114.723 * ln({tk})) * {i} - 2698.0 / {tk} * pow({i}, 1.5) + 1776.0 / {tk} * pow({i}, 2)) * {dil}"
    )
    act = (
        f"(-(3.4286e-6 * {t} * {t} + 6.7503e-4 * {t} + 0.49172143) * sqrt({i}) / (1.0 + 1.394 * sqrt({i})) + (0.08885 - 0.000111 * {t}) * {i})"
    )
    free = (
        f"(({v} - ({k0}::double + {k2}::double * {t})) / (8.314462618::double / 96485.33212 * {tk} * ln(10.0::double)) + "
        f"log10(0.99889::double / 35.453 * {s} / 1.80655 / {dil}) + 2 * {act} - log10({dil}))"
    )
    total = f"({free} - log10(1.0 + (0.1400::double / 96.062 * {s} / 1.80655) / ({ks})))"
    return f"case when {v} is not null and {t} is not null and {s} > 0 then {total} end"


@query(
    f"""with f as (select event_id, case when event_id % 7 <> 0 then -0.85 - value / 10000 end as vrse, 5 + user_id % 20::double as temperature,
         (event_id % 36)::double as salinity from events)
        select event_id, round({ph_sql('vrse', 'temperature', 'salinity', -1.3944286, -0.00107)}, 6) as ph_corrected from f"""
)
def corrected_ph(spark, d):
    df = events(spark, d).select(
        "event_id",
        F.when(F.col("event_id") % 7 != 0, F.lit(-0.85) - F.col("value") / 10000).alias("vrse"),
        (F.lit(5.0) + F.col("user_id") % 20).alias("temperature"),
        (F.col("event_id") % 36).cast("double").alias("salinity"),
    )
    return add_corrected_ph(df, -1.3944286, -0.0010700).select("event_id", r6("ph_corrected").alias("ph_corrected"))


# Sources and sinks: each stores the whole table in the shared folder and reads it back


def _stored(spark: SparkSession, label: str, write: Callable[[str], None]) -> str:
    path = new_shared_path(spark, label)
    write(path)
    return path


@query("select event_id, ts as datetime_utc, value from events")
def parquet_series(spark, d):
    df = events(spark, d).select("event_id", TS, "value")
    path = _stored(spark, "series", lambda p: src.write_parquet_series(df, p))
    return src.read_parquet_series(spark, path)


@query("select event_id, date_trunc('second', ts) as datetime_utc, value from events")
def csv_series(spark, d):
    df = events(spark, d).select("event_id", TS, "value")
    path = new_shared_path(spark, "products")
    src.write_products(df, {"csv_path": path})
    out = src.read_csv_lenient_time(spark, path, TS)
    return op.cast_columns(out, {"event_id": "bigint", "value": "double"})


@query("select event_id, ts as datetime_utc, date_trunc('second', ts) as whole from events")
def epoch_table(spark, d):
    seconds = micros(F.col("ts")) / F.lit(1_000_000)
    df = table(spark, d, "events").select(
        "event_id", (micros(F.col("ts")).cast("decimal(20,0)") / 1000000).cast("decimal(20,6)").alias(TS), seconds.alias("whole")
    )
    path = _stored(spark, "epoch", lambda p: df.write.parquet(p))
    kept = src.read_epoch_table(spark, path).drop("whole")
    cut = src.read_epoch_table(spark, path, time_col="whole", truncate=True).drop(TS)
    return kept.join(cut, "event_id")


EPOCH_FROM, EPOCH_TO = "2024-01-05 00:00:00", "2024-01-20 12:00:00"


@query(f"select event_id, ts as datetime_utc from events where ts >= timestamp '{EPOCH_FROM}' and ts <= timestamp '{EPOCH_TO}'")
def epoch_window(spark, d):
    seconds = (micros(F.col("ts")).cast("decimal(20,0)") / 1000000).cast("decimal(20,6)")
    df = table(spark, d, "events").select("event_id", seconds.alias(TS))
    path = _stored(spark, "epoch", lambda p: df.write.parquet(p))
    return src.read_epoch_table(spark, path, lo=EPOCH_FROM, hi=EPOCH_TO)


@query(with_sql(periods_sql(60, 25), final="select date_trunc('second', lo) as start_time, date_trunc('second', hi) as end_time, 4 as qc_flag from iv"))
def interval_csv(spark, d):
    iv = error_periods(spark, d, 60, 25)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    df = iv.select(text("start_time"), text("end_time"), "qc_flag", "comment")
    path = _stored(spark, "intervals", lambda p: df.write.option("header", True).csv(p))
    return src.read_intervals(spark, path).drop("comment")


@query("select ts as datetime_utc, 200 + value / 10 as oxygen_umol_kg from events")
def instrument_csv(spark, d):
    df = events(spark, d).select(
        F.date_format(TS, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("datetime"), (F.lit(200) + F.col("value") / 10).alias("O2_calc"), "user_id"
    )
    path = _stored(spark, "instrument", lambda p: df.write.option("header", True).csv(p))
    return src.read_oxygen(spark, path)


@query("select ts as datetime_utc, value / 10 as latitude, -user_id / 10.0::double as longitude from events")
def track_points(spark, d):
    df = events(spark, d).select(
        (F.col("value") / 10).alias("_lat"), (-F.col("user_id") / 10.0).alias("_lon"),
        F.date_format(TS, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
    )
    path = _stored(spark, "track", lambda p: df.write.format("xml").option("rootTag", "trkseg").option("rowTag", "trkpt").save(p))
    return src.ingest_track_points(spark, path)


def log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Log lines made from events, with every kind of damage at its own period."""
    every = lambda n: F.col("event_id") % n == 0
    hms = F.when(every(29), F.concat(F.date_format(TS, "HHmm"), F.lit("60"))).otherwise(F.date_format(TS, "HHmmss"))
    dmy = F.when(every(17), F.concat(F.date_format(TS, "ddMM"), F.lit("2$*"))).otherwise(F.date_format(TS, "ddMMyy"))
    south = F.when(every(2), F.lit(" S")).otherwise(F.lit(" N"))
    lat = F.concat(F.col("user_id") % 90, F.lit(" "), F.col("value").cast("string"), south)
    lat = F.when(every(23), (F.col("user_id") % 90).cast("string")).otherwise(lat)
    fields = [
        ("t1= ", F.when(every(19), F.lit("1.2.3")).otherwise(F.col("value").cast("string"))),
        ("c1= ", F.col("user_id")),
        ("s= ", F.when(~every(13), F.col("value") + 1)),
        ("t2= ", F.col("event_id")),
        ("lat= ", lat),
        ("hms=", F.when(~every(5), hms)),
        ("dmy=", dmy),
    ]
    line = F.concat_ws("  ", *[F.concat(F.lit(k), v.cast("string")) for k, v in fields])
    return events(spark, d).select("event_id", line.alias("line"))


_LOG = """k as (select *, event_id % 19 = 0 as bad_t1, event_id % 13 = 0 as no_s, event_id % 23 = 0 as no_hemi from events),
   t as (select *, case when event_id % 5 <> 0 then
       (case when event_id % 29 = 0 then date_trunc('minute', ts) + interval '1 minute' else date_trunc('second', ts) end)
       + case when event_id % 17 = 0 then interval '1 year' else interval '0 days' end end as dt,
     row_number() over (order by event_id) as rn from k where not bad_t1 and not no_s and not no_hemi),
   a as (select *, last_value(dt ignore nulls) over w as adt,
     last_value(case when dt is not null then rn end ignore nulls) over w as arn from t
     window w as (order by event_id rows between unbounded preceding and current row))"""


@query(
    f"""with {_LOG} select event_id, value as t1, user_id::double as c1, value + 1 as s, event_id::double as t2,
        round((user_id % 90 + value / 60) * case when event_id % 2 = 0 then -1 else 1 end, 6) as latitude,
        dt as datetime, adt + interval '2 seconds' * (rn - arn) as ts from a"""
)
def log_rows(spark, d):
    rows, _ = src.parse_keyvalue_lines(log_lines(spark, d), "line", "event_id")
    return rounded(rows.drop("longitude"), "latitude")


@query(
    """with k as (select *, event_id % 3 as user_key from events), f as (
       select user_key, event_id, case when event_id % 4 = 0 then ts end as known, row_number() over (partition by user_key order by event_id) as rn from k),
       a as (select *, last_value(known ignore nulls) over w as base, last_value(case when known is not null then rn end ignore nulls) over w as arn
         from f window w as (partition by user_key order by event_id rows between unbounded preceding and current row))
       select nullif(user_key, 2) as user_key, event_id, base + interval '2 seconds' * (rn - arn) as ts from a"""
)
def fill_time_by_key(spark, d):
    """Filled along each of three keys, one of them null."""
    df = events(spark, d).select(
        F.when(F.col("event_id") % 3 != 2, F.col("event_id") % 3).alias("user_key"), "event_id",
        F.when(F.col("event_id") % 4 == 0, F.col(TS)).alias("known"),
    )
    return src.fill_time_by_increment(df, "known", "event_id", "2s", ["user_key"]).drop("known")


_FILES = """l as (select *, event_id % 2 as file, case when event_id % 7 = 0 then 'W' else 'E' end as side from events),
   g as (select *, event_id % 11 = 0 as no_pairs, event_id % 13 = 0 as bad_time from l)"""


def _written_logs(spark, d) -> tuple[DataFrame, DataFrame]:
    """Two log files in event order, with repeated keys, invalid times, both hemispheres and lines without pairs."""
    every = lambda n: F.col("event_id") % n == 0
    lon = F.concat(F.col("user_id") % 180, F.lit(" 30.0 "), F.when(every(7), F.lit("W")).otherwise(F.lit("E")))
    fields = [
        ("t1= ", F.lit("9.5")), ("t1= ", F.col("value")), ("c1= ", F.col("user_id")), ("s= ", F.col("value") + 1),
        ("t2= ", F.col("event_id")), ("lon= ", lon),
        ("hms=", F.when(every(13), F.lit("256199")).otherwise(F.date_format(TS, "HHmmss"))), ("dmy=", F.date_format(TS, "ddMMyy")),
    ]
    line = F.concat_ws("  ", *[F.concat(F.lit(k), v.cast("string")) for k, v in fields])
    lines = events(spark, d).select(
        (F.col("event_id") % 2).alias("file"), "event_id", F.when(every(11), F.lit("no pairs here")).otherwise(line).alias("value"))
    path = new_shared_path(spark, "logs")
    for i in (0, 1):  # a file is one ordered stream
        lines.where(F.col("file") == i).orderBy("event_id").coalesce(1).select("value").write.text(f"{path}/{i}")
    return src.ingest_keyvalue_log(spark, [f"{path}/0", f"{path}/1"])


@query(
    f"""with {_FILES}, t as (select *, case when not bad_time then date_trunc('second', ts) end as dt,
          row_number() over (partition by file order by event_id) as rn from g where not no_pairs),
        a as (select *, last_value(dt ignore nulls) over w as adt, last_value(case when dt is not null then rn end ignore nulls) over w as arn
          from t window w as (partition by file order by event_id rows between unbounded preceding and current row))
        select event_id::double as t2, value as t1, user_id::double as c1, value + 1 as s,
          round((user_id % 180 + 0.5::double) * case when side = 'W' then -1 else 1 end, 6) as longitude,
          dt as datetime, adt + interval '2 seconds' * (rn - arn) as ts from a"""
)
def log_files(spark, d):
    rows, _ = _written_logs(spark, d)
    return rounded(rows.drop("file", "block", "position", "latitude"), "longitude")


@query(
    f"""with {_FILES} select false as dropped, 'invalid date or time' as reject_reason, 't1= 9.5  t1= ' || value || '  c1= ' || user_id || '  s= ' || (value + 1)
        || '  t2= ' || event_id || '  lon= ' || (user_id % 180) || ' 30.0 ' || side || '  hms=256199  dmy=' || strftime(ts, '%d%m%y') as line
        from g where bad_time and not no_pairs"""
)
def log_file_rejects(spark, d):
    _, rejects = _written_logs(spark, d)
    return rejects.select("dropped", "reject_reason", "line")


@query(
    f"""with {_LOG} select event_id, true as dropped, case when bad_t1 then 'unreadable value for t1' when no_hemi then 'no hemisphere in lat'
        else 'missing s' end as reject_reason from k where bad_t1 or no_s or no_hemi"""
)
def log_rejects(spark, d):
    _, rejects = src.parse_keyvalue_lines(log_lines(spark, d), "line", "event_id")
    return rejects.drop("line")


# Composite jobs; one second of the feeds is five minutes of the events

SCALE = 300


def cruise(spark: SparkSession, d: str, keyed: bool = False) -> dict[str, DataFrame]:
    """The raw feeds; ``keyed`` tells them apart by vessel."""
    ev = vessels(events(spark, d)) if keyed else events(spark, d)
    own = ["vessel"] if keyed else []
    kind = lambda k: ev.where(F.col("event_type") == k)
    v, u = F.col("value"), F.col("user_id")
    return {
        "gps": kind("view").select(*own, TS, F.when(F.col("event_id") % 11 != 0, v / 10).alias("latitude"), (-u / 10.0).alias("longitude")),
        "track": kind("click").select(*own, TS, (v / 10).alias("latitude"), (-u / 10.0).alias("longitude")),
        "tsg": kind("purchase").select(
            *own, TS, (v / 20).alias("temp"), (u / 100.0).alias("cond"), F.when(F.col("event_id") % 7 != 0, F.lit(29) + v / 100).alias("salinity")
        ),
        "log_rows": kind("error").select(*own, F.col(TS).alias("ts"), (v / 20).alias("t1"), (u / 100.0).alias("c1"), (F.lit(30) + v / 100).alias("s")),
        "ph": kind("signup").select(
            *own, TS, (F.lit(-0.88) - v / 10000).alias("vrse"), (F.lit(7.5) + v / 40).alias("ph_total"), F.lit("raw").alias("timestamp")
        ),
        "ph_intervals": error_periods(spark, d, 60, 25, keyed),
        "rho": kind("click").select(*own, TS, v.alias("rho_ppb")),
        "oxygen": kind("purchase").select(*own, TS, (F.lit(200) + v / 10).alias("oxygen_umol_kg")),
        "shutdowns": error_periods(spark, d, 120, 30, keyed),
    }


CRUISE = [
    EV,
    "gps0 as (select datetime_utc, case when event_id % 11 <> 0 then value / 10 end as latitude, -user_id / 10.0::double as longitude from ev where event_type = 'view')",
    "trk as (select datetime_utc + interval '13800 seconds' as datetime_utc, value / 10 as latitude, -user_id / 10.0::double as longitude from ev where event_type = 'click')",
    "tsg0 as (select datetime_utc, value / 20 as temperature, user_id / 100.0::double as cond, case when event_id % 7 <> 0 then 29 + value / 100 end as salinity from ev where event_type = 'purchase')",
    "ship as (select datetime_utc, value / 20 as temperature, user_id / 100.0::double as cond, 30 + value / 100 as salinity from ev where event_type = 'error')",
    "ph0 as (select datetime_utc, -0.88 - value / 10000 as vrse, 7.5 + value / 40 as ph_total from ev where event_type = 'signup')",
    "rho as (select datetime_utc, value as rho_ppb, 2 as rho_flag from ev where event_type = 'click')",
    "oxy as (select datetime_utc, 200 + value / 10 as oxygen_umol_kg from ev where event_type = 'purchase')",
    periods_sql(60, 25),
    "sd as (select ts as lo, case when event_id % 4 = 0 then ts else ts + interval '30 minutes' end as hi from events where event_type = 'error' and value > 120)",
    grid_sql("gg", ["gps0"], "300 seconds"),
    asof_sql("gr", "gg", "gps0", "450 seconds", "l.*", [("latitude", "latitude"), ("longitude", "longitude")]),
    asof_sql("gf", "gr", "trk", "450 seconds", "l.*", [("latitude", "la"), ("longitude", "lo")]),
    """gps as (select datetime_utc, coalesce(latitude, la) as latitude, coalesce(longitude, lo) as longitude,
         case when latitude is null then 'gpx' else 'gps' end as source from gf)""",
    grid_sql("tg", ["tsg0"], "600 seconds"),
    asof_sql("tr", "tg", "tsg0", "450 seconds", "l.*", [("temperature", "temperature"), ("cond", "cond"), ("salinity", "salinity")]),
    asof_sql("tf", "tr", "ship", "750 seconds", "l.*", [("temperature", "te"), ("cond", "co"), ("salinity", "sa")]),
    """tsg as (select *, 2 as temperature_flag, case when salinity < 30 then 4 else 2 end as salinity_flag from
         (select datetime_utc, coalesce(temperature, te) as temperature, coalesce(cond, co) as cond, coalesce(salinity, sa) as salinity,
          case when temperature is null then 'ship' else 'uw' end as source from tf))""",
    """ph as (select datetime_utc, vrse, ph_total, case when exists (select 1 from iv where lo <= datetime_utc and datetime_utc <= hi) then 4
         when ph_total > 9 then 4 else 2 end as ph_flag from ph0)""",
]
_S = "600 seconds"
COMBINE = [
    grid_sql("cg", ["gps", "tsg", "ph", "rho", "oxy"], _S),
    asof_sql("c1", "cg", "gps", _S, "l.*", [("latitude", "latitude"), ("longitude", "longitude")]),
    asof_sql("c2", "c1", "tsg", _S, "l.*", [(c, c) for c in ("temperature", "temperature_flag", "salinity", "salinity_flag")]),
    asof_sql("c3", "c2", "ph", _S, "l.*", [("vrse", "vrse"), ("ph_flag", "ph_flag")]),
    asof_sql("c4", "c3", "rho", _S, "l.*", [("rho_ppb", "rho_ppb"), ("rho_flag", "rho_flag")]),
    asof_sql("c5", "c4", "oxy", _S, "l.*", [("oxygen_umol_kg", "oxygen_umol_kg")]),
    f"comb as (select *, {ph_sql('vrse', 'temperature', 'salinity', -1.3944286, -0.00107)} as ph_corrected from c5)",
    """prod as (select datetime_utc, latitude, longitude, temperature, salinity, vrse, rho_ppb, oxygen_umol_kg, ph_corrected,
         case when temperature is null then null when bad then 4 else temperature_flag end as temperature_flag,
         case when salinity is null then null when bad then 4 else salinity_flag end as salinity_flag,
         case when ph_corrected is null then null when bad then 4 else ph_flag end as ph_flag,
         case when rho_ppb is null then null when bad then 4 else rho_flag end as rho_flag
       from (select *, exists (select 1 from sd where lo < datetime_utc and datetime_utc < hi) as bad from comb))""",
]
_PRODUCT = """select datetime_utc, round(latitude, 6) as latitude, round(longitude, 6) as longitude, round(temperature, 6) as temperature,
  temperature_flag, round(salinity, 6) as salinity, salinity_flag, round(vrse, 6) as vrse, ph_flag, rho_ppb, rho_flag,
  round(oxygen_umol_kg, 6) as oxygen_umol_kg, round(ph_corrected, 6) as ph_corrected from """
_PRODUCT_REAL = ["latitude", "longitude", "temperature", "salinity", "vrse", "oxygen_umol_kg", "ph_corrected"]


@query(with_sql(*CRUISE, final="select datetime_utc, round(latitude, 6) as latitude, round(longitude, 6) as longitude, source from gps"))
def patch_gps(spark, d):
    c = cruise(spark, d)
    out = plans.patch_gps(c["gps"], c["track"], SCALE, 46 * SCALE, 1.5 * SCALE)
    return rounded(out, "latitude", "longitude")


@query(
    with_sql(
        *CRUISE,
        final="""select datetime_utc, round(temperature, 6) as temperature, round(cond, 6) as cond, round(salinity, 6) as salinity, source,
                 temperature_flag, salinity_flag from tsg""",
    ),
    flags="temperature_flag salinity_flag",
)
def patch_tsg(spark, d):
    c = cruise(spark, d)
    out = plans.patch_tsg(c["tsg"], c["log_rows"], 2 * SCALE, 2.5 * SCALE, 1.5 * SCALE)
    return rounded(out, "temperature", "cond", "salinity")


@query(with_sql(*CRUISE, final="select datetime_utc, round(vrse, 6) as vrse, round(ph_total, 6) as ph_total, ph_flag from ph"), flags="ph_flag")
def flag_ph(spark, d):
    c = cruise(spark, d)
    return rounded(plans.flag_ph(c["ph"].drop("timestamp"), c["ph_intervals"]), "vrse", "ph_total")


@query(with_sql(*CRUISE, *COMBINE, final=_PRODUCT + "prod"), flags="temperature_flag salinity_flag ph_flag rho_flag")
def process_underway(spark, d):
    product = plans.process_underway(
        **cruise(spark, d), interval=2 * SCALE, scale=SCALE, feed_dir=new_shared_path(spark, "feeds")
    )
    return rounded(product["combined"], *_PRODUCT_REAL)


def cruise_by_vessel_sql(final: str, *more: str) -> str:
    """A result of the cruise for each vessel by itself, as if there were no others."""
    whole = with_sql(*CRUISE, *more, final=final)
    return by_vessel_sql(lambda source: whole.replace("from events", f"from {source}"))


@query(
    cruise_by_vessel_sql("select datetime_utc, round(latitude, 6) as latitude, round(longitude, 6) as longitude, source from gps")
)
def patch_gps_by_key(spark, d):
    c = cruise(spark, d, keyed=True)
    out = plans.patch_gps(c["gps"], c["track"], SCALE, 46 * SCALE, 1.5 * SCALE, keys=["vessel"])
    return rounded(out, "latitude", "longitude")


@query(cruise_by_vessel_sql(_PRODUCT + "prod", *COMBINE), flags="temperature_flag salinity_flag ph_flag rho_flag")
def process_underway_by_key(spark, d):
    """The products of several vessels in one job."""
    product = plans.process_underway(
        **cruise(spark, d, keyed=True), interval=2 * SCALE, scale=SCALE, feed_dir=new_shared_path(spark, "feeds"), keys=["vessel"]
    )
    return rounded(product["combined"], *_PRODUCT_REAL)


def _validation_sql() -> str:
    from tidelane.operators.validate import RULES

    rows = []
    for name, source in {"gps": "gps", "tsg": "tsg", "ph": "ph", "rho": "rho", "oxygen": "oxy"}.items():
        rules = RULES[name]
        entry = "select '{0}' as feed, '{1}' as rule, '{2}' as \"column\", '{3}' as severity, {4} as violations, {5} as passed from {6}".format
        rows += [entry(name, "required", c, "error", "0", "true", "(select 1)") for c in [TS, *rules.ranges]]
        for c, (lo, hi) in rules.ranges.items():
            rows.append(entry(name, "type", c, "error", "0", "true", "(select 1)"))
            bad, strict = f"count(*) filter ({c} < {lo} or {c} > {hi})", c in rules.strict
            rows.append(entry(name, "range", c, "error" if strict else "warning", bad, f"{bad} = 0" if strict else "true", source))
    return with_sql(*CRUISE, final=" union all ".join(rows))


@query(_validation_sql(), violations="bigint")
def process_validation(spark, d):
    """The checks that come with the whole product."""
    return plans.process_underway(
        **cruise(spark, d), interval=2 * SCALE, scale=SCALE, feed_dir=new_shared_path(spark, "feeds")
    )["validation"]


@query(
    with_sql(
        *CRUISE, *COMBINE, f"p as ({_PRODUCT}prod)",
        final="""select 'parquet' as origin, * from p
                 union all select 'csv', * replace (date_trunc('second', datetime_utc) as datetime_utc) from p""",
    ),
    flags="temperature_flag salinity_flag ph_flag rho_flag",
)
def process_outputs(spark, d):
    """The whole product as it stands in its files."""
    path = new_shared_path(spark, "product")
    outputs = {"parquet_path": f"{path}/product.parquet", "csv_path": f"{path}/product.csv"}
    plans.process_underway(
        **cruise(spark, d), interval=2 * SCALE, scale=SCALE, feed_dir=new_shared_path(spark, "feeds"), outputs=outputs
    )
    kept = src.read_parquet_series(spark, outputs["parquet_path"])
    text = spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").schema(kept.schema).csv(
        outputs["csv_path"])
    both = kept.withColumn("origin", F.lit("parquet")).unionByName(text.withColumn("origin", F.lit("csv")))
    return rounded(both, *_PRODUCT_REAL)


@query(with_sql(*CRUISE, *COMBINE, final=_PRODUCT + "comb"), flags="temperature_flag salinity_flag ph_flag rho_flag")
def combine_underway(spark, d):
    c = cruise(spark, d)
    feeds = plans.prepare_feeds(**{n: df for n, df in c.items() if n != "shutdowns"}, scale=SCALE)
    return rounded(plans.combine_underway(feeds, -1.3944286, -0.0010700, 2 * SCALE, 2 * SCALE), *_PRODUCT_REAL)


@query(
    with_sql(
        *CRUISE,
        final="""select time_bucket(interval '30 minutes', datetime_utc) as datetime_utc, min(datetime_utc) as datetime_utc_first,
                 round(avg(vrse), 6) as vrse, round(avg(ph_total), 6) as ph_total, max(cast(ph_flag as varchar)) as ph_flag from ph group by 1""",
    )
)
def flagged_minute_means(spark, d):
    c = cruise(spark, d)
    return rounded(plans.flagged_minute_means(c["ph"], c["ph_intervals"], "30m"), "vrse", "ph_total")


_MEANS = ["latitude", "longitude", "temperature", "salinity", "vrse", "rho_ppb", "oxygen_umol_kg", "ph_corrected"]


def _means_sql(where: str, extra: str = "") -> str:
    cols = ", ".join(f"round(avg({c}), {9 if c == 'vrse' else 6}) as {c}" for c in _MEANS)
    return f"select time_bucket(interval '50 minutes', datetime_utc, timestamp '1970-01-01') as datetime_utc, {cols}{extra} from prod {where} group by 1"


def _rounded_means(df: DataFrame, *cols: str) -> DataFrame:
    """Voltages differ in the seventh digit, so their means are compared to nine."""
    return df.withColumns({c: F.round(c, 9 if c == "vrse" else 6) for c in cols})


def _product(spark, d):
    made = plans.process_underway(
        **cruise(spark, d), interval=2 * SCALE, scale=SCALE, feed_dir=new_shared_path(spark, "feeds")
    )
    return made["combined"]


@query(
    with_sql(
        *CRUISE, *COMBINE,
        final=_means_sql("where temperature_flag not in (3, 4) and salinity_flag not in (3, 4) and ph_flag not in (3, 4) and rho_flag not in (3, 4)", ", round(avg(ph_flag), 6) as ph_flag"),
    )
)
def clean_means(spark, d):
    clean, _ = plans.clean_and_raw_means(_product(spark, d), 10 * SCALE)
    return _rounded_means(clean.select(TS, *_MEANS, "ph_flag"), *_MEANS, "ph_flag")


@query(with_sql(*CRUISE, *COMBINE, final=_means_sql("")))
def raw_means(spark, d):
    _, raw = plans.clean_and_raw_means(_product(spark, d), 10 * SCALE)
    return _rounded_means(raw.select(TS, *_MEANS), *_MEANS)


AUDIT_COLUMNS = ["datetime_utc", "event_id", "temperature", "salinity", "conductivity", "latitude", "longitude"]
AUDITED = """audited as (select ts as datetime_utc, event_id, value / 20 as temperature, 25 + value / 40 as salinity,
  value / 10 as conductivity, 41 + value / 100 as latitude, -user_id / 10.0::double as longitude from {source})"""


def long_sql(check: str, item: str, metrics: dict[str, str], source: str) -> str:
    entries = ", ".join(f"{{'m': '{m}', 'v': cast({e} as double)}}" for m, e in metrics.items())
    return f"select '{check}' as \"check\", {item} as item, unnest([{entries}]) as e from {source}"


def audit_sql(source: str = "events", median: str = "median(s)", digits: int = 6) -> str:
    from tidelane.operators.validate import PRODUCT_RANGES

    same = lambda *names: {n: n for n in names}
    jump = """(select sqrt(pow(latitude - lag(latitude) over (order by datetime_utc), 2)
      + pow(longitude - lag(longitude) over (order by datetime_utc), 2)) * 111 as km from audited)"""
    parts = [
        long_sql("missing", f"'{c}'", {"missing": f"count(*) - count({c})", "percent": f"100.0 * (count(*) - count({c})) / count(*)"}, "audited")
        for c in AUDIT_COLUMNS
    ]
    parts.append(
        long_sql("non_monotonic", "null", {"rows": "count(*)"},
                 "(select datetime_utc as t, lag(datetime_utc) over (order by event_id) as p from audited) where t < p")
    )
    regular = ["rows", "intervals", "mean_s", "median_s", "std_s", "min_s", "max_s", "duplicates", "irregular", "irregular_pct"]
    parts.append(long_sql("regularity", "null", same(*regular), f"({regularity_sql('datetime_utc', 'audited', median, digits)})"))
    for c in AUDIT_COLUMNS:
        if c in PRODUCT_RANGES:
            lo, hi = PRODUCT_RANGES[c]
            bad = f"count(*) filter ({c} < {lo} or {c} > {hi})"
            parts.append(
                long_sql("ranges", f"'{c}'", {"lo": str(lo), "hi": str(hi), "out_of_range": bad, "min_value": f"min({c})", "max_value": f"max({c})"}, "audited")
            )
    pearson = "corr(salinity, conductivity)"
    parts.append(long_sql("correlation", "null", {"n": "count(*)", "correlation": pearson, "low": f"{pearson} < 0.5"}, "audited where temperature is not null"))
    parts.append(long_sql("jumps", "null", {"jumps": "count(*)"}, f"{jump} where km > 10"))
    for c in AUDIT_COLUMNS[1:]:
        rolled = f"""(select {c} as x, avg({c}) over w as m, stddev_samp({c}) over w as s from audited
          window w as (order by datetime_utc rows between 2 preceding and 2 following))"""
        odd = "count(*) filter (abs(x - m) > 1.5 * nullif(s, 0))"
        parts.append(long_sql("outliers", f"'{c}'", {"outliers": odd, "percent": f"100.0 * {odd} / count(*)"}, rolled))
    complete = ["time_range_s", "median_s", "expected_points", "actual_points", "completeness_pct", "large_gaps"]
    parts.append(long_sql("completeness", "null", same(*complete), f"({completeness_sql('datetime_utc', 'audited', median, digits)})"))
    blanks = " + ".join(f"(count(*) - count({c}))" for c in AUDIT_COLUMNS)
    n = len(AUDIT_COLUMNS)
    distinct = "(select count(*) from (select distinct * from audited))"
    parts.append(
        long_sql("quality", "null", {
            "rows": "count(*)", "total_cells": f"{n} * count(*)", "missing_cells": blanks, "duplicate_rows": f"count(*) - {distinct}",
            "completeness": f"100.0 * ({n} * count(*) - ({blanks})) / ({n} * count(*))", "uniqueness": f"100.0 * {distinct} / count(*)",
        }, "audited")
    )
    every = " union all ".join(f"select * from ({p})" for p in parts)
    return f'with {AUDITED.format(source=source)} select "check", item, e.m as metric, round(e.v, 5) as value from ({every})'


def audited(df: DataFrame) -> DataFrame:
    value, own = F.col("value"), [c for c in ("vessel",) if c in df.columns]
    return df.select(
        *own, TS, "event_id", (value / 20).alias("temperature"), (F.lit(25) + value / 40).alias("salinity"),
        (value / 10).alias("conductivity"), (F.lit(41) + value / 100).alias("latitude"), (-F.col("user_id") / 10.0).alias("longitude"),
    )


@query(audit_sql())
def audit_series(spark, d):
    out = op.collect_audit(op.audit_series(audited(events(spark, d)), TS, arrival="event_id", k=1.5))
    return out.withColumn("value", F.round("value", 5))


@query("select * from (" + by_vessel_sql(lambda source: audit_sql(source, EXACT_MEDIAN, 12)) + """) where not ("check" in ('non_monotonic', 'jumps') and value = 0)""")
def audit_by_key(spark, d):
    """The audit of each vessel's series; counts of rows found are given where there are some."""
    reports = op.audit_series(audited(vessels(events(spark, d))), TS, arrival="event_id", k=1.5, keys=["vessel"])
    return op.collect_audit(reports, ["vessel"]).withColumn("value", F.round("value", 5))
