"""Incremental ingestion state (I1-I5, K9, K10), one row per feed.

The reference keeps a single state row and plans one window per run; here
the state is a table with one row per feed (``state_id``) and planning,
advancing and window enumeration are column expressions over it, with the
current date passed in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import col_

# ---- fixed values (must equal the reference's behaviour) -------------------
BACKFILL_WINDOW_DAYS = 7
DAILY_CATCHUP_MAX_DAYS = 3
BACKFILL, DAILY = "backfill", "daily"
MISSING_DATES_ERROR = "Invalid ingestion state: missing backfill dates."
DEFAULT_BACKFILL_START = "2025-01-01"
# -----------------------------------------------------------------------------


def plan_runs(state: DataFrame, today: Column, backfill_days: int = BACKFILL_WINDOW_DAYS,
              catchup_days: int = DAILY_CATCHUP_MAX_DAYS) -> DataFrame:
    """Mode, window_start, window_end, mark_backfill_complete, error
    for every state row (``today`` is the UTC date of the run)."""
    yesterday = F.date_sub(today, 1)
    complete = F.coalesce(F.col("backfill_complete"), F.lit(False))
    start = F.coalesce(F.col("backfill_progress_cutoff"), F.col("backfill_start_date"))
    bf_end = F.col("backfill_end_date")
    missing = start.isNull() | bf_end.isNull()
    bf_done = start > bf_end
    bf_ws = F.when(~missing & ~bf_done, start)
    bf_we = F.when(~missing & ~bf_done, F.least(F.date_add(start, backfill_days - 1), bf_end))

    d_ws0 = F.when(F.col("last_daily_run_end").isNotNull(),
                   F.date_add(F.to_date(F.col("last_daily_run_end")), 1)).otherwise(yesterday)
    d_ok = d_ws0 <= yesterday
    d_ws = F.when(d_ok, d_ws0)
    d_we = F.when(d_ok, F.least(F.date_add(d_ws0, catchup_days - 1), yesterday))
    return state.select(
        "*",
        F.when(complete, F.lit(DAILY)).otherwise(F.lit(BACKFILL)).alias("mode"),
        F.when(complete, d_ws).otherwise(bf_ws).alias("window_start"),
        F.when(complete, d_we).otherwise(bf_we).alias("window_end"),
        (~complete & ~missing & bf_done).alias("mark_backfill_complete"),
        F.when(~complete & missing, F.lit(MISSING_DATES_ERROR)).alias("error"))


def backfill_advance(plans: DataFrame) -> DataFrame:
    """After a backfill window: cutoff = end + 1, complete when past
    the backfill end.  Mark-complete plans only set the flag."""
    done = plans.filter((F.col("mode") == BACKFILL) & F.col("window_end").isNotNull())
    adv = done.select("state_id", F.date_add("window_end", 1).alias("backfill_progress_cutoff"),
                      (F.date_add("window_end", 1) > F.col("backfill_end_date")).alias("backfill_complete"))
    mark = plans.filter("mark_backfill_complete").select(
        "state_id", F.lit(None).cast("date").alias("backfill_progress_cutoff"), F.lit(True).alias("backfill_complete"))
    return adv.unionByName(mark)


def daily_advance(plans: DataFrame, run_started_at: Column) -> DataFrame:
    """After a daily window: last end = window_end 23:59:59 UTC, last
    start = when the run started."""
    done = plans.filter((F.col("mode") == DAILY) & F.col("window_end").isNotNull())
    return done.select("state_id", run_started_at.alias("last_daily_run_start"),
                       (F.col("window_end").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(23), F.lit(59),
                                                                                   F.lit(59)))
                       .alias("last_daily_run_end"))


def enumerate_windows(state: DataFrame, days: int = BACKFILL_WINDOW_DAYS) -> DataFrame:
    """I4: every backfill window successive runs would plan, per feed."""
    start = F.coalesce(F.col("backfill_progress_cutoff"), F.col("backfill_start_date"))
    s = state.select("state_id", start.alias("_s"), F.col("backfill_end_date").alias("_e")) \
        .filter(F.col("_s") <= F.col("_e"))
    w = s.select("state_id", "_e", F.explode(F.sequence("_s", "_e", F.expr(f"INTERVAL {days} DAYS")))
                 .alias("window_start"))
    return w.select("state_id", "window_start",
                    F.least(F.date_add("window_start", days - 1), F.col("_e")).alias("window_end"))


def assign_windows(rows: DataFrame, state: DataFrame, key: str, ts: str,
                   days: int = BACKFILL_WINDOW_DAYS) -> DataFrame:
    """Each row's backfill window (equi-join on the feed key and
    arithmetic on dates - no range join), rows outside the backfill dropped."""
    s = state.select(F.col("state_id").alias(key), F.col("backfill_start_date").alias("_s"),
                     F.col("backfill_end_date").alias("_e"))
    j = rows.join(s, key)
    d = F.to_date(col_(ts))
    idx = F.floor(F.datediff(d, F.col("_s")) / days)
    ws = F.date_add(F.col("_s"), (idx * days).cast("int"))
    return j.filter((d >= F.col("_s")) & (d <= F.col("_e"))).select(
        rows.columns + [ws.alias("window_start"), F.least(F.date_add(ws, days - 1), F.col("_e")).alias("window_end")])


def window_counts(rows: DataFrame, state: DataFrame, key: str, ts: str, days: int = BACKFILL_WINDOW_DAYS,
                  count: str = "n") -> DataFrame:
    """I5 counts: rows per feed and backfill window.  Rows are counted per
    feed and day first (with a map-side step), so a feed with half of all rows
    meets its state row as one row per day."""
    daily = rows.groupBy(F.col(key), F.to_date(col_(ts)).alias("_day")).agg(F.count("*").alias("_n"))
    return (assign_windows(daily, state, key, "_day", days).groupBy(key, "window_start", "window_end")
            .agg(F.sum("_n").alias(count)))


def assign_to_windows(rows: DataFrame, windows: DataFrame, key: str, ts: str, bin_days: int = 7,
                      salts: int = 1) -> DataFrame:
    """Each row with every window (``window_start`` to ``window_end``, both
    included, of its ``key``) that holds its day; windows of any length, also
    overlapping ones.

    Windows are listed under each ``bin_days`` long bin that they touch, so the
    join is on (key, bin) and looks at few pairs beyond its result.  ``salts``
    deals the rows of one (key, bin) to that many tasks; the windows are
    repeated for each.
    """
    day = F.to_date(col_(ts))
    bin_of = lambda d: F.floor(F.unix_date(d) / F.lit(bin_days)).cast("int")
    w = (windows.where("window_start <= window_end").select(F.col(key).alias("_key"), "window_start", "window_end")
         .withColumn("_bin", F.explode(F.sequence(bin_of(F.col("window_start")), bin_of(F.col("window_end")))))
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns]), F.lit(salts)).cast("int")
    r = rows.withColumns({"_day": day, "_row_bin": bin_of(day), "_row_salt": salt})
    on = ((F.col(key) == F.col("_key")) & (F.col("_row_bin") == F.col("_bin")) & (F.col("_row_salt") == F.col("_salt"))
          & F.col("_day").between(F.col("window_start"), F.col("window_end")))
    return r.join(w, on).select(*rows.columns, "window_start", "window_end")


def seed_defaults(feeds: DataFrame, today: Column, start_date: str = DEFAULT_BACKFILL_START) -> DataFrame:
    """K10 defaults: a fresh state row per feed id."""
    s = F.lit(start_date).cast("date")
    return feeds.select(
        F.col("state_id"), s.alias("backfill_start_date"), today.alias("backfill_end_date"),
        s.alias("backfill_progress_cutoff"), F.lit(False).alias("backfill_complete"),
        F.lit(None).cast("timestamp").alias("last_daily_run_start"),
        F.lit(None).cast("timestamp").alias("last_daily_run_end"),
        F.lit(None).cast("string").alias("lock_owner"), F.lit(None).cast("timestamp").alias("lock_expires_at"),
        today.cast("timestamp").alias("updated_at"))
