"""Degradation / recovery alerts with hysteresis.

State per series, in (time, id) order:
  value < low             -> signal D: alert visible, "degraded"
  value >= high           -> signal R: if visible, "recovering"; hidden ``hold``
                             seconds after the first R of the episode
  low <= value < high     -> no signal, state unchanged

Equivalent window form: ``ls`` = last signal so far, ``ep`` = number of D so
far, ``rec`` = first R time of the current episode. degraded iff ls = D;
recovering iff ls = R and ep > 0 and t < rec + hold; else normal.

Scale: a prefix scan over one key would order that key's whole history in one
task. Instead rows are cut into segments: (key, time chunk), and where a chunk has more than
``segment_rows`` rows, its seconds by their running count, and a second that alone has more its ids by quantiles. Windows run per
segment, and each segment receives a carry-in state (ls, ep, rec) computed from
a per-segment summary table that holds one row per segment. The result equals
the sequential loop exactly, whatever the segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import clamp, fixed2, is_number
from tidemark.operators.dashboard import id_cuts, id_part, latest_per_series

UNB = Window.unboundedPreceding
CUR = Window.currentRow


def segmented(df: DataFrame, key: str, t: str, id_col: str, chunk: int, segment_rows: int) -> DataFrame:
    """``df`` with its segment ``_c``, in the order of (t, id) within a key: the chunk of time, and in a chunk of more than
    ``segment_rows`` rows the part that the running count of its seconds gives, and in such a second one of 256 parts by id.
    """
    rows = df.withColumn("_b", F.floor(F.col(t) / F.lit(chunk)).cast("bigint"))
    seconds = rows.groupBy(F.col(key).alias("_sk"), F.col("_b").alias("_sb"), F.col(t).alias("_st")).agg(F.count(F.lit(1)).alias("_n"))
    by_chunk = Window.partitionBy("_sk", "_sb")  # at most ``chunk`` seconds
    seconds = seconds.withColumn("_all", F.sum("_n").over(by_chunk)).where(F.col("_all") > segment_rows)
    before = F.coalesce(F.sum("_n").over(by_chunk.orderBy("_st").rowsBetween(UNB, -1)), F.lit(0))
    # a new part where the running count passes a multiple, and an odd one of its own for a second that is too large
    seconds = seconds.withColumn("_p", 2 * F.floor(before / segment_rows) + F.when(F.col("_n") > segment_rows, 1).otherwise(0))
    busy = seconds.where(F.col("_n") > segment_rows).select(F.col("_sk").alias(key), F.col("_st").alias(t))
    cuts = id_cuts(df, busy, [key, t], id_col, 256)
    dense = seconds.join(cuts, F.col("_sk").eqNullSafe(F.col(f"_{key}")) & F.col("_st").eqNullSafe(F.col(f"_{t}")), "left").select("_sk", "_st", "_p", "_cuts")
    rows = rows.join(dense, F.col(key).eqNullSafe(F.col("_sk")) & F.col(t).eqNullSafe(F.col("_st")), "left")
    part = id_part("_cuts", id_col)
    segment = F.struct(F.col("_b").alias("chunk"), F.coalesce("_p", F.lit(0)).alias("part"), part.alias("ids"))
    return rows.select(*df.columns, segment.alias("_c"))


def alert_states(
    df: DataFrame,
    key: str = "k",
    t: str = "sec",
    value: str = "q",
    id_col: str = "id",
    low: float = 2.5,
    high: float = 3.0,
    hold: int = 3,
    chunk: int = 60,
    segment_rows: int = 100_000,
) -> DataFrame:
    """Per-row alert state; ``t`` is a numeric time in seconds (bigint)."""
    v = F.col(value)
    # a value that is no number gives no signal (Spark would order NaN above all)
    sig = F.when(is_number(v) & (v < F.lit(low)), F.lit("D")).when(is_number(v) & (v >= F.lit(high)), F.lit("R"))
    s = segmented(df.select(id_col, key, t, value).withColumn("_sig", sig), key, t, id_col, int(chunk), int(segment_rows))

    # 1) local scan inside each (key, chunk) segment
    seg = Window.partitionBy(key, "_c").orderBy(t, id_col).rowsBetween(UNB, CUR)
    s = s.withColumn("_ls", F.last("_sig", ignorenulls=True).over(seg)).withColumn(
        "_lep", F.sum(F.when(F.col("_sig") == "D", 1).otherwise(0)).over(seg).cast("bigint")
    )
    seg_ep = Window.partitionBy(key, "_c", "_lep").orderBy(t, id_col).rowsBetween(UNB, CUR)
    s = s.withColumn("_lrec", F.min(F.when(F.col("_sig") == "R", F.col(t))).over(seg_ep))

    # 2) one summary row per segment: its state at the last row
    last = F.max_by(F.struct("_ls", "_lep", "_lrec"), F.struct(t, id_col))
    summ = s.groupBy(key, "_c").agg(last.alias("_e")).select(
        key, "_c", F.col("_e._ls").alias("ls_c"), F.col("_e._lep").alias("nd_c"), F.col("_e._lrec").alias("rec_c")
    )

    # 3) carry-in state per segment from the segments before it
    by_key = Window.partitionBy(key).orderBy("_c")
    before = by_key.rowsBetween(UNB, -1)
    summ = summ.withColumn("ls_in", F.last("ls_c", ignorenulls=True).over(before)).withColumn(
        "ep_in", F.coalesce(F.sum("nd_c").over(before), F.lit(0)).cast("bigint")
    )
    # episode id at the end of each segment; rec at the end = min rec over the
    # segments of that episode up to this one
    summ = summ.withColumn("_gep", F.col("ep_in") + F.col("nd_c"))
    ep_w = Window.partitionBy(key, "_gep").orderBy("_c").rowsBetween(UNB, CUR)
    summ = summ.withColumn("_rec_end", F.min("rec_c").over(ep_w))
    summ = summ.withColumn("rec_in", F.lag("_rec_end", 1).over(by_key)).select(key, "_c", "ls_in", "ep_in", "rec_in")

    # 4) combine carry-in with the local scan
    # null-safe: rows without a key are a series of their own, rows without a time its first segment
    carry = summ.select(F.col(key).alias("_key"), F.col("_c").alias("_chunk"), "ls_in", "ep_in", "rec_in")
    j = s.join(carry, F.col(key).eqNullSafe(F.col("_key")) & F.col("_c").eqNullSafe(F.col("_chunk")), "left")
    ls = F.coalesce(F.col("_ls"), F.col("ls_in"))
    ep = F.col("ep_in") + F.col("_lep")
    rec = F.when(F.col("_lep") > 0, F.col("_lrec")).otherwise(F.least(F.col("rec_in"), F.col("_lrec")))
    state = (
        F.when(ls == "D", F.lit("degraded"))
        .when((ls == "R") & (ep > 0) & (F.col(t) < rec + F.lit(int(hold))), F.lit("recovering"))
        .otherwise(F.lit("normal"))
    )
    return j.select(id_col, key, t, value, F.col("_sig").alias("signal"), state.alias("state"))


def latest_by_second(points: DataFrame, ts: str = "ingestion_timestamp", value: str = "predicted_qoe", id_col: str = "id") -> DataFrame:
    """The feed of a dashboard's one alert: the last value of every second, clamped to the chart's range, as (id, k, sec, q) with one series 0.

    A partial aggregate for each second, so the busiest second comes to a task as one row of each task before it.
    """
    latest = latest_per_series(points.where(F.col(ts).isNotNull()).withColumn("sec", F.unix_seconds(F.col(ts).cast("timestamp"))), "sec", value, ts, id_col)
    return latest.select(F.col("latest_id").alias("id"), F.lit(0).cast("bigint").alias("k"), "sec", clamp(F.col(value)).alias("q"))


# Alert texts of the dashboard.
DEGRADED_TITLE = "QoE Degradation Detected"
RECOVERED_TITLE = "QoE Recovered"


def alert_messages(states: DataFrame, value: str = "q", poor_cut: float = 2.0, excellent_cut: float = 4.0) -> DataFrame:
    """The alert text at every row that updates the alert: each D row, and
    each R row while the alert is still shown (state recovering).
    """
    v = F.col(value)
    is_deg = F.col("signal") == "D"
    is_rec = (F.col("signal") == "R") & (F.col("state") == "recovering")
    level = F.when(is_deg, F.when(v < F.lit(poor_cut), "Poor").otherwise("Fair")).otherwise(
        F.when(v >= F.lit(excellent_cut), "Excellent").otherwise("Good")
    )
    desc = F.when(is_deg, F.concat(F.lit("Quality has dropped to "), level, F.lit(" level"))).otherwise(
        F.concat(F.lit("Quality has improved to "), level, F.lit(" level"))
    )
    return states.filter(is_deg | is_rec).select(
        *[c for c in states.columns if c not in ("signal",)],
        F.when(is_deg, F.lit(DEGRADED_TITLE)).otherwise(F.lit(RECOVERED_TITLE)).alias("title"),
        desc.alias("description"),
        fixed2(v).alias("value_text"),
    )


def alert_states_loop(rows, low: float = 2.5, high: float = 3.0, hold: int = 3) -> dict:
    """Sequential reference of ``alert_states`` for tests: rows are
    (id, key, t, value); returns {id: state}."""
    out = {}
    st = {}
    for rid, k, t, v in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        visible, rec = st.get(k, (False, None))
        if v < low:
            visible, rec, state = True, None, "degraded"
        elif v >= high and visible:
            if rec is None:
                rec = t
            if t < rec + hold:
                state = "recovering"
            else:
                visible, rec, state = False, None, "normal"
        else:
            if visible and rec is not None and t >= rec + hold:
                visible, rec = False, None
            state = "normal" if not visible else ("degraded" if rec is None else "recovering")
        st[k] = (visible, rec)
        out[rid] = state
    return out
