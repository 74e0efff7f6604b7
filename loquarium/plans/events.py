"""Intervals, durations, speech activity and range joins over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from loquarium.operators import filters, intervals, stats, vad
from loquarium.plans.tables import SPAN_SQL, spans, table

_VALUE = "(select event_id, user_id, event_type, value from events)"


def _timed(spark, d):
    return table(spark, d, "events").select("event_id", F.lit(0.0).alias("start"), F.col("value").alias("end"))


def _duration(bounds):
    return lambda spark, d: table(spark, d, "events").where(filters.within(F.col("value"), 2.0, 30.0, bounds)).select("event_id", "value")


def duration_rejects(spark, d):
    t = _timed(spark, d).withColumn("reason", filters.duration_reason(F.col("start"), F.col("end"), 2.0, 30.0))
    return filters.split(t)[1].select("event_id", "reason")


def drops_by_reason(spark, d):
    t = _timed(spark, d).withColumn("reason", filters.duration_reason(F.col("start"), F.col("end"), 2.0, 30.0))
    return t.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def interval_islands(spark, d):
    return intervals.islands(spans(spark, d), ["user_id"])


ISLANDS = f"""{SPAN_SQL}, m as (select *, max(e) over (partition by user_id order by s, e rows between unbounded preceding and 1 preceding) p from iv),
n as (select *, sum(case when p is null or s > p then 1 else 0 end) over (partition by user_id order by s, e rows unbounded preceding) g from m),
isl as (select user_id, min(s) s, max(e) e from n group by user_id, g)"""


def interval_islands_adjacent(spark, d):
    return intervals.islands_adjacent(spans(spark, d), ["user_id"]).groupBy("user_id").agg(F.count("*").alias("n"), F.sum("s").alias("s"), F.sum("e").alias("e"))


ADJACENT_SQL = f"""with {SPAN_SQL}, m as (select *, lag(e) over (partition by user_id order by s, e) p from iv),
n as (select *, sum(case when p is null or s > p then 1 else 0 end) over (partition by user_id order by s, e rows unbounded preceding) g from m),
x as (select user_id, g, min(s) s, arg_max(e, s * 10000000 + e - 17000000000) e from n group by user_id, g) select user_id, count(*) n, cast(sum(s) as bigint) s, cast(sum(e) as bigint) e from x group by user_id"""


def interval_overlaps(spark, d):
    return intervals.overlaps(spans(spark, d), ["user_id"])


OVERLAPS_SQL = f"with {SPAN_SQL}, m as (select *, max(e) over (partition by user_id order by s, e rows between unbounded preceding and 1 preceding) p from iv) select user_id, s, least(p, e) e from m where p > s"


def interval_gaps(spark, d):
    return intervals.gaps(spans(spark, d), ["user_id"])


GAPS_SQL = f"with {ISLANDS}, g as (select user_id, lag(e) over (partition by user_id order by s) s, s e from isl) select * from g where s < e"


def clip_to_window(spark, d):
    return intervals.clip(spans(spark, d).select("event_id", "s", "e"), F.lit(1704100000), F.lit(1704200000))


CLIP_SQL = f"with {SPAN_SQL} select event_id, greatest(s, 1704100000) s, least(e, 1704200000) e from iv where e > 1704100000 and s < 1704200000"


def short_gap_fill(spark, d):
    return intervals.fill_short_gaps(spans(spark, d), ["user_id"], 600, 30)


FILL_SQL = f"""with {ISLANDS}, l as (select * from isl where e - s >= 30), m2 as (select *, lag(e) over (partition by user_id order by s) p from l),
n2 as (select *, sum(case when p is null or s - p >= 600 then 1 else 0 end) over (partition by user_id order by s rows unbounded preceding) g from m2)
select user_id, min(s) s, max(e) e from n2 group by user_id, g"""


def same_label_runs(spark, d):
    r = intervals.runs(spans(spark, d), ["user_id"], ["s", "event_id"], "event_type")
    return r.groupBy("user_id", "run").agg(F.min("event_type").alias("event_type"), F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"))


RUNS_SQL = f"""with {SPAN_SQL}, m as (select *, case when lag(event_type) over w is distinct from event_type then 1 else 0 end x from iv window w as (partition by user_id order by s, event_id)),
n as (select *, sum(x) over (partition by user_id order by s, event_id rows unbounded preceding) run from m) select user_id, cast(run as bigint) run, min(event_type) event_type, min(s) s, max(e) e, count(*) n from n group by user_id, run"""


def frame_labels(spark, d):
    """Seconds since an hour began as frames of 10 s for each user and hour: frames that any event covers."""
    s = spans(spark, d).select("user_id", (F.col("s") - 1704067200).alias("t"), "e", "s").withColumn("hour", F.expr("t div 3600"))
    s = s.select("user_id", "hour", (F.col("t") % 3600).alias("s"), (F.col("t") % 3600 + F.col("e") - F.col("s")).alias("e"))
    clipped = s.withColumn("e", F.least("e", F.lit(3600)))
    return intervals.frame_labels(clipped, ["user_id", "hour"], F.lit(3600), 10).groupBy("user_id", "hour").agg(F.sum("label").alias("on"), F.count("*").alias("frames"))


FRAMES_SQL = f"""with {SPAN_SQL}, t as (select user_id, (s - 1704067200) // 3600 as hr, (s - 1704067200) % 3600 a, least((s - 1704067200) % 3600 + e - s, 3600) b from iv),
f as (select distinct user_id, hr, unnest(range(a // 10, b // 10)) f from t) select user_id, hr as hour, (select count(*) from f where f.user_id = k.user_id and f.hr = k.hr) as "on", 360::bigint frames from (select distinct user_id, hr from t) k"""


def range_join_points(spark, d):
    """Errors that happen within another event's span of the same user."""
    s = spans(spark, d)
    p = s.where("event_type = 'error'").select("user_id", F.col("event_id").alias("point"), F.col("s").alias("at"))
    return intervals.range_join(p, s.select("user_id", "event_id", "s", "e"), ["user_id"], "at", "s", "e", 600).where("point <> event_id").select("point", "event_id")


RANGE_SQL = f"with {SPAN_SQL} select p.event_id point, i.event_id from iv p join iv i on p.user_id = i.user_id and p.s >= i.s and p.s < i.e and p.event_id <> i.event_id where p.event_type = 'error'"


def overlap_join(spark, d):
    s = spans(spark, d)
    a = s.where("event_type = 'click'").select("user_id", F.col("event_id").alias("a"), "s", "e")
    b = s.where("event_type = 'view'").select("user_id", F.col("event_id").alias("b"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    return intervals.overlap_join(a, b, ["user_id"], 600).select("a", "b", (F.col("oe") - F.col("os")).alias("shared"))


OVERLAP_JOIN_SQL = f"with {SPAN_SQL} select x.event_id a, y.event_id b, least(x.e, y.e) - greatest(x.s, y.s) shared from iv x join iv y on x.user_id = y.user_id and x.e > y.s and x.s < y.e and x.e > x.s and y.e > y.s where x.event_type = 'click' and y.event_type = 'view'"


def asof_event(spark, d):
    """Each purchase with the latest click of its user before or at it."""
    s = spans(spark, d)
    left = s.where("event_type = 'purchase'").select("user_id", "event_id", "s")
    right = s.where("event_type = 'click'").groupBy("user_id", "s").agg(F.max("event_id").alias("click"))
    return intervals.as_of(left, right, ["user_id"], "s", ["click"]).select("event_id", "click")


ASOF_SQL = f"""with {SPAN_SQL}, r as (select user_id, s, max(event_id) click from iv where event_type = 'click' group by all)
select l.event_id, r.click from iv l asof left join r on l.user_id = r.user_id and l.s >= r.s where l.event_type = 'purchase'"""


def subsegments_sliding(spark, d):
    t = table(spark, d, "documents").select("doc_id", (F.col("n_chars") / 100).alias("len"))
    return intervals.subsegments(t, F.lit(0.0), F.col("len"), 1.5, 0.75).select("doc_id", "sub", "s", F.round(F.col("dur") * 100).cast("long").alias("dur"))


SUB_SQL = """with t as (select doc_id, n_chars / 100::double len from documents), w as (select doc_id, len, unnest(range(0, case when len < 1.5 then 1 else cast(ceil((len - 1.5) / 0.75) as integer) + 1 end)) sub from t),
x as (select doc_id, sub, sub * 0.75::double s, least(1.5, len - sub * 0.75::double) dur from w) select doc_id, cast(sub as integer) sub, s, cast(round(dur * 100) as bigint) dur from x where dur > 0.05"""


def vad_split_manifest(spark, d):
    """Long documents in pieces of 50 with 0.63 before each piece but the first; the stream status of each piece."""
    t = table(spark, d, "documents").select("doc_id", (F.col("n_chars") / 100).alias("len"))
    t = t.withColumn("k", F.explode(F.sequence(F.lit(0), F.floor(F.col("len") / 50).cast("int")))).where("k * 50 < len")
    t = t.withColumns({"offset": F.greatest(F.col("k") * 50 - F.lit(0.625), F.lit(0.0)), "stop": F.least(F.col("k") * 50.0 + 50, "len")})
    return vad.stream_status(t, ["doc_id"], ["k"]).select("doc_id", "k", "offset", F.round((F.col("stop") - F.col("offset")) * 1000).cast("long").alias("ms"), "status")


SPLIT_SQL = """with t as (select doc_id, n_chars / 100::double len from documents), w as (select doc_id, len, unnest(range(0, cast(floor(len / 50) as integer) + 1)) k from t), x as (select * from w where k * 50 < len)
select doc_id, cast(k as integer) k, greatest(k * 50 - 0.625::double, 0) as "offset", cast(round((least(k * 50.0 + 50, len) - greatest(k * 50 - 0.625::double, 0)) * 1000) as bigint) ms,
case when n = 1 then 'single' when k = 0 then 'start' when k = n - 1 then 'end' else 'next' end status from (select *, count(*) over (partition by doc_id) n from x)"""


def vad_hysteresis(spark, d):
    e = spans(spark, d).select("user_id", "event_id", "s", "cents")
    return vad.hysteresis(e, ["user_id"], ["s", "event_id"], F.col("cents") / 100, 30.0, 5.0).select("event_id", "state")


HYST_SQL = f"""with {SPAN_SQL} select event_id, coalesce(last_value(case when cents > 3000 then 1 when cents < 500 then 0 end ignore nulls) over (partition by user_id order by s, event_id rows unbounded preceding), 0) state from iv"""


def _smoothed(how):
    def run(spark, d):
        e = spans(spark, d).select("user_id", "event_id", "s", "cents")
        return vad.smooth(e, ["user_id"], ["s", "event_id"], "cents", 2, 2, how).select("event_id", "smoothed")

    return run


def _smooth_sql(f):
    return f"with {SPAN_SQL} select event_id, cast({f}(cents) over (partition by user_id order by s, event_id rows between 2 preceding and 2 following) as double) smoothed from iv"


def vad_thresholds(spark, d):
    e = spans(spark, d).select("user_id", "cents")
    return vad.scaled_thresholds(e, ["user_id"], "cents", 0.5, 0.25).select("user_id", "onset", "offset")


def session_stats(spark, d):
    s = spans(spark, d).select("user_id", (F.col("s") - 1704067200).alias("s"), (F.col("e") - 1704067200).alias("e"))
    r = stats.session_report(s.withColumns({"s": F.col("s").cast("double"), "e": F.col("e").cast("double")}), "user_id")
    return r.select("user_id", "speech", "silence", "overlap")


SESSION_SQL = f"""with {ISLANDS}, a as (select user_id, sum(e - s) sp, max(e) - 1704067200 z from isl group by user_id),
o as (select user_id, sum(least(p, e) - s) ov from (select *, max(e) over (partition by user_id order by s, e rows between unbounded preceding and 1 preceding) p from iv) where p > s group by user_id)
select a.user_id, cast(sp as double) speech, cast(z - sp as double) silence, cast(coalesce(ov, 0) as double) overlap from a left join o using (user_id)"""


def overlapping_windows(spark, d):
    e = spans(spark, d).select("user_id", "s", "event_id", "cents")
    from pyspark.sql import Window

    f = e.withColumn("frame", F.row_number().over(Window.partitionBy("user_id").orderBy("s", "event_id")) - 1)
    return vad.overlapping_windows(f, ["user_id"], "frame", "cents", 4, 2, "mean").select("user_id", "t", "smoothed")


WINDOWS_SQL = f"""with {SPAN_SQL}, f as (select user_id, cents, row_number() over (partition by user_id order by s, event_id) - 1 f from iv), w as (select user_id, cents, unnest(range(f * 2, f * 2 + 4)) t from f)
select user_id, cast(t as integer) t, avg(cents) smoothed from w group by user_id, t"""


def event_sessions(spark, d):
    from loquarium.streaming import events as stream

    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return stream.sessions(e, "30 minutes").select("user_id", F.unix_micros("start").alias("start"), "n")


SESSIONS_SQL = """with m as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute then 0 else 1 end x from events),
g as (select *, sum(x) over (partition by user_id order by ts rows unbounded preceding) g from m) select user_id, epoch_us(min(ts)) start, count(*) n from g group by user_id, g"""


def event_windows(spark, d):
    from loquarium.streaming import events as stream

    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return stream.tumbling(e).select(F.unix_seconds("start").alias("start"), "event_type", "n")


QUERIES = {
    "duration_filter_open_closed": (_duration("(]"), "select event_id, value from events where value > 2 and value <= 30"),
    "duration_filter_closed": (_duration("[]"), "select event_id, value from events where value >= 2 and value <= 30"),
    "duration_filter_closed_open": (_duration("[)"), "select event_id, value from events where value >= 2 and value < 30"),
    "duration_rejects": (duration_rejects, "select event_id, case when value <= 2 then 'duration_below_minimum' else 'duration_above_maximum' end reason from events where not (value > 2 and value <= 30)"),
    "drops_by_reason": (drops_by_reason, "select case when value <= 2 then 'duration_below_minimum' else 'duration_above_maximum' end reason, count(*) n from events where not (value > 2 and value <= 30) group by 1"),
    "interval_islands": (interval_islands, f"with {ISLANDS} select user_id, s, e from isl"),
    "interval_islands_adjacent": (interval_islands_adjacent, ADJACENT_SQL),
    "interval_overlaps": (interval_overlaps, OVERLAPS_SQL),
    "interval_gaps": (interval_gaps, GAPS_SQL),
    "clip_to_window": (clip_to_window, CLIP_SQL),
    "short_gap_fill": (short_gap_fill, FILL_SQL),
    "same_label_runs": (same_label_runs, RUNS_SQL),
    "frame_labels": (frame_labels, FRAMES_SQL),
    "range_join_points": (range_join_points, RANGE_SQL),
    "overlap_join": (overlap_join, OVERLAP_JOIN_SQL),
    "asof_event": (asof_event, ASOF_SQL),
    "subsegments_sliding": (subsegments_sliding, SUB_SQL),
    "vad_split_manifest": (vad_split_manifest, SPLIT_SQL),
    "vad_hysteresis": (vad_hysteresis, HYST_SQL),
    "vad_smooth_mean": (_smoothed("mean"), _smooth_sql("avg")),
    "vad_smooth_median": (_smoothed("median"), _smooth_sql("median")),
    "vad_thresholds": (vad_thresholds, f"with {SPAN_SQL} select user_id, min(cents) + 0.5 * (max(cents) - min(cents)) onset, min(cents) + 0.25 * (max(cents) - min(cents)) as \"offset\" from iv group by user_id"),
    "session_stats": (session_stats, SESSION_SQL),
    "overlapping_windows": (overlapping_windows, WINDOWS_SQL),
    "event_sessions": (event_sessions, SESSIONS_SQL),
    "event_windows": (event_windows, "select cast(epoch(date_trunc('hour', ts)) as bigint) start, event_type, count(*) n from events group by all"),
}
