"""Weather stations: text-time parsing, sentinel nulls, the daily roll-up and
the hourly table joined to the gauges."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.functions.dates import ampm_timestamp
from pluvio.functions.nulls import exact_sum, null_tokens, round_half
from pluvio.operators.columns import containing
from pluvio.operators.quality import station_flag

# fixed values: sentinel texts the stations write for "no value"
STATION_SENTINELS = ("---", "------")
# fixed values: the fields both stations report, those only the second one has, and text fields
STATION_FIELDS = ("temp_out", "hi_temp", "low_temp", "wind_speed", "wind_dir", "hi_speed", "hi_dir", "bar",
                  "rain", "rain_rate")
SECOND_STATION_FIELDS = (*STATION_FIELDS, "hi_solar_rad", "uv_index")
STATION_TEXT = ("wind_dir", "hi_dir")


def parse_station(raw: DataFrame, measures: dict[str, str], prefix: str,
                  date_col: str = "x_date", time_col: str = "x_time",
                  shift_hours: int = 0, sentinels=STATION_SENTINELS, text=STATION_TEXT) -> DataFrame:
    """Station export -> (time_date, <prefix><name>...): whole-row duplicates
    removed, 12-hour text clock parsed (and shifted), sentinel texts made null and
    values read as numbers (``text`` columns stay text). ``measures`` maps source
    column -> published name."""
    x = raw.dropDuplicates()
    def read(src):
        v = null_tokens(F.col(src).cast("string"), sentinels)
        return v if src in text else v.try_cast("double")
    cols = [read(src).alias(prefix + dst) for src, dst in measures.items()]
    return x.select(ampm_timestamp(date_col, time_col, shift_hours).alias("time_date"), *cols)


def cut_after(df: DataFrame, ts: str, other: DataFrame, other_date: str) -> DataFrame:
    """Keep rows at or before the latest date of another table (a scalar subquery,
    so no job runs before the plan does). No latest date keeps nothing."""
    return df.filter(F.col(ts) <= other.select(F.max(other_date)).scalar())


def daily_weather(lead: DataFrame, other: DataFrame | None, ts: str = "time_date",
                  drop=(), digits: int = 2) -> DataFrame:
    """Hourly station rows -> one row per day. Rows of ``lead`` drive (``other``
    is left-joined by time). Columns whose name contains 'dir' are dropped; 'hi'
    columns take the day's max, 'low' the min, 'rain' the sum (0 when empty) and
    every other the mean; names match case-insensitively. One aggregation;
    sums (also those behind the means) are accumulated exactly (decimal), so the
    rounded figures do not depend on the order rows are added in."""
    w = lead if other is None else lead.join(other, on=ts, how="left")
    w = w.withColumn("date", F.to_date(ts)).drop(ts)
    w = w.drop(*containing(w, "dir"))
    hi = containing(w, "hi")
    low = [c for c in containing(w, "low") if c not in hi]
    rain = [c for c in containing(w, "rain") if c not in hi + low]
    mean = [c for c in w.columns if c not in {"date", *hi, *low, *rain}]
    aggs = ([F.max(c).alias(c) for c in hi] + [F.min(c).alias(c) for c in low]
            + [F.round(F.coalesce(exact_sum(c), F.lit(0)), digits).cast("double").alias(c) for c in rain]
            + [(exact_sum(c).cast("double") / F.count(c)).alias(c) for c in mean])
    d = w.groupBy("date").agg(*aggs).drop(*drop)
    return d.select("date", *[(F.col(c) if c in rain else round_half(c, digits)).alias(c)
                              for c in d.columns if c != "date"])


def hourly_weather(hourly_wide: DataFrame, lead: DataFrame | None, other: DataFrame | None,
                   start, end, lead_probe: str, other_probe: str,
                   ts: str = "time_date", lead_flag: str = "quality_lead",
                   other_flag: str = "quality_other") -> DataFrame:
    """Hourly gauge table left-joined to both stations on the exact hour, with
    a period flag per station (each station optional)."""
    h = hourly_wide
    for st, probe, flag in ((lead, lead_probe, lead_flag), (other, other_probe, other_flag)):
        if st is None:
            continue
        h = h.join(st.withColumnRenamed(ts, "datehour"), on="datehour", how="left")
        h = h.withColumn(flag, station_flag("datehour", probe, start, end))
    return h


def station_daily_flags(daily: DataFrame, start, end, probes: dict[str, str]) -> DataFrame:
    """Per day, the station period flag for each ``{flag_name: probe_column}``."""
    return daily.withColumns({f: station_flag("date", p, start, end) for f, p in probes.items()})
