"""SQL twins of the registered queries, for DuckDB over the same Parquet tables."""

from __future__ import annotations

from hazemill import domain

MEMBERS = ["east", "north", "south", "west"]
MORE_MEMBERS = ["centre", *MEMBERS]


def _case(parameter: str, field: str, quote: bool = False) -> str:
    rows = " ".join(
        f"when '{name}' then " + (f"'{getattr(spec, field)}'" if quote else str(getattr(spec, field)))
        for name, spec in domain.SPECS.items()
    )
    return f"(case {parameter} {rows} end)"


def code_sql(value: str) -> str:
    p = "parameter"
    return f"""case when {_case(p, 'high')} is null then 1
      when {value} is null or isnan({value}) or isinf({value}) or {value} < 0 then 2
      when {value} > {_case(p, 'high')} or {value} < {_case(p, 'low')} then 3
      when unit <> '' and unit <> {_case(p, 'unit', True)} then 4
      when not (latitude between -90 and 90 and longitude between -180 and 180) then 5
      else 0 end"""


def reason_sql(code: str) -> str:
    rows = " ".join(f"when {number} then '{text}'" for number, text in domain.REASONS.items())
    return f"case {code} {rows} else '{domain.UNKNOWN_REASON}' end"


def aqi_sql(p: str, c: str, close: bool = False) -> str:
    tables = []
    for name, bands in domain.AQI_BANDS.items():
        rows = []
        for band, after in zip(bands, bands[1:] + [None]):
            slope = f"(cast({band.i_high - band.i_low} as double) / (cast({band.c_high} as double) - cast({band.c_low} as double)))"
            rows.append(
                f"when {c} >= {band.c_low} and {c} <= {band.c_high} then "
                f"round({slope} * ({c} - cast({band.c_low} as double)) + {band.i_low})"
            )
            if close and after is not None:
                rows.append(f"when {c} > {band.c_high} and {c} < {after.c_low} then {band.i_high}")
        tables.append(f"when '{name}' then case {' '.join(rows)} else {bands[-1].i_high} end")
    return f"cast(case {p} {' '.join(tables)} else -1 end as integer)"


def category_sql(i: str) -> str:
    rows = " ".join(f"when {i} <= {upper} then '{name}'" for upper, name in domain.AQI_CATEGORIES)
    return f"case when {i} < 0 then 'Unknown' {rows} else 'Hazardous' end"


def exact(x: str, over: str = "") -> str:
    """Order-independent sum: units of 2^-70 as 128-bit integers, double for NaN and the like."""
    fits = f"isfinite({x}) and abs({x}) < 1e12"
    fixed = f"sum(case when {fits} then cast({x} * pow(2, 70) as hugeint) end) {over}"
    wide = f"sum(case when not ({fits}) then {x} end) {over}"
    return f"(coalesce(cast({fixed} as double) * pow(2, -70), 0) + coalesce({wide}, 0))"


def round2(x: str) -> str:
    return f"trunc({x} * 100 + 0.5) / 100"


READINGS = """
st as (select n_nationkey, n_name as city, r_name as country,
              cast(n_nationkey * 6 - 72 as double) as lat, cast(n_nationkey * 14 - 168 as double) as lon
       from nation join region on n_regionkey = r_regionkey),
e as (select event_id, ts, user_id, event_type, value,
             cast(json_extract_string(props, '$.k') as int) as k from events),
readings as (
  select concat('st-', cast(user_id % 25 as varchar)) as location_id, city as location, city, country,
    case when k = 97 then 'xx' when k % 6 = 5 then 'co' when event_type = 'click' then 'pm25'
         when event_type = 'view' then 'pm10' when event_type = 'purchase' then 'no2'
         when event_type = 'signup' then 'o3' else 'so2' end as parameter,
    case when k = 95 then value * 50 when k = 94 then -value
         when k = 93 then cast('NaN' as double) else value end as value,
    case when k = 98 then 'ppm' when k = 96 then '' when k % 6 = 5 and k <> 97 then 'mg/m³'
         else 'µg/m³' end as unit,
    case when k = 92 then 200.0 else lat end as latitude, lon as longitude,
    ts as timestamp, event_id, user_id, event_type
  from e join st on user_id % 25 = n_nationkey)"""

VALID = f"valid as (select * from readings where {code_sql('value')} = 0)"


def rolled(name: str, source: str, extra: str = "") -> str:
    """Daily aggregates of a source, the description taken from the earliest reading."""
    order = "struct_pack(timestamp, location, city, country, unit, latitude, longitude)"
    first = ", ".join(
        f"arg_min({c}, {order}) as {c}"
        for c in ("location", "city", "country", "unit", "latitude", "longitude")
    )
    return f"""
{name}_sums as (
  select location_id, parameter, time_bucket(interval '1 day', timestamp) as window_start, {first},
    count(*) as n, {exact('value')} as total, min(value) as low, max(value) as high
  from {source} group by location_id, parameter, time_bucket(interval '1 day', timestamp){extra}),
{name}_aqi as (select *, total / n as mean, {aqi_sql('parameter', '(total / n)')} as aqi from {name}_sums),
{name} as (
  select location_id, location, city, country, parameter, unit, latitude, longitude, window_start,
    window_start + interval '1 day' as window_end, n as "count", {round2('total')} as "sum",
    {round2('mean')} as "avg", low as "min", high as "max", aqi, {category_sql('aqi')} as aqi_category
  from {name}_aqi)"""


DAILY = f"{READINGS}, {VALID}, {rolled('daily', 'valid')}"
FEED = f"{READINGS}, {rolled('feed', 'readings', ', user_id')}"

_VERSION = """"count" desc nulls last, case when "avg" is null or isnan("avg") then 1e300 else "avg" end"""
_REST = (
    'location, city, country, unit, latitude, longitude, window_end, "count", "sum", "avg", '
    '"min", "max", aqi, aqi_category'
)
_ORDER = ", ".join(f"{c} nulls first" for c in _REST.split(", "))
UNIQUE = f"""{FEED},
uniq as (select * exclude (rn) from (
  select *, row_number() over (
    partition by location_id, parameter, window_start order by {_VERSION}, {_ORDER}) as rn
  from feed) where rn = 1)"""
CODED = f"""{UNIQUE},
coded as (select *, cast({code_sql('"avg"')} as integer) as code from uniq),
judged as (select *, code = 0 as valid, {reason_sql('code')} as reason from coded),
cleaned as (select * from judged where valid)"""

WATERMARK = "wm as (select max(timestamp) - interval '1 hour' as w from valid)"


def ranking(source: str) -> str:
    return f"""select location, city, country, round(avg(aqi), 1) as avg_aqi,
      round({exact('"avg"')} / count("avg"), 2) as avg_pm25, max("max") as peak_pm25, count(*) as windows
    from {source} where parameter = 'pm25' group by location, city, country
    order by avg_aqi desc, location, city, country limit 10"""


def series(source: str, keys: str) -> str:
    return f"""select {keys}, city, parameter, round({exact('"avg"')} / count("avg"), 2) as rolling_mean,
      round(avg(aqi), 1) as rolling_aqi, max("max") as peak, count(*) as windows
    from {source} group by {keys}, city, parameter"""


_BYTES = "list_transform(regexp_extract_all(hex(encode({text})), '(..)', 1), lambda x: cast(('0x' || x) as hugeint))"


def fnv(text: str, bits: int) -> str:
    offset, prime = {32: (2166136261, 16777619), 64: (14695981039346656037, 1099511628211)}[bits]
    step = f"(xor(a, b) * cast({prime} as hugeint)) % cast({2**bits} as hugeint)"
    return f"list_reduce({_BYTES.format(text=text)}, lambda a, b: {step}, cast({offset} as hugeint))"


def owner(station: str, members: list[str]) -> str:
    scores = ", ".join(
        f"struct_pack(s := {fnv(f"'{m}' || chr(0) || {station}", 64)}, o := {-i}, m := '{m}')"
        for i, m in enumerate(members)
    )
    return f"list_max([{scores}]).m"


STATIONS = f"""{READINGS},
stations as (
  select concat('oa-', cast(s_suppkey as varchar)) as location_id, s_name as location, city, country,
    lat as latitude, lon as longitude
  from supplier join st on s_nationkey = n_nationkey)"""

SLUGGED = f"""{STATIONS},
slugged as (select * replace (
  'st-' || lpad(lower(hex(cast({fnv("location", 32)} as ubigint))), 8, '0') as location_id) from stations)"""

LATEST = """
latest as (
  select concat('oa-', cast(user_id as varchar)) as location_id, parameter, value, unit,
    unnest([timestamp, cast(null as timestamp)]) as timestamp
  from readings)"""

_SLIDES = """
ticks as (select distinct unnest(generate_series(window_end, window_end + interval '3 days', interval '1 day')) as as_of
          from {source}),
spread as (select t.as_of, s.* from ticks t join {source} s
           on s.window_end between t.as_of - interval '3 days' and t.as_of)"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    def add(name: str, ctes: str, select: str) -> None:
        sql[name] = f"with {ctes}\n{select}"

    agg_columns = (
        "location_id, location, city, country, parameter, unit, latitude, longitude, window_start,"
        ' window_end, "count", "sum", "avg", "min", "max", aqi, aqi_category'
    )
    reading_columns = (
        "location_id, location, city, country, parameter, value, unit, latitude, longitude, timestamp"
    )
    verdict = f"""judged as (select {reading_columns}, event_id, user_id,
        cast({code_sql('value')} as integer) as code from readings)"""

    # Sources, sinks and payloads.
    add("read_aggregates", DAILY, f"select {agg_columns} from daily")
    add(
        "register_views",
        DAILY,
        """select city, parameter, count(*) as windows, max(aqi) as peak_aqi from daily
        group by city, parameter""",
    )
    add("to_messages", DAILY, f"select location_id as key, {agg_columns} from daily")
    add(
        "read_aggregate_stream",
        DAILY,
        f"select {agg_columns} from daily",
    )
    add(
        "fan_out",
        DAILY,
        f"select s as sink, {agg_columns} from daily, (values ('parquet'), ('messages')) t(s)",
    )
    add("flatten_locations", STATIONS, "select * from stations")
    add("flatten_latest", f"{READINGS}, {LATEST}", "select * from latest")
    add(
        "enrich_with_station",
        f"{STATIONS}, {LATEST}",
        """select location_id, location, city, country, parameter, value, unit, latitude, longitude,
          timestamp from latest join stations using (location_id)""",
    )

    # Validation and cleaning.
    add(
        "validate_frame",
        f"{READINGS}, {verdict}",
        f"select *, code = 0 as valid, {reason_sql('code')} as reason from judged",
    )
    add("only_valid", f"{READINGS}, {VALID}", f"select {reading_columns}, event_id, user_id from valid")
    add(
        "with_spec",
        READINGS,
        f"""select {reading_columns}, event_id, user_id, {_case('parameter', 'unit', True)} as expected_unit,
          cast({_case('parameter', 'low')} as double) as min_value,
          cast({_case('parameter', 'high')} as double) as max_value from readings""",
    )
    add(
        "with_spec_table",
        READINGS,
        f"""select event_id, parameter, limits.top as max_value,
          case when limits.top is null then 1 when isnan(value) or value < 0 then 2
               when value > limits.top then 3 when unit <> '' and unit <> limits.u then 4
               when not latitude between -90 and 90 then 5 else 0 end as code
        from readings left join (select parameter, max(unit) as u, 2 * ({exact('value')} / count(value)) as top from readings
          where parameter <> 'xx' and unit in ('µg/m³', 'mg/m³') and not isnan(value)
          group by parameter) limits using (parameter)""",
    )
    add(
        "quality_report",
        f"{READINGS}, {verdict}",
        f"""select code, {reason_sql('code')} as reason, count(*) as readings from judged
        group by code order by code""",
    )
    add(
        "collector_counters",
        f"{DAILY}, {verdict}",
        f"""select 'measurements_total' as counter, '' as label, count(*) as total from judged
        union all select 'invalid_total', {reason_sql('code')}, count(*) from judged
          where code <> 0 group by code
        union all select 'aggregates_total', '', count(*) from daily""",
    )
    add("dedup", UNIQUE, f"select {agg_columns} from uniq")
    add("clean", CODED, f"select {agg_columns}, code, valid, reason from cleaned")
    add(
        "clean_report",
        CODED,
        """select r as raw_rows, r - u as duplicate_rows, u - c as invalid_rows, r - c as dropped_rows,
          c as clean_rows
        from (select (select count(*) from feed) as r, count(*) as u, count(*) filter (where valid) as c from judged)""",
    )

    # Roll-up and reports.
    add("tumbling_aggregate", DAILY, f"select {agg_columns} from daily")
    add(
        "with_aqi",
        f"""{DAILY}, again as (select * replace ({aqi_sql('parameter', 'avg')} as aqi) from daily)""",
        f"select {agg_columns.replace('aqi_category', '')} {category_sql('aqi')} as aqi_category from again",
    )
    add("by_parameter", DAILY, f"select {agg_columns} from daily where parameter = 'pm25'")
    add("worst_stations", CODED, ranking("cleaned"))
    add("worst_stations_sql", FEED, ranking("feed"))
    add(
        "pollutant_summary",
        CODED,
        f"""select parameter, round({exact('"avg"')} / count("avg"), 2) as "mean", min("min") as "min",
          max("max") as "max", round({exact('"sum"')}, 1) as "sum", count(*) as "count"
        from cleaned group by parameter order by parameter""",
    )
    add(
        "aqi_category_breakdown",
        CODED,
        "select aqi_category, count(*) as windows from cleaned group by 1 order by 2 desc, 1",
    )
    add(
        "aqi_category_share",
        CODED,
        """select aqi_category, count(*) as windows,
          round(count(*) * 100.0::double / sum(count(*)) over (), 2) as share_percent
        from cleaned group by 1 order by 2 desc, 1""",
    )
    means = ", ".join(
        f"""coalesce({exact(f"case when parameter = '{p}' then avg end")}
          / nullif(count(case when parameter = '{p}' then avg end), 0), 0) as {p}"""
        for p in domain.PARAMETERS
    )
    add("city_pollutant_matrix", CODED, f"select city, {means} from cleaned group by city order by city")
    add(
        "pollutant_distribution",
        f"""{CODED},
        box as (select parameter, quantile_cont("avg", 0.25) as q1, quantile_cont("avg", 0.5) as median,
          quantile_cont("avg", 0.75) as q3 from cleaned group by parameter)""",
        """select c.parameter, count(*) as windows, round(min(c."avg"), 6) as "min",
          round(min(c."avg") filter (where c."avg" >= q1 - 1.5 * (q3 - q1)), 6) as whisker_low,
          round(any_value(q1), 6) as q1, round(any_value(median), 6) as median,
          round(any_value(q3), 6) as q3,
          round(max(c."avg") filter (where c."avg" <= q3 + 1.5 * (q3 - q1)), 6) as whisker_high,
          round(max(c."avg"), 6) as "max",
          count(*) filter (where c."avg" < q1 - 1.5 * (q3 - q1) or c."avg" > q3 + 1.5 * (q3 - q1)) as outliers
        from cleaned c join box b on c.parameter = b.parameter group by c.parameter order by 1""",
    )
    add(
        "aqi_timeseries",
        CODED,
        "select city, window_end, location_id, aqi from cleaned where parameter = 'pm25' order by 1, 2, 3",
    )
    add("distinct_values", CODED, "select distinct city, parameter from cleaned order by 1, 2")

    # The present state.
    newest = f"""newest as (select * from daily qualify row_number() over (
        partition by location_id, location, city, country, parameter order by window_end desc) = 1)"""
    add("latest_per_station", f"{DAILY}, {newest}", f"select {agg_columns} from newest")
    add(
        "aqi_map",
        f"{DAILY}, {newest}",
        """select location_id, location, city, latitude, longitude, aqi, aqi_category, "avg"
        from newest where parameter = 'pm25'""",
    )
    add(
        "kpi_summary",
        f"""{DAILY}, {newest},
        worst as (select aqi, city, location_id from newest where parameter = 'pm25'
          order by aqi desc, city, location_id limit 1)""",
        """select (select count(distinct location_id) from daily) as active_stations,
          (select count(*) from daily) as aggregates_in_window, aqi as worst_pm25_aqi,
          city as worst_pm25_city, location_id as worst_pm25_location_id from worst""",
    )
    add(
        "preview",
        DAILY,
        f"""select {agg_columns} from daily
        order by window_end, location_id, parameter, unit limit 5""",
    )
    add(
        "recent_windows",
        DAILY,
        f"""select {agg_columns} from daily where window_end in
          (select distinct window_end from daily order by 1 desc limit 5)""",
    )
    week = "window_end >= (select max(window_end) from daily) - interval '7 days'"
    add("within_last", DAILY, f"select {agg_columns} from daily where {week}")
    add(
        "rolling_summary",
        f"{DAILY}, recent as (select * from daily where {week})",
        series("recent", "1 as one").replace("1 as one, ", "", 1).replace("1 as one, ", ""),
    )
    frame = (
        "over (partition by city, parameter order by window_end"
        " range between interval '3 days' preceding and current row)"
    )
    avg = '"avg"'
    add(
        "rolling_as_of",
        DAILY,
        f"""select distinct city, parameter, window_end,
          round({exact(avg, frame)} / count("avg") {frame}, 2) as rolling_mean,
          round(avg(aqi) {frame}, 1) as rolling_aqi, max("max") {frame} as peak,
          count(*) {frame} as windows from daily""",
    )

    add(
        "sliding_summary",
        f"{DAILY}, {_SLIDES.format(source='daily')}",
        series("spread", "as_of"),
    )

    # Shards.
    add("assign_shards", SLUGGED, f"select *, {owner('location_id', MEMBERS)} as owner from slugged")
    add(
        "shard_sizes",
        SLUGGED,
        f"""select owner, count(location_id) as stations
        from (select unnest([{', '.join(repr(m) for m in MEMBERS)}]) as owner) left join
          (select location_id, {owner('location_id', MEMBERS)} as owner from slugged) using (owner)
        group by 1 order by 1""",
    )
    add(
        "shard_moves",
        SLUGGED,
        f"""select *, old_owner <> new_owner as moved from (
          select location_id, {owner('location_id', MEMBERS)} as old_owner,
            {owner('location_id', MORE_MEMBERS)} as new_owner from slugged)""",
    )
    add(
        "assigned_to",
        f"""{SLUGGED}, {LATEST},
        named as (select s.location_id as slug, t.location_id from stations t join slugged s using (location))""",
        f"""select slug as location_id, slug as location, city, country, parameter, value, unit,
          latitude, longitude, timestamp
        from latest join named using (location_id) join stations using (location_id)
        where {owner('slug', MEMBERS)} = '{MEMBERS[1]}'""",
    )

    # Scalar functions, as columns and from SQL.
    add(
        "scalar_functions",
        READINGS,
        f"""select event_id, {aqi_sql('parameter', 'value')} as aqi,
          {aqi_sql('parameter', 'value', True)} as aqi_closed,
          {category_sql(aqi_sql('parameter', 'value'))} as category,
          cast({code_sql('value')} as integer) as code, {reason_sql(code_sql('value'))} as reason,
          -- An integer has no negative zero.
          {round2('(value / 3)')} + 0.0 as window_rounded, round(value / 3, 1) + 0.0 as half_up,
          case when event_type = 'error' then null else timestamp end as parsed,
          'st-' || lpad(lower(hex(cast({fnv("location || '·' || cast(user_id as varchar)", 32)} as ubigint))), 8, '0') as slug
        from readings""",
    )
    add(
        "sql_functions",
        READINGS,
        f"""select event_id, {aqi_sql('parameter', 'value')} as aqi,
          {category_sql(aqi_sql('parameter', 'value'))} as category,
          cast({code_sql('value')} as integer) as code, {reason_sql(code_sql('value'))} as reason,
          round(value / 3, 2) + 0.0 as half_up from readings""",
    )

    # Streams: the batch twin, limited to windows the watermark has passed.
    add(
        "stream_tumbling",
        f"{DAILY}, {WATERMARK}",
        f"select {agg_columns} from daily, wm where window_end <= w",
    )
    add(
        "flush_tail",
        f"{DAILY}, {WATERMARK}",
        f"select {agg_columns} from daily, wm where window_end > w",
    )
    add(
        "periodic_emission",
        f"{DAILY}, {WATERMARK}",
        f"select {agg_columns} from daily, wm where window_end <= w",
    )
    add("repaired_windows", DAILY, f"select {agg_columns} from daily")
    add(
        "consume_messages",
        DAILY,
        """select location_id as key, case when parameter = 'co' then 'reject' else 'aggregate' end as outcome,
          count(*) as messages from daily group by 1, 2""",
    )
    add(
        "live_latest_per_station",
        f"{DAILY}, {newest}",
        f"select {agg_columns} from newest where {week}",
    )
    sql["live_rolling_summary"] = sql["rolling_summary"]
    add("stream_and_tail", DAILY, f"select {agg_columns} from daily")
    add("stream_dedup", DAILY, f"select {agg_columns} from daily")
    add(
        "stream_sliding",
        f"{DAILY}, {_SLIDES.format(source='daily')}",
        f"""select * from ({series('spread', 'as_of')})
        where as_of < (select max(window_end) from daily) - interval '1 hour'""",
    )
    add(
        "stream_chain",
        f"""{DAILY}, {WATERMARK}, closed as (select daily.* from daily, wm where window_end <= w),
        {_SLIDES.format(source='closed')}""",
        f"select * from ({series('spread', 'as_of')}) where as_of <= (select w from wm)",
    )
    return sql
