"""DuckDB SQL for every registered query: an independent statement of the
same semantics over the driver's tables, used as the correctness oracle.

Dialect notes: ``date_sub('minute', a, b)`` is Spark's ``timestampdiff``
(whole units, truncated); DuckDB's ``dayofweek`` counts Sunday as 0;
``round_even`` is Spark's ``bround``; sums of integers are cast to BIGINT.
"""

from __future__ import annotations

from ridelens import schema

# name -> (dependencies, body)
_CTE: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], body: str) -> None:
    _CTE[name] = (deps, body)


def build(select: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTE[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return select
    if select.lstrip().upper().startswith("WITH"):
        select = f"SELECT * FROM (\n{select}\n)"
    parts = ",\n".join(f"{n} AS (\n{_CTE[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{select}"


K = "(user_id % 20)"
M = "((user_id + event_id) % 20)"
START = "(ts + to_days(CAST((event_id % 13) * 30 + CASE WHEN event_id % 97 = 0 THEN 150 ELSE 0 END AS INTEGER)))"
SPAN = "(CASE WHEN event_id % 211 = 0 THEN -300 WHEN event_id % 223 = 0 THEN 93600 ELSE round(value * 60) END)"


def some(expression: str, divisor: int) -> str:
    return f"CASE WHEN event_id % {divisor} <> 0 THEN {expression} END"


_cte(
    "ev",
    [],
    "SELECT event_id, ts, user_id, event_type, value, "
    "unnest(range(1, CASE WHEN event_id % 101 = 0 THEN 3 ELSE 2 END)) AS copy_no FROM events",
)
_cte(
    "trips_raw",
    ["ev"],
    f"""SELECT
  {some("'R' || CAST(event_id AS VARCHAR)", 499)} AS ride_id,
  CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_type = 'click' THEN 'electric_bike'
       WHEN event_type = 'view' THEN 'classic_bike' ELSE 'electric_scooter' END AS rideable_type,
  {some(START, 541)} AS started_at,
  CASE WHEN event_id % 67 = 0 THEN NULL
       ELSE {START} + to_seconds(CAST({SPAN} AS BIGINT)) + to_milliseconds((event_id % 3) * 400) END AS ended_at,
  CASE WHEN event_id % 7 = 0 THEN ''
       WHEN event_id % 667 = 0 THEN 'Public Rack - Station ' || CAST({K} AS VARCHAR) || ' (TEMPORARY)'
       WHEN event_id % 23 = 0 THEN 'Public Rack - Station ' || CAST({K} AS VARCHAR)
       WHEN event_id % 29 = 0 THEN 'Station ' || CAST({K} AS VARCHAR) || ' (TEMPORARY)'
       ELSE 'Station ' || CAST({K} AS VARCHAR) END AS start_station_name,
  CASE WHEN event_id % 31 = 0 THEN NULL
       ELSE 'ID' || CAST({K} AS VARCHAR) || CASE WHEN event_id % 19 = 0 THEN 'B' ELSE '' END END AS start_station_id,
  CASE WHEN event_id % 14 = 0 THEN '' WHEN event_id % 71 = 0 THEN NULL
       WHEN event_id % 407 = 0 THEN 'Public Rack - Station ' || CAST({M} AS VARCHAR) || ' (TEMPORARY)'
       WHEN event_id % 37 = 0 THEN 'Public Rack - Station ' || CAST({M} AS VARCHAR)
       WHEN event_id % 43 = 0 THEN 'Station ' || CAST({M} AS VARCHAR) || ' (TEMPORARY)'
       ELSE 'Station ' || CAST({M} AS VARCHAR) END AS end_station_name,
  'ID' || CAST({M} AS VARCHAR) || CASE WHEN event_id % 17 = 0 THEN 'B' ELSE '' END AS end_station_id,
  {some(f"41.65::DOUBLE + 0.02::DOUBLE * {K} + 0.0001::DOUBLE * (event_id % 5)", 503)} AS start_lat,
  {some(f"-87.90::DOUBLE + 0.015::DOUBLE * {K}", 509)} AS start_lng,
  CASE WHEN event_id % 73 = 0 THEN NULL ELSE 41.65::DOUBLE + 0.02::DOUBLE * {M} END AS end_lat,
  {some(f"-87.90::DOUBLE + 0.015::DOUBLE * {M}", 521)} AS end_lng,
  {some("CASE WHEN user_id % 2 = 0 THEN 'member' ELSE 'casual' END", 523)} AS member_casual,
  strftime({START}, '%Y%m') AS source_month
FROM ev""",
)
# DATETIME columns hold whole seconds: fractions are rounded half up.
_cte(
    "typed",
    ["trips_raw"],
    """SELECT * REPLACE (date_trunc('second', started_at + INTERVAL 500 MILLISECOND) AS started_at,
  date_trunc('second', ended_at + INTERVAL 500 MILLISECOND) AS ended_at) FROM trips_raw""",
)
# Main clean, written as the reference's DELETE: keep rows where the
# predicate is FALSE or NULL.
_cte(
    "clean",
    ["typed"],
    """SELECT * FROM typed WHERE NOT coalesce(
  ride_id IS NULL OR rideable_type IS NULL OR started_at IS NULL OR ended_at IS NULL OR
  member_casual IS NULL OR start_lat IS NULL OR start_lng IS NULL OR end_lat IS NULL OR end_lng IS NULL OR
  start_station_name = NULL AND end_station_name = NULL OR
  start_station_name = '' AND end_station_name = '' OR
  date_sub('minute', started_at, ended_at) <= 1 OR
  date_sub('minute', started_at, ended_at) > 210, FALSE)""",
)
_cte("dups", ["clean"], "SELECT ride_id FROM clean GROUP BY ride_id HAVING count(*) > 1")
_cte(
    "dedup",
    ["clean", "dups"],
    "SELECT c.* FROM clean c WHERE NOT EXISTS (SELECT 1 FROM dups d WHERE d.ride_id = c.ride_id)",
)
_cte(
    "stations_raw",
    [],
    """SELECT CAST(n_nationkey AS VARCHAR) AS "ID",
  'Station ' || CAST(n_nationkey % 20 AS VARCHAR) AS "Station Name",
  CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE 'STN' || CAST(n_nationkey AS VARCHAR) END AS "Short Name",
  CAST(10 + n_nationkey AS INTEGER) AS "Total Docks",
  CAST(10 + n_nationkey - n_nationkey % 3 AS INTEGER) AS "Docks in Service",
  'In Service' AS "Status",
  41.651::DOUBLE + 0.02::DOUBLE * n_nationkey AS "Latitude",
  -87.901::DOUBLE + 0.015::DOUBLE * n_nationkey AS "Longitude"
FROM nation""",
)
_cte(
    "stations",
    ["stations_raw"],
    """SELECT "Station Name" AS s_name, "Short Name" AS s_id,
  CAST("Latitude" AS FLOAT) AS lat, CAST("Longitude" AS FLOAT) AS lng FROM stations_raw""",
)
_cte(
    "ustations",
    ["stations"],
    """SELECT s_name, s_id, lat, lng FROM (
  SELECT *, row_number() OVER (PARTITION BY s_name ORDER BY s_id IS NOT NULL, s_id, lat, lng) AS rn
  FROM stations WHERE s_name IS NOT NULL) WHERE rn = 1""",
)
_cte(
    "conformed",
    ["dedup", "ustations"],
    """SELECT t.ride_id, t.rideable_type, t.started_at, t.ended_at,
  CASE WHEN s.s_name IS NOT NULL THEN s.s_name ELSE t.start_station_name END AS start_station_name,
  CASE WHEN s.s_name IS NOT NULL THEN s.s_id ELSE t.start_station_id END AS start_station_id,
  t.end_station_name, t.end_station_id,
  CASE WHEN s.s_name IS NOT NULL THEN CAST(s.lat AS DOUBLE) ELSE t.start_lat END AS start_lat,
  CASE WHEN s.s_name IS NOT NULL THEN CAST(s.lng AS DOUBLE) ELSE t.start_lng END AS start_lng,
  t.end_lat, t.end_lng, t.member_casual, t.source_month
FROM dedup t LEFT JOIN ustations s ON t.start_station_name = s.s_name""",
)

HAVERSINE = """(12741972.0::DOUBLE * asin(least(1.0::DOUBLE, sqrt(
   sin((radians({lat2}) - radians({lat1})) / 2.0) * sin((radians({lat2}) - radians({lat1})) / 2.0)
   + cos(radians({lat1})) * cos(radians({lat2}))
     * (sin((radians({lng2}) - radians({lng1})) / 2.0) * sin((radians({lng2}) - radians({lng1})) / 2.0))))))"""


def haversine(lng1: str, lat1: str, lng2: str, lat2: str) -> str:
    return HAVERSINE.format(lng1=lng1, lat1=lat1, lng2=lng2, lat2=lat2)


DERIVE = f"""SELECT
  CASE WHEN member_casual = 'member' THEN TRUE ELSE FALSE END AS member,
  CASE WHEN rideable_type = 'electric_bike' THEN 1 WHEN rideable_type = 'classic_bike' THEN 2 ELSE 3 END AS rideable_type,
  date_sub('minute', started_at, ended_at) AS duration,
  round_even({haversine('start_lng', 'start_lat', 'end_lng', 'end_lat')}, 0) AS distance,
  CAST(hour(started_at) AS INTEGER) AS hour,
  CAST(dayofweek(started_at) + 1 AS INTEGER) AS weekday,
  CAST(month(started_at) AS INTEGER) AS month,
  CAST(year(started_at) AS INTEGER) AS year,
  start_station_name, start_station_id, end_station_name, end_station_id,
  start_lat, start_lng, end_lat, end_lng
FROM {{src}}"""

NARROW = """SELECT member, CAST(rideable_type AS TINYINT) AS rideable_type, CAST(duration AS INTEGER) AS duration,
  CAST(distance AS INTEGER) AS distance, CAST(hour AS TINYINT) AS hour, CAST(weekday AS TINYINT) AS weekday,
  CAST(month AS TINYINT) AS month, CAST(year AS SMALLINT) AS year,
  start_station_name, start_station_id, end_station_name, end_station_id,
  CAST(start_lat AS FLOAT) AS start_lat, CAST(start_lng AS FLOAT) AS start_lng,
  CAST(end_lat AS FLOAT) AS end_lat, CAST(end_lng AS FLOAT) AS end_lng
FROM {src}"""


def zcut(src: str, col: str, sd: str = "stddev_pop", strict: bool = False) -> str:
    z = f"(CAST(r.{col} AS DOUBLE) - s.mu) / nullif(s.sd, 0)"
    keep = f"abs({z}) < 3" if strict else f"NOT coalesce(abs({z}) > 3, FALSE)"
    return (
        f"SELECT r.* FROM {src} r, (SELECT avg(CAST({col} AS DOUBLE)) AS mu, {sd}(CAST({col} AS DOUBLE)) AS sd "
        f"FROM {src}) s WHERE {keep}"
    )


# Main path: rides derived after the station conformance, as in the reference.
_cte("derived", ["conformed"], DERIVE.format(src="conformed"))
_cte("rides_all", ["derived"], NARROW.format(src="derived"))
_cte("rides", ["rides_all"], zcut("rides_all", "duration"))
# Operator-level z-score check on rides without the conformance.
_cte("derived_plain", ["dedup"], DERIVE.format(src="dedup"))
_cte("rides_all_plain", ["derived_plain"], NARROW.format(src="derived_plain"))
_cte("rides_plain", ["rides_all_plain"], zcut("rides_all_plain", "duration"))



def segment_case(member: str, bike: str, members: dict[str, str], bikes: dict[str, str], otherwise: str) -> str:
    """The segment label by member and bike; ``members`` and ``bikes`` are SQL
    values and their parts of the label."""
    whens = [f"WHEN {member} = {m} AND {bike} = {b} THEN '{prefix}{label}'" for m, prefix in members.items() for b, label in bikes.items()]
    return f"CASE {' '.join(whens)} ELSE {otherwise} END"


BIKES = {str(code): label for code, label in schema.BIKE_LABELS.items()}
RAW_BIKES = {f"'{raw}'": schema.BIKE_LABELS[schema.BIKE_CODES.get(raw, schema.BIKE_OTHER_CODE)] for raw in schema.RAW_BIKE_TYPES}
MEMBERS = {str(flag).upper(): prefix for flag, prefix in schema.SEGMENT_PREFIXES.items()}
RAW_MEMBERS = {f"'{schema.MEMBER_VALUE}'": schema.SEGMENT_PREFIXES[True], f"'{schema.CASUAL_VALUE}'": schema.SEGMENT_PREFIXES[False]}
LAST_SEGMENT = schema.SEGMENT_PREFIXES[False] + schema.BIKE_LABELS[schema.BIKE_OTHER_CODE]
SEGMENT = segment_case("member", "rideable_type", MEMBERS, BIKES, f"'{LAST_SEGMENT}'")

_cte(
    "time_rollup",
    ["rides"],
    f"""SELECT {SEGMENT} AS type, year, month, weekday, hour, member, rideable_type,
  count(*) AS n_trips, CAST(sum(duration) AS BIGINT) AS duration,
  CAST(sum(duration) AS DOUBLE) / count(*) AS avg_duration
FROM rides GROUP BY year, month, weekday, hour, type, member, rideable_type""",
)
_cte(
    "tr_dated",
    ["time_rollup"],
    """SELECT *,
  CASE WHEN year * 12 + month BETWEEN 2024 * 12 + 1 AND 2025 * 12 + 1
       THEN strftime(make_date(year, month, 1), '%b.%Y') END AS date,
  CASE WHEN year * 12 + month BETWEEN 2024 * 12 + 1 AND 2025 * 12 + 1
       THEN CAST(year AS INTEGER) * 12 + CAST(month AS INTEGER) END AS date_order
FROM time_rollup""",
)

# Legacy path: type, drop duplicated keys, drop missing, derive, z-score on seconds.
_cte(
    "ltyped",
    ["typed"],
    """SELECT ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id,
  end_station_name, end_station_id, CAST(start_lat AS FLOAT) AS start_lat, CAST(start_lng AS FLOAT) AS start_lng,
  CAST(end_lat AS FLOAT) AS end_lat, CAST(end_lng AS FLOAT) AS end_lng, member_casual
FROM typed""",
)
_cte(
    "ldedup",
    ["ltyped"],
    """SELECT * FROM ltyped WHERE ride_id IS NULL OR ride_id NOT IN (
  SELECT ride_id FROM ltyped WHERE ride_id IS NOT NULL GROUP BY ride_id HAVING count(*) > 1)""",
)
_cte(
    "lcomplete",
    ["ldedup"],
    """SELECT * FROM ldedup WHERE NOT (ride_id IS NULL OR rideable_type IS NULL OR started_at IS NULL OR
  ended_at IS NULL OR member_casual IS NULL OR start_lat IS NULL OR end_lat IS NULL)""",
)
_cte(
    "lderived",
    ["lcomplete"],
    """SELECT member_casual, rideable_type, CAST(date_sub('second', started_at, ended_at) AS INTEGER) AS trip_duration,
  CAST(hour(started_at) AS INTEGER) AS hour_of_day,
  CASE dayofweek(started_at) WHEN 0 THEN 'Sun' WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed'
       WHEN 4 THEN 'Thu' WHEN 5 THEN 'Fri' WHEN 6 THEN 'Sat' END AS day_of_week,
  CASE month(started_at) WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr'
       WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep'
       WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' WHEN 12 THEN 'Dec' END AS month,
  CAST(year(started_at) AS INTEGER) AS year,
  start_station_name, start_station_id, end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng
FROM lcomplete""",
)
_cte("ltrim", ["lderived"], zcut("lderived", "trip_duration"))


def _fix_id(src: str, name: str, idc: str) -> str:
    main = f"(SELECT max(i.{idc}) FROM {src} i WHERE i.{name} = t.{name})"
    cols = []
    for c in [
        "member_casual", "rideable_type", "trip_duration", "hour_of_day", "day_of_week", "month", "year",
        "start_station_name", "start_station_id", "end_station_name", "end_station_id",
        "start_lat", "start_lng", "end_lat", "end_lng",
    ]:
        cols.append(f"CASE WHEN t.{idc} != {main} THEN {main} ELSE t.{idc} END AS {idc}" if c == idc else f"t.{c}")
    return f"SELECT {', '.join(cols)} FROM {src} t"


_cte("lfix_start", ["ltrim"], _fix_id("ltrim", "start_station_name", "start_station_id"))
_cte("lfix_end", ["lfix_start"], _fix_id("lfix_start", "end_station_name", "end_station_id"))
_cte(
    "lreport",
    ["lfix_end"],
    zcut(
        "(SELECT rideable_type, member_casual, round_even(trip_duration / 60.0, 0) AS trip_duration "
        "FROM lfix_end WHERE trip_duration > 0)",
        "trip_duration",
        sd="stddev_samp",
        strict=True,
    ),
)
_cte(
    "lstations",
    ["lfix_end"],
    """SELECT start_station_name, count(*) AS n_trips,
  CASE WHEN count(start_lng) = count(*) THEN avg(CAST(start_lng AS DOUBLE)) END AS lng,
  CASE WHEN count(start_lat) = count(*) THEN avg(CAST(start_lat AS DOUBLE)) END AS lat
FROM lfix_end GROUP BY start_station_name HAVING start_station_name != ''""",
)

# Areas, by half-planes: a box less a closed triangle, a box less a notch, two
# parts, and plain boxes.
_cte(
    "areas",
    [],
    """SELECT CAST(r_regionkey AS BIGINT) AS area_id, r_name AS community, r_regionkey AS kind,
  41.64::DOUBLE + 0.08::DOUBLE * r_regionkey + CASE WHEN r_regionkey = 4 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS y0
FROM region""",
)


def left_of(x: str, y: str, a: tuple[float, float], b: tuple[float, float]) -> str:
    """The point's side of the line from a to b (heights above the area's
    foot): above 0 to the left."""
    (ax, ay), (bx, by) = a, b
    return f"(({bx - ax!r}::DOUBLE) * ({y} - a.y0 - {ay!r}::DOUBLE) - ({by - ay!r}::DOUBLE) * ({x} - ({ax!r}::DOUBLE)))"


def within(x: str, y: str) -> str:
    """Strictly inside area ``a``."""

    def box(top: float) -> str:
        return f"({x} > -88.0 AND {x} < -87.0 AND {y} > a.y0 AND {y} < a.y0 + {top}::DOUBLE)"

    def turn(corners: list[tuple[float, float]], sign: str) -> str:
        return " AND ".join(f"{left_of(x, y, p, q)} {sign} 0" for p, q in zip(corners, corners[1:]))

    hole = [(-87.91, 0.02), (-87.86, 0.02), (-87.885, 0.06), (-87.91, 0.02)]
    notch = [(-88.0, 0.04), (-87.79, 0.05), (-88.0, 0.06)]
    part = [(-87.75, 0.06), (-87.72, 0.06), (-87.735, 0.08), (-87.75, 0.06)]
    return f"""(CASE a.kind WHEN 0 THEN {box(0.08)} AND NOT ({turn(hole, ">=")})
    WHEN 1 THEN {box(0.08)} AND NOT ({turn(notch, ">=")})
    WHEN 2 THEN {box(0.04)} OR ({turn(part, ">")})
    ELSE {box(0.08)} END)"""


def station_rollup(src: str) -> str:
    return f"""SELECT start_station_name, member, count(*) AS n_trips,
  avg(CAST(start_lng AS DOUBLE)) AS lng, avg(CAST(start_lat AS DOUBLE)) AS lat, count(*) / 1000.0 AS n_trips_k
FROM {src} GROUP BY start_station_name, member"""


_cte("st_member", ["rides"], station_rollup("rides") + " HAVING count(*) > 0")
_cte("st_member_all", ["rides_all"], station_rollup("rides_all"))


def area_totals(points: str) -> str:
    return f"""SELECT a.area_id, a.community, coalesce(t.n_trips, 0) AS n_trips FROM areas a LEFT JOIN (
  SELECT a.community, CAST(coalesce(sum(p.n_trips), 0) AS BIGINT) AS n_trips
  FROM {points} p JOIN areas a ON {within("p.lng", "p.lat")}
  GROUP BY a.community) t ON a.community = t.community"""


def audit(key: str, value: str, noun: str, where: str = "", detail: bool = False, src: str = "ltrim") -> str:
    pairs = f"SELECT {key}, {value}, count(*) AS n_trips FROM {src} {where} GROUP BY {key}, {value}"
    ranked = f"""SELECT *,
    row_number() OVER (PARTITION BY {key} ORDER BY n_trips DESC, {value} IS NOT NULL, {value}) AS r_most,
    row_number() OVER (PARTITION BY {key} ORDER BY n_trips ASC, {value} IS NOT NULL, {value}) AS r_least,
    count(DISTINCT {value}) OVER (PARTITION BY {key})
      + max(CASE WHEN {value} IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY {key}) AS n_distinct
  FROM ({pairs})"""
    per_key = f"""SELECT {key}, any_value(n_distinct) AS n_distinct_{noun}s,
    max(CASE WHEN r_most = 1 THEN {value} END) AS most_popular_{noun},
    max(CASE WHEN r_least = 1 THEN {value} END) AS less_popular_{noun}
  FROM ({ranked}) GROUP BY {key} HAVING any_value(n_distinct) > 1"""
    if not detail:
        return per_key
    return f"""SELECT k.{key}, k.n_distinct_{noun}s, p.{value}, p.n_trips AS count_trips,
    k.most_popular_{noun}, k.less_popular_{noun}
  FROM ({per_key}) k JOIN ({pairs}) p ON k.{key} = p.{key}"""


R6 = "round({0}, 6) AS {0}"

SQL: dict[str, str] = {}


def _q(name: str, needs: list[str], select: str) -> None:
    SQL[name] = build(select, needs)


_q("union_months", ["trips_raw"], "SELECT * FROM trips_raw WHERE source_month BETWEEN '202401' AND '202501'")
# The load path: a missing text is blank, and what is wrong with a line follows
# from its ride's number.
_cte(
    "faulty",
    ["trips_raw"],
    """SELECT *, CASE WHEN e % 73 = 0 THEN 'line'
  ELSE nullif(concat_ws(',', CASE WHEN e % 89 = 0 THEN 'started_at' END, CASE WHEN e % 83 = 0 THEN 'start_lat' END,
    CASE WHEN e % 79 = 0 THEN 'end_lng' END), '') END AS reason
FROM (SELECT *, CAST(substr(ride_id, 2) AS BIGINT) AS e FROM trips_raw)""",
)
_q(
    "load_text",
    ["faulty"],
    """SELECT * EXCLUDE (e, reason) REPLACE (
  coalesce(ride_id, '') AS ride_id, coalesce(rideable_type, '') AS rideable_type, coalesce(start_station_name, '') AS start_station_name,
  coalesce(start_station_id, '') AS start_station_id, coalesce(end_station_name, '') AS end_station_name,
  coalesce(end_station_id, '') AS end_station_id, coalesce(member_casual, '') AS member_casual,
  date_trunc('second', started_at + INTERVAL 500 MILLISECOND) AS started_at,
  date_trunc('second', ended_at + INTERVAL 500 MILLISECOND) AS ended_at)
FROM faulty WHERE reason IS NULL""",
)
_q("load_rejects", ["faulty"], "SELECT source_month, reason, count(*) AS n_rows FROM faulty GROUP BY source_month, reason")
_q(
    "delete_where_3vl",
    ["typed"],
    """SELECT * FROM typed WHERE NOT coalesce(
  start_station_name = NULL AND end_station_name = NULL OR start_station_name = '' AND end_station_name = '', FALSE)""",
)
_q("clean_trips", ["clean"], "SELECT * FROM clean")
_q("drop_all_duplicates", ["dedup"], "SELECT * FROM dedup")
_q("keep_in", ["clean", "dups"], "SELECT * FROM clean WHERE ride_id IN (SELECT ride_id FROM dups)")
# The copies of a duplicated ride are identical rows, so any kept copy is the same.
_q(
    "drop_duplicates_keep_one",
    ["clean"],
    "SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY ride_id) = 1",
)
_q(
    "null_audit",
    ["conformed"],
    "SELECT "
    + ", ".join(
        f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}_nulls"
        for c in [
            "member_casual", "rideable_type", "start_station_name", "start_station_id", "start_lat",
            "start_lng", "end_station_name", "end_station_id", "end_lat", "end_lng",
        ]
    )
    + " FROM conformed",
)
_q("conform_station", ["conformed"], "SELECT * FROM conformed")
_q(
    "span_rules",
    ["lcomplete"],
    """SELECT * FROM lcomplete WHERE NOT coalesce(started_at >= ended_at, FALSE)
  AND NOT coalesce(date_sub('second', started_at, ended_at) > 86400, FALSE)
  AND NOT coalesce(date_sub('second', started_at, ended_at) < 60, FALSE)""",
)
_q("legacy_missing", ["lderived"], "SELECT * FROM lderived WHERE trip_duration > 0")
def ledger_sql(steps: list[tuple[str, str, str | None]]) -> str:
    """Union of (step, table, changed-row condition) counts with rows_in and removed."""
    parts = []
    for i, (name, table, cond) in enumerate(steps):
        changed = f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)" if cond else "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT {i} AS step_no, '{name}' AS step, count(*) AS rows_out, {changed} AS changed FROM {table}")
    body = "\n  UNION ALL ".join(parts)
    return f"""SELECT step_no, step, lag(rows_out) OVER (ORDER BY step_no) AS rows_in, rows_out,
  lag(rows_out) OVER (ORDER BY step_no) - rows_out AS removed, changed FROM (
  {body})"""


_q(
    "cleaning_ledger",
    ["trips_raw", "clean", "dedup", "rides"],
    ledger_sql([("load", "trips_raw", None), ("clean", "clean", None), ("drop_duplicates", "dedup", None), ("zscore", "rides", None)]),
)
_cte(
    "conform_flag",
    ["dedup", "ustations"],
    """SELECT s.s_name IS NOT NULL AND (t.start_station_name IS DISTINCT FROM s.s_name
    OR t.start_station_id IS DISTINCT FROM s.s_id
    OR t.start_lat IS DISTINCT FROM CAST(s.lat AS DOUBLE)
    OR t.start_lng IS DISTINCT FROM CAST(s.lng AS DOUBLE)) AS changed
FROM dedup t LEFT JOIN ustations s ON t.start_station_name = s.s_name""",
)
_q(
    "statement_ledger",
    ["trips_raw", "clean", "dedup", "conform_flag", "rides"],
    ledger_sql(
        [
            ("load", "trips_raw", None),
            ("clean", "clean", None),
            ("drop_duplicates", "dedup", None),
            ("conform_stations", "conform_flag", "changed"),
            ("zscore", "rides", None),
        ]
    ),
)
# The id updates count the rows their WHERE clause selects, written as the
# reference writes it: id != (the name's MAX(id)).
_cte(
    "start_flag",
    ["ltrim"],
    """SELECT t.start_station_id != (SELECT max(i.start_station_id) FROM ltrim i
    WHERE i.start_station_name = t.start_station_name) AS changed FROM ltrim t""",
)
_cte(
    "end_flag",
    ["lfix_start"],
    """SELECT t.end_station_id != (SELECT max(i.end_station_id) FROM lfix_start i
    WHERE i.end_station_name = t.end_station_name) AS changed FROM lfix_start t""",
)
_q(
    "legacy_ledger",
    ["ltyped", "ldedup", "lcomplete", "ltrim", "start_flag", "end_flag"],
    ledger_sql(
        [
            ("load", "ltyped", None),
            ("drop_duplicates", "ldedup", None),
            ("drop_missing", "lcomplete", None),
            ("zscore", "ltrim", None),
            ("start_ids", "start_flag", "changed"),
            ("end_ids", "end_flag", "changed"),
        ]
    ),
)
_q("preview", ["dedup"], "SELECT * FROM dedup ORDER BY ride_id LIMIT 6")
_q("type_trips", ["ltyped"], "SELECT * FROM ltyped")
_q("derive_rides", ["derived"], "SELECT * FROM derived")
_q("derive_rides_legacy", ["lderived"], "SELECT * FROM lderived")
_q("narrow_types", ["rides_all"], "SELECT * FROM rides_all")
_q(
    "haversine",
    ["dedup"],
    f"""SELECT ride_id, round({haversine('start_lng', 'start_lat', 'end_lng', 'end_lat')}) AS distance_m,
  round({haversine('end_lng', 'end_lat', 'start_lng', 'start_lat')}) AS distance_back_m FROM dedup""",
)
_q("to_minutes_half_even", ["lderived"], "SELECT trip_duration, round_even(trip_duration / 60.0, 0) AS minutes FROM lderived")
_q("to_minutes_half_up", ["lderived"], "SELECT trip_duration, round(trip_duration / 60.0, 0) AS minutes FROM lderived")
_q("zscore_pop", ["rides_plain"], "SELECT * FROM rides_plain")
_q("zscore_samp", ["rides_all"], zcut("rides_all", "duration", sd="stddev_samp", strict=True))
_q(
    "zscore_columns",
    ["rides_all"],
    """SELECT member, rideable_type, duration, round(zp, 9) AS z_pop, round(zs, 9) AS z_samp,
  NOT coalesce(abs(zp) > 2, FALSE) AS kept_pop, coalesce(abs(zs) < 2, FALSE) AS kept_samp
FROM (SELECT r.*, (r.duration::DOUBLE - s.mu) / nullif(s.p, 0) AS zp, (r.duration::DOUBLE - s.mu) / nullif(s.q, 0) AS zs
  FROM rides_all r, (SELECT avg(duration::DOUBLE) AS mu, stddev_pop(duration::DOUBLE) AS p, stddev_samp(duration::DOUBLE) AS q
    FROM rides_all) s)""",
)
_q("analysis_rides", ["rides"], "SELECT * FROM rides")
_q("time_rollup", ["time_rollup"], "SELECT * FROM time_rollup")
_q("time_rollup_merged", ["time_rollup"], "SELECT * FROM time_rollup")
_q(
    "month_sketches",
    ["rides_all"],
    """SELECT member, count(*) AS n_trips, count(DISTINCT start_station_name) AS n_stations,
  TRUE AS distinct_within, TRUE AS quantiles_within FROM rides_all GROUP BY member""",
)
_q(
    "time_rollup_decimal",
    ["rides"],
    f"""SELECT {SEGMENT} AS type, year, month, weekday, hour, member, rideable_type,
  count(*) AS n_trips, CAST(sum(duration) AS BIGINT) AS duration,
  CAST(CASE WHEN sum(duration) < 0 THEN -1 ELSE 1 END
       * ((20000 * CAST(abs(sum(duration)) AS HUGEINT) + count(*)) // (2 * count(*))) AS DOUBLE) / 10000.0 AS avg_duration
FROM rides GROUP BY year, month, weekday, hour, type, member, rideable_type""",
)
_q(
    "od_rollup",
    ["rides"],
    """SELECT member, start_station_name, end_station_name, count(*) AS n_trips,
  round(avg(duration), 6) AS duration, round(avg(CAST(start_lat AS DOUBLE)), 6) AS s_lat,
  round(avg(CAST(start_lng AS DOUBLE)), 6) AS s_lng, round(avg(CAST(end_lat AS DOUBLE)), 6) AS e_lat,
  round(avg(CAST(end_lng AS DOUBLE)), 6) AS e_lng
FROM rides GROUP BY member, start_station_name, end_station_name""",
)
_q(
    "frequency",
    ["rides"],
    """SELECT member, rideable_type, count(*) AS n_trips,
  CASE WHEN CAST(member AS INTEGER) = 1 THEN 'Member' WHEN CAST(member AS INTEGER) = 0 THEN 'Casual' END AS member_label,
  CASE rideable_type WHEN 1 THEN 'Electric Bike' WHEN 2 THEN 'Classic Bike' WHEN 3 THEN 'Electric Scooter' END AS bike_label
FROM rides GROUP BY member, rideable_type""",
)
_q(
    "monthly_usage",
    ["tr_dated"],
    "SELECT date, date_order, member, rideable_type, CAST(sum(n_trips) AS BIGINT) AS n FROM tr_dated "
    "GROUP BY date, date_order, member, rideable_type",
)
_q(
    "weekday_usage",
    ["time_rollup"],
    "SELECT weekday, member, rideable_type, CAST(sum(n_trips) AS BIGINT) AS n FROM time_rollup GROUP BY ALL",
)
_q(
    "hour_usage",
    ["time_rollup"],
    "SELECT hour, member, rideable_type, CAST(sum(n_trips) AS BIGINT) AS n FROM time_rollup GROUP BY ALL",
)
_q(
    "usage_frames",
    ["tr_dated"],
    "\n  UNION ALL BY NAME ".join(
        f"SELECT '{frame}' AS frame, {keys}, CAST(sum(n_trips) AS BIGINT) AS n FROM tr_dated GROUP BY {keys}"
        for frame, keys in {
            "frequency": "member, rideable_type",
            "monthly": "date, date_order, member, rideable_type",
            "weekday": "weekday, member, rideable_type",
            "hour": "hour, member, rideable_type",
            "heatmap": "date, date_order, weekday, hour, member",
        }.items()
    ),
)
_q(
    "heatmap",
    ["tr_dated"],
    """SELECT *, round_even(n / sum(n) OVER (PARTITION BY date, weekday, hour) * 100.0, 2) AS percentage FROM (
  SELECT date, date_order, weekday, hour, member, CAST(sum(n_trips) AS BIGINT) AS n FROM tr_dated
  GROUP BY date, date_order, weekday, hour, member)""",
)
_q(
    "monthly_share",
    ["tr_dated"],
    """SELECT *, round_even(n / sum(n) OVER (PARTITION BY date, member) * 100.0, 2) AS percentage FROM (
  SELECT date, date_order, member, rideable_type, CAST(sum(n_trips) AS BIGINT) AS n FROM tr_dated
  GROUP BY date, date_order, member, rideable_type)""",
)
_q(
    "avg_duration_row",
    ["time_rollup"],
    "SELECT type, weekday, CAST(duration AS DOUBLE) / nullif(n_trips, 0) AS avg_duration FROM time_rollup",
)
_q(
    "avg_duration_weighted",
    ["time_rollup"],
    """SELECT type, weekday, CAST(sum(duration) AS DOUBLE) / nullif(sum(n_trips), 0) AS avg_duration,
  CAST(sum(n_trips) AS BIGINT) AS n_trips FROM time_rollup GROUP BY type, weekday""",
)
_q(
    "time_rollup_legacy",
    ["lfix_end"],
    """SELECT year, month, day_of_week, hour_of_day, rideable_type, member_casual, count(*) AS n_trips,
  CAST(sum(trip_duration) AS BIGINT) AS trip_duration,
  CASE month WHEN 'Jan' THEN 1 WHEN 'Feb' THEN 2 WHEN 'Mar' THEN 3 WHEN 'Apr' THEN 4 WHEN 'May' THEN 5
    WHEN 'Jun' THEN 6 WHEN 'Jul' THEN 7 WHEN 'Aug' THEN 8 WHEN 'Sep' THEN 9 WHEN 'Oct' THEN 10
    WHEN 'Nov' THEN 11 WHEN 'Dec' THEN 12 END AS month_level,
  CASE day_of_week WHEN 'Mon' THEN 1 WHEN 'Tue' THEN 2 WHEN 'Wed' THEN 3 WHEN 'Thu' THEN 4 WHEN 'Fri' THEN 5
    WHEN 'Sat' THEN 6 WHEN 'Sun' THEN 7 END AS weekday_level
FROM lfix_end GROUP BY year, month, day_of_week, hour_of_day, rideable_type, member_casual""",
)
_q(
    "share_segments",
    ["lreport"],
    """WITH c AS (
  SELECT member_casual, rideable_type, count(*) AS n_trips,
    """
    + segment_case("member_casual", "rideable_type", RAW_MEMBERS, RAW_BIKES, "NULL")
    + """ AS type
  FROM lreport GROUP BY member_casual, rideable_type),
p AS (SELECT *, n_trips / (SELECT sum(n_trips) FROM c) * 100.0 AS percent FROM c),
o AS (SELECT *, row_number() OVER w AS position, sum(percent) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ymax
  FROM p WINDOW w AS (ORDER BY type DESC NULLS LAST, member_casual ASC NULLS FIRST, rideable_type ASC NULLS FIRST)),
l AS (SELECT *, coalesce(lag(ymax) OVER (ORDER BY position), 0.0) AS ymin FROM o)
SELECT member_casual, rideable_type, n_trips, type, round(percent, 6) AS percent,
  round_even(percent, 2) AS pct_label, round(ymax, 6) AS ymax, round(ymin, 6) AS ymin,
  round((ymax + ymin) / 2.0, 6) AS labpos,
  type || chr(10) || regexp_replace(CAST(round_even(percent, 2) AS VARCHAR), '\\.0$', '') || ' %' AS label,
  CAST(position AS INTEGER) AS position
FROM l""",
)


_q(
    "running_minutes",
    ["dedup"],
    """SELECT ride_id, started_at, date_sub('minute', started_at, ended_at) AS minutes, row_number() OVER w AS position,
  CAST(sum(date_sub('minute', started_at, ended_at)) OVER w AS BIGINT) AS cum_minutes,
  CAST(sum(date_sub('minute', started_at, ended_at)) OVER w AS BIGINT) - date_sub('minute', started_at, ended_at) AS minutes_before
FROM dedup WINDOW w AS (ORDER BY started_at, ride_id)""",
)
_q(
    "time_rollup_ordered",
    ["time_rollup"],
    "SELECT *, row_number() OVER (ORDER BY year, month, weekday, hour, type, member, rideable_type) AS position FROM time_rollup",
)
SQL["time_rollup_legacy_ordered"] = f"""SELECT *, row_number() OVER (ORDER BY year, month_level NULLS LAST, weekday_level NULLS LAST,
  hour_of_day, rideable_type NULLS FIRST, member_casual NULLS FIRST) AS position FROM ({SQL["time_rollup_legacy"]})"""


def histogram_sql(by: list[str]) -> str:
    keys = ", ".join(by)
    return f"""SELECT {keys}, bin, CAST(sum(cnt) AS BIGINT) AS n, bin - 1.0 AS xmin, bin + 1.0 AS xmax FROM (
  SELECT {keys}, count(*) AS cnt,
    CASE WHEN duration = (SELECT min(duration) FROM rides) AND (duration - 1) % 2 = 0 THEN duration + 1.0
         ELSE ceil((duration - 1.0) / 2.0) * 2.0 END AS bin
  FROM rides WHERE duration IS NOT NULL GROUP BY {keys}, duration) GROUP BY {keys}, bin"""


_q(
    "histogram",
    ["rides"],
    f"""SELECT *, CASE WHEN CAST(member AS INTEGER) = 1 THEN 'Member' WHEN CAST(member AS INTEGER) = 0 THEN 'Casual' END AS member_label,
  CASE rideable_type WHEN 1 THEN 'Electric Bike' WHEN 2 THEN 'Classic Bike' WHEN 3 THEN 'Electric Scooter' END AS bike_label
FROM ({histogram_sql(['member', 'rideable_type'])})""",
)
_q(
    "histogram_facet",
    ["rides"],
    f"""SELECT *, CASE rideable_type WHEN 1 THEN 'Electric Bike' WHEN 2 THEN 'Classic Bike' WHEN 3 THEN 'Electric Scooter' END
  || ' / ' || CASE WHEN CAST(member AS INTEGER) = 1 THEN 'Member' ELSE 'Casual' END AS panel
FROM ({histogram_sql(['rideable_type', 'member'])})""",
)
_q(
    "boxplot_stats",
    ["rides"],
    """WITH q AS (
  SELECT member, rideable_type, count(*) AS n,
    quantile_cont(CAST(duration AS DOUBLE), 0.25) AS lower, quantile_cont(CAST(duration AS DOUBLE), 0.5) AS middle,
    quantile_cont(CAST(duration AS DOUBLE), 0.75) AS upper
  FROM rides WHERE duration IS NOT NULL GROUP BY member, rideable_type),
w AS (
  SELECT q.member, q.rideable_type,
    min(CASE WHEN r.duration >= q.lower - 1.5 * (q.upper - q.lower) THEN CAST(r.duration AS DOUBLE) END) AS ymin,
    max(CASE WHEN r.duration <= q.upper + 1.5 * (q.upper - q.lower) THEN CAST(r.duration AS DOUBLE) END) AS ymax,
    CAST(sum(CASE WHEN r.duration < q.lower - 1.5 * (q.upper - q.lower) OR r.duration > q.upper + 1.5 * (q.upper - q.lower)
        THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
  FROM rides r JOIN q ON r.member = q.member AND r.rideable_type = q.rideable_type GROUP BY q.member, q.rideable_type)
SELECT q.member, q.rideable_type, q.n, w.ymin, q.lower, q.middle, q.upper, w.ymax,
  q.middle - 1.58 * (q.upper - q.lower) / sqrt(q.n) AS notchlower,
  q.middle + 1.58 * (q.upper - q.lower) / sqrt(q.n) AS notchupper, w.n_outliers
FROM q JOIN w ON q.member = w.member AND q.rideable_type = w.rideable_type""",
)
_q(
    "boxplot_outliers",
    ["rides"],
    """WITH q AS (
  SELECT member, rideable_type, quantile_cont(CAST(duration AS DOUBLE), 0.25) AS lower,
    quantile_cont(CAST(duration AS DOUBLE), 0.75) AS upper
  FROM rides WHERE duration IS NOT NULL GROUP BY member, rideable_type)
SELECT r.member, r.rideable_type, r.duration AS value, count(*) AS n
FROM rides r JOIN q ON r.member = q.member AND r.rideable_type = q.rideable_type
WHERE r.duration < q.lower - 1.5 * (q.upper - q.lower) OR r.duration > q.upper + 1.5 * (q.upper - q.lower)
GROUP BY r.member, r.rideable_type, r.duration""",
)
_q(
    "station_trips",
    ["lstations"],
    "SELECT start_station_name, n_trips, round(lng, 6) AS lng, round(lat, 6) AS lat FROM lstations",
)
_q(
    "station_trips_by_member",
    ["st_member"],
    "SELECT start_station_name, member, n_trips, round(lng, 6) AS lng, round(lat, 6) AS lat, n_trips_k FROM st_member",
)
_q(
    "top_stations",
    ["lstations"],
    "SELECT start_station_name, n_trips, round(lng, 6) AS lng, round(lat, 6) AS lat, "
    "CAST(row_number() OVER (ORDER BY n_trips DESC, start_station_name) AS INTEGER) AS rank FROM lstations",
)
_q("id_conflict_start", ["ltrim"], audit("start_station_name", "start_station_id", "id"))
_q("id_conflict_end", ["ltrim"], audit("end_station_name", "end_station_id", "id"))
_q(
    "name_conflict_start",
    ["lfix_end"],
    audit(
        "start_station_id",
        "start_station_name",
        "name",
        where="WHERE start_station_name NOT LIKE 'Public Rack - %'",
        src="lfix_end",
    ),
)
_q(
    "name_conflict_end",
    ["lfix_end"],
    audit(
        "end_station_id",
        "end_station_name",
        "name",
        where="WHERE end_station_name NOT LIKE 'Public Rack%' OR end_station_name NOT LIKE '%TEMPORARY)'",
        detail=True,
        src="lfix_end",
    ),
)
_q(
    "name_conflict_end_intended",
    ["lfix_end"],
    audit(
        "end_station_id",
        "end_station_name",
        "name",
        where="WHERE end_station_name NOT LIKE 'Public Rack%' AND end_station_name NOT LIKE '%TEMPORARY)'",
        detail=True,
        src="lfix_end",
    ),
)
_q(
    "distinct_count_null",
    ["dedup"],
    """SELECT start_station_name, count(DISTINCT start_station_id) AS n_ids_sql,
  count(DISTINCT start_station_id) + max(CASE WHEN start_station_id IS NULL THEN 1 ELSE 0 END) AS n_ids_r
FROM dedup GROUP BY start_station_name""",
)
_q("canonical_id_start", ["lfix_start"], "SELECT * FROM lfix_start")
_q("canonical_id_end", ["ltrim"], "SELECT * FROM (" + _fix_id("ltrim", "end_station_name", "end_station_id") + ")")


def canonical_name_sql(side: str) -> str:
    name, sid = f"{side}_station_name", f"{side}_station_id"
    return f"""SELECT t.* REPLACE (CASE WHEN t.{name} != m.main THEN m.main ELSE t.{name} END AS {name})
FROM lfix_end t LEFT JOIN (
  SELECT {sid}, max({name}) AS main FROM lfix_end
  WHERE {name} NOT LIKE 'Public Rack%' AND {name} NOT LIKE '%TEMPORARY)'
  GROUP BY {sid}) m ON t.{sid} = m.{sid}"""


_q("canonical_name", ["lfix_end"], canonical_name_sql("start"))
_q("canonical_name_end", ["lfix_end"], canonical_name_sql("end"))
_q(
    "canonical_id_mode",
    ["ltrim"],
    """SELECT t.member_casual, t.rideable_type, t.trip_duration, t.hour_of_day, t.day_of_week, t.month, t.year,
  t.start_station_name,
  CASE WHEN t.start_station_id != m.main THEN m.main ELSE t.start_station_id END AS start_station_id,
  t.end_station_name, t.end_station_id, t.start_lat, t.start_lng, t.end_lat, t.end_lng
FROM ltrim t LEFT JOIN (
  SELECT start_station_name, start_station_id AS main FROM (
    SELECT start_station_name, start_station_id,
      row_number() OVER (PARTITION BY start_station_name ORDER BY count(*) DESC, start_station_id) AS rn
    FROM ltrim WHERE start_station_id IS NOT NULL GROUP BY start_station_name, start_station_id)
  WHERE rn = 1) m ON t.start_station_name = m.start_station_name""",
)
# Stations as sets of ids that some name joins: every pair of ids reached.
_cte(
    "stops",
    ["ltrim"],
    """SELECT start_station_name AS name, start_station_id AS id FROM ltrim
  WHERE start_station_name != '' AND start_station_id != ''
  UNION ALL SELECT end_station_name, end_station_id FROM ltrim WHERE end_station_name != '' AND end_station_id != ''""",
)
STATIONS = """WITH RECURSIVE pairs AS (SELECT DISTINCT name, id FROM stops),
reach(id, other) AS (
  SELECT id, id FROM pairs
  UNION SELECT r.id, q.id FROM reach r JOIN pairs p ON p.id = r.other JOIN pairs q ON q.name = p.name),
part AS (SELECT id, min(other) AS component FROM reach GROUP BY id),
own AS (SELECT s.name, s.id, p.component FROM stops s JOIN part p ON p.id = s.id),
best_id AS (
  SELECT component, id AS canonical_id FROM (SELECT component, id, count(*) AS n FROM own GROUP BY component, id)
  QUALIFY row_number() OVER (PARTITION BY component ORDER BY n DESC, id) = 1),
best_name AS (
  SELECT component, name AS canonical_name FROM (SELECT component, name, count(*) AS n FROM own GROUP BY component, name)
  QUALIFY row_number() OVER (PARTITION BY component ORDER BY name LIKE 'Public Rack%' OR name LIKE '%TEMPORARY)', n DESC, name) = 1),
known AS (SELECT DISTINCT name, id, component, canonical_id, canonical_name FROM own JOIN best_id USING (component) JOIN best_name USING (component))
"""
_q(
    "station_identity",
    ["stops"],
    STATIONS
    + """SELECT component, any_value(canonical_id) AS canonical_id, any_value(canonical_name) AS canonical_name,
  count(DISTINCT id) AS n_ids, count(DISTINCT name) AS n_names,
  (SELECT count(*) FROM own o WHERE o.component = k.component) AS n_trips
FROM known k GROUP BY component""",
)


def unified(side: str) -> tuple[str, str]:
    """The canonical id and name on one side: by name, else by id."""
    name, sid = f"{side}_station_name", f"{side}_station_id"

    def pick(c: str, own: str) -> str:
        return f"""CASE WHEN t.{name} IN (SELECT name FROM known) THEN (SELECT min(k.{c}) FROM known k WHERE k.name = t.{name})
    WHEN coalesce(t.{name}, '') = '' AND t.{sid} IN (SELECT id FROM known)
    THEN (SELECT min(k.{c}) FROM known k WHERE k.id = t.{sid}) ELSE t.{own} END AS {own}"""

    return pick("canonical_name", name), pick("canonical_id", sid)


_q(
    "unify_stations",
    ["ltrim", "stops"],
    STATIONS + f"SELECT t.* REPLACE ({', '.join([*unified('start'), *unified('end')])}) FROM ltrim t",
)
_q("legacy_rides", ["lfix_end"], "SELECT * FROM lfix_end")
_q("legacy_report", ["lreport"], "SELECT * FROM lreport")
_q(
    "within_join",
    ["st_member", "areas"],
    """SELECT p.start_station_name, p.member, p.n_trips, round(p.lng, 6) AS lng, round(p.lat, 6) AS lat, p.n_trips_k,
  a.area_id, a.community
FROM st_member p LEFT JOIN areas a ON """
    + within("p.lng", "p.lat"),
)
_q(
    "within_join_rides",
    ["rides", "areas"],
    """SELECT r.member, r.rideable_type, r.duration, r.start_station_name, r.start_lng, r.start_lat, a.area_id, a.community
FROM rides r LEFT JOIN areas a ON """
    + within("CAST(r.start_lng AS DOUBLE)", "CAST(r.start_lat AS DOUBLE)"),
)
_q("area_totals", ["st_member_all", "areas"], area_totals("st_member_all"))
_q("area_trips", ["st_member", "areas"], area_totals("st_member"))

# The bucketed method computes the same exact statistics.
SQL["boxplot_stats_bucketed"] = SQL["boxplot_stats"]
