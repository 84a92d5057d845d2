"""DuckDB oracle SQL for the registered queries.

The SQL is written independently of the Spark code from the operator
``trips`` and ``clean`` are CTEs that restate the events -> trips mapping.
"""
from __future__ import annotations

TRIPS = """trips AS (
  SELECT cast(event_id AS VARCHAR) AS ride_id,
         ts AS started_at,
         ts + to_microseconds(cast(round(value * 60000000) AS BIGINT)) AS ended_at,
         CASE WHEN user_id % 3 = 0 THEN 'casual' ELSE 'member' END AS member_casual,
         CASE WHEN event_type IN ('click', 'view') THEN 'classic_bike' ELSE 'electric_bike' END AS rideable_type,
         CASE WHEN k % 23 <> 0 THEN 'S' || lpad(cast(user_id % 20 AS VARCHAR), 2, '0') END AS start_station_id,
         CASE WHEN k % 23 <> 0 THEN 'Station ' || lpad(cast(user_id % 20 AS VARCHAR), 2, '0') END AS start_station_name,
         CASE WHEN k % 17 <> 0 THEN 'Station ' || lpad(cast(k % 20 AS VARCHAR), 2, '0') END AS end_station_name,
         CASE WHEN k % 31 <> 0 THEN cast(40.70 AS DOUBLE) + cast(0.001 AS DOUBLE) * (user_id % 20) END AS start_lat,
         CASE WHEN k % 31 <> 0 THEN cast(-74.00 AS DOUBLE) + cast(0.001 AS DOUBLE) * (user_id % 20) END AS start_lng
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e)"""

CLEAN = """clean AS (
  SELECT *, cast(hour(started_at) AS INTEGER) AS hour FROM (
    SELECT *, date_diff('microsecond', started_at, ended_at) / cast(60000000 AS DOUBLE) AS duration_min
    FROM trips) d
  WHERE duration_min > 1 AND duration_min < 240 AND started_at IS NOT NULL)"""

# station-hour counts, top 3 stations, hourly series and 28-lag features
LAGS = ",\n".join(f"lag(total_trips, {k}) OVER (PARTITION BY station_id ORDER BY start_hour) AS lag_{k}"
                  for k in range(1, 29))
LAG_NN = " AND ".join(f"lag_{k} IS NOT NULL" for k in range(1, 29))
LAG_COLS = ", ".join(f"lag_{k}" for k in range(1, 29))

FEATURES = f"""pop AS (
  SELECT start_station_id AS station_id, count(*) AS trips FROM trips
  WHERE start_station_id IS NOT NULL GROUP BY 1),
top AS (
  SELECT station_id, trips, cast(row_number() OVER (ORDER BY trips DESC, station_id) - 1 AS INTEGER) AS station_rank
  FROM pop ORDER BY trips DESC, station_id LIMIT 3),
series AS (
  SELECT date_trunc('hour', t.started_at) AS start_hour, t.start_station_id AS station_id,
         top.station_rank, count(*) AS total_trips
  FROM trips t JOIN top ON t.start_station_id = top.station_id
  WHERE t.started_at IS NOT NULL AND t.member_casual IS NOT NULL AND t.rideable_type IS NOT NULL
  GROUP BY 1, 2, 3),
lagged AS (
  SELECT *, {LAGS} FROM series),
features AS (
  SELECT start_hour, station_id, total_trips, station_rank, {LAG_COLS},
         cast(hour(start_hour) AS INTEGER) AS hour, cast(isodow(start_hour) - 1 AS INTEGER) AS day_of_week,
         cast(CASE WHEN isodow(start_hour) IN (6, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
         cast(month(start_hour) AS INTEGER) AS month
  FROM lagged WHERE {LAG_NN})"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def T(body: str) -> str:
    return with_ctes(body, TRIPS)


def C(body: str) -> str:
    return with_ctes(body, TRIPS, CLEAN)


def Fe(body: str) -> str:
    return with_ctes(body, TRIPS, FEATURES)


# ---------------------------------------------------------------- forecasting
def linear_expr(spec, lags: str = "lags", h: str = "h", d: str = "d", wk: str = "wk", m: str = "m",
                rank: str = "cast(station_rank AS DOUBLE)") -> str:
    """The linear model as SQL, same operation order as the Spark fold."""
    acc = f"cast({float(spec.intercept)!r} AS DOUBLE)"
    for k, w in enumerate(spec.lag_w, start=1):
        acc = f"({acc} + cast({float(w)!r} AS DOUBLE) * {lags}[{k}])"
    for w, c in ((spec.hour_w, h), (spec.dow_w, d), (spec.weekend_w, wk), (spec.month_w, m), (spec.rank_w, rank)):
        acc = f"({acc} + cast({float(w)!r} AS DOUBLE) * {c})"
    return f"greatest(cast(0.0 AS DOUBLE), {acc})"


def tree_expr(nodes, column) -> str:
    """An ensemble as SQL: a nested CASE for each tree; ``column`` names an input."""
    def below(tree: dict, n: int) -> str:
        _, _, left, right, feature, threshold, cats, negate, prediction, _ = tree[n]
        if left < 0:
            return f"cast({prediction!r} AS DOUBLE)"
        if cats is None:
            test = f"{column(feature)} <= {threshold!r}"
        else:
            test = f"{column(feature)} {'NOT IN' if negate else 'IN'} ({', '.join(map(repr, cats))})"
        return f"CASE WHEN {test} THEN {below(tree, left)} ELSE {below(tree, right)} END"

    trees: dict = {}
    for r in nodes:
        trees.setdefault(r[0], {})[r[1]] = r
    out = "cast(0.0 AS DOUBLE)"
    for tree in trees.values():
        out = f"({out} + cast({tree[0][9]!r} AS DOUBLE) * {below(tree, 0)})"
    return out


def tree_cover_sql(nodes) -> str:
    """For each input of an ensemble: nodes that split on it, feature rows that reach them, and its share of the splits."""
    parts = []
    for r in nodes:
        if r[2] < 0:
            continue
        tests, n = [], r[1]
        while n:  # the tests on the way down, from the node up
            up = next(x for x in nodes if x[0] == r[0] and n in (x[2], x[3]))
            feature, threshold, cats, negate = up[4:8]
            test = f"{feature} <= {threshold!r}" if cats is None else f"{feature} {'NOT IN' if negate else 'IN'} ({', '.join(map(repr, cats))})"
            tests.append(test if n == up[2] else f"NOT ({test})")
            n = up[1]
        parts.append(f"SELECT '{r[4]}' AS feature, count(*) AS rows FROM features WHERE {' AND '.join(tests) or 'true'}")
    return ("SELECT feature, count(*) AS splits, sum(rows)::BIGINT AS rows, round_even(count(*) / (sum(count(*)) OVER ()) * 100, 1) AS share FROM ("
            + " UNION ALL ".join(parts) + ") x GROUP BY feature")


def tree_forecast_sql(nodes, as_of: str, body: str) -> str:
    """``forecast_sql`` of an ensemble: inputs are the fold's lags and calendar."""
    names = {f"lag_{k}": f"lags[{k}]" for k in range(1, 29)} | {
        "hour": "h", "day_of_week": "d", "is_weekend": "wk", "month": "m", "station_rank": "cast(station_rank AS DOUBLE)"}
    model = f"greatest(cast(0.0 AS DOUBLE), {tree_expr(nodes, names.__getitem__)})"
    return "WITH RECURSIVE " + ",\n".join([TRIPS, FEATURES, forecast_ctes(None, as_of, model=model)]) + "\n" + body


def forecast_ctes(spec, as_of: str, mode: str = "reference", horizon: int = 24, bridge: bool = False, model: str | None = None) -> str:
    """CTEs ``st`` (last state per station) and ``fold`` (the recursive walk);
    use with ``WITH RECURSIVE`` after TRIPS and FEATURES."""
    lags0 = "[" + ", ".join(f"cast(lag_{k} AS DOUBLE)" for k in range(1, 29)) + "]"
    if mode == "aligned":
        lags0 = "[cast(total_trips AS DOUBLE), " + ", ".join(f"cast(lag_{k} AS DOUBLE)" for k in range(1, 28)) + "]"
    t = "base + to_hours(cast(j + 1 AS BIGINT))"
    cal_t = (f"cast(hour({t}) AS DOUBLE)", f"cast(isodow({t}) - 1 AS DOUBLE)",
             f"CASE WHEN isodow({t}) IN (6, 7) THEN 1.0 ELSE 0.0 END", f"cast(month({t}) AS DOUBLE)")
    pn = model or (linear_expr(spec) if mode == "reference" else linear_expr(spec, "lags", *cal_t))
    limit = "B" if bridge else f"B + {horizon}"
    return f"""st AS (
  SELECT *, greatest(G, 0) AS B, start_hour + to_hours(cast(least(G, 0) AS BIGINT)) AS base FROM (
    SELECT *, cast(trunc(date_diff('microsecond', start_hour, TIMESTAMP '{as_of}') / 3600000000.0) AS INTEGER) AS G
    FROM features QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY start_hour DESC) = 1) s),
fold AS (
  SELECT station_id, station_rank, B, base, 0 AS j, {lags0} AS lags,
         cast(hour AS DOUBLE) AS h, cast(day_of_week AS DOUBLE) AS d, cast(is_weekend AS DOUBLE) AS wk,
         cast(month AS DOUBLE) AS m, cast(NULL AS DOUBLE) AS p
  FROM st
  UNION ALL
  SELECT station_id, station_rank, B, base, j + 1, list_concat([{pn}], lags[1:27]),
         {cal_t[0]}, {cal_t[1]}, {cal_t[2]}, {cal_t[3]}, {pn}
  FROM fold WHERE j < {limit}),
preds AS (
  SELECT station_id, station_rank, j AS step, base + to_hours(cast(j AS BIGINT)) AS target_hour, p AS predicted_trips
  FROM fold WHERE {"j >= 1 AND j <= B" if bridge else "j > B"})"""


def forecast_sql(spec, as_of: str, body: str, mode: str = "reference", bridge: bool = False) -> str:
    return "WITH RECURSIVE " + ",\n".join([TRIPS, FEATURES, forecast_ctes(spec, as_of, mode, bridge=bridge)]) + "\n" + body


# ---------------------------------------------------------------- split-based evaluation
SPLIT = """split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY start_hour, station_rank) - 1 < floor(count(*) OVER () * 0.8)
                 THEN 'train' ELSE 'test' END AS split FROM features),
train AS (SELECT * FROM split WHERE split = 'train'),
test AS (SELECT * FROM split WHERE split = 'test'),
hm AS (SELECT hour, avg(total_trips) AS predicted FROM train GROUP BY hour),
scored AS (SELECT t.*, hm.predicted FROM test t LEFT JOIN hm USING (hour))"""


def Sp(body: str) -> str:
    return with_ctes(body, TRIPS, FEATURES, SPLIT)
