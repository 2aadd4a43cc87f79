"""The registered queries as SQL for another engine, over the same tables."""

from __future__ import annotations

TRIPS = """
base AS (
    SELECT l.*, o.o_orderdate,
        CASE WHEN l_partkey % 103 = 0 THEN 10 ELSE 1 END AS k,
        CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 ELSE 1 END AS sgn,
        (l_orderkey * 7919 + l_linenumber * 3571) % 86400 AS off,
        CAST(l_quantity * 75 - 150 AS BIGINT) AS dur
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
),
metered AS (
    SELECT *, (l_quantity - 1) * 0.37e0 * k AS trip_distance,
        2.0e0 + 2.5e0 * ((l_quantity - 1) * 0.37e0 * k) + l_tax * 40 AS meter
    FROM base
),
-- all line items; the training queries need no order
fares AS (
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_id,
        CAST(l_suppkey % 2 + 1 AS VARCHAR) AS vendorid,
        CASE WHEN l_partkey % 97 <> 0 THEN l_linenumber - 1 END AS passenger_count,
        trip_distance,
        sgn * meter AS fare_amount,
        sgn * meter * l_discount AS tip_amount,
        sgn * (meter * (1 + l_discount) + 1.3e0) AS total_amount,
        CASE WHEN l_partkey % 101 <> 0 THEN o_orderdate + to_seconds(off) END
            AS tpep_pickup_datetime,
        o_orderdate + to_seconds(off + dur) AS tpep_dropoff_datetime,
        l_orderkey, o_orderdate
    FROM metered
),
trips AS (SELECT * EXCLUDE (l_orderkey, o_orderdate) FROM fares WHERE o_orderdate IS NOT NULL),
timed AS (
    SELECT *, (CAST(floor(epoch(tpep_dropoff_datetime)) AS BIGINT)
        - CAST(floor(epoch(tpep_pickup_datetime)) AS BIGINT)) / 60.0e0 AS duration_min
    FROM trips
),
valid AS (
    SELECT * FROM timed WHERE trip_distance > 0 AND duration_min > 0 AND total_amount > 0
),
enriched AS (
    SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
        CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
        TIMESTAMP '2024-01-01 00:00:00' AS processed_at
    FROM trips WHERE tpep_pickup_datetime IS NOT NULL
)"""


def _settled(value: str, digits: int) -> str:
    """Rounding that does not depend on the order a sum was taken in."""
    return f"CAST(round(CAST({value} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


_REPORT = [
    ("total_trips", "count(*)"),
    ("total_revenue", _settled("sum(total_amount)", 2)),
    ("avg_cost_per_trip", _settled("avg(total_amount)", 2)),
    ("avg_distance_miles", _settled("avg(trip_distance)", 2)),
    ("avg_duration_min", _settled("avg(duration_min)", 1)),
    (
        "avg_speed_mph",
        _settled("sum(trip_distance) / nullif(sum(duration_min) / 60, 0)", 2),
    ),
    (
        "avg_tip_percent",
        _settled("sum(tip_amount) / nullif(sum(fare_amount), 0) * 100", 2),
    ),
]
_DROPPED = [
    ("total_distance_miles", _settled("sum(trip_distance)", 2)),
    ("avg_tip_amount", _settled("avg(tip_amount)", 2)),
]
_CALCULATED = [("calculated_at", "TIMESTAMP '2024-01-01 00:00:00'")]


def _daily(measures: list[tuple[str, str]], tail: str = "") -> str:
    columns = ", ".join(f"{sql} AS {name}" for name, sql in measures)
    return f"""WITH {TRIPS}
SELECT date_trunc('day', tpep_pickup_datetime) AS date, {columns}
FROM valid WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 1 {tail}"""


# A day is closed once it ended a day before the newest pickup time of a valid trip.
_CLOSED = """HAVING date_trunc('day', tpep_pickup_datetime) + INTERVAL 1 DAY <= (
    SELECT max(tpep_pickup_datetime) - INTERVAL 1 DAY FROM valid)"""


def _followed() -> str:
    columns = ", ".join(f"{sql} AS {name}" for name, sql in _REPORT + _DROPPED)
    return f"""WITH {TRIPS},
steps(step, most) AS (VALUES ('first', 2), ('late', 9), ('compacted', 9), ('followed', 9))
SELECT date_trunc('day', tpep_pickup_datetime) AS date, {columns}, step
FROM valid, steps WHERE tpep_pickup_datetime IS NOT NULL AND coalesce(passenger_count, -1) <= most
GROUP BY 1, step"""


_IN_RANGE = """trip_distance > 0 AND trip_distance <= 100
    AND {label} > 2.5 AND {label} < 200 AND passenger_count > 0 AND passenger_count <= 6"""

# A thousandth and 80 % of the hash range.
_SAMPLED = "00418937"
_IN_TRAIN = "md5(trip_id) < 'cccccccd'"


def _training(label: str = "fare_amount") -> str:
    return f"""{TRIPS},
training AS (
    SELECT trip_id, trip_distance, CAST(passenger_count AS DOUBLE) AS passenger_count,
        {label} AS label, {_IN_TRAIN} AS in_train
    FROM fares WHERE {_IN_RANGE.format(label=label)}
)"""


_MOMENTS = """
m AS (
    SELECT avg(trip_distance) AS mx, avg(passenger_count) AS mp, avg(label) AS my,
        stddev_pop(trip_distance) AS sx, stddev_pop(passenger_count) AS sp,
        stddev_pop(label) AS sy,
        corr(trip_distance, passenger_count) AS r,
        corr(trip_distance, label) AS rx, corr(passenger_count, label) AS rp
    FROM training WHERE in_train
)"""

# Ordinary least squares for two features, from correlations.
_OLS = f"""{_MOMENTS},
model AS (
    SELECT *, my - per_mile * mx - per_passenger * mp AS intercept FROM (
        SELECT *, (rx - r * rp) / (1 - r * r) * sy / sx AS per_mile,
            (rp - r * rx) / (1 - r * r) * sy / sp AS per_passenger
        FROM m)
)"""

# Elastic net for two standardized features, exactly. The optimum keeps each
# coefficient negative, zero or positive; for each of the nine choices the rest is
# linear, and only the optimum's own choice agrees with its signs and, where a
# coefficient is zero, with the bound on its gradient.
_ELASTIC_NET = f"""{_MOMENTS},
penalty AS (SELECT *, 0.5e0 * 0.1e0 / sy AS l1, 0.5e0 * 0.1e0 / sy AS l2 FROM m),
signs AS (SELECT * FROM (VALUES (-1), (0), (1)) a(sa), (VALUES (-1), (0), (1)) b(sb)),
candidate AS (
    SELECT *,
        CASE WHEN sa = 0 THEN 0
            WHEN sb = 0 THEN (rx - l1 * sa) / (1 + l2)
            ELSE ((1 + l2) * (rx - l1 * sa) - r * (rp - l1 * sb)) / ((1 + l2) * (1 + l2) - r * r)
        END AS ba,
        CASE WHEN sb = 0 THEN 0
            WHEN sa = 0 THEN (rp - l1 * sb) / (1 + l2)
            ELSE ((1 + l2) * (rp - l1 * sb) - r * (rx - l1 * sa)) / ((1 + l2) * (1 + l2) - r * r)
        END AS bb
    FROM penalty, signs
),
model AS (
    SELECT *, my - per_mile * mx - per_passenger * mp AS intercept FROM (
        SELECT *, ba * sy / sx AS per_mile, bb * sy / sp AS per_passenger FROM candidate
        WHERE sign(ba) = sa AND sign(bb) = sb
            AND (sa <> 0 OR abs(rx - r * bb) <= l1) AND (sb <> 0 OR abs(rp - r * ba) <= l1))
)"""

_PREDICTION = "per_mile * trip_distance + per_passenger * passenger_count + intercept"


def _model(kind: str, select: str) -> str:
    return f"WITH {_training()}, {kind} {select}"


def _coefficients(kind: str, digits: int) -> str:
    columns = ", ".join(
        f"{_settled(n, digits)} AS {n}" for n in ("intercept", "per_mile", "per_passenger")
    )
    return _model(kind, f"SELECT {columns} FROM model")


def _score_trips(kind: str) -> str:
    return _model(
        kind,
        f"""SELECT trip_id, label, {_settled(_PREDICTION, 3)} AS prediction
FROM training, model WHERE NOT in_train""",
    )


def _model_metrics(kind: str) -> str:
    return _model(
        kind,
        f"""SELECT count(*) AS n, {_settled("sqrt(avg(e * e))", 4)} AS rmse,
    {_settled("1 - sum(e * e) / (var_pop(label) * count(*))", 6)} AS r2
FROM (SELECT label, label - ({_PREDICTION}) AS e FROM training, model WHERE NOT in_train)""",
    )


def _score_cases(kind: str) -> str:
    return _model(
        kind,
        f"""SELECT description, CAST(d AS DOUBLE) AS trip_distance,
    CAST(p AS DOUBLE) AS passenger_count,
    {_settled("per_mile * d + per_passenger * p + intercept", 3)} AS prediction
FROM model, (VALUES
    (0.5e0, 1, 'Very short trip'), (1.0e0, 1, 'Short trip'), (2.0e0, 1, 'Average trip'),
    (5.0e0, 1, 'Medium trip'), (10.0e0, 1, 'Long trip'), (20.0e0, 1, 'Very long trip'),
    (5.0e0, 2, '5 miles, 2 passengers'), (5.0e0, 4, '5 miles, 4 passengers'),
    (1.0e0, 1, 'Example'), (3.0e0, 1, 'Example'), (5.0e0, 1, 'Example'),
    (10.0e0, 1, 'Example'), (20.0e0, 1, 'Example')) AS c(d, p, description)""",
    )


def _fare_curve(kind: str) -> str:
    return _model(
        kind,
        f"""SELECT i * 50.0e0 / 99 AS trip_distance,
    {_settled("per_mile * (i * 50.0e0 / 99) + per_passenger + intercept", 3)} AS prediction
FROM model, range(100) AS g(i)""",
    )


def _summary(kind: str, effects: str, shown: str = "") -> str:
    return _model(
        kind,
        f"""SELECT {_settled("intercept", 2)} AS base_fare, {_settled("per_mile", 2)} AS per_mile,
    {_settled("per_passenger", 2)} AS per_passenger,
    printf('Fare = $%.2f + $%.2f*distance', intercept, per_mile)
        || CASE WHEN abs(per_passenger) > min_effect THEN printf(' + $%.2f*passengers', per_passenger)
            ELSE '' END AS formula{shown}
FROM model, (VALUES {effects}) AS e(min_effect)""",
    )


_SUMMARY = _summary(_ELASTIC_NET, "(0.001e0)")
_SUMMARY_OLS = _summary(_OLS, "(0.001e0), (0.01e0)", ", min_effect")

# Standard errors of the unpenalised fit, from its residuals and the features' moments.
_OLS_ERRORS = _model(
    _OLS,
    f""", rest AS (
    SELECT count(*) AS n_rows, sum((label - ({_PREDICTION})) * (label - ({_PREDICTION}))) / (count(*) - 3) AS s2
    FROM training, model WHERE in_train),
e AS (SELECT *, s2 / (n_rows * (1 - r * r)) AS v FROM model, rest)
SELECT {_settled("intercept", 6)} AS intercept, {_settled("per_mile", 6)} AS per_mile,
    {_settled("per_passenger", 6)} AS per_passenger, n_rows,
    {_settled("sqrt(v) / sx", 8)} AS se_per_mile, {_settled("sqrt(v) / sp", 8)} AS se_per_passenger,
    {_settled("sqrt(s2 / n_rows + v * (mx * mx / (sx * sx) + mp * mp / (sp * sp) - 2 * r * mx * mp / (sx * sp)))", 8)}
        AS se_intercept
FROM e""",
)

# All columns of the raw layout; what the tables lack follows from the rest.
_SHOWN = """vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
    trip_distance, trip_distance - 74 AS pickup_longitude, trip_distance + 40 AS pickup_latitude,
    CAST(passenger_count + 1 AS INTEGER) AS ratecodeid,
    CASE WHEN vendorid = '1' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    trip_distance * 2 - 74 AS dropoff_longitude, trip_distance * 2 + 40 AS dropoff_latitude,
    CAST(CAST(vendorid AS INTEGER) + 1 AS INTEGER) AS payment_type, fare_amount,
    tip_amount + 1 AS extra, fare_amount * 2 AS mta_tax, tip_amount,
    total_amount * 4 AS tolls_amount, 0.25e0 AS improvement_surcharge, total_amount"""

_LAKE = f"WITH {TRIPS} SELECT {_SHOWN}, year, month FROM enriched"

_LISTING = """listing AS (
    SELECT DISTINCT concat('raw/', year(o_orderdate), '/', o_custkey) AS stem, o_custkey
    FROM orders
)"""


def oracle_sql() -> dict[str, str]:
    report = _daily(_REPORT + _CALCULATED, "ORDER BY date")
    return {
        "daily_stats": report,
        "daily_stats_full": _daily(_REPORT + _DROPPED + _CALCULATED),
        "first_days": _daily(_REPORT + _CALCULATED, "ORDER BY date LIMIT 5"),
        "monthly_counts": f"""WITH {TRIPS}
SELECT year, month, count(*) AS count FROM enriched GROUP BY year, month ORDER BY year, month""",
        "fare_correlation": f"""WITH {TRIPS}
SELECT {_settled("corr(trip_distance, fare_amount)", 6)} AS correlation FROM fares""",
        "dataset_counts": f"""WITH {_training()}
SELECT (SELECT count(*) FROM fares) AS n_trips, count(*) AS n_clean,
    count(*) FILTER (in_train) AS n_train, count(*) FILTER (NOT in_train) AS n_test
FROM training""",
        "enrich_trips": f"WITH {TRIPS} SELECT * FROM enriched",
        "trip_duration": f"WITH {TRIPS} SELECT trip_id, duration_min FROM timed",
        "valid_trips": f"WITH {TRIPS} SELECT * FROM valid WHERE tpep_pickup_datetime IS NOT NULL",
        "normalize_columns": "SELECT * FROM lineitem",
        "training_set": f"""WITH {_training()} SELECT * EXCLUDE (in_train) FROM training""",
        "training_set_fallback_label": f"""WITH {_training("total_amount")}
SELECT * EXCLUDE (in_train) FROM training""",
        "training_features": f"""WITH {_training()}
SELECT trip_id, label, CAST(2 AS INTEGER) AS n_features, trip_distance AS feature_distance,
    passenger_count AS feature_passengers
FROM training""",
        "train_test_split": f"""WITH {_training()}
SELECT trip_id, CASE WHEN in_train THEN 'train' ELSE 'test' END AS part FROM training""",
        "trip_sample": f"""WITH {TRIPS}
SELECT trip_id, trip_distance, fare_amount FROM fares WHERE md5(trip_id) < '{_SAMPLED}'""",
        "random_split": f"""WITH {_training()}
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_in_both, TRUE AS share_is_near FROM training""",
        "fare_model": _coefficients(_ELASTIC_NET, 4),
        "fare_model_ols": _OLS_ERRORS,
        "model_summary": _SUMMARY,
        "model_summary_ols": _SUMMARY_OLS,
        "score_trips": _score_trips(_ELASTIC_NET),
        "score_trips_ols": _score_trips(_OLS),
        "model_metrics": _model_metrics(_ELASTIC_NET),
        "model_metrics_ols": _model_metrics(_OLS),
        "score_cases": _score_cases(_ELASTIC_NET),
        "score_cases_ols": _score_cases(_OLS),
        "fare_curve": _fare_curve(_ELASTIC_NET),
        "fare_curve_ols": _fare_curve(_OLS),
        "model_roundtrip": _model(
            _OLS,
            f"""SELECT trip_id, {_settled(_PREDICTION, 3)} AS prediction
FROM training, model WHERE NOT in_train""",
        ),
        "csv_strict_scan": f"""WITH {TRIPS}
SELECT {_SHOWN} FROM trips
WHERE CAST(split_part(trip_id, '-', 1) AS BIGINT) % 13 NOT IN (1, 2, 3, 4)""",
        "load_clock": f"""WITH {TRIPS}
SELECT count(*) AS trips, TRUE AS one_time, TRUE AS in_time FROM enriched""",
        "trained_fares": _model(
            _ELASTIC_NET,
            f"""SELECT kept, n, {_settled("rmse", 4)} AS rmse, {_settled("r2", 4)} AS r2,
    {_settled("intercept", 4)} AS intercept, {_settled("per_mile", 4)} AS per_mile,
    {_settled("per_passenger", 4)} AS per_passenger
FROM model, (VALUES (TRUE), (FALSE)) AS k(kept), (
    SELECT count(*) AS n, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / (var_pop(label) * count(*)) AS r2
    FROM (SELECT label, label - ({_PREDICTION}) AS e FROM training, model WHERE NOT in_train))""",
        ),
        "load_account": f"""WITH {TRIPS},
numbered AS (SELECT CAST(split_part(trip_id, '-', 1) AS BIGINT) AS n FROM trips),
placed AS (SELECT n, CASE WHEN n % 13 = 2 THEN 5 ELSE n % 5 END AS source FROM numbered)
SELECT CAST(source AS BIGINT) AS source, CASE WHEN source = 5 THEN 'failed' ELSE 'loaded' END AS status,
    CAST(count(*) FILTER (n % 13 IN (1, 2, 3, 4)) AS BIGINT) AS dropped
FROM placed GROUP BY source""",
        "lake_scan": f"""WITH {TRIPS}
SELECT year, month, count(*) AS count FROM enriched
WHERE year * 100 + month BETWEEN 199611 AND 199903 GROUP BY year, month ORDER BY year, month""",
        "lake_write_roundtrip": f"WITH {TRIPS} SELECT * FROM enriched",
        "stats_write_roundtrip": report,
        "new_files": f"""WITH {_LISTING}
SELECT stem || '.csv' AS path, length(stem) AS length FROM listing WHERE o_custkey % 3 <> 0""",
        "absent_files": f"""WITH {_LISTING},
named AS (SELECT stem || '.csv' AS path, o_custkey || '.csv' AS name FROM listing)
SELECT path, name FROM named WHERE path >= 'raw/1998'
    AND name NOT IN (SELECT name FROM named WHERE path < 'raw/1998')""",
        "new_data_gate": f"""WITH {TRIPS}
SELECT count(DISTINCT coalesce(passenger_count, -1)) AS sources_found, TRUE AS open_before,
    TRUE AS open_after_load, FALSE AS open_after_publish, CAST(0 AS BIGINT) AS files_left
FROM trips""",
        "indexed_listing": f"""WITH {TRIPS},
parts AS (SELECT coalesce(passenger_count, -1) AS source,
    CASE WHEN source < 2 OR (source = 2 AND CAST(split_part(trip_id, '-', 1) AS BIGINT) % 2 = 1)
        THEN 1 ELSE 2 END AS part, tpep_pickup_datetime IS NOT NULL AS has_time FROM trips),
steps AS (SELECT CAST(step AS BIGINT) AS step, 1 + count(DISTINCT source) FILTER (part <= step) AS folders,
    1 + count(DISTINCT source) FILTER (part = step) AS changed, count(*) FILTER (part <= step AND has_time) AS trips
    FROM parts, (VALUES (1), (2), (3)) AS v(step) GROUP BY ALL)
SELECT step, folders, CASE WHEN step < 3 THEN changed ELSE 0 END AS listed, CAST(0 AS BIGINT) AS unlike, trips
FROM steps""",
        "ledger_append": _LAKE,
        "stream_ingest": _LAKE,
        "announced_stream": _LAKE,
        "compacted_lake": _LAKE,
        "compacted_report": report,
        "concurrent_loads": _LAKE,
        "followed_ledger": _followed(),
        "stream_daily_stats": _daily(_REPORT + _DROPPED),
        "stream_closed_days": _daily(_REPORT + _DROPPED, _CLOSED),
        "dead_batch_hidden": f"""WITH {TRIPS}
SELECT {_SHOWN}, year, month, via FROM enriched, (VALUES ('batch'), ('stream')) AS v(via)""",
        "incremental_report": report,
        "updated_report": f"""WITH {TRIPS},
parts AS (SELECT date_trunc('day', tpep_pickup_datetime) AS day,
    CASE WHEN CAST(split_part(trip_id, '-', 1) AS BIGINT) % 17 = 0 THEN 3
        ELSE year(tpep_pickup_datetime) % 2 + 1 END AS part
    FROM valid WHERE tpep_pickup_datetime IS NOT NULL)
SELECT CAST(step AS BIGINT) AS step, count(DISTINCT day) FILTER (part <= step) AS days,
    count(DISTINCT day) FILTER (part = step) AS rewritten, count(*) FILTER (part <= step) AS trips
FROM parts, (VALUES (1), (2), (3)) AS v(step) GROUP BY ALL""",
        "daily_run": f"""WITH days AS ({_daily(_REPORT)})
SELECT count(*) AS days, CAST(sum(total_trips) AS BIGINT) AS trips, {_settled("sum(total_revenue)", 2)} AS revenue,
    CAST(1 AS BIGINT) AS files_failed, TRUE AS open_before, TRUE AS open_after_load,
    FALSE AS open_after_publish, TRUE AS second_run_idle, TRUE AS model_tested
FROM days""",
    }
