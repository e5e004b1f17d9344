"""DuckDB SQL for the registered queries, written from the store's semantics.

The queries share views of the driver tables as common table expressions. They use row numbers
and correlated picks where the Spark side folds, and integer rounding where the Spark side uses
decimals, so that the two sides are independent.
"""

from __future__ import annotations

from parceltide import constants as K


def _sql(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_sql(v) for v in row) + ")" for row in rows)


# --- fixed values: mapping of the driver tables, thresholds and names as the store has them, here and below ---
_ROUTE_MINUTES = (270, 450, 360, 150, 210, 240, 300)

_CTE = {
    "hubs": f"""hubs(hub_id, hub_name, city, latitude, longitude, capacity) AS (
        SELECT column0, column1, column2, column3::DOUBLE, column4::DOUBLE, column5
        FROM (VALUES {_values(K.HUB_SEED)}) AS t(column0, column1, column2, column3, column4, column5))""",
    "routes": f"""routes(idx, route_id, origin, destination, distance_km, avg_duration_h, avg_min, base_risk) AS (
        VALUES {_values((i, r[0], r[1], r[2], r[3], r[4], _ROUTE_MINUTES[i], K.ROUTE_RISK[r[0]])
                        for i, r in enumerate(K.ROUTE_SEED))})""",
    "weather": f"""weather(name, factor10) AS (
        VALUES ('clear', 10), ('rain', 13), ('fog', 12), ('snow', 18), ('storm', 25))""",
    "mapped": """mapped AS (
        SELECT o.*, r.route_id, r.avg_min, ho.hub_id AS hub_id, hd.hub_id AS dest_hub_id,
               ho.latitude AS o_lat, ho.longitude AS o_lon, hd.latitude AS d_lat, hd.longitude AS d_lon,
               'FR' || CAST(o_orderkey + 100000 AS VARCHAR) AS parcel_id,
               'CLIENT_' || substr('ABCDE', CAST(o_custkey % 5 AS INTEGER) + 1, 1) AS client_id,
               (o_orderkey * 37 + 11) % 101 AS c,
               o_orderdate + to_minutes((o_orderkey * 53) % 1440) AS planned_pickup,
               CASE WHEN o_orderkey % 20 <= 9 THEN 'clear' WHEN o_orderkey % 20 <= 14 THEN 'rain'
                    WHEN o_orderkey % 20 <= 16 THEN 'fog' WHEN o_orderkey % 20 <= 18 THEN 'snow'
                    ELSE 'storm' END AS weather_condition
        FROM orders o JOIN routes r ON r.idx = o_orderkey % 7
        JOIN hubs ho ON ho.city = r.origin JOIN hubs hd ON hd.city = r.destination)""",
    "timed": """timed AS (
        SELECT m.*, (avg_min * factor10 * (1000 + 3 * c)) // 10000 AS dur
        FROM mapped m JOIN weather w ON w.name = m.weather_condition)""",
    "planned": """planned AS (
        SELECT parcel_id, client_id, route_id, hub_id, dest_hub_id, planned_pickup,
               planned_pickup + to_minutes(dur) AS planned_delivery, weather_condition,
               c / 100.0::DOUBLE AS congestion_level,
               CAST(200 + (o_orderkey * 61) % 700 AS DOUBLE) AS distance_km,
               (10 + (o_orderkey * 7919) % 4991) / 100.0::DOUBLE AS weight_kg
        FROM timed WHERE o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW')""",
    "lines": """lines AS (
        SELECT t.*, l_linenumber AS ln, ((l_partkey * 31 + l_suppkey * 17) % 241) - 60 AS d
        FROM lineitem JOIN timed t ON l_orderkey = o_orderkey)""",
    "shifted": """shifted AS (
        SELECT parcel_id,
               ['accepted', 'pickup', 'in_transit', 'delivered', 'delivered', 'pickup', 'scan'][ln] AS event_type,
               planned_pickup + to_minutes(CASE ln WHEN 1 THEN -60 WHEN 2 THEN d WHEN 3 THEN d + dur * 2 // 5
                   WHEN 4 THEN dur + d WHEN 5 THEN dur + d + 5 WHEN 6 THEN d + 5 ELSE dur + d + 70 END) AS event_timestamp,
               CASE WHEN ln IN (4, 5, 7) THEN dest_hub_id ELSE hub_id END AS hub_id,
               CASE WHEN ln IN (4, 5, 7) THEN d_lat ELSE o_lat END AS latitude,
               CASE WHEN ln IN (4, 5, 7) THEN d_lon ELSE o_lon END AS longitude
        FROM lines)""",
    "ev": """ev AS (
        SELECT 'EV-' || parcel_id || '-' || upper(substr(event_type, 1, 3)) || '-' || CAST(epoch_ms(event_timestamp) AS VARCHAR) AS event_id,
               parcel_id, event_type, event_timestamp, hub_id, latitude, longitude
        FROM shifted)""",
    "joined": """joined AS (
        SELECT e.*, p.client_id, p.route_id, p.planned_pickup, p.planned_delivery,
               p.parcel_id IS NOT NULL AS known,
               CASE WHEN e.event_type = 'pickup' AND p.parcel_id IS NOT NULL
                    THEN epoch_us(e.event_timestamp) - epoch_us(p.planned_pickup)
                    WHEN e.event_type = 'delivered' AND p.parcel_id IS NOT NULL
                    THEN epoch_us(e.event_timestamp) - epoch_us(p.planned_delivery)
                    ELSE 0 END / 60000000.0::DOUBLE AS delay_minutes
        FROM ev e LEFT JOIN planned p ON p.parcel_id = e.parcel_id)""",
    "numbered": """numbered AS (
        SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY event_timestamp DESC, event_id DESC) AS nth
        FROM joined WHERE known)""",
    "mapped_last": """mapped_last AS (
        SELECT parcel_id, event_type FROM (
            SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY event_timestamp DESC, event_id DESC) AS k
            FROM joined WHERE known AND event_type <> 'scan') WHERE k = 1)""",
    "actual": """actual AS (
        SELECT parcel_id, max(event_timestamp) FILTER (event_type = 'pickup') AS actual_pickup,
               max(event_timestamp) FILTER (event_type = 'delivered') AS actual_delivery
        FROM ev GROUP BY parcel_id)""",
    "golden": """golden AS (
        SELECT *, CASE WHEN delay_minutes <= 15 THEN 'low' WHEN delay_minutes <= 60 THEN 'medium' ELSE 'high' END AS risk_level,
               CASE WHEN delay_minutes <= 0 THEN 0.0::DOUBLE
                    WHEN delay_minutes <= 15 THEN least(0.3::DOUBLE, delay_minutes / 50)
                    WHEN delay_minutes <= 60 THEN least(1.0::DOUBLE, 0.3::DOUBLE + (delay_minutes - 15) / 90)
                    ELSE least(1.0::DOUBLE, 0.7::DOUBLE + (delay_minutes - 60) / 150) END AS risk_probability
        FROM (SELECT p.parcel_id, p.client_id, p.route_id,
                     CASE WHEN n.parcel_id IS NULL THEN p.hub_id ELSE n.hub_id END AS hub_id,
                     CASE m.event_type WHEN 'accepted' THEN 'accepted' WHEN 'pickup' THEN 'picked_up'
                          WHEN 'in_transit' THEN 'in_transit' WHEN 'delivered' THEN 'delivered'
                          ELSE 'planned' END AS status,
                     p.planned_pickup, a.actual_pickup, p.planned_delivery, a.actual_delivery,
                     coalesce(n.delay_minutes, 0.0::DOUBLE) AS delay_minutes,
                     p.weather_condition, p.congestion_level
              FROM planned p LEFT JOIN (SELECT * FROM numbered WHERE nth = 1) n USING (parcel_id)
              LEFT JOIN mapped_last m USING (parcel_id) LEFT JOIN actual a USING (parcel_id)))""",
    "al": """al AS (
        SELECT 'ALT-' || parcel_id || '-' || CAST(epoch_us(event_timestamp) // 1000000 AS VARCHAR) AS alert_id,
               parcel_id, 'delay_detected' AS alert_type,
               CASE WHEN delay_minutes > 120 THEN 'critical' WHEN delay_minutes > 60 THEN 'high'
                    WHEN delay_minutes > 30 THEN 'medium' ELSE 'low' END AS severity,
               round_even(delay_minutes, 1) AS delay_min, event_type, hub_id, client_id, route_id,
               'Colis ' || parcel_id || ' en retard de ' || CAST(CAST(round_even(delay_minutes, 0) AS BIGINT) AS VARCHAR)
                   || ' min (' || event_type || ')' AS message,
               event_timestamp AS created_at, FALSE AS acknowledged
        FROM joined WHERE known AND delay_minutes > 15)""",
}
_CTE.update({
    # The plan joined to its pickups and deliveries row by row, as the training files are.
    "pairs": """pairs AS (
        SELECT p.*, u.event_timestamp AS actual_pickup, d.event_timestamp AS actual_delivery,
               coalesce((epoch_us(d.event_timestamp) - epoch_us(p.planned_delivery)) / 60000000.0::DOUBLE, 0.0::DOUBLE) AS delay_minutes
        FROM planned p
        LEFT JOIN (SELECT * FROM ev WHERE event_type = 'pickup') u ON u.parcel_id = p.parcel_id
        LEFT JOIN (SELECT * FROM ev WHERE event_type = 'delivered') d ON d.parcel_id = p.parcel_id)""",
    "labelled": """labelled AS (
        SELECT *, CASE WHEN delay_minutes <= 15 THEN 0 WHEN delay_minutes <= 60 THEN 1 ELSE 2 END AS risk_label FROM pairs)""",
    "train": """train AS (
        SELECT parcel_id, max(actual_pickup) AS actual_pickup, actual_delivery, delay_minutes, risk_label, count(*) AS copies
        FROM labelled GROUP BY parcel_id, actual_delivery, delay_minutes, risk_label)""",
    "ordered": """ordered AS (
        SELECT *, row_number() OVER (PARTITION BY risk_label ORDER BY md5(parcel_id || '|' ||
                      coalesce(strftime(actual_delivery, '%Y-%m-%d %H:%M:%S'), '-') || '|42')) - 1 AS group_rank,
               count(*) OVER (PARTITION BY risk_label) AS group_size
        FROM train)""",
    "enc": """enc AS (
        SELECT 'route_id' AS "column", v AS value, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT coalesce(route_id, 'unknown') AS v FROM planned)
        UNION ALL SELECT 'weather_condition', v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) FROM (SELECT DISTINCT coalesce(weather_condition, 'clear') AS v FROM planned)
        UNION ALL SELECT 'client_id', v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) FROM (SELECT DISTINCT coalesce(client_id, 'unknown') AS v FROM planned)
        UNION ALL SELECT 'hub_id', v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) FROM (SELECT DISTINCT coalesce(hub_id, 'unknown') AS v FROM planned))""",
    "scored": f"""scored AS (
        SELECT p.*, least(1.0::DOUBLE, base * factor * (1 + congestion_level * 0.5::DOUBLE)) AS score
        FROM planned p
        JOIN (VALUES {_values((r, v) for r, v in K.ROUTE_RISK.items())}) AS b(route, base0) ON b.route = p.route_id
        JOIN (VALUES {_values((w, v) for w, v in K.WEATHER_FACTOR.items())}) AS f(weather, factor0) ON f.weather = p.weather_condition,
        LATERAL (SELECT CAST(base0 AS DOUBLE) AS base, CAST(factor0 AS DOUBLE) AS factor))""",
    "levels": """levels AS (
        SELECT *, CASE WHEN score < 0.35::DOUBLE THEN 0 WHEN score < 0.65::DOUBLE THEN 1 ELSE 2 END AS level FROM scored)""",
    "judged": """judged AS (
        SELECT l.risk_label AS label, v.level AS prediction FROM labelled l JOIN levels v USING (parcel_id))""",
})
_NEEDS = {
    "mapped": ["hubs", "routes"], "timed": ["mapped", "weather"], "planned": ["timed"],
    "lines": ["timed"], "shifted": ["lines"], "ev": ["shifted"], "joined": ["ev", "planned"],
    "numbered": ["joined"], "mapped_last": ["joined"], "actual": ["ev"],
    "golden": ["numbered", "mapped_last", "actual"], "al": ["joined"],
    "pairs": ["planned", "ev"], "labelled": ["pairs"], "train": ["labelled"], "ordered": ["train"],
    "enc": ["planned"], "scored": ["planned"], "levels": ["scored"], "judged": ["labelled", "levels"],
}


def _with(*names: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(_CTE[n] for n in ordered) + "\n"


def _q(*names: str, sql: str) -> str:
    return _with(*names) + sql


# Half-up rounding to one place in integers; hits and total are counts.
def _pct(hits: str) -> str:
    return (f"CASE WHEN count(*) = 0 THEN NULL ELSE "
            f"((2000 * count(*) FILTER ({hits}) + count(*)) // (2 * count(*))) / 10.0::DOUBLE END")


_AVG = "CAST(round(CAST(avg(delay_minutes) AS DECIMAL(38, 15)), 1) AS DOUBLE)"
_ONTIME = _pct("delay_minutes <= 15")
_N = "count(*) FILTER ({})".format

_KPI = f"""SELECT count(*) AS total_parcels, {_N("status = 'delivered'")} AS delivered,
    {_N("status NOT IN ('delivered', 'planned')")} AS in_transit, {_N('delay_minutes > 15')} AS delayed,
    {_N("risk_level = 'high'")} AS high_risk, {_AVG} AS avg_delay_min, {_ONTIME} AS on_time_pct FROM golden"""

_HUB_RISK = f"""SELECT hub_id, count(*) AS total, {_N("risk_level = 'high'")} AS high_risk,
    {_N("risk_level = 'medium'")} AS medium_risk, {_AVG} AS avg_delay, {_ONTIME} AS on_time_pct
    FROM golden GROUP BY hub_id"""

_STATE_COLUMNS = """parcel_id, client_id, route_id, hub_id, status, planned_pickup, actual_pickup,
    planned_delivery, actual_delivery, delay_minutes, risk_level, risk_probability,
    weather_condition, congestion_level"""

_ALERT_PAGE = """SELECT a.alert_id, a.parcel_id, a.alert_type, a.severity, a.message, a.created_at,
    a.acknowledged, g.hub_id, g.client_id, g.route_id
    FROM al a LEFT JOIN golden g ON g.parcel_id = a.parcel_id WHERE NOT a.acknowledged
    ORDER BY a.created_at DESC, a.alert_id, a.message LIMIT 20"""

_RAW = """'{"event_id":"' || event_id || '","parcel_id":"' || parcel_id || '","event_type":"' || event_type
    || '","event_timestamp":"' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') || '","hub_id":"' || hub_id
    || '","latitude":' || CAST(latitude AS VARCHAR) || ',"longitude":' || CAST(longitude AS VARCHAR) || '}'"""

_DEAD = f"""SELECT 'delivery_events' AS topic,
    '{{"reason":"unknown_parcel","parcel_id":"' || parcel_id || '","event_type":"' || event_type || '","raw":' || {_RAW} || '}}' AS raw_message,
    'unknown_parcel' AS error_reason, event_timestamp AS created_at
    FROM ev WHERE NOT EXISTS (SELECT 1 FROM planned p WHERE p.parcel_id = ev.parcel_id)"""


# Three decimals of a double, correctly rounded: the split product's error settles ties.
_SCORE_3 = """(CASE WHEN p - floor(p) = 0.5 AND err > 0 THEN ceil(p) WHEN p - floor(p) = 0.5 AND err < 0 THEN floor(p)
    ELSE round_even(p, 0) END) / 1000.0::DOUBLE"""

_FEATURES = """SELECT parcel_id, r.idx AS route_enc, w.idx AS weather_enc, c.idx AS client_enc, h.idx AS hub_enc,
    congestion_level, distance_km, weight_kg, CAST(hour(planned_pickup) AS INTEGER) AS hour_of_day,
    CAST(isodow(planned_pickup) - 1 AS INTEGER) AS day_of_week, CASE WHEN isodow(planned_pickup) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    hours AS planned_duration_h, w.idx * congestion_level AS weather_congestion,
    distance_km / CASE WHEN hours = 0 THEN 1 ELSE hours END AS distance_per_hour,
    CAST(congestion_level > 0.7::DOUBLE AS INTEGER) AS high_congestion,
    CAST(weather_condition IN ('snow', 'storm') AS INTEGER) AS severe_weather, CAST(weight_kg > 30 AS INTEGER) AS heavy_parcel,
    CAST(weather_condition = 'rain' AS INTEGER) AS weather_rain, CAST(weather_condition = 'fog' AS INTEGER) AS weather_fog,
    CAST(weather_condition = 'snow' AS INTEGER) AS weather_snow, CAST(weather_condition = 'storm' AS INTEGER) AS weather_storm,
    congestion_level * congestion_level AS congestion_sq, risk AS weather_risk_score, risk * (1 + congestion_level) AS composite_risk
    FROM (SELECT *, (epoch_us(planned_delivery) - epoch_us(planned_pickup)) / 60000000.0::DOUBLE / 60 AS hours,
                 CASE weather_condition WHEN 'rain' THEN 0.3::DOUBLE WHEN 'fog' THEN 0.2::DOUBLE WHEN 'snow' THEN 0.8::DOUBLE
                      WHEN 'storm' THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END AS risk FROM planned) p
    JOIN enc r ON r."column" = 'route_id' AND r.value = p.route_id
    JOIN enc w ON w."column" = 'weather_condition' AND w.value = p.weather_condition
    JOIN enc c ON c."column" = 'client_id' AND c.value = p.client_id
    JOIN enc h ON h."column" = 'hub_id' AND h.value = p.hub_id"""

_REPORT = """, per AS (
    SELECT k.cls, k.name, count(*) FILTER (label = k.cls) AS support, count(*) FILTER (prediction = k.cls) AS predicted,
           count(*) FILTER (label = k.cls AND prediction = k.cls) AS hits
    FROM judged, (VALUES (0, 'low'), (1, 'medium'), (2, 'high')) AS k(cls, name) GROUP BY k.cls, k.name),
rated AS (
    SELECT *, CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0 END AS p, CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS r
    FROM per WHERE support > 0 OR predicted > 0),
done AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM rated)
SELECT name AS class, p AS precision, r AS recall, f AS f1, support::DOUBLE AS support FROM done
UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT sum(hits) / sum(support)::DOUBLE AS a, sum(support)::DOUBLE AS n FROM done)
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support)::DOUBLE FROM done
UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support),
    sum(support)::DOUBLE FROM done"""

_EVENT = "event_id, parcel_id, event_type, event_timestamp, hub_id, latitude, longitude"
_TIMELINE = """SELECT date_trunc('hour', event_timestamp)::TIMESTAMP AS hour, event_type, count(*) AS count
            FROM ev GROUP BY ALL"""


_UPSERTED = """SELECT t.parcel_id, coalesce(g.client_id, t.client_id) AS client_id, coalesce(g.route_id, t.route_id) AS route_id,
            coalesce(g.hub_id, t.hub_id) AS hub_id, 'planned' AS status, t.planned_pickup + INTERVAL 30 MINUTE AS planned_pickup, g.actual_pickup,
            t.planned_pickup + to_minutes(t.dur + 30) AS planned_delivery, g.actual_delivery, coalesce(g.delay_minutes, 0) AS delay_minutes,
            coalesce(g.risk_level, 'low') AS risk_level, coalesce(g.risk_probability, 0) AS risk_probability, 'fog' AS weather_condition,
            t.c / 100.0::DOUBLE AS congestion_level FROM timed t LEFT JOIN golden g ON g.parcel_id = t.parcel_id"""


_LATE_NORMALISED = """SELECT parcel_id, client_id, hub_id, route_id, status, delay_minutes, risk_level,
            strftime(planned_delivery, '%Y-%m-%dT%H:%M:%S') AS planned_delivery,
            strftime(actual_delivery, '%Y-%m-%dT%H:%M:%S') AS actual_delivery FROM golden WHERE delay_minutes > 15
            ORDER BY delay_minutes DESC, parcel_id LIMIT 20"""


def oracle_sql() -> dict[str, str]:
    g, j = "golden", "joined"
    return {
        # sources
        "scan_planned": _q("planned", sql="SELECT * FROM planned"),
        "scan_events": _q("ev", sql="SELECT event_id, parcel_id, event_type, event_timestamp, hub_id, latitude, longitude FROM ev"),
        # correlation
        "correlate_events": _q(j, sql="SELECT * FROM joined"),
        "event_delay": _q(j, sql="SELECT event_id, parcel_id, event_type, delay_minutes FROM joined WHERE known"),
        "golden_record": _q(g, sql=f"SELECT {_STATE_COLUMNS} FROM golden"),
        "risk_score": _q(g, sql="SELECT parcel_id, delay_minutes, risk_level, risk_probability FROM golden"),
        "alerts": _q("al", sql="SELECT * FROM al"),
        "dead_letters": _q("ev", "planned", sql=_DEAD),
        "recent_errors": _q("ev", "planned", sql=f"SELECT * FROM ({_DEAD}) ORDER BY created_at DESC, raw_message LIMIT 20"),
        "events_log": _q("ev", sql=f"SELECT parcel_id, event_type, event_timestamp, hub_id, latitude, longitude, {_RAW} AS raw_payload FROM ev"),
        "message_counts": _q(j, sql="""SELECT (SELECT count(*) FROM planned) AS planned, count(*) AS events,
            count(*) FILTER (known AND delay_minutes > 15) AS alerts, count(*) FILTER (NOT known) AS errors FROM joined"""),
        "event_span": _q("ev", sql="SELECT count(*) AS events, min(event_timestamp) AS first_event, max(event_timestamp) AS last_event FROM ev"),
        "dedup_events": _q("ev", sql="SELECT DISTINCT * FROM ev"),
        # parcels
        "delayed_parcels": _q(g, sql="""SELECT parcel_id, client_id, hub_id, route_id, status, delay_minutes, risk_level,
            planned_delivery, actual_delivery FROM golden WHERE delay_minutes > 15
            ORDER BY delay_minutes DESC, parcel_id LIMIT 20"""),
        "at_risk_parcels": _q(g, sql="""SELECT parcel_id, client_id, hub_id, route_id, status, risk_level, risk_probability,
            delay_minutes FROM golden WHERE risk_level IN ('medium', 'high') AND status <> 'delivered'
            ORDER BY risk_probability DESC, delay_minutes DESC, parcel_id LIMIT 20"""),
        "risk_or_late_parcels": _q(g, sql="""SELECT parcel_id, client_id, hub_id, route_id, status, risk_level,
            CAST(round(CAST(delay_minutes AS DECIMAL(38, 15)), 0) AS DOUBLE) AS delay_min, planned_delivery FROM golden
            WHERE risk_level IN ('medium', 'high') OR delay_minutes > 15 ORDER BY delay_min DESC, parcel_id LIMIT 50"""),
        "client_parcels": _q(g, sql="""SELECT parcel_id, hub_id, route_id, status, risk_level, delay_minutes, planned_delivery
            FROM golden WHERE client_id = 'CLIENT_B' ORDER BY delay_minutes DESC, parcel_id LIMIT 20"""),
        # aggregates
        "kpi_summary": _q(g, sql=_KPI),
        "kpi_sla": _q(g, sql=f"""SELECT coalesce(on_time_pct, 0) AS on_time_pct, 95.0::DOUBLE AS sla_target_pct,
            round(coalesce(on_time_pct, 0) - 95, 1) AS sla_gap_pct FROM ({_KPI})"""),
        "hub_stats": _q(g, sql=f"""SELECT hub_id, count(*) AS total_parcels, {_N("status = 'delivered'")} AS delivered,
            {_N('delay_minutes > 15')} AS delayed, {_N("risk_level = 'high'")} AS high_risk, {_AVG} AS avg_delay_min,
            {_ONTIME} AS on_time_pct FROM golden GROUP BY hub_id ORDER BY high_risk DESC, avg_delay_min DESC, hub_id LIMIT 20"""),
        "hub_map": _q(g, "hubs", sql=f"""SELECT h.hub_id, h.hub_name, h.latitude, h.longitude, s.total, s.high_risk, s.medium_risk,
            s.avg_delay, s.on_time_pct, CASE WHEN s.high_risk > 5 THEN 'red' WHEN s.medium_risk > 10 THEN 'orange' ELSE 'green' END AS colour
            FROM hubs h LEFT JOIN ({_HUB_RISK}) s USING (hub_id)"""),
        "route_stats": _q(g, sql=f"""SELECT route_id, count(*) AS total, {_AVG} AS avg_delay_min, {_N("risk_level = 'high'")} AS high_risk_count,
            {_ONTIME} AS on_time_pct FROM golden GROUP BY route_id ORDER BY avg_delay_min DESC, route_id LIMIT 20"""),
        "route_delays": _q(g, sql=f"""SELECT route_id, {_AVG} AS avg_delay, {_N('delay_minutes > 15')} AS delayed_count,
            {_ONTIME} AS on_time_pct FROM golden WHERE route_id IS NOT NULL GROUP BY route_id"""),
        "route_lines": _q(g, "routes", "hubs", sql="""SELECT r.route_id, a.hub_id AS from_hub, a.latitude AS from_lat, a.longitude AS from_lon,
            b.hub_id AS to_hub, b.latitude AS to_lat, b.longitude AS to_lon,
            (SELECT count(*) FROM golden WHERE golden.route_id = r.route_id) AS parcels
            FROM routes r JOIN hubs a ON a.city = r.origin JOIN hubs b ON b.city = r.destination"""),
        "risk_distribution": _q(g, sql="SELECT risk_level, count(*) AS count FROM golden GROUP BY risk_level"),
        "parcels_by_status": _q(g, sql="""SELECT status, risk_level, count(*) AS count FROM golden GROUP BY status, risk_level
            ORDER BY count DESC, status, risk_level LIMIT 20"""),
        # alerts and events
        "recent_alerts": _q(g, "al", sql=_ALERT_PAGE),
        "active_alerts": _q(g, "al", sql=f"SELECT severity, message, created_at, hub_id, client_id FROM ({_ALERT_PAGE})"),
        "alert_feed": _q(g, "al", sql=f"""SELECT CASE WHEN severity IN ('critical', 'high', 'medium', 'low') THEN severity ELSE 'low' END AS severity,
            CASE WHEN severity IN ('critical', 'high') THEN '🔴' WHEN severity = 'medium' THEN '🟠' ELSE '🟢' END AS icon,
            coalesce(hub_id, '?') AS hub_id, coalesce(client_id, '?') AS client_id, left(message, 80) AS message,
            strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM ({_ALERT_PAGE})"""),
        "event_journal": _q("ev", sql="""SELECT parcel_id, event_type, event_timestamp, hub_id, latitude, longitude FROM ev
            WHERE event_type = 'delivered' AND hub_id = 'HUB_LYON' ORDER BY event_timestamp DESC, parcel_id, event_type, hub_id LIMIT 50"""),
        "event_timeline": _q("ev", sql=_TIMELINE),
        "normalise_result": _q(g, sql=_LATE_NORMALISED),
        # sources and sinks
        "clean_columns": "SELECT * FROM customer",
        "flatten_pages": "SELECT c_custkey, c_name, c_acctbal FROM customer",
        "seed_dimensions": f"""WITH stored AS (SELECT DISTINCT 'CLIENT_' || c_mktsegment[1] AS client_id, c_mktsegment AS client_name,
                24.0::DOUBLE AS sla_hours, 1 AS priority FROM customer),
            seed AS (SELECT column0 AS client_id, column1 AS client_name, column2::DOUBLE AS sla_hours, column3 AS priority
                FROM (VALUES {_values(K.CLIENT_SEED)}) AS t(column0, column1, column2, column3))
            SELECT * FROM stored UNION ALL SELECT * FROM seed WHERE client_id NOT IN (SELECT client_id FROM stored)""",
        "seed_hubs": f"""WITH stored AS (SELECT CASE WHEN n_nationkey % 5 = 0
                THEN [{", ".join(_sql(r[0]) for r in K.HUB_SEED)}][n_nationkey // 5 + 1] ELSE 'HUB_' || n_name END AS hub_id,
                n_name AS hub_name, n_name AS city, n_nationkey::DOUBLE AS latitude, n_regionkey::DOUBLE AS longitude,
                1000 AS capacity FROM nation),
            seed AS (SELECT column0 AS hub_id, column1 AS hub_name, column2 AS city, column3::DOUBLE AS latitude,
                column4::DOUBLE AS longitude, column5 AS capacity
                FROM (VALUES {_values(K.HUB_SEED)}) AS t(column0, column1, column2, column3, column4, column5))
            SELECT * FROM stored UNION ALL SELECT * FROM seed WHERE hub_id NOT IN (SELECT hub_id FROM stored)""",
        "seed_routes": f"""WITH stored AS (SELECT CASE WHEN n_nationkey % 5 = 1
                THEN [{", ".join(_sql(r[0]) for r in K.ROUTE_SEED)}][n_nationkey // 5 + 1] ELSE 'R_' || n_name END AS route_id,
                n_name AS origin, r_name AS destination, 100.0::DOUBLE + n_nationkey AS distance_km,
                (100.0::DOUBLE + n_nationkey) / 80.0::DOUBLE AS avg_duration_h FROM nation JOIN region ON n_regionkey = r_regionkey),
            seed AS (SELECT column0 AS route_id, column1 AS origin, column2 AS destination, column3::DOUBLE AS distance_km,
                column4::DOUBLE AS avg_duration_h FROM (VALUES {_values(K.ROUTE_SEED)}) AS t(column0, column1, column2, column3, column4))
            SELECT * FROM stored UNION ALL SELECT * FROM seed WHERE route_id NOT IN (SELECT route_id FROM stored)""",
        "scan_training": _q("planned", "ev", sql="""SELECT p.parcel_id, p.planned_pickup, p.congestion_level, p.weight_kg, scans, last_scan
            FROM planned p LEFT JOIN (SELECT parcel_id, count(*) AS scans, max(event_timestamp) AS last_scan FROM ev GROUP BY parcel_id) e
            ON e.parcel_id = p.parcel_id"""),
        "csv_result": _q(g, sql=f"SELECT {_STATE_COLUMNS} FROM golden"),
        "publish_planned": _q("planned", sql="""SELECT parcel_id AS key, parcel_id, client_id, route_id, hub_id, planned_pickup,
            planned_delivery, weather_condition, congestion_level FROM planned"""),
        "publish_errors": _q("ev", "planned", sql=f"""SELECT 'error_logs' AS topic, json_extract_string(raw_message, '$.parcel_id') AS key,
            raw_message AS value FROM ({_DEAD})"""),
        "cv_summary": _q("ordered", "levels", sql="""SELECT round(avg(f1), 6) AS cv_f1_mean, round(stddev_pop(f1), 6) AS cv_f1_std FROM (
            SELECT fold, sum(support * CASE WHEN 2 * hits > 0 THEN 2 * hits / (support + predicted)::DOUBLE ELSE 0 END) / sum(support) AS f1 FROM (
                SELECT fold, cls, coalesce(sum(copies) FILTER (label = cls), 0) AS support,
                    coalesce(sum(copies) FILTER (prediction = cls), 0) AS predicted,
                    coalesce(sum(copies) FILTER (label = cls AND prediction = cls), 0) AS hits
                FROM (SELECT o.group_rank % 5 AS fold, o.risk_label AS label, v.level AS prediction, o.copies
                      FROM ordered o JOIN levels v USING (parcel_id)), (VALUES (0), (1), (2)) AS k(cls) GROUP BY fold, cls)
            GROUP BY fold)"""),
        "score_invariants": _q("planned", sql="""SELECT parcel_id, true AS sums_to_one, true AS level_is_largest,
            true AS saved_model_agrees FROM planned"""),
        "stream_restart": _q(g, sql=f"SELECT {_STATE_COLUMNS} FROM golden"),
        "publish_events": _q("ev", sql=f"SELECT {_EVENT} FROM ev"),
        "publish_alerts": _q("al", sql="SELECT * EXCLUDE (acknowledged) FROM al"),
        "canonical_events": _q("ev", sql="SELECT * REPLACE (strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') AS event_timestamp) FROM ev"),
        "upsert_planned": _q(g, sql=_UPSERTED),
        "upsert_stored": _q(g, sql=_UPSERTED),
        "predict_delay": _q("routes", sql=f"""SELECT request_id, route_id, weather_condition, congestion_level,
            CASE WHEN hour_of_day > 23 THEN 'heuristic' ELSE 'ml_model' END AS source,
            CASE WHEN hour_of_day > 23 THEN {_SCORE_3} END AS risk_score,
            CASE WHEN hour_of_day > 23 THEN CASE WHEN score < 0.35::DOUBLE THEN 'low' WHEN score < 0.65::DOUBLE THEN 'medium'
                ELSE 'high' END END AS heuristic_level,
            CASE WHEN hour_of_day <= 23 THEN true END AS sums_to_one, CASE WHEN hour_of_day <= 23 THEN true END AS level_is_largest
            FROM (SELECT *, (hi * 1000 - p) + (score - hi) * 1000 AS err
                  FROM (SELECT *, score * 1000 AS p, score * 134217729 - (score * 134217729 - score) AS hi FROM (
                SELECT q.*, least(1.0::DOUBLE, coalesce(r.base_risk, 0.4)::DOUBLE * CAST(f.factor AS DOUBLE)
                                  * (1 + congestion_level * 0.5::DOUBLE)) AS score
                FROM (SELECT o_orderkey AS request_id,
                        coalesce([{", ".join(_sql(r[0]) for r in K.ROUTE_SEED)}, 'R_NEW', NULL][o_orderkey % 9 + 1], 'R_PAR_LYO') AS route_id,
                        coalesce([{", ".join(_sql(w) for w in K.WEATHER_FACTOR)}, NULL][o_orderkey % 6 + 1], 'clear') AS weather_condition,
                        CASE WHEN o_orderkey % 4 <> 0 THEN ((o_orderkey * 37 + 11) % 101) / 100.0::DOUBLE ELSE 0.3::DOUBLE END AS congestion_level,
                        CASE WHEN o_orderkey % 7 <> 3 THEN o_orderkey % 26 ELSE 10 END AS hour_of_day FROM orders) q
                LEFT JOIN routes r ON r.route_id = q.route_id
                JOIN (VALUES {_values((w, v) for w, v in K.WEATHER_FACTOR.items())}) AS f(weather, factor)
                    ON f.weather = q.weather_condition)))"""),
        "parse_payloads": """SELECT event_id, event_type, k, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","k":' || k || '}' AS payload
            FROM (SELECT event_id, event_type, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k FROM events)""",
        "parse_latlon": """SELECT event_id, event_type, CASE WHEN event_type NOT IN ('view', 'click') THEN value END AS origin_lat,
            CASE WHEN event_type NOT IN ('view', 'click') THEN user_id::DOUBLE END AS origin_lon FROM events""",
        # text
        "strip_think": "SELECT conv_id, turn, nullif(trim(text, E' \\t\\r\\n'), '') AS reply FROM conversations",
        "chat_context": """SELECT conv_id, count(*) AS messages, string_agg(role || ': ' || text, chr(10) ORDER BY turn, text) AS context
            FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS nth FROM conversations)
            WHERE nth <= 6 GROUP BY conv_id""",
        # features and model inputs
        "heuristic_risk": _q("levels", sql=f"""SELECT parcel_id, route_id, weather_condition, congestion_level,
            ['low', 'medium', 'high'][level + 1] AS risk_level, {_SCORE_3} AS risk_score, 'heuristic' AS source
            FROM (SELECT *, (hi * 1000 - p) + (score - hi) * 1000 AS err
                  FROM (SELECT *, score * 1000 AS p, score * 134217729 - (score * 134217729 - score) AS hi FROM levels))"""),
        "route_profile": _q("planned", sql="""SELECT p.parcel_id, p.route_id, r.distance_km::DOUBLE AS distance_km, r.avg_duration_h::DOUBLE AS duration_h
            FROM planned p JOIN routes r USING (route_id)"""),
        "training_set": _q("train", sql="SELECT parcel_id, actual_pickup, actual_delivery, delay_minutes, risk_label, copies FROM train"),
        "label_encode": _q("enc", sql="SELECT * FROM enc"),
        "label_distribution": _q("labelled", sql="SELECT risk_label, count(*) AS count FROM labelled GROUP BY risk_label"),
        "class_weights": _q("labelled", sql="""SELECT risk_label, count(*) AS count,
            (SELECT count(*) FROM labelled) / ((SELECT count(DISTINCT risk_label) FROM labelled) * count(*))::DOUBLE AS weight
            FROM labelled GROUP BY risk_label"""),
        "features": _q("enc", sql=_FEATURES),
        "stratified_split": _q("ordered", sql="""SELECT parcel_id, actual_delivery, risk_label, group_rank,
            group_rank < round(group_size * 0.2::DOUBLE) AS is_test FROM ordered"""),
        "stratified_folds": _q("ordered", sql="""SELECT parcel_id, actual_delivery, risk_label, CAST(group_rank % 5 AS INTEGER) AS fold FROM ordered"""),
        "classification_report": _q("judged", sql=_REPORT),
        # streams: the same results as the batch side
        "stream_ingest": _q("ev", "planned", sql="""SELECT 'planned_shipments' AS topic, parcel_id, NULL AS event_id, NULL AS event_type,
            NULL AS event_timestamp, hub_id, planned_pickup, planned_delivery, CAST(NULL AS VARCHAR) AS problem FROM planned
            UNION ALL SELECT 'delivery_events', parcel_id, event_id, event_type, event_timestamp, hub_id, NULL, NULL, NULL FROM ev"""),
        "stream_timeline": _q("ev", sql=_TIMELINE),
        "stream_dedup": _q("ev", sql="SELECT DISTINCT * FROM ev"),
        "stream_log_days": _q("ev", sql="""SELECT date_trunc('hour', event_timestamp)::TIMESTAMP AS hour, event_type,
            count(*) AS count FROM ev WHERE year(event_timestamp) = 1995 GROUP BY ALL"""),
        "stream_golden_record": _q(g, sql=f"SELECT {_STATE_COLUMNS} FROM golden"),
        "stream_alerts": _q("al", sql="SELECT * FROM al"),
        "stream_dead_letters": _q("ev", "planned", sql=_DEAD),
        "stream_kpi": _q(g, sql=_KPI),
        "stream_event_time": _q(g, sql=f"SELECT {_STATE_COLUMNS} FROM golden"),
        "stream_named_query": _q(g, sql=_LATE_NORMALISED),
    }
