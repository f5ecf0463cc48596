"""The SQL twin of each named query, for DuckDB over the same tables."""

from __future__ import annotations

# Common table expressions; later ones may use earlier ones.
def due_alerts(latest: str, history: str, levels: str) -> str:
    """Shipments on their way in ``latest`` that ``history`` never saw end, with the alert they are due."""
    return f"""
        SELECT l.event_id, l.shipment_id, l.carrier_id, l.warehouse_id, l.event_type AS trigger_event_type, l.event_timestamp,
               p.late_risk_probability, p.risk_level,
               CASE p.risk_level WHEN 'HIGH' THEN 'CRITICAL' WHEN 'MEDIUM' THEN 'HIGH' END AS alert_priority,
               'OPEN' AS alert_status,
               concat('Proactive delay-risk warning for shipment ', l.shipment_id, ' at ', l.warehouse_id,
                      ' while status is ', l.event_type, '. Predicted late-delivery risk: ', p.risk_level, ' (',
                      round(p.late_risk_probability * 100, 1), '%); no DELAYED event has occurred.') AS notification_message,
               TIMESTAMP '2024-02-01' AS evaluated_at
        FROM {latest} l JOIN predictions p USING (shipment_id)
        WHERE l.event_type IN ('SCAN', 'IN_TRANSIT', 'OUT_FOR_DELIVERY') AND p.risk_level IN ({levels})
          AND NOT EXISTS (SELECT 1 FROM {history} t WHERE t.shipment_id = l.shipment_id AND t.event_type IN ('DELAYED', 'DELIVERED'))"""


CTES = {
    "order_rows": """
        SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(l.l_quantity AS INT)) AS shipment_id,
               CAST(l.l_orderkey AS BIGINT) AS order_key,
               l.l_suppkey, l.l_returnflag, l.l_extendedprice, l.l_discount, c.c_nationkey, c.c_mktsegment,
               n.n_name, r.r_name, o.o_orderdate, l.l_shipdate,
               CAST(((datediff('day', o.o_orderdate, l.l_shipdate) % 7) + 7) % 7 AS INT) AS lead_time,
               CASE o.o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 4 END AS scheduled_time
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "fact": """
        SELECT shipment_id, order_key,
               concat('CARR00', CAST(l_suppkey % 6 + 1 AS VARCHAR)) AS carrier_key,
               concat('WH', lpad(CAST(c_nationkey + 1 AS VARCHAR), 3, '0')) AS warehouse_key,
               concat('RT-', r_name, '-', c_mktsegment) AS route_key,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key,
               lead_time, scheduled_time,
               (lead_time - scheduled_time) * 24 AS delay_hours,
               NOT (lead_time > scheduled_time AND l_returnflag <> 'R') AS on_time,
               l_extendedprice AS sales,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(0.05 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS profit
        FROM order_rows""",
    "dim_carrier": """
        SELECT concat('CARR00', CAST(n AS VARCHAR)) AS carrier_id, concat('Carrier ', CAST(n AS VARCHAR)) AS carrier_name,
               CASE n % 3 WHEN 0 THEN 'Same Day' WHEN 1 THEN 'Express' ELSE 'Standard' END AS service_type
        FROM (SELECT DISTINCT s_suppkey % 6 + 1 AS n FROM supplier)""",
    "dim_warehouse": """
        SELECT concat('WH', lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0')) AS warehouse_id,
               concat('Warehouse ', n_name) AS warehouse_name,
               concat(n_name, CASE WHEN n_nationkey % 8 = 0 THEN ' ' ELSE '' END) AS region,
               CAST(5000 + 100 * n_nationkey AS INT) AS capacity_units
        FROM nation""",
    "dim_route": """
        SELECT DISTINCT concat('RT-', r_name, '-', c_mktsegment) AS route_id, r_name AS origin_market, c_mktsegment AS destination_region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date,
               CAST(day(d) AS INT) AS day, CAST(month(d) AS INT) AS month, CAST(quarter(d) AS INT) AS quarter,
               CAST(year(d) AS INT) AS year, dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(date_trunc('month', lo - INTERVAL 1 MONTH)::TIMESTAMP,
                                            (hi + INTERVAL 1 MONTH)::TIMESTAMP, INTERVAL 1 DAY)) AS d
              FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders))""",
    "nation_routes": """
        SELECT concat('RN', CAST(n_nationkey AS VARCHAR)) AS route_id, r_name AS origin_market, n_name AS destination_region
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 7""",
    "period": """
        SELECT f.*, d.year, d.month FROM fact f JOIN dim_date d USING (date_key)
        WHERE d.full_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
    "faulty_once": """
        SELECT shipment_id, order_key,
               CASE WHEN warehouse_key <> 'WH005' THEN carrier_key END AS carrier_key, warehouse_key,
               CASE WHEN warehouse_key = 'WH009' THEN 'RT-NOWHERE' ELSE route_key END AS route_key,
               date_key, lead_time, scheduled_time,
               delay_hours + CASE WHEN lead_time = 6 THEN 1 ELSE 0 END AS delay_hours,
               CASE WHEN warehouse_key <> 'WH011' THEN on_time END AS on_time, sales, profit
        FROM fact""",
    "faulty": "SELECT * FROM faulty_once UNION ALL SELECT * FROM faulty_once WHERE warehouse_key = 'WH013'",
    "fact_predictions": """
        SELECT shipment_id, p AS late_risk_probability, p >= 0.36::DOUBLE AS predicted_is_late,
               CASE WHEN p >= 0.7::DOUBLE THEN 'HIGH' WHEN p >= 0.4::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
        FROM (SELECT shipment_id,
                     ((CAST(order_key AS BIGINT) * 31 + lead_time * 7 + scheduled_time * 3) % 101)::DOUBLE / 100.0::DOUBLE AS p
              FROM fact)""",
    "labelled": """
        SELECT p.*, NOT f.on_time AS is_late FROM fact_predictions p JOIN fact f USING (shipment_id)""",
    "track": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(event_id // 4 AS VARCHAR) AS shipment_id,
               concat('CARR00', CAST(user_id % 6 + 1 AS VARCHAR)) AS carrier_id,
               concat('WH', lpad(CAST(user_id % 25 + 1 AS VARCHAR), 3, '0')) AS warehouse_id,
               CASE event_type WHEN 'signup' THEN 'SCAN' WHEN 'view' THEN 'IN_TRANSIT' WHEN 'click' THEN 'OUT_FOR_DELIVERY'
                               WHEN 'purchase' THEN 'DELIVERED' ELSE 'DELAYED' END AS event_type,
               ts AS event_timestamp, CAST(event_id % 3 AS BIGINT) AS kafka_partition, event_id AS kafka_offset,
               ts AS kafka_timestamp, CAST(json_extract_string(props, '$.k') AS INT) AS k
        FROM events""",
    "hist": """
        SELECT event_id, shipment_id, carrier_id, warehouse_id, event_type, event_timestamp,
               kafka_partition, kafka_offset, kafka_timestamp FROM track""",
    "seen": "SELECT * FROM hist WHERE event_timestamp < TIMESTAMP '2024-01-15'",
    "arriving": """
        SELECT * REPLACE (kafka_offset + 1000000000 AS kafka_offset) FROM hist
        WHERE event_timestamp >= TIMESTAMP '2024-01-10'""",
    "latest": """
        SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY event_timestamp DESC,
            kafka_timestamp DESC, kafka_partition DESC, kafka_offset DESC, event_id DESC) AS n FROM hist) WHERE n = 1""",
    "seen_latest": """
        SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY event_timestamp DESC,
            kafka_timestamp DESC, kafka_partition DESC, kafka_offset DESC, event_id DESC) AS n FROM seen) WHERE n = 1""",
    "predictions": """
        SELECT shipment_id, p AS late_risk_probability, p >= 0.36::DOUBLE AS predicted_is_late,
               CASE WHEN p >= 0.7::DOUBLE THEN 'HIGH' WHEN p >= 0.4::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
        FROM (SELECT shipment_id, sum(k)::DOUBLE / count(*)::DOUBLE / 100.0::DOUBLE AS p FROM track GROUP BY shipment_id)""",
    "alerts": due_alerts("latest", "hist", "'MEDIUM', 'HIGH'"),
    "seen_alerts": due_alerts("seen_latest", "seen", "'MEDIUM', 'HIGH'"),
    "seen_high_alerts": due_alerts("seen_latest", "seen", "'HIGH'"),
    "performance": """
        SELECT f.carrier_key AS carrier_id, c.carrier_name, f.route_key AS route_id, count(*) AS total_shipments,
               avg(CASE WHEN f.on_time THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS on_time_rate,
               avg(f.lead_time) AS avg_lead_time, avg(f.delay_hours) AS avg_delay_hours
        FROM fact f JOIN dim_carrier c ON f.carrier_key = c.carrier_id GROUP BY ALL""",
    "candidates": """
        SELECT route_id, carrier_id, carrier_name, 1.0::DOUBLE - on_time_rate AS late_risk_probability,
               avg_lead_time AS expected_lead_time_days, CAST(NULL AS DOUBLE) AS shipping_cost, total_shipments
        FROM performance""",
    "costed": """
        SELECT c.* REPLACE (CASE WHEN NOT (c.route_id LIKE 'RT-ASIA%' AND c.carrier_id = 'CARR003') THEN k.cost END AS shipping_cost)
        FROM candidates c JOIN (SELECT carrier_key AS carrier_id, route_key AS route_id,
                                       sum(CAST(sales AS DECIMAL(24,8)))::DOUBLE / count(*) AS cost
                                FROM fact GROUP BY ALL) k USING (carrier_id, route_id)""",
    "scenarios": """
        SELECT * FROM (VALUES
            ('S1', 'warehouse_outage:WH003+24h', 'warehouse_outage', 'WH003', 24.0::DOUBLE, 100.0::DOUBLE, 42, TIMESTAMP '2024-01-01'),
            ('S2', 'carrier_disruption:CARR002+12h', 'carrier_disruption', 'CARR002', 12.0::DOUBLE, 60.0::DOUBLE, 42, TIMESTAMP '2024-01-02'),
            ('S3', 'route_disruption:RT-ASIA-BUILDING+18h', 'route_disruption', 'RT-ASIA-BUILDING', 18.0::DOUBLE, 75.0::DOUBLE, 42, TIMESTAMP '2024-01-03')
        ) s(scenario_id, scenario_name, scenario_type, target_id, added_delay_hours, affected_percent, random_seed, created_at)""",
    "targeted": """
        SELECT s.*, f.* FROM fact f JOIN scenarios s ON CASE s.scenario_type
            WHEN 'warehouse_outage' THEN f.warehouse_key WHEN 'carrier_disruption' THEN f.carrier_key ELSE f.route_key END = s.target_id""",
    "sampled": """
        SELECT *, affected_percent >= 100 OR
            ('0x' || substr(sha256(concat(random_seed, ':', shipment_id)), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615::DOUBLE
                < affected_percent / 100.0::DOUBLE AS is_affected
        FROM targeted""",
    "impact_base": """
        SELECT *, CASE WHEN is_affected THEN added_delay_hours ELSE 0.0::DOUBLE END AS added,
               on_time AND (NOT is_affected OR added_delay_hours <= greatest(-delay_hours, 0)) AS still_on_time
        FROM sampled""",
    "impact": """
        SELECT scenario_id, shipment_id, order_key, carrier_key, warehouse_key, route_key, is_affected,
               lead_time::DOUBLE AS baseline_lead_time_days, lead_time::DOUBLE + added / 24.0::DOUBLE AS scenario_lead_time_days,
               delay_hours::DOUBLE AS baseline_delay_hours, added AS added_delay_hours,
               delay_hours::DOUBLE + added AS scenario_delay_hours,
               on_time AS baseline_on_time, still_on_time AS scenario_on_time, on_time AND NOT still_on_time AS newly_late,
               sales, profit
        FROM impact_base""",
    "summary": """
        SELECT scenario_id, count(*) AS target_shipments, count(*) FILTER (WHERE is_affected) AS affected_shipments,
               avg(baseline_on_time::INT) AS baseline_on_time_rate, avg(scenario_on_time::INT) AS scenario_on_time_rate,
               (avg(scenario_on_time::INT) - avg(baseline_on_time::INT)) * 100.0::DOUBLE AS on_time_rate_change_pp,
               avg(baseline_delay_hours) AS avg_baseline_delay_hours, avg(scenario_delay_hours) AS avg_scenario_delay_hours,
               avg(added_delay_hours) FILTER (WHERE is_affected) AS avg_added_delay_hours,
               count(*) FILTER (WHERE newly_late) AS newly_late_shipments,
               coalesce(sum(CAST(sales AS DECIMAL(24,8))) FILTER (WHERE newly_late), 0)::DOUBLE AS sales_at_risk,
               coalesce(sum(CAST(profit AS DECIMAL(24,8))) FILTER (WHERE newly_late), 0)::DOUBLE AS profit_at_risk
        FROM impact GROUP BY scenario_id""",
    "alternatives": """
        SELECT scenario_id, carrier_key, carrier_name, on_time_rate FROM (
            SELECT *, row_number() OVER (PARTITION BY scenario_id ORDER BY on_time_rate DESC, carrier_key) AS n FROM (
                SELECT s.scenario_id, f.carrier_key, c.carrier_name, avg(f.on_time::INT) AS on_time_rate
                FROM scenarios s JOIN fact f ON
                       (s.scenario_type = 'route_disruption' AND f.route_key = s.target_id)
                    OR (s.scenario_type = 'carrier_disruption' AND f.carrier_key <> s.target_id
                        AND f.route_key IN (SELECT route_key FROM fact WHERE carrier_key = 'CARR002'))
                JOIN dim_carrier c ON c.carrier_id = f.carrier_key
                GROUP BY ALL)) WHERE n = 1""",
    "mitigations": """
        SELECT s.scenario_id, a.rank AS recommendation_rank, a.kind AS action_type,
               CASE s.scenario_type WHEN 'warehouse_outage' THEN CASE a.rank
                   WHEN 1 THEN concat('Prioritise the ', format('{:,}', k.newly_late_shipments), ' shipments projected to become late at ', s.target_id, '.')
                   WHEN 2 THEN 'Activate overflow capacity or a backup warehouse before accepting new loads.'
                   ELSE 'Notify owners of newly-late shipments and revise their expected delivery times.' END
               ELSE CASE a.rank
                   WHEN 1 THEN coalesce('Shift eligible loads to ' || t.carrier_name || ' (' || t.carrier_key || '), the strongest historical candidate.',
                                        'Review alternate carriers manually; no historical candidate is available.')
                   WHEN 2 THEN concat('Prioritise the ', format('{:,}', k.newly_late_shipments), ' shipments projected to become late.')
                   ELSE 'Add a temporary planning buffer and communicate revised delivery estimates.' END END AS recommendation,
               CASE s.scenario_type WHEN 'warehouse_outage' THEN CASE a.rank
                   WHEN 1 THEN concat(format('{:,}', k.affected_shipments), ' shipments are affected by the simulated outage.')
                   WHEN 2 THEN 'The dataset has no warehouse distance matrix, so automatic rerouting is not claimed.'
                   ELSE format('Projected on-time-rate change: {:.2f} percentage points.', k.on_time_rate_change_pp) END
               ELSE CASE a.rank
                   WHEN 1 THEN coalesce(format('Historical on-time rate: {:.2f}%.', t.on_time_rate * 100), 'No supporting carrier rows.')
                   WHEN 2 THEN concat(format('{:,}', k.affected_shipments), ' shipments are affected by the simulated disruption.')
                   ELSE format('Average added delay among affected shipments: {:.1f} hours.', k.avg_added_delay_hours) END END AS evidence
        FROM scenarios s JOIN summary k USING (scenario_id) LEFT JOIN alternatives t USING (scenario_id)
        JOIN (VALUES ('warehouse_outage', 1, 'PRIORITISE'), ('warehouse_outage', 2, 'CAPACITY'), ('warehouse_outage', 3, 'COMMUNICATION'),
                     ('other', 1, 'REASSIGN'), ('other', 2, 'PRIORITISE'), ('other', 3, 'BUFFER')) a(type, rank, kind)
          ON a.type = CASE s.scenario_type WHEN 'warehouse_outage' THEN 'warehouse_outage' ELSE 'other' END""",
    "thresholds": """
        SELECT i / 100.0::DOUBLE AS threshold,
               count(*) FILTER (WHERE is_late AND late_risk_probability >= i / 100.0::DOUBLE) AS tp,
               count(*) FILTER (WHERE NOT is_late AND late_risk_probability >= i / 100.0::DOUBLE) AS fp,
               count(*) FILTER (WHERE is_late AND late_risk_probability < i / 100.0::DOUBLE) AS fn
        FROM labelled, (SELECT unnest(generate_series(20, 81)) AS i) GROUP BY i""",
}
CTE_ORDER = list(CTES)


def with_ctes(query: str) -> str:
    """Prefix a query with the expressions it uses, directly or through others."""
    wanted: set[str] = set()
    pending = [query]
    while pending:
        words = set(pending.pop().replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in words & set(CTES) - wanted:
            wanted.add(name)
            pending.append(CTES[name])
    if not wanted:
        return query
    body = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTE_ORDER if name in wanted)
    return f"WITH {body}\n{query}"


KPIS = """count(*) AS total_shipments,
       round(sum(on_time::INT) * 100.0::DOUBLE / count(*), 2) AS on_time_rate_pct,
       round(avg(delay_hours), 2) AS avg_delay_hours"""
RATES = """count(*) AS total_shipments, avg(lead_time) AS avg_lead_time, avg(delay_hours) AS avg_delay_hours,
       sum(on_time::INT)::DOUBLE / count(*) AS on_time_rate"""
FACT_COLS = "shipment_id, order_key, carrier_key, warehouse_key, route_key, date_key, lead_time, scheduled_time, delay_hours, on_time, sales, profit"


def money(column: str) -> str:
    return f"round(sum(CAST({column} AS DECIMAL(24,8))), 2)::DOUBLE"


def ranking(source: str, drop_cost: bool) -> str:
    cost = "" if drop_cost else "shipping_cost, "
    return f"""
        SELECT route_id, carrier_id, carrier_name, late_risk_probability, expected_lead_time_days, {cost}total_shipments,
               cost_included, predicted_on_time_probability, round(on_pts, 2) AS on_time_points,
               round(lead_pts, 2) AS lead_time_points, round(cost_pts, 2) AS cost_points, score AS recommendation_score,
               late_risk_probability >= 0.7::DOUBLE AS high_risk,
               CAST(row_number() OVER (PARTITION BY route_id ORDER BY score DESC, late_risk_probability, carrier_id) AS INT) AS rank
        FROM (SELECT *, round(1.0::DOUBLE - late_risk_probability, 4) AS predicted_on_time_probability,
                     round(on_pts + lead_pts + cost_pts, 2) AS score
              FROM (SELECT *,
                        (1.0::DOUBLE - late_risk_probability) * CASE WHEN cost_included THEN 0.7::DOUBLE ELSE 0.7::DOUBLE / 0.9::DOUBLE END * 100 AS on_pts,
                        CASE WHEN l0 = l1 THEN 1.0::DOUBLE ELSE (l1 - expected_lead_time_days) / (l1 - l0) END
                            * CASE WHEN cost_included THEN 0.2::DOUBLE ELSE 0.2::DOUBLE / 0.9::DOUBLE END * 100 AS lead_pts,
                        CASE WHEN NOT cost_included THEN 0.0::DOUBLE
                             ELSE CASE WHEN c0 = c1 THEN 1.0::DOUBLE ELSE (c1 - shipping_cost) / (c1 - c0) END * 0.1::DOUBLE * 100 END AS cost_pts
                    FROM (SELECT *, min(expected_lead_time_days) OVER w AS l0, max(expected_lead_time_days) OVER w AS l1,
                                 min(shipping_cost) OVER w AS c0, max(shipping_cost) OVER w AS c1,
                                 count(shipping_cost) OVER w = count(*) OVER w AS cost_included
                          FROM {source} WINDOW w AS (PARTITION BY route_id))))"""


def report(rows: list[tuple[str, str]]) -> str:
    """A check report from (name, count query) pairs."""
    parts = [f"SELECT '{name}' AS check_name, CAST(({query}) AS BIGINT) AS violations" for name, query in rows]
    return "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ") checks"


def duplicated(table: str, *keys: str) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {present} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"


def nulls(table: str, *columns: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE " + " OR ".join(f"{c} IS NULL" for c in columns)


def orphans(table: str, key: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT count(*) FROM {table} f LEFT JOIN {parent} d ON f.{key} = d.{parent_key} "
        f"WHERE d.{parent_key} IS NULL AND f.{key} IS NOT NULL"
    )


REQUIRED = ["shipment_id", "carrier_key", "warehouse_key", "route_key", "date_key"]
RELATED = [
    ("carrier_key", "dim_carrier", "carrier_id"), ("warehouse_key", "dim_warehouse", "warehouse_id"),
    ("route_key", "dim_route", "route_id"), ("date_key", "dim_date", "date_key"),
]


def dq_checks() -> list[tuple[str, str]]:
    rows = [
        ("fact.shipment_id unique", duplicated("faulty", "shipment_id")),
        ("fact columns in order", "SELECT 0"),
        ("fact.on_time accepted", "SELECT count(*) FROM faulty WHERE on_time NOT IN (true, false)"),
        ("fact.on_time not null", nulls("faulty", "on_time")),
        ("fact keys not null", nulls("faulty", *REQUIRED)),
        ("fact.delay_hours formula",
         "SELECT count(*) FROM faulty WHERE delay_hours IS DISTINCT FROM (lead_time - scheduled_time) * 24"),
    ]
    rows += [(f"fact.{c} not null", nulls("faulty", c)) for c in REQUIRED]
    for key, dim, dim_key in RELATED:
        rows += [
            (f"fact.{key} in {dim}", orphans("faulty", key, dim, dim_key)),
            (f"{dim}.{dim_key} not null", nulls(dim, dim_key)),
            (f"{dim}.{dim_key} unique", duplicated(dim, dim_key)),
        ]
    return rows


def profile(table: str, name: str, columns: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"coalesce(substr(replace(CAST(min({c}) AS VARCHAR), '|', '/'), 1, 50), '') AS sample_value, count(*) AS row_count FROM {table}"
        for c, t in columns
    ]
    return (
        f"SELECT '{name}' AS table_name, row_count, CAST({len(columns)} AS BIGINT) AS column_count, "
        f"column_name, data_type, null_count, sample_value FROM (" + " UNION ALL ".join(parts) + ") cols"
    )


FACT_TYPES = [
    ("shipment_id", "string"), ("order_key", "bigint"), ("carrier_key", "string"), ("warehouse_key", "string"),
    ("route_key", "string"), ("date_key", "int"), ("lead_time", "int"), ("scheduled_time", "int"),
    ("delay_hours", "int"), ("on_time", "boolean"), ("sales", "double"), ("profit", "double"),
]
COMPARED = [c for c, _ in FACT_TYPES if c != "shipment_id"]

# Impact with the faults of the what-if check planted.
TAMPERED = """(SELECT * REPLACE (scenario_delay_hours + CASE WHEN carrier_key IN ('CARR001', 'CARR002') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS scenario_delay_hours,
                      scenario_on_time OR warehouse_key = 'WH004' AS scenario_on_time) FROM impact ) t"""
RAISED = """(SELECT l.event_id, l.shipment_id, l.warehouse_id, l.event_type AS trigger_event_type, p.risk_level,
                    CASE WHEN l.warehouse_id = 'WH001' THEN 'HIGH' WHEN p.risk_level = 'HIGH' THEN 'CRITICAL' ELSE 'HIGH' END AS alert_priority
             FROM seen_latest l JOIN predictions p USING (shipment_id)
             WHERE l.event_type IN ('SCAN', 'IN_TRANSIT', 'OUT_FOR_DELIVERY') AND p.risk_level IN ('MEDIUM', 'HIGH')
               AND NOT EXISTS (SELECT 1 FROM seen t WHERE t.shipment_id = l.shipment_id AND t.event_type IN ('DELAYED', 'DELIVERED'))) r"""
PREDICTION_FAULT = """(SELECT shipment_id, late_risk_probability + CASE WHEN risk_level = 'HIGH' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS late_risk_probability,
                              CASE WHEN risk_level = 'HIGH' THEN 'SEVERE' ELSE risk_level END AS risk_level FROM fact_predictions ) b"""
LONE = """(SELECT * REPLACE (CASE WHEN carrier_id NOT IN ('CARR001', 'CARR004') THEN carrier_name END AS carrier_name) FROM candidates
           WHERE route_id NOT LIKE 'RT-EUROPE%' OR carrier_id = 'CARR002') c"""

def raised_twice(first: str) -> str:
    """Alerts of an early evaluation, and those that a later one adds for other shipments."""
    return f"""
        SELECT * EXCLUDE (evaluated_at) FROM {first}
        UNION ALL SELECT * EXCLUDE (evaluated_at) FROM alerts WHERE shipment_id NOT IN ( SELECT shipment_id FROM {first} )"""


QUERIES = {
    "carrier_performance": f"""
        SELECT c.carrier_id, c.carrier_name, c.service_type, {RATES}
        FROM fact f JOIN dim_carrier c ON f.carrier_key = c.carrier_id GROUP BY ALL""",
    "route_performance": f"""
        SELECT r.route_id, r.origin_market, r.destination_region, {RATES}
        FROM fact f JOIN dim_route r ON f.route_key = r.route_id GROUP BY ALL""",
    "sla_monthly": """
        SELECT d.year, d.month, count(*) AS total_shipments, CAST(sum(on_time::INT) AS BIGINT) AS on_time_shipments,
               sum(on_time::INT)::DOUBLE / count(*) AS on_time_rate, avg(delay_hours) AS avg_delay_hours
        FROM fact f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.year, d.month""",
    "sla_rollup": """
        SELECT count(DISTINCT (d.year, d.month)) AS months, count(*) AS total_shipments,
               CAST(sum(on_time::INT) AS BIGINT) AS on_time_shipments,
               round(sum(on_time::INT) * 100.0::DOUBLE / count(*), 2) AS sla_pct,
               round(avg(delay_hours), 2) AS avg_delay_hours, min(d.year) AS first_year, max(d.year) AS last_year
        FROM fact f JOIN dim_date d ON f.date_key = d.date_key""",
    "staging_warehouse": """
        SELECT warehouse_id, warehouse_name, trim(region) AS region, capacity_units FROM dim_warehouse""",
    "card_overview": f"""
        SELECT {KPIS}, {money('sales')} AS total_sales, {money('profit')} AS total_profit FROM period""",
    "card_delay_trend": f"SELECT make_date(year, month, 1) AS month, {KPIS} FROM period GROUP BY 1",
    "card_carrier": f"""
        SELECT carrier_name, service_type, {KPIS}, {money('sales')} AS total_sales
        FROM period f JOIN dim_carrier c ON f.carrier_key = c.carrier_id GROUP BY 1, 2""",
    "card_route": f"""
        SELECT route_id, origin_market, destination_region, {KPIS}
        FROM period f JOIN dim_route r ON f.route_key = r.route_id GROUP BY 1, 2, 3""",
    "card_warehouse": f"""
        SELECT warehouse_name, region, capacity_units, {KPIS}
        FROM period f JOIN dim_warehouse w ON f.warehouse_key = w.warehouse_id GROUP BY 1, 2, 3""",
    "card_at_risk": """
        SELECT p.*, f.carrier_key, f.warehouse_key, f.route_key, f.scheduled_time
        FROM fact_predictions p LEFT JOIN fact f USING (shipment_id) WHERE p.risk_level IN ('HIGH', 'MEDIUM')""",
    "card_route_reco": f"""
        SELECT b.route_id, r.origin_market, r.destination_region, carrier_id AS recommended_carrier_id,
               carrier_name AS recommended_carrier_name, predicted_on_time_probability AS historical_on_time_rate,
               expected_lead_time_days, recommendation_score, total_shipments AS supporting_shipments,
               TIMESTAMP '2024-02-01' AS generated_at
        FROM ({ranking('candidates', True)}) b JOIN dim_route r USING (route_id) WHERE rank = 1""",
    "card_open_alerts": "SELECT alert_priority, count(*) AS alert_count FROM alerts GROUP BY alert_priority",
    "card_scenario_kpis": """
        SELECT s.scenario_name, s.scenario_type, s.target_id, s.added_delay_hours, s.affected_percent,
               target_shipments, affected_shipments, round(baseline_on_time_rate * 100, 2) AS baseline_on_time_percent,
               round(scenario_on_time_rate * 100, 2) AS scenario_on_time_percent,
               round(on_time_rate_change_pp, 2) AS on_time_rate_change_pp, newly_late_shipments,
               round(avg_baseline_delay_hours, 2) AS avg_baseline_delay_hours,
               round(avg_scenario_delay_hours, 2) AS avg_scenario_delay_hours,
               round(CAST(sales_at_risk AS DECIMAL(24,8)), 2)::DOUBLE AS sales_at_risk,
               round(CAST(profit_at_risk AS DECIMAL(24,8)), 2)::DOUBLE AS profit_at_risk, s.created_at
        FROM scenarios s JOIN summary USING (scenario_id)""",
    "card_affected_latest": """
        SELECT s.scenario_name, shipment_id, warehouse_key, carrier_key, route_key, baseline_on_time, scenario_on_time,
               newly_late, round(baseline_delay_hours, 2) AS baseline_delay_hours, round(i.added_delay_hours, 2) AS added_delay_hours,
               round(scenario_delay_hours, 2) AS scenario_delay_hours, round(CAST(sales AS DECIMAL(24,8)), 2)::DOUBLE AS sales,
               round(CAST(profit AS DECIMAL(24,8)), 2)::DOUBLE AS profit
        FROM impact i JOIN (SELECT scenario_id, scenario_name FROM scenarios ORDER BY created_at DESC LIMIT 1) s USING (scenario_id)
        WHERE is_affected ORDER BY newly_late DESC, scenario_delay_hours DESC, shipment_id LIMIT 2000""",
    "card_mitigation_latest": """
        SELECT s.scenario_name, m.recommendation_rank, m.action_type, m.recommendation, m.evidence
        FROM mitigations m JOIN (SELECT scenario_id, scenario_name FROM scenarios ORDER BY created_at DESC LIMIT 1) s USING (scenario_id)""",
    "open_delay_alert_list": """
        SELECT shipment_id, warehouse_id, event_timestamp, 'OPEN' AS alert_status FROM hist WHERE event_type = 'DELAYED'""",
    "latest_status_list": "SELECT shipment_id, event_type, warehouse_id, event_timestamp FROM latest",
    "fact_shipment": "SELECT * FROM fact",
    "fact_partition_month": """
        SELECT substr(CAST(date_key AS VARCHAR), 1, 6) AS shipment_month, warehouse_key, count(*) AS shipments FROM fact GROUP BY 1, 2""",
    "cohort_filter": "SELECT * FROM fact WHERE carrier_key = 'CARR002'",
    "export_shipment_date": "SELECT f.*, d.full_date AS shipment_date FROM fact f JOIN dim_date d USING (date_key)",
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date, CAST(day(d) AS INT) AS day,
               CAST(month(d) AS INT) AS month, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year,
               dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(date_trunc('month', lo - INTERVAL 1 MONTH)::TIMESTAMP, (hi + INTERVAL 1 MONTH)::TIMESTAMP, INTERVAL 1 DAY)) AS d
              FROM (SELECT CAST(min(x) AS DATE) AS lo, CAST(max(x) AS DATE) AS hi
                    FROM (SELECT o_orderdate AS x FROM orders UNION ALL SELECT l_shipdate FROM lineitem)))""",
    "dim_route": """
        SELECT 'RT' || lpad(CAST(row_number() OVER (ORDER BY origin_market, destination_region) AS VARCHAR), 3, '0') AS route_id,
               origin_market, destination_region
        FROM (SELECT DISTINCT r_name AS origin_market, n_name AS destination_region FROM order_rows )""",
    "dim_region_keys": """
        SELECT 'WH' || lpad(CAST(row_number() OVER (ORDER BY region) AS VARCHAR), 3, '0') AS warehouse_id,
               concat('Warehouse ', region) AS warehouse_name, region
        FROM (SELECT DISTINCT concat(' ', n_name, '  ') AS region FROM order_rows )""",
    "lookup_left_join": """
        SELECT o.shipment_id AS order_item_id, w.warehouse_id AS warehouse_key, r.route_id AS route_key
        FROM order_rows o LEFT JOIN dim_warehouse w ON trim(w.region) = o.n_name
        LEFT JOIN nation_routes r ON r.origin_market = o.r_name AND r.destination_region = o.n_name""",
    "date_validation_misses": """
        SELECT f.date_key, count(*) AS shipments FROM fact f
        LEFT JOIN (SELECT date_key FROM dim_date WHERE day <> 15) d USING (date_key) WHERE d.date_key IS NULL GROUP BY 1""",
    "enriched_fact": """
        SELECT f.shipment_id, f.order_key, f.warehouse_key, r.route_id AS route_key, f.date_key, f.lead_time, f.scheduled_time,
               f.delay_hours, f.on_time, f.sales, f.profit
        FROM fact f JOIN order_rows o USING (shipment_id)
        LEFT JOIN nation_routes r ON r.origin_market = o.r_name AND r.destination_region = o.n_name""",
    "null_counts": "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c, _ in FACT_TYPES) + " FROM faulty",
    "duplicate_keys": "SELECT shipment_id, count(*) AS row_count FROM faulty GROUP BY 1 HAVING count(*) > 1",
    "distinct_profile": "SELECT count(*) AS row_count, count(DISTINCT shipment_id) AS distinct_keys FROM faulty",
    "table_profile": profile("faulty", "fact_shipment", FACT_TYPES),
    "orphan_keys": """
        SELECT f.route_key, count(*) AS row_count FROM faulty f LEFT JOIN dim_route r ON f.route_key = r.route_id
        WHERE r.route_id IS NULL GROUP BY 1""",
    "unaccepted_values": """
        SELECT event_id, event_type FROM hist WHERE event_type NOT IN ('SCAN', 'IN_TRANSIT', 'OUT_FOR_DELIVERY')""",
    "row_reconcile": """
        SELECT count(*) AS mismatched_keys, count(*) FILTER (WHERE gone) AS left_only, CAST(0 AS BIGINT) AS right_only, """
        + ", ".join(f"count(*) FILTER (WHERE NOT gone AND {c}_d) AS {c}_mismatches" for c in COMPARED)
        + " FROM (SELECT b.warehouse_key IS NULL AS gone, b.warehouse_key = 'WH013' AS twice, "
        + ", ".join(f"f.{c} IS DISTINCT FROM b.{c}" + " OR b.warehouse_key = 'WH015'" * (c == "carrier_key") + f" AS {c}_d"
                    for c in COMPARED)
        + " FROM fact f FULL JOIN (SELECT * FROM faulty_once WHERE warehouse_key <> 'WH017') b USING (shipment_id)) m"
        " WHERE twice OR gone OR " + " OR ".join(f"{c}_d" for c in COMPARED),
    "orders_from_csv": """
        SELECT o.order_key * 100 + o.scheduled_time * 10 + o.lead_time AS order_item_id, o.order_key AS order_id,
               CASE WHEN o.lead_time < 5 THEN CAST(strftime(o.o_orderdate, '%Y%m%d') AS INT) END AS date_key,
               o.lead_time = 6 AS date_failed, o.lead_time < 5 AS date_known,
               concat('WH', lpad(CAST(o.c_nationkey + 1 AS VARCHAR), 3, '0')) AS warehouse_key, r.route_id AS route_key,
               o.l_extendedprice AS sales,
               CAST(CAST(o.l_extendedprice AS DECIMAL(18,2)) * (CAST(0.05 AS DECIMAL(4,2)) - CAST(o.l_discount AS DECIMAL(4,2))) AS DOUBLE) AS order_profit_per_order
        FROM order_rows o LEFT JOIN nation_routes r ON r.origin_market = o.r_name AND r.destination_region = o.n_name""",
    "carrier_assign_coverage": """
        SELECT count(DISTINCT shipment_id) AS items, count(DISTINCT shipment_id) AS one_carrier FROM fact""",
    "row_count_reconcile": """
        SELECT 'fact' AS table_name, (SELECT count(*) FROM fact ) AS source_rows, (SELECT count(*) FROM faulty ) AS target_rows,
               (SELECT count(*) FROM fact ) = (SELECT count(*) FROM faulty ) AS matches
        UNION ALL SELECT 'dim_route', (SELECT count(*) FROM dim_route ), (SELECT count(*) FROM nation_routes ),
               (SELECT count(*) FROM dim_route ) = (SELECT count(*) FROM nation_routes )""",
    "id_symmetric_diff": """
        SELECT shipment_id, true AS in_left, false AS in_right FROM
            (SELECT shipment_id FROM fact WHERE NOT on_time EXCEPT SELECT shipment_id FROM fact WHERE delay_hours > 0)
        UNION ALL SELECT shipment_id, false, true FROM
            (SELECT shipment_id FROM fact WHERE delay_hours > 0 EXCEPT SELECT shipment_id FROM fact WHERE NOT on_time)""",
    "dq_report": report(dq_checks()),
    "mart_report": report([(name, "SELECT 0") for name in (
        "carrier_performance.carrier_id not null", "carrier_performance.carrier_id unique",
        "route_performance.route_id not null", "route_performance.route_id unique",
        "sla_monthly.year not null", "sla_monthly.month not null", "sla_monthly month unique", "sla_monthly values sane",
    )]),
    "prediction_report": report([
        ("shipment_id not null", f"SELECT count(*) FROM {PREDICTION_FAULT} WHERE shipment_id IS NULL"),
        ("shipment_id unique", duplicated(PREDICTION_FAULT, "shipment_id")),
        ("probability in range", f"SELECT count(*) FROM {PREDICTION_FAULT} WHERE late_risk_probability NOT BETWEEN 0 AND 1"),
        ("risk_level accepted", f"SELECT count(*) FROM {PREDICTION_FAULT} WHERE risk_level NOT IN ('LOW', 'MEDIUM', 'HIGH')"),
    ]),
    "curated_round_trip": f"SELECT {FACT_COLS}, substr(CAST(date_key AS VARCHAR), 1, 6) AS shipment_month FROM fact",
    "curated_layout": "SELECT count(DISTINCT (date_key // 100, warehouse_key)) AS partitions FROM fact",
    "date_export_round_trip": """
        SELECT d.full_date AS shipment_date, count(*) AS shipments FROM fact f JOIN dim_date d USING (date_key) GROUP BY 1""",
    "csv_round_trip": "SELECT * FROM fact_predictions",
    "versioned_fact": "SELECT * FROM fact WHERE on_time",
    "scenario_round_trip": "SELECT s.*, CAST(3 AS BIGINT) AS actions FROM summary s",
    "carrier_route_performance": "SELECT * FROM performance",
    "carrier_route_contract": """
        SELECT carrier_key AS carrier_id, route_key AS route_id, count(*) AS total_shipments,
               avg(on_time::INT) AS on_time_rate, avg(lead_time) AS avg_lead_time, avg(delay_hours) AS avg_delay_hours
        FROM fact GROUP BY 1, 2""",
    "carrier_score": ranking("candidates", True),
    "carrier_score_with_cost": ranking("costed", False),
    "candidate_violations": report([
        ("candidate fields missing", f"SELECT count(*) FROM {LONE} WHERE carrier_name IS NULL"),
        ("probability out of range", f"SELECT count(*) FROM {LONE} WHERE late_risk_probability NOT BETWEEN 0 AND 1"),
        ("routes with one candidate", f"SELECT count(*) FROM (SELECT route_id FROM {LONE} GROUP BY 1 HAVING count(*) < 2)"),
    ]),
    "best_carrier_per_route": f"""
        SELECT route_id, carrier_id AS recommended_carrier_id, carrier_name AS recommended_carrier_name,
               predicted_on_time_probability AS historical_on_time_rate, expected_lead_time_days, recommendation_score,
               total_shipments AS supporting_shipments FROM ({ranking('candidates', True)}) b WHERE rank = 1""",
    "whatif_impact": "SELECT * FROM impact",
    "whatif_summary": "SELECT * FROM summary",
    "whatif_best_alternative": "SELECT * FROM alternatives",
    "whatif_mitigation": "SELECT * FROM mitigations",
    "whatif_scenarios": """
        SELECT s.*, k.target_shipments AS cohort_size FROM scenarios s JOIN summary k USING (scenario_id)""",
    "whatif_violations": report([
        ("impact rows off target", "SELECT 0"),
        ("impact arithmetic wrong", f"""SELECT count(*) FROM {TAMPERED} WHERE
            abs(scenario_delay_hours - baseline_delay_hours - added_delay_hours) > 1e-6 OR (scenario_on_time AND NOT baseline_on_time)
            OR newly_late IS DISTINCT FROM (baseline_on_time AND NOT scenario_on_time)"""),
        ("summary differs from impact", f"""SELECT count(*) FROM
            (SELECT scenario_id, avg(scenario_on_time::INT) AS rate, avg(scenario_delay_hours) AS delay FROM {TAMPERED} GROUP BY 1) c
            JOIN summary s USING (scenario_id)
            WHERE abs(c.rate - s.scenario_on_time_rate) > 1e-6 OR abs(c.delay - s.avg_scenario_delay_hours) > 1e-6"""),
        ("scenarios without action", "SELECT 1"),
    ]),
    "event_history": "SELECT * FROM hist",
    "new_events": "SELECT * FROM arriving WHERE event_id NOT IN (SELECT event_id FROM seen )",
    "latest_tracking": "SELECT * FROM latest",
    "latest_merge": """
        SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY event_timestamp DESC,
            kafka_timestamp DESC, kafka_partition DESC, kafka_offset DESC, event_id DESC) AS n
            FROM (SELECT * FROM seen UNION ALL SELECT * FROM arriving )) WHERE n = 1""",
    "delay_alerts": """
        SELECT event_id, shipment_id, carrier_id, warehouse_id, event_type, event_timestamp, 'OPEN' AS alert_status,
               TIMESTAMP '2024-02-01' AS created_at FROM hist WHERE event_type = 'DELAYED'""",
    "new_delay_alerts": """
        SELECT DISTINCT a.event_id, a.shipment_id, a.warehouse_id, a.event_timestamp FROM arriving a
        LEFT JOIN (SELECT event_id FROM seen WHERE event_type = 'DELAYED') e USING (event_id)
        WHERE a.event_type = 'DELAYED' AND e.event_id IS NULL""",
    "tracking_violations": report([
        ("latest differs from newest event", """SELECT count(*) FROM seen_latest s FULL JOIN latest l USING (shipment_id)
            WHERE s.event_id IS DISTINCT FROM l.event_id"""),
        ("alerts differ from DELAYED events", """SELECT count(*) FROM
            ((SELECT event_id FROM hist WHERE event_type = 'DELAYED' EXCEPT SELECT event_id FROM seen WHERE event_type = 'DELAYED')
             UNION ALL
             (SELECT event_id FROM seen WHERE event_type = 'DELAYED' EXCEPT SELECT event_id FROM hist WHERE event_type = 'DELAYED'))"""),
    ]),
    "stream_history": "SELECT * FROM hist",
    "stream_latest": "SELECT * FROM latest",
    "stream_delay_alerts": """
        SELECT event_id, shipment_id, carrier_id, warehouse_id, event_type, event_timestamp, 'OPEN' AS alert_status
        FROM hist WHERE event_type = 'DELAYED'""",
    "rejected_records": """
        SELECT CASE event_type WHEN 'DELAYED' THEN 'missing event_id' ELSE 'missing warehouse_id' END AS reason, count(*) AS records
        FROM hist WHERE event_type IN ('DELAYED', 'IN_TRANSIT') GROUP BY 1""",
    "proactive_alerts": "SELECT * FROM alerts",
    "stream_alerts_timed": raised_twice("seen_high_alerts"),
    "stream_proactive_alerts": raised_twice("seen_alerts"),
    "proactive_alerts_again": "SELECT event_id, shipment_id, alert_priority FROM alerts WHERE alert_priority <> 'CRITICAL'",
    "proactive_alert_violations": report([
        ("eligible shipments without alert", f"SELECT count(*) FROM alerts a WHERE a.shipment_id NOT IN (SELECT shipment_id FROM {RAISED} )"),
        ("alerts without valid trigger", f"""SELECT count(*) FROM {RAISED} LEFT JOIN hist h ON h.event_id = r.event_id
            WHERE h.event_id IS NULL OR h.shipment_id <> r.shipment_id OR h.event_type NOT IN ('SCAN', 'IN_TRANSIT', 'OUT_FOR_DELIVERY')
               OR h.event_type <> r.trigger_event_type"""),
        ("alerts evaluated after DELAYED", f"""SELECT count(DISTINCT r.shipment_id) FROM {RAISED}
            JOIN hist h ON h.shipment_id = r.shipment_id AND h.event_type = 'DELAYED' AND h.event_timestamp <= TIMESTAMP '2024-02-01'"""),
        ("alert shipments repeated", "SELECT 0"),
        ("alerts with wrong priority", f"""SELECT count(*) FROM {RAISED}
            WHERE (risk_level = 'HIGH' AND alert_priority <> 'CRITICAL') OR (risk_level = 'MEDIUM' AND alert_priority <> 'HIGH')"""),
    ]),
    "top_risk_shipment": """
        SELECT f.shipment_id, f.order_key, f.carrier_key AS carrier_id, f.warehouse_key AS warehouse_id, w.region
        FROM fact_predictions p JOIN fact f USING (shipment_id) LEFT JOIN dim_warehouse w ON w.warehouse_id = f.warehouse_key
        WHERE p.risk_level = 'HIGH' AND f.on_time ORDER BY p.late_risk_probability DESC, p.shipment_id LIMIT 1""",
    "prediction_upsert": """
        SELECT shipment_id, p AS late_risk_probability, p >= 0.36::DOUBLE AS predicted_is_late,
               CASE WHEN p >= 0.7::DOUBLE THEN 'HIGH' WHEN p >= 0.4::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
               CASE WHEN high THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS scored_at
        FROM (SELECT shipment_id, risk_level = 'HIGH' AS high,
                     CASE WHEN risk_level = 'HIGH' THEN late_risk_probability / 2 ELSE late_risk_probability END AS p
              FROM fact_predictions )""",
    "risk_tiers": "SELECT * FROM predictions",
    "risk_distribution": "SELECT risk_level, count(*) AS shipments FROM fact_predictions GROUP BY 1",
    "threshold_search": """
        SELECT threshold, tp AS true_positives, fp AS false_positives, fn AS false_negatives,
               coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0.0::DOUBLE) AS precision,
               coalesce((5 * tp)::DOUBLE / nullif(5 * tp + 4 * fn + fp, 0), 0.0::DOUBLE) AS f2 FROM thresholds""",
    "classification_metrics": """
        SELECT n AS rows, round((tp + fn)::DOUBLE / n, 4) AS late_rate, 0.36::DOUBLE AS threshold,
               round((SELECT sum(late * (below + other / 2)) / (sum(late) * sum(other)) FROM (
                   SELECT late, other, coalesce(sum(other) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                   FROM (SELECT late_risk_probability AS p, (count(*) FILTER (WHERE is_late))::DOUBLE AS late,
                                (count(*) FILTER (WHERE NOT is_late))::DOUBLE AS other FROM (SELECT is_late, late_risk_probability + (order_key % 1009)::DOUBLE / 1e9::DOUBLE AS late_risk_probability FROM labelled JOIN fact USING (shipment_id)) GROUP BY 1))), 4) AS roc_auc,
               round((n - fp - fn)::DOUBLE / n, 4) AS accuracy, round(tp::DOUBLE / (tp + fp), 4) AS precision,
               round(tp::DOUBLE / (tp + fn), 4) AS recall, round((2 * tp)::DOUBLE / (2 * tp + fp + fn), 4) AS f1
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE is_late AND late_risk_probability >= 0.36::DOUBLE) AS tp,
                     count(*) FILTER (WHERE NOT is_late AND late_risk_probability >= 0.36::DOUBLE) AS fp,
                     count(*) FILTER (WHERE is_late AND late_risk_probability < 0.36::DOUBLE) AS fn FROM (SELECT is_late, late_risk_probability + (order_key % 1009)::DOUBLE / 1e9::DOUBLE AS late_risk_probability FROM labelled JOIN fact USING (shipment_id)) )""",
    "classification_metrics_close": """
        SELECT n AS rows, round((tp + fn)::DOUBLE / n, 4) AS late_rate, 0.36::DOUBLE AS threshold,
               round((SELECT sum(late * (below + other / 2)) / (sum(late) * sum(other)) FROM (
                   SELECT late, other, coalesce(sum(other) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                   FROM (SELECT late_risk_probability AS p, (count(*) FILTER (WHERE is_late))::DOUBLE AS late,
                                (count(*) FILTER (WHERE NOT is_late))::DOUBLE AS other FROM (SELECT is_late, 0.36::DOUBLE + ((order_key * 7919 % 20011)::DOUBLE - 10000.0::DOUBLE) / 4e9::DOUBLE AS late_risk_probability FROM labelled JOIN fact USING (shipment_id)) GROUP BY 1))), 4) AS roc_auc,
               round((n - fp - fn)::DOUBLE / n, 4) AS accuracy, round(tp::DOUBLE / (tp + fp), 4) AS precision,
               round(tp::DOUBLE / (tp + fn), 4) AS recall, round((2 * tp)::DOUBLE / (2 * tp + fp + fn), 4) AS f1
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE is_late AND late_risk_probability >= 0.36::DOUBLE) AS tp,
                     count(*) FILTER (WHERE NOT is_late AND late_risk_probability >= 0.36::DOUBLE) AS fp,
                     count(*) FILTER (WHERE is_late AND late_risk_probability < 0.36::DOUBLE) AS fn FROM (SELECT is_late, 0.36::DOUBLE + ((order_key * 7919 % 20011)::DOUBLE - 10000.0::DOUBLE) / 4e9::DOUBLE AS late_risk_probability FROM labelled JOIN fact USING (shipment_id)) )""",
    "feature_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, median({c}::DOUBLE) AS median FROM ( SELECT scheduled_time, sales, profit, d.year AS order_year, "
        "d.month AS order_month, isodow(d.full_date) - 1 AS order_day_of_week FROM fact f JOIN dim_date d USING (date_key) )"
        for c in ("scheduled_time", "sales", "profit", "order_year", "order_month", "order_day_of_week")),
    "staging_carrier": "SELECT carrier_id, carrier_name, service_type FROM dim_carrier",
    "staging_route": "SELECT route_id, origin_market, destination_region FROM dim_route",
    "staging_date": "SELECT * FROM dim_date",
    "staging_shipment": "SELECT * FROM fact",
    "scoring_input": """
        SELECT f.shipment_id, f.route_key, f.warehouse_key, f.scheduled_time, f.sales, f.profit, d.year AS order_year,
               d.month AS order_month, CAST(isodow(d.full_date) - 1 AS INT) AS order_day_of_week
        FROM fact f JOIN dim_date d USING (date_key)""",
    "training_input": """
        SELECT f.shipment_id, o.o_orderdate AS order_timestamp, concat('RN', CAST(o.c_nationkey AS VARCHAR)) AS route_key,
               f.warehouse_key, f.scheduled_time::DOUBLE AS scheduled_time, f.sales, f.profit,
               CAST(year(o.o_orderdate) AS INT) AS order_year, CAST(month(o.o_orderdate) AS INT) AS order_month,
               CAST(isodow(o.o_orderdate) - 1 AS INT) AS order_day_of_week, CAST(NOT f.on_time AS INT) AS is_late
        FROM fact f JOIN order_rows o USING (shipment_id)""",
    "time_split": """
        SELECT shipment_id, date_key, CASE WHEN i < floor(n * 0.8::DOUBLE) THEN 'train' WHEN i < floor(n * 0.9::DOUBLE) THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT shipment_id, date_key, count(*) OVER () AS n,
                     row_number() OVER (ORDER BY date_key, md5(shipment_id), shipment_id) - 1 AS i FROM fact )""",
}
QUERIES |= {  # a replay changes nothing
    "stream_replay_history": QUERIES["stream_history"], "stream_replay_latest": QUERIES["stream_latest"],
    "stream_replay_alerts": QUERIES["stream_delay_alerts"],
}
ORACLES = {name: with_ctes(sql.strip()) for name, sql in QUERIES.items()}
