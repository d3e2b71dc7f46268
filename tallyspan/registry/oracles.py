"""DuckDB statements that answer each registered query in another way.

The licence tables are derived here from the same star-schema views.  The daily
metrics are written in the literal form: calendar x licences, then the latest state
on or before each day.
"""

from __future__ import annotations


def _price(kind: str) -> str:
    return f"CASE {kind} WHEN 'PASS' THEN 100 WHEN 'SIM' THEN 1000 WHEN 'SUPERVISION' THEN 5000 END::BIGINT"


def _by_remainder(key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'SIM' ELSE 'SUPERVISION' END"


DENSE_CHANGES = f"""
license_changes AS (
  SELECT event_id AS id, user_id AS license_id, CAST(ts AS DATE) AS date,
         {_price(_by_remainder('event_id'))} AS price, {_by_remainder('event_id')} AS type,
         event_type <> 'error' AS renewable
  FROM events)"""

_PRIORITY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'SUPERVISION' WHEN '2-HIGH' THEN 'SIM'
         WHEN '3-MEDIUM' THEN 'SIM' ELSE 'PASS' END"""

SPARSE_CHANGES = f"""
license_changes AS (
  SELECT o_orderkey AS id, o_custkey AS license_id, CAST(o_orderdate AS DATE) AS date,
         {_price(_PRIORITY)} AS price, {_PRIORITY} AS type, o_orderstatus <> 'F' AS renewable
  FROM orders)"""


def _entities(name: str, created: str, where: str = "") -> str:
    return f"""
{name} AS (
  SELECT license_id AS id, license_id % 40 AS customer_id, {_by_remainder('license_id')} AS type,
         CAST({created} AS DATE) AS creation_date,
         {_price(_by_remainder('license_id'))} AS price, TRUE AS renewable
  FROM (SELECT license_id, MIN(date) AS first_date FROM license_changes GROUP BY license_id) {where})"""


PLAIN = _entities("initial_licenses", "first_date - INTERVAL 2 DAY")
_EDGE_DATE = """CASE WHEN license_id % 3 = 0 THEN first_date + INTERVAL 3 DAY
              ELSE first_date - INTERVAL 2 DAY END"""
EDGE = _entities("initial_licenses", _EDGE_DATE, "WHERE license_id % 7 <> 5")

DENSE = f"WITH {DENSE_CHANGES}, {PLAIN}"
DENSE_EDGE = f"WITH {DENSE_CHANGES}, {EDGE}"
SPARSE = f"WITH {SPARSE_CHANGES}, {PLAIN}"
SPARSE_EDGE = f"WITH {SPARSE_CHANGES}, {EDGE}"

GAPS = f"""
WITH license_days AS (
  SELECT event_id AS id, user_id AS license_id, CAST(ts AS DATE) AS date,
         CASE WHEN event_type <> 'error' THEN {_by_remainder('event_id')} END AS type,
         CASE WHEN event_id % 97 <> 0 THEN event_type <> 'error' END AS renewable
  FROM events),
license_changes AS (SELECT *, {_price('type')} AS price FROM license_days), {EDGE}"""

FAULTS = f"""
WITH license_days AS (
  SELECT event_id AS id, user_id AS license_id, CAST(ts AS DATE) AS date, event_type <> 'error' AS renewable,
         {_by_remainder('event_id')} AS kind
  FROM events),
faulty AS (
  SELECT id, license_id, date, renewable,
         CASE WHEN id % 101 = 0 THEN 'INVALID' ELSE kind END AS type,
         CASE WHEN id % 103 = 0 THEN 6000 ELSE {_price('kind')} END AS price
  FROM license_days),
license_changes AS (
  SELECT *, 0::BIGINT AS ord FROM faulty UNION ALL SELECT *, 1::BIGINT AS ord FROM faulty WHERE id % 50 = 0),
{_entities('clean_licenses', _EDGE_DATE, "WHERE license_id % 7 <> 5")},
initial_licenses AS (
  SELECT *, 0::BIGINT AS ord FROM clean_licenses
  UNION ALL
  SELECT id, customer_id, type, CAST(creation_date + INTERVAL 10 DAY AS DATE), price, renewable, 1::BIGINT
  FROM clean_licenses WHERE id % 20 = 0)"""

# The states of the table with gaps, beside another fixture.
GAP_STATES = f"""
gap_days AS (
  SELECT event_id AS id, user_id AS license_id, CAST(ts AS DATE) AS date,
         CASE WHEN event_id % 97 <> 0 THEN event_type <> 'error' END AS renewable
  FROM events),
gap_entities AS (
  SELECT license_id, CAST(CASE WHEN license_id % 3 = 0 THEN MIN(date) + 3 ELSE MIN(date) - 2 END AS DATE) AS date
  FROM gap_days WHERE license_id % 7 <> 5 GROUP BY license_id),
gap_last AS (SELECT license_id, date, MAX(id) AS id FROM gap_days GROUP BY ALL),
gap_states AS (
  SELECT renewable FROM gap_days SEMI JOIN gap_last USING (license_id, date, id)
  UNION ALL SELECT TRUE FROM gap_entities ANTI JOIN gap_last USING (license_id, date))"""

# One state per licence and day: the change with the highest id, else the entity row under id -1.
STATES = """,
changed AS (
  SELECT license_id, date, renewable, price, type, id FROM license_changes
  QUALIFY id = MAX(id) OVER (PARTITION BY license_id, date)),
states AS (
  FROM changed
  UNION ALL
  SELECT e.id, e.creation_date, e.renewable, e.price, e.type, -1
  FROM initial_licenses e
  WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.license_id = e.id AND c.date = e.creation_date))"""

CALENDAR = """,
calendar AS (
  SELECT CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM states)"""

# The days of every licence, from its creation to the end of the calendar.
OWN_DAYS = """,
own_days AS (
  SELECT id AS license_id,
         CAST(UNNEST(generate_series(MIN(creation_date), (SELECT MAX(date) FROM states), INTERVAL 1 DAY)) AS DATE) AS day
  FROM initial_licenses GROUP BY id)"""

PANEL = f"""{OWN_DAYS},
panel AS (
  SELECT o.license_id, o.day AS date, s.renewable, s.type, s.price
  FROM own_days o ASOF JOIN states s ON s.license_id = o.license_id AND s.date <= o.day
  WHERE s.renewable IS NOT NULL)"""

# A state holds from its day to the day before the next one, the last one to the end of the calendar;
# it shows if the licence exists by then and the state says whether it is renewable.
HELD = """,
held AS (
  SELECT s.*, COALESCE(LEAD(date) OVER (PARTITION BY license_id ORDER BY date),
                       (SELECT MAX(date) + 1 FROM states)) AS until
  FROM states s),
visible AS (
  SELECT h.* FROM held h
  JOIN (SELECT id, MIN(creation_date) AS created FROM initial_licenses GROUP BY id) e ON e.id = h.license_id
  WHERE h.date >= e.created AND h.renewable IS NOT NULL)"""

# The same panel without an as-of join: the days of every visible state, one by one.
PANEL_SERIES = f"""{HELD},
panel AS (
  SELECT license_id, CAST(UNNEST(generate_series(date, until - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date,
         renewable, type, price
  FROM visible)"""

COLUMN_PANEL = f"""{OWN_DAYS},
panel AS (
  SELECT o.license_id, o.day AS date,
         LAST_VALUE(renewable IGNORE NULLS) OVER w AS renewable,
         LAST_VALUE(type IGNORE NULLS) OVER w AS type,
         LAST_VALUE(price IGNORE NULLS) OVER w AS price
  FROM own_days o LEFT JOIN states s ON s.license_id = o.license_id AND s.date = o.day
  WINDOW w AS (PARTITION BY o.license_id ORDER BY o.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

# The price of a day and type is unknown where every licence is active without a price.
METRICS = """,
metrics AS (
  SELECT date, type, COUNT(*) FILTER (WHERE renewable) AS active_license_count,
         COUNT(*) FILTER (WHERE NOT renewable) AS inactive_license_count,
         CASE WHEN COUNT(*) FILTER (WHERE NOT renewable OR price IS NOT NULL) > 0
              THEN CAST(COALESCE(SUM(price) FILTER (WHERE renewable), 0) AS BIGINT) END AS active_license_price
  FROM panel GROUP BY date, type)"""

# Levels without a panel: what has begun by a day less what has ended by then.
LEVELS = f"""{HELD},
edges AS (
  SELECT date AS day, type, 1 AS step, renewable, price FROM visible
  UNION ALL SELECT until, type, -1, renewable, price FROM visible),
levels AS (
  SELECT c.date, t.type,
         CAST(COALESCE(SUM(e.step) FILTER (WHERE e.renewable), 0) AS BIGINT) AS active_license_count,
         CAST(COALESCE(SUM(e.step * e.price) FILTER (WHERE e.renewable), 0) AS BIGINT) AS active_license_price,
         CAST(COALESCE(SUM(e.step) FILTER (WHERE NOT e.renewable), 0) AS BIGINT) AS inactive_license_count
  FROM calendar c, (SELECT DISTINCT type FROM visible) t
  LEFT JOIN edges e ON e.type = t.type AND e.day <= c.date
  GROUP BY c.date, t.type)"""

# Levels of a given panel, counted day by day.
PANEL_LEVELS = """,
levels AS (
  SELECT c.date, t.type, COUNT(*) FILTER (WHERE p.renewable) AS active_license_count,
         CAST(COALESCE(SUM(p.price) FILTER (WHERE p.renewable), 0) AS BIGINT) AS active_license_price,
         COUNT(*) FILTER (WHERE NOT p.renewable) AS inactive_license_count
  FROM calendar c, (SELECT DISTINCT type FROM panel) t
  LEFT JOIN panel p ON p.type = t.type AND p.date = c.date
  GROUP BY c.date, t.type)"""

MART = """,
mart AS (
  SELECT today.*,
         COALESCE(today.active_license_count - eve.active_license_count, 0) AS daily_active_diff,
         COALESCE(today.active_license_price - eve.active_license_price, 0) AS daily_price_diff,
         COALESCE(today.inactive_license_count - eve.inactive_license_count, 0) AS daily_inactive_diff
  FROM levels today
  LEFT JOIN levels eve ON eve.date = today.date - 1 AND eve.type IS NOT DISTINCT FROM today.type)"""


def mart(fixture: str, levels: str = LEVELS) -> str:
    return f"{fixture}{STATES}{CALENDAR}{levels}{MART}\nSELECT * FROM mart"


REPORT = """
SELECT rule, table_name, CAST(checked AS BIGINT) AS checked, CAST(COALESCE(failed, 0) AS BIGINT) AS failed,
       CASE WHEN checked > 0 THEN ROUND(COALESCE(failed, 0) / checked, 6) ELSE 0.0::DOUBLE END AS failed_ratio
FROM ({parts})"""


def _rule(rule: str, table: str, ok: str, source: str | None = None) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, COUNT(*) AS checked, "
        f"COUNT(*) FILTER (WHERE NOT COALESCE({ok}, FALSE)) AS failed FROM {source or table}"
    )


def _report(*parts: str) -> str:
    return REPORT.format(parts="\n  UNION ALL ".join(parts))


TYPE_OK = "type IN ('PASS', 'SIM', 'SUPERVISION')"
PRICE_OK = "price BETWEEN 0 AND 5000"
LIST_PRICE = "CASE type WHEN 'PASS' THEN 100 WHEN 'SIM' THEN 1000 WHEN 'SUPERVISION' THEN 5000 END"
CREATED = "(SELECT MIN(i.creation_date) FROM initial_licenses i WHERE i.id = c.license_id)"
HAS_ENTITY = "EXISTS (SELECT 1 FROM initial_licenses i WHERE i.id = c.license_id)"
HAS_CHANGE = "EXISTS (SELECT 1 FROM license_changes c WHERE c.license_id = e.id)"
FIRST_ROW = "ord = (SELECT MIN(o.ord) FROM initial_licenses o WHERE o.id = e.id)"


def _consistency() -> str:
    parts = []
    for table, prefix, day, key, names in (
        ("initial_licenses", "entity", "creation_date", "customer_id", "id customer_id type creation_date price renewable"),
        ("license_changes", "change", "date", "license_id", "id license_id date price type renewable"),
    ):
        complete = " AND ".join(f"{n} IS NOT NULL" for n in names.split())
        first = f"ord = (SELECT MIN(o.ord) FROM {table} o WHERE o.id = e.id)"
        parts += [
            _rule(f"{prefix}_no_missing_values", table, complete),
            _rule(f"{prefix}_price_positive", table, "price > 0"),
            _rule(f"{prefix}_price_matches_type", table, f"price = {LIST_PRICE}"),
            _rule(f"{prefix}_not_in_future", table, f"{day} <= DATE '2024-01-25'"),
            _rule(f"{prefix}_{key}_positive", table, f"{key} > 0"),
            _rule(f"{prefix}_renewable_is_boolean", table, "renewable IN (TRUE, FALSE)"),
            _rule(f"{prefix}_id_unique", table, first, f"{table} e"),
        ]
    parts.append(_rule("entity_type_accepted", "initial_licenses", TYPE_OK))
    return f"{FAULTS}{_report(*parts)}"


def _validation() -> str:
    return _report(
        _rule("change_type_accepted", "license_changes", TYPE_OK),
        _rule("change_price_in_range", "license_changes", PRICE_OK),
        _rule("entity_type_accepted", "initial_licenses", TYPE_OK),
        _rule("entity_price_in_range", "initial_licenses", PRICE_OK),
        _rule("change_not_before_creation", "license_changes", f"date >= {CREATED}", "license_changes c"),
        _rule("change_has_entity", "license_changes", HAS_ENTITY, "license_changes c"),
        _rule("entity_has_change", "initial_licenses", HAS_CHANGE, "initial_licenses e"),
        _rule("entity_id_unique", "initial_licenses", FIRST_ROW, "initial_licenses e"),
    )


HALF = "(SELECT MAX(id) // 2 FROM license_changes)"
RAW = "SELECT id, license_id, date, price, type, renewable FROM license_changes"

TOGGLE = f"""
WITH log AS (
  SELECT user_id, event_id,
         CASE WHEN event_type = 'error' THEN 'RENEW_TYPE' ELSE {_by_remainder('event_id')} END AS label
  FROM events)
SELECT user_id, event_id, label,
       LAST_VALUE(CASE WHEN label NOT LIKE 'RENEW%' THEN label END IGNORE NULLS) OVER w AS main_type,
       SUM(CASE WHEN label LIKE 'RENEW%' THEN 1 ELSE 0 END) OVER w % 2 = 0 AS is_active
FROM log
WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

APPORTION = """
WITH keys AS (
  SELECT c_custkey + 1 AS customer_key, CAST(FLOOR(POW(CAST(c_custkey + 1 AS DOUBLE), -1.5) * 1e18) AS HUGEINT) AS weight
  FROM customer),
rest AS (SELECT (SELECT COUNT(*) FROM orders) - COUNT(*) AS rest, CAST(SUM(weight) AS HUGEINT) AS whole FROM keys),
floors AS (
  SELECT customer_key, rest, weight * rest // whole AS base, weight * rest % whole AS left_over FROM keys, rest),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY left_over DESC, customer_key) AS place, SUM(base) OVER () AS given FROM floors)
SELECT customer_key, CAST(1 + base + CASE WHEN place <= rest - given THEN 1 ELSE 0 END AS BIGINT) AS allotted
FROM ranked"""

# The versions of the changes after three runs: half of them, new versions of some, the rest.
CHANGE_VERSIONS = f"""
versions AS (
  SELECT *, 1 AS run_id FROM license_changes WHERE id < {HALF}
  UNION ALL
  SELECT id, license_id + CASE WHEN id % 20 = 3 THEN 1 ELSE 0 END, CAST(date + INTERVAL 30 DAY AS DATE),
         5000::BIGINT, 'SUPERVISION', NOT renewable, 2 FROM license_changes WHERE id % 10 = 3
  UNION ALL
  SELECT *, 3 FROM license_changes WHERE id >= {HALF} AND id % 10 <> 3)"""

# New versions of every tenth change, and entities from the first versions.
UPDATED_EDGE = f"""WITH known AS (WITH {SPARSE_CHANGES} SELECT * FROM license_changes),
{EDGE.replace('license_changes', 'known')},
license_changes AS (
  SELECT * FROM known WHERE id % 10 <> 3
  UNION ALL
  SELECT id, license_id + CASE WHEN id % 20 = 3 THEN 1 ELSE 0 END, CAST(date + INTERVAL 30 DAY AS DATE),
         5000::BIGINT, 'SUPERVISION', NOT renewable FROM known WHERE id % 10 = 3)"""

# Changes that come after a run up to the middle of 1996 whose watermark is behind their day.
LATE = """
mark AS (
  SELECT MAX(day) AS day FROM (
    SELECT date AS day FROM license_changes WHERE id % 11 <> 7
    UNION ALL SELECT creation_date FROM initial_licenses) WHERE day <= DATE '1996-06-30'),
late AS (SELECT * FROM license_changes WHERE id % 11 = 7 AND date < (SELECT day FROM mark))"""

FLAGS = """,
flagged AS (
  SELECT s.*, LAG(renewable) OVER (PARTITION BY license_id ORDER BY date) AS before FROM states s),
events_by_day AS (
  SELECT date, type,
         SUM(CASE WHEN renewable AND NOT COALESCE(before, FALSE) THEN 1 ELSE 0 END) AS activated,
         SUM(CASE WHEN NOT renewable AND COALESCE(before, FALSE) THEN 1 ELSE 0 END) AS deactivated
  FROM flagged GROUP BY date, type)"""

TYPES = ",\ntypes AS (SELECT DISTINCT type FROM {source})"
GRID = "FROM calendar c CROSS JOIN types t"


def oracle_sql() -> dict[str, str]:
    flag_changes = f"""
      COALESCE(date >= {CREATED}, FALSE) AS change_not_before_creation, {HAS_ENTITY} AS change_has_entity,
      COALESCE({TYPE_OK}, FALSE) AS change_type_accepted, COALESCE({PRICE_OK}, FALSE) AS change_price_in_range"""
    flag_entities = f"""
      {FIRST_ROW} AS entity_id_unique, {HAS_CHANGE} AS entity_has_change,
      COALESCE({TYPE_OK}, FALSE) AS entity_type_accepted, COALESCE({PRICE_OK}, FALSE) AS entity_price_in_range"""
    return {
        "mart": mart(DENSE, PANEL + PANEL_LEVELS),
        "mart_edge": mart(SPARSE_EDGE),
        "mart_sparse": mart(SPARSE),
        "mart_gaps": mart(GAPS, PANEL_SERIES + PANEL_LEVELS),
        "mart_gaps_colfill": mart(GAPS, COLUMN_PANEL + PANEL_LEVELS),
        # state history and its parts
        "stg_initial": f"{DENSE_EDGE} SELECT id AS license_id, creation_date, renewable, price, type FROM initial_licenses",
        "stg_changes": f"""WITH {DENSE_CHANGES}
SELECT license_id, date, renewable, price, type, id FROM license_changes c
WHERE id = (SELECT MAX(o.id) FROM license_changes o WHERE o.license_id = c.license_id AND o.date = c.date)""",
        "initial_not_superseded": f"{DENSE_EDGE}{STATES} SELECT * FROM states WHERE id = -1",
        "state_history": f"{DENSE_EDGE}{STATES} SELECT * FROM states",
        "state_history_sparse": f"{SPARSE}{STATES} SELECT * FROM states",
        "dedup_keep_last": f"""{FAULTS}
SELECT id, license_id, date, price, type, renewable, ord FROM license_changes
QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY ord DESC) = 1""",
        "first_occurrence": f"""{FAULTS}
SELECT id, ord, ROW_NUMBER() OVER (PARTITION BY id ORDER BY ord) = 1 AS is_first FROM license_changes""",
        # calendar and grids
        "calendar": f"{SPARSE_EDGE}{STATES}{CALENDAR} SELECT date FROM calendar",
        "license_types": f"{DENSE}{STATES}{CALENDAR}{PANEL} SELECT DISTINCT type FROM panel",
        "date_type_grid": f"{SPARSE}{STATES}{CALENDAR}{PANEL}{TYPES.format(source='panel')} SELECT c.date, t.type {GRID}",
        "densify": f"""{SPARSE}{STATES}{CALENDAR}{TYPES.format(source='license_changes')}
SELECT c.date, t.type,
       (SELECT COUNT(*) FROM license_changes l WHERE l.date = c.date AND l.type = t.type) AS n_changes {GRID}""",
        # panel
        "daily_states": f"{DENSE_EDGE}{STATES}{CALENDAR}{PANEL_SERIES} SELECT * FROM panel",
        "daily_states_gaps": f"{GAPS}{STATES}{CALENDAR}{PANEL_SERIES} SELECT * FROM panel",
        "daily_states_colfill": f"{GAPS}{STATES}{CALENDAR}{COLUMN_PANEL} SELECT * FROM panel",
        "asof_lookup": f"""{SPARSE_EDGE}{STATES},
points AS (SELECT id AS point_id, license_id, CAST(date + INTERVAL 45 DAY AS DATE) AS date FROM license_changes)
SELECT p.point_id, p.license_id, p.date, s.date AS state_date, s.renewable, s.price, s.type
FROM points p ASOF LEFT JOIN states s ON p.license_id = s.license_id AND p.date >= s.date""",
        "license_daily_series": f"""{DENSE}{STATES},
own_days AS (
  SELECT license_id, CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM states GROUP BY license_id)
SELECT d.license_id, d.date, s.renewable
FROM own_days d ASOF LEFT JOIN states s ON d.license_id = s.license_id AND d.date >= s.date""",
        # metrics
        "daily_metrics": f"{DENSE_EDGE}{STATES}{CALENDAR}{PANEL_SERIES}{METRICS} SELECT * FROM metrics",
        "daily_metrics_gaps": f"{GAPS}{STATES}{CALENDAR}{PANEL_SERIES}{METRICS} SELECT * FROM metrics",
        "daily_price": f"""{DENSE}{STATES}{CALENDAR}{PANEL_SERIES}{METRICS}{TYPES.format(source='panel')}
SELECT c.date, t.type, COALESCE(m.active_license_price, 0) AS active_license_price
{GRID} LEFT JOIN metrics m ON m.date = c.date AND m.type = t.type""",
        "daily_events": f"""{DENSE}{STATES}{CALENDAR}{FLAGS}{TYPES.format(source='states')}
SELECT c.date, t.type, CAST(COALESCE(e.activated, 0) AS BIGINT) AS activated_licenses,
       CAST(COALESCE(e.deactivated, 0) AS BIGINT) AS deactivated_licenses
{GRID} LEFT JOIN events_by_day e ON e.date = c.date AND e.type = t.type""",
        "panel_counts": f"""{DENSE}{STATES}{CALENDAR}{TYPES.format(source='changed')},
base AS (
  SELECT c.date, t.type, COUNT(s.id) FILTER (WHERE s.renewable) AS active_license_count,
         COUNT(s.id) FILTER (WHERE NOT s.renewable) AS inactive_license_count
  {GRID} LEFT JOIN changed s ON s.date = c.date AND s.type = t.type GROUP BY c.date, t.type)
SELECT *, COALESCE(active_license_count - LAG(active_license_count) OVER w, 0) AS daily_active_diff,
       COALESCE(inactive_license_count - LAG(inactive_license_count) OVER w, 0) AS daily_inactive_diff
FROM base WINDOW w AS (PARTITION BY type ORDER BY date)""",
        "panel_price": f"""{DENSE}{STATES}{CALENDAR}{TYPES.format(source='license_changes')}
SELECT c.date, t.type, CAST(COALESCE((SELECT SUM(l.price) FROM license_changes l
       WHERE l.date = c.date AND l.type = t.type AND l.renewable), 0) AS BIGINT) AS active_license_price {GRID}""",
        "mart_preview": f"{mart(DENSE)} ORDER BY date, type LIMIT 10",
        "gate_min_rows": f"SELECT COUNT(*) >= 9 AS has_min_rows FROM ({mart(DENSE)})",
        "view_mart": mart(DENSE_EDGE),
        "src_csv_utc": f"WITH {SPARSE_CHANGES} {RAW} WHERE date BETWEEN DATE '1996-01-02' AND DATE '1997-12-31'",
        "parse_utc": "SELECT event_id, CASE WHEN event_type <> 'error' THEN epoch_us(ts) END AS micros FROM events",
        "src_csv_roundtrip": mart(DENSE),
        "src_csv_swapped": f"WITH {SPARSE_CHANGES} {RAW}",
        "src_table_replace": f"WITH {SPARSE_CHANGES} {RAW}",
        # quality
        "dq_report": FAULTS + _validation(),
        "dq_flagged_rows": f"""{FAULTS}, flagged AS (SELECT c.*, {flag_changes} FROM license_changes c)
SELECT *, change_not_before_creation AND change_has_entity AND change_type_accepted
       AND change_price_in_range AS is_valid FROM flagged""",
        "dq_flagged_entities": f"""{FAULTS}, flagged AS (SELECT e.*, {flag_entities} FROM initial_licenses e)
SELECT *, entity_id_unique AND entity_has_change AND entity_type_accepted
       AND entity_price_in_range AS is_valid FROM flagged""",
        "dq_creation_date": f"""{FAULTS}
SELECT id, license_id, date, {CREATED} AS creation_date FROM license_changes c
WHERE NOT COALESCE(date >= {CREATED}, FALSE)""",
        "dq_duplicate_id": f"{FAULTS} SELECT id, ord FROM initial_licenses e WHERE NOT {FIRST_ROW}",
        "dq_orphans": f"""{FAULTS}
SELECT license_id, COUNT(*) AS n_changes FROM license_changes c WHERE NOT {HAS_ENTITY} GROUP BY license_id""",
        "dq_unchanged_entities": "SELECT c_custkey AS license_id FROM customer EXCEPT SELECT user_id FROM events",
        "dq_type": f"""{FAULTS}
SELECT 'license_changes' AS table_name, id, type FROM license_changes WHERE NOT COALESCE({TYPE_OK}, FALSE)
UNION ALL SELECT 'initial_licenses', id, type FROM initial_licenses WHERE NOT COALESCE({TYPE_OK}, FALSE)""",
        "dq_price": f"""{FAULTS}
SELECT 'license_changes' AS table_name, id, price FROM license_changes WHERE NOT COALESCE({PRICE_OK}, FALSE)
UNION ALL SELECT 'initial_licenses', id, price FROM initial_licenses WHERE NOT COALESCE({PRICE_OK}, FALSE)""",
        "dq_distribution": f"""{SPARSE}
SELECT COUNT(DISTINCT customer_id) AS n_customers, COUNT(DISTINCT id) AS n_licenses,
       BOOL_AND(renewable) AS all_renewable, COUNT(DISTINCT customer_id) < COUNT(DISTINCT id) AS fewer_customers
FROM initial_licenses""",
        "dq_distribution_window": f"""WITH {SPARSE_CHANGES},
months AS (SELECT DISTINCT CAST(date_trunc('month', date) + INTERVAL 1 MONTH AS DATE) AS last_day FROM license_changes)
SELECT CAST(last_day - INTERVAL 89 DAY AS DATE) AS first_day, last_day, COUNT(DISTINCT license_id) AS n_licenses, TRUE AS is_close
FROM months JOIN license_changes ON date BETWEEN last_day - INTERVAL 89 DAY AND last_day GROUP BY last_day""",
        "dq_not_null": f"{GAPS}{STATES}{CALENDAR}{LEVELS}{MART}"
        + _report(
            _rule("license_id_not_null", "stg_initial", "id IS NOT NULL", "initial_licenses"),
            _rule("creation_date_not_null", "stg_initial", "creation_date IS NOT NULL", "initial_licenses"),
            _rule("type_not_null", "stg_initial", "type IS NOT NULL", "initial_licenses"),
            _rule("renewable_not_null", "state_history", "renewable IS NOT NULL", "states"),
            _rule("type_not_null", "state_history", "type IS NOT NULL", "states"),
            _rule("active_license_count_not_null", "mart", "active_license_count IS NOT NULL"),
            _rule("inactive_license_count_not_null", "mart", "inactive_license_count IS NOT NULL"),
            _rule("active_license_price_not_null", "mart", "active_license_price IS NOT NULL"),
        ),
        "dq_panel": f"{GAPS}{STATES}{CALENDAR}{COLUMN_PANEL}"
        + _report(
            _rule("license_id_not_null", "daily_states", "license_id IS NOT NULL", "panel"),
            _rule("date_not_null", "daily_states", "date IS NOT NULL", "panel"),
            _rule("renewable_accepted", "daily_states", "renewable IN (TRUE, FALSE)", "panel"),
        ),
        "dq_consistency": _consistency(),
        "dq_accepted_values": f"""{FAULTS}, {GAP_STATES}"""
        + _report(
            _rule("type_accepted", "license_changes", TYPE_OK),
            _rule("price_accepted", "license_changes", "price IN (100, 1000, 5000)"),
            _rule("type_accepted", "initial_licenses", TYPE_OK),
            _rule("renewable_accepted", "state_history", "renewable IN (TRUE, FALSE)", "gap_states"),
        ),
        "dq_relationships": FAULTS
        + _report(
            _rule("license_id_in_initial_licenses", "license_changes", HAS_ENTITY, "license_changes c"),
            _rule("id_in_license_changes", "initial_licenses", HAS_CHANGE, "initial_licenses e"),
            _rule("o_custkey_in_customer", "orders", "o_custkey IN (SELECT c_custkey FROM customer)"),
        ),
        "dq_mart_invariants": f"""{SPARSE_EDGE}{STATES}{CALENDAR}{LEVELS}{MART}
SELECT 'columns' AS invariant, TRUE AS holds
UNION ALL SELECT 'non_negative', BOOL_AND(LEAST(active_license_count, inactive_license_count, active_license_price) >= 0) FROM mart
UNION ALL SELECT 'list_price', BOOL_AND(active_license_price = active_license_count * {LIST_PRICE}) FROM mart
UNION ALL SELECT 'last_day_total', SUM(active_license_count + inactive_license_count) =
  (SELECT COUNT(DISTINCT id) FROM initial_licenses WHERE creation_date <= (SELECT MAX(date) FROM calendar))
FROM mart WHERE date = (SELECT MAX(date) FROM calendar)""",
        "dq_transition_sums": f"""{SPARSE}{STATES},
steps AS (SELECT LAG(type) OVER (PARTITION BY license_id ORDER BY date) AS from_type, type AS to_type FROM states),
counts AS (SELECT from_type, to_type, COUNT(*) AS n FROM steps WHERE from_type IS NOT NULL GROUP BY ALL),
shares AS (
  SELECT from_type, ROUND(n / (SELECT SUM(o.n) FROM counts o WHERE o.from_type = c.from_type), 6) AS part FROM counts c)
SELECT from_type, ROUND(SUM(part), 6) AS share_sum, COUNT(*) AS n_shares, TRUE AS sums_to_one FROM shares GROUP BY 1""",
        "price_by_type_check": f"""{DENSE}{STATES}{CALENDAR}{LEVELS}{MART},
checked AS (SELECT *, CAST(active_license_count * {LIST_PRICE} AS BIGINT) AS expected_price FROM mart)
SELECT date, type, active_license_price, expected_price,
       COALESCE(active_license_price = expected_price, FALSE) AS is_consistent,
       active_license_count >= 0 AND inactive_license_count >= 0 AND active_license_price >= 0 AS is_non_negative
FROM checked""",
        "mart_conservation": f"""{SPARSE_EDGE}{STATES}{CALENDAR}{PANEL}
SELECT c.date, (SELECT COUNT(*) FROM panel p WHERE p.date = c.date) AS total_licenses,
       (SELECT COUNT(*) FROM initial_licenses i WHERE i.creation_date <= c.date) AS existing_licenses
FROM calendar c""",
        # profiles
        "prof_seasonality": f"""{SPARSE}
SELECT YEAR(creation_date) AS year, COUNT(*) AS n_created,
       COUNT(*) FILTER (WHERE MONTH(creation_date) <= 3) AS n_first_quarter,
       COUNT(*) FILTER (WHERE ISODOW(creation_date) <= 5) AS n_weekday,
       ROUND(COUNT(*) FILTER (WHERE MONTH(creation_date) <= 3) / COUNT(*), 6) AS first_quarter_share
FROM initial_licenses GROUP BY 1""",
        "prof_customer_concentration": f"""{SPARSE}
SELECT ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, customer_id) AS customer_rank, customer_id,
       COUNT(*) AS n_licenses, ROUND(COUNT(*) / (SELECT COUNT(*) FROM initial_licenses), 6) AS license_share
FROM initial_licenses GROUP BY customer_id ORDER BY n_licenses DESC, customer_id LIMIT 10""",
        "prof_changes_per_license": "SELECT o_custkey AS license_id, COUNT(*) AS n_changes FROM orders GROUP BY 1",
        "prof_change_histogram": """
SELECT n_changes, COUNT(*) AS n_licenses
FROM (SELECT o_custkey, COUNT(*) AS n_changes FROM orders GROUP BY 1) GROUP BY n_changes""",
        "prof_price_moves": f"""{SPARSE}{STATES},
steps AS (SELECT price - LAG(price) OVER (PARTITION BY license_id ORDER BY date) AS step FROM states)
SELECT CASE WHEN step > 0 THEN 'rise' WHEN step < 0 THEN 'fall' ELSE 'same' END AS move, COUNT(*) AS n_moves
FROM steps WHERE step IS NOT NULL GROUP BY 1""",
        "prof_transitions": f"""{SPARSE}{STATES},
steps AS (SELECT LAG(type) OVER (PARTITION BY license_id ORDER BY date) AS from_type, type AS to_type FROM states),
counts AS (SELECT from_type, to_type, COUNT(*) AS n FROM steps WHERE from_type IS NOT NULL GROUP BY ALL)
SELECT from_type, to_type, n AS n_transitions,
       ROUND(n / (SELECT SUM(o.n) FROM counts o WHERE o.from_type = c.from_type), 6) AS transition_share
FROM counts c""",
        "prof_steady_state": f"""{SPARSE}{STATES},
steps AS (SELECT LAG(type) OVER (PARTITION BY license_id ORDER BY date) AS from_type, type AS to_type FROM states),
counts AS (SELECT from_type, to_type, COUNT(*) AS n FROM steps WHERE from_type IS NOT NULL GROUP BY ALL),
chances AS (SELECT from_type, to_type, n / SUM(n) OVER (PARTITION BY from_type) AS chance FROM counts),
walks AS (
  WITH RECURSIVE walk AS (
    SELECT DISTINCT from_type AS origin, from_type AS here, 1.0::DOUBLE AS share, 0 AS step FROM chances
    UNION ALL
    SELECT origin, to_type, CAST(SUM(share * chance) AS DOUBLE), step + 1
    FROM walk JOIN chances ON here = from_type WHERE step < 300 GROUP BY origin, to_type, step)
  SELECT * FROM walk WHERE step = 300)
SELECT origin AS from_type, here AS to_type, ROUND(share, 6) AS share FROM walks""",
        # allocation and log states
        "apportion": APPORTION,
        "repeat_rows": """
SELECT license_id, UNNEST(generate_series(1, n)) AS copy
FROM (SELECT o_custkey AS license_id, COUNT(*) AS n FROM orders GROUP BY 1)""",
        "assign_batches": f"""WITH {SPARSE_CHANGES}
SELECT id, date, (ROW_NUMBER() OVER (ORDER BY date, id) - 1) // 1000 AS batch_id FROM license_changes""",
        "toggle_states": TOGGLE,
        # incremental runs
        "inc_window": f"WITH {SPARSE_CHANGES} {RAW} WHERE date BETWEEN DATE '1996-01-02' AND DATE '1997-12-31'",
        "inc_first_run": f"WITH {SPARSE_CHANGES} {RAW} WHERE date <= DATE '1996-12-31'",
        **dict.fromkeys(
            ("inc_upsert", "inc_upsert_idempotent"),
            f"""WITH {SPARSE_CHANGES}
SELECT id, license_id, date, CASE WHEN date >= DATE '1997-01-01' THEN price + 1 ELSE price END AS price, type, renewable
FROM license_changes""",
        ),
        "inc_batches_equal_one_shot": f"WITH {SPARSE_CHANGES} {RAW}",
        "inc_checkpoint": f"""WITH {SPARSE_CHANGES}, {PLAIN},
all_days AS (SELECT date FROM license_changes UNION ALL SELECT creation_date FROM initial_licenses),
runs(run_id, as_of) AS (VALUES (1::BIGINT, DATE '1995-06-30'), (2::BIGINT, DATE '1997-06-30'))
SELECT run_id, (SELECT MAX(date) FROM all_days WHERE date <= as_of) AS last_data_date,
       (SELECT MAX(date) FROM all_days WHERE date <= as_of) AS last_processed_date
FROM runs""",
        "inc_watermarks": f"""WITH {SPARSE_CHANGES}
SELECT MAX(date) AS last_data_timestamp,
       MIN(date) FILTER (WHERE strftime(date, '%Y-%m') = '1996-03') AS last_processed_timestamp,
       COUNT(DISTINCT strftime(date, '%Y-%m')) FILTER (WHERE strftime(date, '%Y-%m') = '1996-03') AS failed_batches
FROM license_changes""",
        "inc_backfill": f"""WITH {SPARSE_CHANGES} {RAW}
WHERE id < {HALF} OR date >= (SELECT MAX(date) FROM license_changes) - INTERVAL 365 DAY""",
        "late_split": f"""WITH {SPARSE_CHANGES}
SELECT id, license_id, date, price, type, renewable,
       date < (SELECT MAX(date) FROM license_changes WHERE id < {HALF}) - INTERVAL 365 DAY AS is_late
FROM license_changes WHERE id >= {HALF}""",
        "recompute_affected": mart(SPARSE_EDGE),
        "metric_store": mart(SPARSE_EDGE),
        "partition_overwrite": f"""WITH {SPARSE_CHANGES},
moved AS (
  SELECT id, CAST(CASE WHEN renewable THEN date ELSE date + INTERVAL 45 DAY END AS DATE) AS date FROM license_changes)
SELECT id, date, CAST(date AS VARCHAR) AS event_day FROM moved""",
        "inc_null_keys": f"""WITH {SPARSE_CHANGES},
holed AS (SELECT * REPLACE (CASE WHEN id % 10 <> 0 THEN id END AS id) FROM license_changes)
SELECT *, id IS NULL AS rejected FROM holed UNION ALL SELECT *, TRUE FROM holed WHERE id IS NULL AND price = 100""",
        "inc_run_watermarks": f"""WITH {SPARSE_CHANGES}, {PLAIN},
all_days AS (SELECT date FROM license_changes UNION ALL SELECT creation_date FROM initial_licenses),
marks AS (
  SELECT MAX(date) FILTER (WHERE date <= DATE '1995-06-30') AS first_run,
         MAX(date) FILTER (WHERE date <= DATE '1997-06-30') AS second_run FROM all_days)
SELECT 1::BIGINT AS run_id, first_run AS last_data_date, first_run AS last_processed_date FROM marks
UNION ALL SELECT 2, second_run, first_run FROM marks""",
        "inc_metrics_gap": mart(UPDATED_EDGE),
        "dq_incremental": f"""{FAULTS.replace('license_changes AS (', 'first_changes AS (').replace('initial_licenses AS (', 'first_licenses AS (').replace('FROM (SELECT license_id, MIN(date) AS first_date FROM license_changes', 'FROM (SELECT license_id, MIN(date) AS first_date FROM first_changes')},
initial_licenses AS (SELECT * FROM first_licenses WHERE ord = 0),
license_changes AS (
  SELECT id, license_id, date, price, type, renewable FROM first_changes WHERE ord = 0 AND id % 10 <> 3
  UNION ALL
  SELECT id, license_id + CASE WHEN id % 20 = 3 THEN 1 ELSE 0 END, CAST(date + INTERVAL 30 DAY AS DATE),
         5000::BIGINT, 'SUPERVISION', NOT renewable FROM first_changes WHERE ord = 0 AND id % 10 = 3)"""
        + _validation(),
        "inc_undated": f"""WITH {SPARSE_CHANGES}
SELECT CASE WHEN id % 27 <> 13 THEN id END AS id, license_id, CASE WHEN id % 9 <> 4 THEN date END AS date, price, type,
       renewable, id % 9 = 4 OR id % 27 = 13 AS rejected FROM license_changes""",
        "inc_rejected_report": f"""WITH {SPARSE_CHANGES}
SELECT 'changes' AS table_name, CASE WHEN id % 7 = 3 THEN 'no key' ELSE 'no date' END AS reason, COUNT(*) AS n_rows
FROM license_changes WHERE id % 7 = 3 OR id % 9 = 4 GROUP BY ALL""",
        "inc_late_report": f"""WITH {SPARSE_CHANGES}, {PLAIN}, {LATE}
SELECT 'changes' AS table_name, COUNT(*) AS n_late, MIN(date) AS first_day, MAX(date) AS last_day,
       CAST(DATE '1996-06-30' - MIN(date) + 1 AS BIGINT) AS days
FROM late HAVING COUNT(*) > 0""",
        "inc_late_backfill": f"""WITH {SPARSE_CHANGES}
{RAW} WHERE date <= DATE '1996-06-30'""",
        "rows_known_at": f"""WITH {SPARSE_CHANGES}, {CHANGE_VERSIONS}
SELECT id, license_id, date, price, type, renewable FROM versions WHERE run_id <= 2
QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY run_id DESC) = 1""",
        "asof_known_at": f"""WITH {SPARSE_CHANGES}, {EDGE}, {CHANGE_VERSIONS},
runs AS (SELECT UNNEST([1, 2, 3]) AS seen_by),
known AS (
  SELECT seen_by, v.* FROM versions v JOIN runs ON run_id <= seen_by
  QUALIFY ROW_NUMBER() OVER (PARTITION BY seen_by, id ORDER BY run_id DESC) = 1),
candidates AS (
  SELECT seen_by, license_id, date, renewable, price, type, id FROM known
  UNION ALL SELECT seen_by, id, creation_date, renewable, price, type, -1 FROM initial_licenses, runs),
per_day AS (SELECT * FROM candidates QUALIFY ROW_NUMBER() OVER (PARTITION BY seen_by, license_id, date ORDER BY id DESC) = 1),
points AS (
  SELECT id AS point_id, license_id, CAST(date + INTERVAL 45 DAY AS DATE) AS date, 1 + id % 3 AS run_id FROM license_changes)
SELECT p.point_id, p.license_id, p.date, p.run_id, s.date AS state_date, s.renewable, s.price, s.type
FROM points p ASOF LEFT JOIN per_day s ON p.run_id = s.seen_by AND p.license_id = s.license_id AND p.date >= s.date""",
        "recompute_updates": mart(UPDATED_EDGE),
        # streams
        **dict.fromkeys(("stream_then_metrics", "stream_mart"), mart(SPARSE_EDGE)),
        "stream_dedup": "SELECT event_id, user_id, event_type FROM events",
        "stream_late_rows": """
SELECT event_id, user_id, event_type FROM events
WHERE event_id % 5 <> 0 OR ts > (SELECT MAX(ts) FROM events WHERE event_id % 5 <> 0) - INTERVAL 1 DAY""",
        **dict.fromkeys(
            ("stream_upsert", "stream_after_incremental", "stream_two_sources"), f"WITH {DENSE_CHANGES} {RAW}"
        ),
        "stream_daily_counts": """
SELECT CAST(ts AS DATE) AS date, event_type AS type, COUNT(*) AS n_changes FROM events GROUP BY 1, 2""",
    }
