"""The same results in plain SQL over the given tables, written independently of the operators.

Numbers that Spark rounds half-up from exact decimals are computed here with whole-number
arithmetic, because a rounded double can fall on the other side of a tie.
"""

from __future__ import annotations


def rounded(numerator: str, denominator: str, digits: int) -> str:
    """Half-up ``numerator / denominator`` for whole, non-negative numbers, as a double."""
    scale = 10**digits
    return (
        f"CAST((2 * CAST({numerator} AS HUGEINT) * {scale} + ({denominator})) "
        f"// (2 * CAST({denominator} AS HUGEINT)) AS DOUBLE) / {scale}.0::DOUBLE"
    )


def title(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '), "
        "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
    )


def violations(rules: dict[str, str]) -> str:
    cases = ", ".join(
        f"CASE WHEN NOT coalesce({condition}, false) THEN '{name}' END"
        for name, condition in rules.items()
    )
    return f"coalesce(array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), ','), '')"


def cents(column: str) -> str:
    return f"CAST({column} * 100 AS BIGINT)"


DERIVE = f"""
  round((floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60.0, 2) AS trip_duration_min,
  round(trip_distance_mi * 1.609344, 3) AS trip_distance_km,
  CASE WHEN fare_amount > 0 THEN {rounded(cents('tip_amount'), cents('fare_amount'), 4)} ELSE 0.0 END AS tip_pct,
  CAST(pickup_datetime AS DATE) AS pickup_date,
  CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
  airport_fee_amount > 0 AS is_airport_trip"""

def half_up(value: str, digits: int) -> str:
    """A double rounded half-up by its decimal digits, the way the operators define it."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,16)), {digits}) AS DOUBLE)"


SPEED = f"""CASE WHEN trip_duration_min > 0
    THEN {half_up('trip_distance_km / (trip_duration_min / 60.0)', 2)} END AS avg_speed_kmh"""

MONEY = (
    "fare_amount extra_amount mta_tax_amount tip_amount tolls_amount improvement_surcharge_amount "
    "congestion_surcharge_amount airport_fee_amount cbd_congestion_fee_amount total_amount"
).split()
ZERO_MONEY = ", ".join(
    f"CAST(0 AS DECIMAL(10,2)) AS {name}"
    for name in (
        "extra_amount", "tolls_amount", "improvement_surcharge_amount",
        "congestion_surcharge_amount", "cbd_congestion_fee_amount",
    )
)

SHIPMENT_RULES = {
    "pickup_not_null": "pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL",
    "chronological_order": "dropoff_datetime > pickup_datetime",
    "duration_within_bounds": "trip_duration_min >= 1440 AND trip_duration_min <= 525600",
    "distance_positive": "trip_distance_mi > 0 AND trip_distance_mi < 45",
    "fare_non_negative": "fare_amount >= 0 AND total_amount >= 0",
    "passenger_count_plausible": "passenger_count IS NULL OR (passenger_count >= 0 AND passenger_count <= 9)",
    "pickup_within_declared_month": "strftime(pickup_datetime, '%Y-%m') = load_month",
    "location_ids_valid": "pu_location_id >= 0 AND pu_location_id <= 24 AND do_location_id >= 0 AND do_location_id <= 24",
}
EVENT_RULES = {
    **SHIPMENT_RULES,
    "duration_within_bounds": "trip_duration_min >= 1 AND trip_duration_min <= 360",
    "distance_positive": "trip_distance_mi > 0 AND trip_distance_mi < 200",
}

SHIPMENTS = f"""
typed AS (
  SELECT order_key, line_number, part_key, supplier_key, list_amount, vendor_id, pickup_datetime,
         dropoff_datetime, passenger_count, trip_distance_mi, rate_code_id, store_and_fwd_flag,
         pu_location_id, do_location_id, payment_type_id,
         CAST(fare AS DECIMAL(10,2)) AS fare_amount, CAST(tax AS DECIMAL(10,2)) AS mta_tax_amount,
         CAST(tip AS DECIMAL(10,2)) AS tip_amount, CAST(fare + tax AS DECIMAL(10,2)) AS total_amount,
         CAST(CASE WHEN store_and_fwd_flag = 'R' THEN 1.75 ELSE 0 END AS DECIMAL(10,2)) AS airport_fee_amount,
         {ZERO_MONEY}, load_month
  FROM (
    SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_number, l_partkey AS part_key,
           l_suppkey AS supplier_key, CAST(l_extendedprice AS DECIMAL(10,2)) AS list_amount,
           CAST(l_suppkey % 9 AS INTEGER) AS vendor_id, o_orderdate AS pickup_datetime,
           l_shipdate AS dropoff_datetime, CAST(l_partkey % 11 AS INTEGER) AS passenger_count,
           l_quantity AS trip_distance_mi, l_linenumber AS rate_code_id,
           l_returnflag AS store_and_fwd_flag, s_nationkey AS pu_location_id,
           c_nationkey AS do_location_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type_id,
           CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS fare,
           CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
             * CAST(l_tax AS DECIMAL(4,2)) AS tax,
           CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS tip,
           strftime(o_orderdate, '%Y-%m') AS load_month
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN supplier ON l_suppkey = s_suppkey) AS spelled
),
identified AS (
  SELECT *, sha256(concat_ws('||', CAST(order_key AS VARCHAR), CAST(line_number AS VARCHAR))) AS trip_id
  FROM typed
),
kept AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_key, line_number, load_month
      ORDER BY dropoff_datetime DESC, part_key, supplier_key, trip_distance_mi, list_amount) AS copy
    FROM identified) WHERE copy = 1
),
derived AS (SELECT *, {SPEED} FROM (SELECT *, {DERIVE} FROM kept)),
tagged AS (SELECT *, {violations(SHIPMENT_RULES)} AS violations FROM derived),
valid AS (SELECT * FROM tagged WHERE violations = ''),
rejected AS (SELECT * FROM tagged WHERE violations <> '')"""

EVENT_CODES = """CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
  WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END"""

EVENTS = f"""
typed AS (
  SELECT event_id, CAST(user_id % 9 AS INTEGER) AS vendor_id, ts AS pickup_datetime,
         ts + to_seconds(CAST(round(value * 60) AS INTEGER)) AS dropoff_datetime,
         CAST(k % 11 AS INTEGER) AS passenger_count, CAST(k AS DOUBLE) AS trip_distance_mi,
         CAST(event_id % 8 AS INTEGER) AS rate_code_id,
         CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         c_nationkey AS pu_location_id, CAST(k % 25 AS INTEGER) AS do_location_id,
         {EVENT_CODES} AS payment_type_id,
         CAST(value AS DECIMAL(10,2)) AS fare_amount, CAST(0 AS DECIMAL(10,2)) AS mta_tax_amount,
         CAST(CAST(value AS DECIMAL(10,2)) * CAST(k % 30 AS DECIMAL(4,0)) * 0.01 AS DECIMAL(10,2)) AS tip_amount,
         CAST(CAST(value AS DECIMAL(10,2))
           + CAST(value AS DECIMAL(10,2)) * CAST(k % 30 AS DECIMAL(4,0)) * 0.01 AS DECIMAL(10,2)) AS total_amount,
         CAST(CASE WHEN event_type = 'signup' THEN 1.75 ELSE 0 END AS DECIMAL(10,2)) AS airport_fee_amount,
         {ZERO_MONEY}, strftime(ts, '%Y-%m') AS load_month
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
       LEFT JOIN customer ON user_id = c_custkey
),
derived AS (
  SELECT *, {SPEED} FROM (
    SELECT *, sha256(CAST(event_id AS VARCHAR)) AS trip_id, {DERIVE} FROM typed)
),
tagged AS (SELECT *, {violations(EVENT_RULES)} AS violations FROM derived),
valid AS (SELECT * FROM tagged WHERE violations = ''),
rejected AS (SELECT * FROM tagged WHERE violations <> '')"""


def places(change_day: str) -> str:
    airport = "regexp_matches(lower({}), 'nation_(3|13|23)$')"
    return f"""
place AS (
  SELECT n_nationkey AS id, {title('r_name')} AS borough, n_name AS zone,
         CASE n_nationkey % 3 WHEN 0 THEN 'yellow zone' WHEN 1 THEN 'boro zone' ELSE 'n/a' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT -1, 'Nao informado', 'Nao informado', 'n/a'
),
location AS (
  SELECT id, borough, zone, service_zone, {airport.format('zone')} AS is_airport,
         DATE '1900-01-01' AS first_day,
         CASE WHEN id >= 0 AND id % 5 = 0 THEN DATE '{change_day}' - 1 ELSE DATE '9999-12-31' END AS last_day
  FROM place
  UNION ALL
  SELECT id, borough, zone || ' NEW', service_zone, false, DATE '{change_day}', DATE '9999-12-31'
  FROM place WHERE id >= 0 AND id % 5 = 0
)"""


def fact(vendors: str, rates: str, payments: str) -> str:
    def key(prefix: str) -> str:
        moment = f"{prefix}_datetime"
        return (
            f"CAST(strftime({moment}, '%Y%m%d') AS INTEGER) AS {prefix}_date_key, "
            f"CAST(hour({moment}) * 100 + minute({moment}) AS INTEGER) AS {prefix}_time_key"
        )

    return f"""
fact AS (
  SELECT trip_id, {key('pickup')}, {key('dropoff')},
         CAST(CASE WHEN vendor_id IN ({vendors}) THEN vendor_id ELSE -1 END AS INTEGER) AS vendor_key,
         CAST(CASE WHEN rate_code_id IN ({rates}) THEN rate_code_id ELSE -1 END AS INTEGER) AS rate_code_key,
         CAST(CASE WHEN payment_type_id IN ({payments}) THEN payment_type_id ELSE -1 END AS INTEGER) AS payment_type_key,
         store_and_fwd_flag, is_airport_trip, passenger_count, trip_distance_km, trip_duration_min,
         {', '.join(MONEY)}, avg_speed_kmh, tip_pct, load_month,
         p.id AS pickup_id, p.zone AS pickup_zone, p.borough AS pickup_borough,
         p.is_airport AS pickup_airport, p.first_day AS pickup_version,
         d.id AS dropoff_id, d.zone AS dropoff_zone, d.borough AS dropoff_borough, d.first_day AS dropoff_version
  FROM valid
  LEFT JOIN location p ON pu_location_id = p.id AND pickup_date BETWEEN p.first_day AND p.last_day
  LEFT JOIN location d ON do_location_id = d.id AND pickup_date BETWEEN d.first_day AND d.last_day
)"""


def days(source: str) -> str:
    return f"""
bound AS (
  SELECT date_trunc('month', min(least(CAST(pickup_datetime AS DATE), CAST(dropoff_datetime AS DATE)))) AS first_day,
         last_day(max(greatest(CAST(pickup_datetime AS DATE), CAST(dropoff_datetime AS DATE)))) AS last_day
  FROM {source}
),
day AS (
  SELECT CAST(d AS DATE) AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key
  FROM (SELECT unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM bound)
)"""


CLOCK = """
minutes AS (
  SELECT h * 100 + m AS time_key, h AS hour, m AS minute,
         lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') AS time_label,
         CASE WHEN h < 6 THEN 'Madrugada' WHEN h < 12 THEN 'Manha' WHEN h < 18 THEN 'Tarde' ELSE 'Noite' END AS day_period,
         (h >= 7 AND h <= 9) OR (h >= 16 AND h <= 19) AS is_rush_hour
  FROM (SELECT CAST(i // 60 AS INTEGER) AS h, CAST(i % 60 AS INTEGER) AS m FROM range(1440) AS t(i))
)"""

WEEKEND = "dayofweek(full_date) IN (0, 6)"
DAY_TYPE = f"CASE WHEN {WEEKEND} THEN 'Fim de semana' ELSE 'Dia util' END"

SHIPMENT_PAYMENTS = """
payment AS (
  SELECT * FROM (VALUES (1, 'Urgent'), (2, 'High'), (3, 'Medium'), (4, 'Not specified'), (-1, 'Nao informado'))
    AS t(payment_type_key, payment_type_name)
)"""
SHIPMENT_RATES = """
rate AS (
  SELECT i AS rate_code_key, 'Line ' || i AS rate_code_name FROM range(1, 7) AS t(i)
  UNION ALL SELECT -1, 'Nao informado'
)"""
SHIPMENT_VENDORS = """
vendor AS (
  SELECT i AS vendor_key, 'Carrier ' || i AS vendor_name FROM range(0, 7) AS t(i)
  UNION ALL SELECT -1, 'Nao informado'
)"""

SHIPMENT_FACT = ",".join(
    [SHIPMENTS, places("1998-06-01"), fact("0,1,2,3,4,5,6", "1,2,3,4,5,6", "1,2,3,4")]
)
EVENT_FACT = ",".join(
    [EVENTS, places("2024-01-15"), fact("0,1,2,3,4,5,6,7", "1,2,3,4,5,6", "1,2,3,4")]
)


def using(ctes: str, query: str) -> str:
    return f"WITH {ctes}\n{query}"


KM = "CAST(round(trip_distance_km * 1000) AS BIGINT)"
MINUTES = "CAST(round(trip_duration_min * 100) AS BIGINT)"
SPEEDS = "CAST(round(avg_speed_kmh * 100) AS BIGINT)"
TIPS = "CAST(round(tip_pct * 10000) AS BIGINT)"
TRIPS = "count(*) AS corridas"
REVENUE = "CAST(sum(total_amount) AS DECIMAL(20,2)) AS receita"
TICKET = rounded(f"sum({cents('total_amount')})", "count(*) * 100", 2) + " AS ticket_medio"


def mean(units: str, per_unit: int, digits: int, name: str) -> str:
    return f"{rounded(f'sum({units})', f'count(*) * {per_unit}', digits)} AS {name}"


FACT_COLUMNS = f"""trip_id, pickup_date_key, pickup_time_key, dropoff_date_key, dropoff_time_key,
  vendor_key, rate_code_key, payment_type_key, store_and_fwd_flag, is_airport_trip, passenger_count,
  trip_distance_km, trip_duration_min, {', '.join(MONEY)}, avg_speed_kmh, tip_pct, load_month,
  pickup_id IS NOT NULL AS pickup_location_known, dropoff_id IS NOT NULL AS dropoff_location_known"""

TYPED_COLUMNS = f"""order_key, line_number, part_key, supplier_key, list_amount, vendor_id,
  pickup_datetime, dropoff_datetime, passenger_count, trip_distance_mi, rate_code_id,
  store_and_fwd_flag, pu_location_id, do_location_id, payment_type_id, {', '.join(MONEY)}, load_month"""

DERIVED_COLUMNS = """trip_duration_min, trip_distance_km, avg_speed_kmh, tip_pct, pickup_date,
  pickup_hour, is_airport_trip"""

SPLIT_COLUMNS = "trip_id, order_key, line_number, trip_duration_min, trip_distance_km, total_amount, load_month"

MESSY = """
messy AS (
  SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(c_custkey // 2 AS INTEGER) END AS LocationID,
         CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'unknown' WHEN 3 THEN 'N/A'
           ELSE c_mktsegment END AS Borough,
         CASE WHEN c_custkey % 5 = 0 THEN ' ' WHEN c_custkey % 11 = 0 THEN ' Airport ' || c_name
           ELSE c_name END AS Zone,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS service_zone
  FROM customer
)"""

CLEAN = f"""{MESSY},
clean AS (
  SELECT LocationID AS location_id,
         CASE WHEN nullif(trim(Borough), '') IS NULL OR lower(trim(Borough)) IN ('unknown', 'n/a')
           THEN 'Desconhecido' ELSE {title('trim(Borough)')} END AS borough,
         coalesce(nullif(trim(Zone), ''), 'Zona nao informada') AS zone,
         coalesce(lower(nullif(trim(service_zone), '')), 'n/a') AS service_zone
  FROM messy
),
zones AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY borough, zone, service_zone) AS copy
    FROM clean) WHERE copy = 1
)"""

LATER_CUSTOMERS = """
later AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE c_custkey % 4 WHEN 0 THEN 'MOVED' WHEN 1 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_custkey % 10 <> 7
  UNION ALL
  SELECT c_custkey + 1000000000, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 20 = 0
)"""

VERSIONS = f"""{LATER_CUSTOMERS},
pair AS (
  SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, o.c_custkey IS NOT NULL AS was,
         n.c_custkey IS NOT NULL AS is_now, o.c_nationkey AS old_nation, o.c_mktsegment AS old_segment,
         n.c_nationkey AS new_nation, n.c_mktsegment AS new_segment,
         o.c_nationkey IS DISTINCT FROM n.c_nationkey OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment AS differs
  FROM customer o FULL JOIN later n ON o.c_custkey = n.c_custkey
),
version AS (
  SELECT c_custkey, old_nation AS c_nationkey, old_segment AS c_mktsegment, DATE '1900-01-01' AS effective_from,
         CASE WHEN is_now AND differs THEN DATE '2024-01-31' ELSE DATE '9999-12-31' END AS effective_to,
         NOT (is_now AND differs) AS is_current
  FROM pair WHERE was
  UNION ALL
  SELECT c_custkey, new_nation, new_segment,
         CASE WHEN was THEN DATE '2024-02-01' ELSE DATE '1900-01-01' END, DATE '9999-12-31', true
  FROM pair WHERE is_now AND (NOT was OR differs)
)"""

ORPHAN_KEYS = (
    "pickup_date_key dropoff_date_key pickup_time_key dropoff_time_key vendor_key rate_code_key"
).split()

DQ = f"""{SHIPMENT_FACT},{CLOCK},{days('valid')},{SHIPMENT_PAYMENTS},{SHIPMENT_RATES},{SHIPMENT_VENDORS},
orphan AS (
  SELECT count(*) FILTER (coalesce(pickup_id, -1) NOT IN (SELECT id FROM location)) AS pickup_location,
         count(*) FILTER (coalesce(dropoff_id, -1) NOT IN (SELECT id FROM location)) AS dropoff_location,
         count(*) FILTER (pickup_date_key NOT IN (SELECT date_key FROM day)) + count(*) FILTER (dropoff_date_key NOT IN (SELECT date_key FROM day))
         + count(*) FILTER (pickup_time_key NOT IN (SELECT time_key FROM minutes)) + count(*) FILTER (dropoff_time_key NOT IN (SELECT time_key FROM minutes))
         + count(*) FILTER (vendor_key NOT IN (SELECT vendor_key FROM vendor)) + count(*) FILTER (rate_code_key NOT IN (SELECT rate_code_key FROM rate))
         + count(*) FILTER (payment_type_key NOT IN (SELECT payment_type_key FROM payment)) AS others
  FROM fact
),
result AS (
  SELECT 'silver.fct_source_trips' AS target, 'no_duplicate_trip_ids' AS expectation, 'fail' AS severity,
         (SELECT count(*) FROM (SELECT trip_id FROM valid GROUP BY trip_id HAVING count(*) > 1)) AS observed,
         '== 0' AS expected
  UNION ALL SELECT 'silver.fct_source_trips', 'surrogate_keys_not_null', 'fail',
         (SELECT count(*) FROM valid WHERE trip_id IS NULL), '== 0'
  UNION ALL SELECT 'silver.fct_source_trips', 'nothing_observed', 'warn', NULL, '== 0'
  UNION ALL SELECT 'gold.fct_trips', 'no_orphan_location_keys', 'fail',
         (SELECT pickup_location + dropoff_location FROM orphan), '== 0'
  UNION ALL SELECT 'gold.fct_trips', 'no_orphan_keys', 'fail',
         (SELECT pickup_location + dropoff_location + others FROM orphan), '== 0'
  UNION ALL SELECT 'gold.fct_trips', 'tip_ratio_within_bounds', 'warn',
         (SELECT count(*) FROM fact WHERE tip_pct > 1.0), '== 0'
  UNION ALL SELECT 'gold.fct_trips', 'fact_matches_silver_rowcount', 'fail',
         abs((SELECT count(*) FROM fact) - (SELECT count(*) FROM valid)), '== 0'
  UNION ALL SELECT 'gold.fct_trips', 'few_generous_tips', 'warn',
         (SELECT count(*) FROM fact WHERE tip_pct > 0.1), '<= 0'
),
judged AS (SELECT *, coalesce(CASE split_part(expected, ' ', 1)
    WHEN '==' THEN observed = split_part(expected, ' ', 2)::BIGINT WHEN '!=' THEN observed <> split_part(expected, ' ', 2)::BIGINT
    WHEN '<=' THEN observed <= split_part(expected, ' ', 2)::BIGINT WHEN '>=' THEN observed >= split_part(expected, ' ', 2)::BIGINT
    WHEN '<' THEN observed < split_part(expected, ' ', 2)::BIGINT ELSE observed > split_part(expected, ' ', 2)::BIGINT END, false) AS passed
  FROM result)"""

TWO_RUNS = "(SELECT 'first' AS run_id UNION ALL SELECT 'second')"
DQ_COLUMNS = "target, expectation, severity, observed, expected, passed"

PERIOD_BOROUGH = """FROM fact JOIN minutes ON pickup_time_key = time_key
  GROUP BY day_period, pickup_borough"""

ORACLES: dict[str, str] = {
    "bronze_ingest": """SELECT *, 'lineitem.parquet' AS _source_file, 'batch' AS _batch_id,
        '1995-01' AS load_month FROM lineitem""",
    "bronze_csv_lookup": using(MESSY, "SELECT * FROM messy"),
    "table_source": """SELECT event_id, ts, user_id, event_type, value, strftime(ts, '%Y-%m') AS load_month
        FROM events""",
    "months_scan": using(
        SHIPMENTS,
        """SELECT trip_id, order_key, line_number, total_amount, load_month FROM valid
        WHERE load_month IN ('1995-03', '1996-01', '1996-02', '1999-12')""",
    ),
    "bronze_lineage": """SELECT strftime(ts, '%Y-%m') AS load_month, 'batch-' || event_type AS _batch_id,
        min(ts) AS ingerido_em, count(*) AS linhas FROM events GROUP BY 1, 2""",
    "silver_normalize": using(
        SHIPMENTS,
        """SELECT order_key, CAST(line_number AS INTEGER) AS line_number, CAST(vendor_id AS BIGINT) AS vendor_id,
        pickup_datetime, dropoff_datetime, trip_distance_mi, pu_location_id, do_location_id,
        CAST(payment_type_id AS VARCHAR) AS payment_type_id, true AS extra_missing, load_month FROM typed""",
    ),
    "silver_cast": using(SHIPMENTS, f"SELECT {TYPED_COLUMNS} FROM typed"),
    "silver_derive": using(EVENTS, f"SELECT event_id, {DERIVED_COLUMNS} FROM derived"),
    "silver_zones": using(CLEAN, "SELECT * FROM zones"),
    "silver_flow": using(
        EVENTS,
        f"""SELECT event_id, trip_id, fare_amount, tip_amount, total_amount, {DERIVED_COLUMNS},
        violations = '' AS accepted FROM tagged""",
    ),
    "trip_id": using(
        SHIPMENTS,
        """SELECT sha256(concat_ws('||', CAST(vendor_id AS VARCHAR), CAST(pickup_datetime AS VARCHAR),
          CAST(dropoff_datetime AS VARCHAR), CAST(pu_location_id AS VARCHAR), CAST(do_location_id AS VARCHAR),
          CAST(total_amount AS VARCHAR), CAST(passenger_count AS VARCHAR))) AS trip_id, order_key, line_number
        FROM typed""",
    ),
    "dedup_latest": using(
        SHIPMENTS,
        """SELECT trip_id, order_key, line_number, part_key, supplier_key, list_amount, dropoff_datetime,
        load_month FROM kept""",
    ),
    "rule_violations": using(SHIPMENTS, "SELECT trip_id, violations FROM tagged"),
    "split_valid": using(SHIPMENTS, f"SELECT {SPLIT_COLUMNS} FROM valid"),
    "split_quarantine": using(SHIPMENTS, f"SELECT {SPLIT_COLUMNS}, violations FROM rejected"),
    "reconcile_layers": using(
        SHIPMENTS,
        """SELECT load_month, ingeridas, coalesce(aceitas, 0) AS aceitas, coalesce(rejeitadas, 0) AS rejeitadas,
          ingeridas - distintas AS duplicadas, distintas - coalesce(aceitas, 0) - coalesce(rejeitadas, 0) AS diferenca
        FROM (SELECT load_month, count(*) AS ingeridas, count(DISTINCT trip_id) AS distintas FROM identified GROUP BY load_month)
        LEFT JOIN (SELECT load_month, count(*) AS aceitas FROM valid GROUP BY load_month) USING (load_month)
        LEFT JOIN (SELECT load_month, count(*) AS rejeitadas FROM rejected GROUP BY load_month) USING (load_month)""",
    ),
    "quarantine_reasons": using(
        SHIPMENTS,
        """SELECT motivo, count(*) AS linhas
        FROM (SELECT unnest(string_split(violations, ',')) AS motivo FROM rejected) GROUP BY motivo""",
    ),
    "quarantine_sample": using(
        SHIPMENTS,
        """SELECT order_key, line_number, trip_distance_mi, load_month FROM rejected
        WHERE list_contains(string_split(violations, ','), 'distance_positive')
        ORDER BY order_key, line_number, load_month LIMIT 20""",
    ),
    "dim_date": using(
        SHIPMENTS + "," + days("typed"),
        f"""SELECT date_key, full_date, CAST(year(full_date) AS INTEGER) AS year,
          CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
          strftime(full_date, '%B') AS month_name, strftime(full_date, '%Y-%m') AS year_month,
          CAST(day(full_date) AS INTEGER) AS day, CAST(dayofyear(full_date) AS INTEGER) AS day_of_year,
          CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
          CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, strftime(full_date, '%A') AS day_name,
          {WEEKEND} AS is_weekend, {DAY_TYPE} AS day_type, day(full_date) = 1 AS is_month_start,
          full_date = last_day(full_date) AS is_month_end FROM day""",
    ),
    "dim_time": using(
        CLOCK,
        """SELECT minutes.*, coalesce(events, 0) AS events FROM minutes
        LEFT JOIN (SELECT hour(ts) * 100 + minute(ts) AS time_key, count(*) AS events FROM events GROUP BY 1)
        USING (time_key)""",
    ),
    "dim_static": using(
        ",".join([SHIPMENT_FACT, SHIPMENT_VENDORS, SHIPMENT_RATES, SHIPMENT_PAYMENTS]),
        " UNION ALL ".join(
            f"""SELECT '{name}' AS dimension, CAST({table}.{key} AS INTEGER) AS code, {label} AS label,
            coalesce(trips, 0) AS trips FROM {table}
            LEFT JOIN (SELECT {key}, count(*) AS trips FROM fact GROUP BY 1) u ON u.{key} = {table}.{key}"""
            for name, table, key, label in (
                ("vendor", "vendor", "vendor_key", "vendor_name"),
                ("rate_code", "rate", "rate_code_key", "rate_code_name"),
                ("payment_type", "payment", "payment_type_key", "payment_type_name"),
            )
        ),
    ),
    "dim_location": using(
        CLEAN,
        """SELECT location_id, borough, zone, service_zone,
          regexp_matches(lower(zone), '(jfk|laguardia|newark|airport)') AS is_airport,
          DATE '1900-01-01' AS effective_from, DATE '9999-12-31' AS effective_to, true AS is_current
        FROM (SELECT * FROM zones WHERE location_id IS NOT NULL
              UNION ALL SELECT -1, 'Nao informado', 'Nao informado', 'n/a')""",
    ),
    "calendar_bounds": using(
        SHIPMENTS + "," + days("valid"),
        "SELECT CAST(first_day AS DATE) AS first_day, CAST(last_day AS DATE) AS last_day FROM bound",
    ),
    "fact_pit_join": using(
        SHIPMENT_FACT,
        """SELECT trip_id, load_month, pickup_zone, pickup_version, dropoff_zone, dropoff_version FROM fact""",
    ),
    "fact_pit_by_month": using(SHIPMENT_FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
    "gold_fact": using(SHIPMENT_FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
    "fk_resolve_static": using(
        SHIPMENT_FACT,
        """SELECT vendor_key, rate_code_key, payment_type_key, count(*) AS trips FROM fact GROUP BY 1, 2, 3""",
    ),
    "fk_resolve_scd": using(
        SHIPMENTS,
        f"""SELECT pu_location_id % 3 <> 1 AS pickup_location_known, do_location_id % 3 <> 1 AS dropoff_location_known,
        count(*) AS trips, {REVENUE} FROM valid GROUP BY 1, 2""",
    ),
    "star_join": using(
        EVENT_FACT + "," + CLOCK,
        f"""SELECT trip_id, load_month AS year_month,
          CASE WHEN dayofweek(strptime(CAST(pickup_date_key AS VARCHAR), '%Y%m%d')) IN (0, 6)
            THEN 'Fim de semana' ELSE 'Dia util' END AS day_type,
          time_label, day_period, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone,
          CASE WHEN vendor_key = -1 THEN 'Nao informado' ELSE 'Channel ' || vendor_key END AS vendor_name,
          CASE WHEN rate_code_key = -1 THEN 'Nao informado' ELSE 'Plan ' || rate_code_key END AS rate_code_name,
          CASE payment_type_key WHEN 1 THEN 'click' WHEN 2 THEN 'error' WHEN 3 THEN 'purchase'
            WHEN 4 THEN 'signup' ELSE 'Nao informado' END AS payment_type_name, total_amount
        FROM fact JOIN minutes ON pickup_time_key = time_key""",
    ),
    "orphan_check": using(
        SHIPMENT_FACT,
        """SELECT 'pickup_location_key' AS foreign_key, count(*) FILTER (WHERE pickup_id % 4 = 2) AS observed FROM fact
        UNION ALL SELECT 'dropoff_location_key', count(*) FILTER (WHERE dropoff_id % 4 = 2) FROM fact
        UNION ALL SELECT 'payment_type_key', count(*) FILTER (WHERE payment_type_key = 3) FROM fact
        UNION ALL SELECT unnest(["""
        + ", ".join(f"'{key}'" for key in ORPHAN_KEYS)
        + "]), 0",
    ),
    "dup_check": using(
        SHIPMENTS,
        """SELECT 'bronze' AS layer,
          (SELECT count(*) FROM (SELECT trip_id FROM identified GROUP BY trip_id HAVING count(*) > 1)) AS observed
        UNION ALL SELECT 'silver',
          (SELECT count(*) FROM (SELECT trip_id FROM valid GROUP BY trip_id HAVING count(*) > 1))""",
    ),
    "rowcount_match": using(
        SHIPMENT_FACT,
        """SELECT load_month, fact_rows, silver_rows, abs(fact_rows - silver_rows) AS observed
        FROM (SELECT load_month, count(*) AS fact_rows FROM fact GROUP BY load_month)
        JOIN (SELECT load_month, count(*) AS silver_rows FROM valid GROUP BY load_month) USING (load_month)""",
    ),
    "replace_partitions": using(
        SHIPMENTS,
        """SELECT trip_id, order_key, line_number, trip_distance_mi, total_amount, load_month FROM valid
        WHERE load_month <> '1997-01' AND NOT (load_month LIKE '1996%' AND trip_distance_mi >= 20)""",
    ),
    "full_overwrite": """SELECT s_suppkey, s_name, s_nationkey, s_acctbal + 1 AS s_acctbal FROM supplier
        WHERE s_nationkey <> 3""",
    "append_history": "SELECT * FROM customer",
    "scd1_upsert": """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' v2' ELSE s_name END AS s_name,
          s_nationkey, s_acctbal FROM supplier
        UNION ALL SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_suppkey % 10 = 0""",
    "scd2_upsert": using(VERSIONS, "SELECT * FROM version"),
    "scd2_changed": using(
        VERSIONS,
        """SELECT effective_from, effective_to, is_current, count(*) AS versions FROM version GROUP BY 1, 2, 3""",
    ),
    "snapshot_diff": using(
        VERSIONS,
        """SELECT c_custkey, CASE WHEN NOT was THEN 'added' WHEN NOT is_now THEN 'removed' ELSE 'changed' END AS change
        FROM pair WHERE NOT was OR NOT is_now OR differs""",
    ),
    "dq_gate": f"""WITH {DQ} SELECT {DQ_COLUMNS}, false AS run_passed FROM judged
        UNION ALL SELECT 'gold.fct_trips', 'nothing_shipped', 'fail', (SELECT count(*) FROM fact), '== 0', (SELECT count(*) = 0 FROM fact), false""",
    "bronze_file": """SELECT event_id, value, strftime(ts, '%Y-%m') AS load_month, 'batch' AS _batch_id,
        'green_tripdata_' || strftime(ts, '%Y-%m') || '.parquet' AS file_name FROM events""",
    "schema_widening": """SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS load_month,
        CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice END AS o_totalprice FROM orders""",
    "scd2_untracked": """WITH later AS (
          SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment, c_acctbal + 1 AS balance,
                 c_custkey % 3 = 0 AND c_mktsegment <> 'MOVED' AS differs FROM customer),
        both_loads AS (SELECT c.c_custkey, c.c_mktsegment, c.c_acctbal, l.segment, l.balance, l.differs FROM customer c JOIN later l USING (c_custkey))
        SELECT c_custkey, c_mktsegment, c_acctbal, DATE '1900-01-01' AS effective_from,
               CASE WHEN differs THEN DATE '2024-01-31' ELSE DATE '9999-12-31' END AS effective_to, NOT differs AS is_current FROM both_loads
        UNION ALL SELECT c_custkey, segment, balance, DATE '2024-02-01', DATE '9999-12-31', true FROM both_loads WHERE differs""",
    "scd2_backfill": using(
        LATER_CUSTOMERS,
        """SELECT c_custkey, c_nationkey, c_mktsegment,
          CASE WHEN first THEN DATE '1900-01-01' ELSE day END AS effective_from,
          coalesce(CAST(lead(day) OVER member - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS effective_to,
          lead(day) OVER member IS NULL AS is_current
        FROM (
          SELECT *, lag(day) OVER loads IS NULL AS first,
            lag(day) OVER loads IS NULL OR lag(c_nationkey) OVER loads IS DISTINCT FROM c_nationkey
              OR lag(c_mktsegment) OVER loads IS DISTINCT FROM c_mktsegment AS differs
          FROM (
            SELECT DATE '2024-01-01' AS day, c_custkey, c_nationkey, c_mktsegment FROM customer
            UNION ALL SELECT DATE '2024-02-01', c_custkey, c_nationkey, c_mktsegment FROM later
            UNION ALL SELECT DATE '2024-03-01', c_custkey, c_nationkey, CASE WHEN c_custkey % 6 = 0 THEN 'THIRD' ELSE c_mktsegment END FROM customer)
          WINDOW loads AS (PARTITION BY c_custkey ORDER BY day))
        WHERE differs WINDOW member AS (PARTITION BY c_custkey ORDER BY day)""",
    ),
    "clustered_skipping": """SELECT unnest(['l_partkey', 'l_suppkey']) AS name, true AS skips, CAST(64 AS BIGINT) AS files""",
    "incremental_reland": """SELECT event_id, ts, event_type, CASE WHEN event_id % 3 = 0 THEN value * 2 ELSE value END AS value,
        CASE WHEN event_id % 3 = 2 THEN value / 4 END AS fee,
        CASE WHEN event_id % 3 = 0 THEN '2024-01' ELSE '2024-02' END AS load_month FROM events""",
    "incremental_run": using(EVENT_FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
    "bronze_table": using(
        EVENTS,
        """SELECT load_month, store_and_fwd_flag AS flag, count(*) AS trips, CAST(sum(fare_amount) AS DECIMAL(20,2)) AS fares
        FROM typed GROUP BY 1, 2""",
    ),
    "clustered_rewrite": using(
        SHIPMENTS,
        """SELECT trip_id, order_key, line_number, trip_distance_mi, total_amount, pu_location_id, pickup_datetime,
        load_month FROM valid""",
    ),
    "dq_expectations": using(DQ, f"SELECT {DQ_COLUMNS} FROM judged"),
    "dq_on_write": using(
        DQ, f"SELECT {DQ_COLUMNS} FROM judged WHERE expectation IN ('tip_ratio_within_bounds', 'few_generous_tips')"
    ),
    "dq_failures": using(
        DQ, f"SELECT run_id, {DQ_COLUMNS} FROM judged CROSS JOIN {TWO_RUNS} AS runs WHERE NOT passed"
    ),
    "a7_dq_history": using(DQ, f"SELECT run_id, {DQ_COLUMNS} FROM judged CROSS JOIN {TWO_RUNS} AS runs"),
    "a1_revenue_month_payment": using(
        SHIPMENT_FACT + "," + SHIPMENT_PAYMENTS,
        f"""SELECT load_month AS year_month, payment_type_name, {TRIPS}, {REVENUE}, {TICKET},
          {mean(TIPS, 100, 2, 'gorjeta_media_pct')}
        FROM fact JOIN payment USING (payment_type_key) GROUP BY 1, 2""",
    ),
    "a2_top_flows": using(
        SHIPMENT_FACT,
        f"""SELECT pickup_borough || ' / ' || pickup_zone AS embarque,
          dropoff_borough || ' / ' || dropoff_zone AS desembarque, {TRIPS},
          {mean(KM, 1000, 2, 'km_medio')}, {mean(MINUTES, 100, 1, 'minutos_medios')}, {REVENUE}
        FROM fact GROUP BY 1, 2 HAVING count(*) > 5 ORDER BY receita DESC, embarque, desembarque LIMIT 15""",
    ),
    "a3_speed_by_hour": using(
        ",".join([EVENT_FACT, CLOCK, days("valid")]),
        f"""SELECT hour, day_period, {DAY_TYPE} AS day_type, {TRIPS},
          {mean(SPEEDS, 100, 2, 'velocidade_media_kmh')}, {mean(MINUTES, 100, 1, 'duracao_media_min')}
        FROM fact JOIN minutes ON pickup_time_key = time_key JOIN day ON pickup_date_key = date_key
        WHERE avg_speed_kmh >= 1 AND avg_speed_kmh <= 120 GROUP BY 1, 2, 3""",
    ),
    "a4_airport_vs_city": using(
        SHIPMENT_FACT + "," + SHIPMENT_RATES,
        f"""SELECT CASE WHEN pickup_airport THEN 'Aeroporto' ELSE 'Urbana' END AS tipo_embarque, rate_code_name,
          {TRIPS}, {mean(KM, 1000, 2, 'km_medio')}, {TICKET}, {mean(TIPS, 100, 2, 'gorjeta_media_pct')}
        FROM fact JOIN rate USING (rate_code_key) GROUP BY 1, 2""",
    ),
    "a5_weekday_period": using(
        ",".join([EVENT_FACT, CLOCK, days("valid")]),
        f"""SELECT strftime(full_date, '%A') AS day_name, day_period, {TRIPS}, {REVENUE}
        FROM fact JOIN minutes ON pickup_time_key = time_key JOIN day ON pickup_date_key = date_key
        GROUP BY 1, 2""",
    ),
    "a6_quarantine_rate": using(
        SHIPMENTS,
        f"""SELECT load_month, count(*) FILTER (WHERE violations = '') AS aceitas,
          count(*) FILTER (WHERE violations <> '') AS rejeitadas,
          {rounded("100 * count(*) FILTER (WHERE violations <> '')", 'count(*)', 3)} AS pct_rejeicao
        FROM tagged GROUP BY load_month""",
    ),
    "a9_period_borough": using(
        EVENT_FACT + "," + CLOCK,
        f"""SELECT day_period, pickup_borough AS borough, {TRIPS}, {mean(KM, 1000, 2, 'km_medio')}, {REVENUE}
        {PERIOD_BOROUGH}""",
    ),
    "a9_period_borough_top": using(
        EVENT_FACT + "," + CLOCK,
        f"""SELECT day_period, pickup_borough AS borough, {TRIPS}, {mean(KM, 1000, 2, 'km_medio')},
          {mean(TIPS, 100, 1, 'gorjeta_media_pct')}, {REVENUE}
        {PERIOD_BOROUGH} ORDER BY receita DESC, day_period, borough LIMIT 20""",
    ),
    "kpi_summary": using(
        EVENT_FACT,
        f"""SELECT (SELECT count(*) FROM typed) AS corridas_ingeridas, count(*) AS corridas_fato,
          {rounded('100 * (SELECT count(*) FROM rejected)', '(count(*) + (SELECT count(*) FROM rejected))', 2)}
            AS taxa_quarentena_pct, {REVENUE}, {TICKET},
          {rounded(f"100 * sum({cents('tip_amount')})", f"sum({cents('fare_amount')})", 1)} AS gorjeta_sobre_tarifa_pct
        FROM fact""",
    ),
    "kpi_trips_by_hour": using(
        EVENT_FACT + "," + CLOCK,
        """SELECT hour, count(trip_id) AS corridas FROM minutes LEFT JOIN fact ON pickup_time_key = time_key
        GROUP BY hour""",
    ),
    "kpi_revenue_by_period": using(
        EVENT_FACT + "," + CLOCK,
        f"""SELECT day_period, {REVENUE}, {TRIPS} FROM fact JOIN minutes ON pickup_time_key = time_key
        GROUP BY day_period""",
    ),
    "kpi_revenue_by_borough": using(
        EVENT_FACT, f"SELECT pickup_borough AS borough, {REVENUE}, {TRIPS} FROM fact GROUP BY 1"
    ),
    "layer_counts": using(
        SHIPMENT_FACT,
        """SELECT 'bronze' AS camada, count(*) AS linhas FROM typed
        UNION ALL SELECT 'silver', count(*) FROM valid
        UNION ALL SELECT 'quarentena', count(*) FROM rejected
        UNION ALL SELECT 'gold', count(*) FROM fact""",
    ),
    "bronze_layer": """SELECT strftime(ts, '%Y-%m') AS load_month, count(*) AS linhas, CAST(1 AS BIGINT) AS lotes
        FROM events GROUP BY 1""",
    "silver_layer": using(
        EVENTS,
        """SELECT event_id, trip_id, total_amount, trip_duration_min, trip_distance_km, load_month, violations
        FROM tagged""",
    ),
    "gold_layer": using(
        EVENT_FACT, f"SELECT {FACT_COLUMNS} FROM fact"
    ),
    "run_layers": using(
        EVENT_FACT,
        """SELECT * FROM (
          SELECT 'raw_trips' AS tabela, count(*) AS linhas FROM events
          UNION ALL SELECT 'raw_taxi_zones', count(*) FROM nation
          UNION ALL SELECT 'fct_source_trips', count(*) FROM valid
          UNION ALL SELECT 'fct_source_trips_quarantine', count(*) FROM rejected
          UNION ALL SELECT 'dim_source_zones', count(*) FROM nation
          UNION ALL SELECT 'dim_date', (SELECT date_diff('day', least(date_trunc('month', min(pickup_datetime))::DATE, (SELECT date_trunc('month', min(ts))::DATE FROM events)), greatest(last_day(greatest(max(dropoff_datetime), max(pickup_datetime))::DATE), (SELECT last_day(max(ts)::DATE) FROM events))) + 1 FROM valid)
          UNION ALL SELECT 'dim_time', 1440
          UNION ALL SELECT 'dim_vendor', 9
          UNION ALL SELECT 'dim_rate_code', 7
          UNION ALL SELECT 'dim_payment_type', 5
          UNION ALL SELECT 'dim_location', count(*) + 1 FROM nation
          UNION ALL SELECT 'fct_trips', count(*) FROM fact
          UNION ALL SELECT 'dq_results', 6)""",
    ),
    "incremental_ingest": """SELECT event_id, ts, user_id, event_type, value,
        CASE WHEN event_id % 2 = 0 THEN '2024-01' ELSE '2024-02' END AS load_month FROM events""",
    "incremental_fact": using(SHIPMENT_FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
}
