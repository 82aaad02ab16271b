"""The SQL twin of each registered query, for DuckDB."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-25 00:00:00'"
OLDEST = f"({AS_OF} - INTERVAL 20 DAY)"
DAY = "'%Y-%m-%d'"
TIME = "'%Y-%m-%d %H:%M:%S.%f'"
NOW_TEXT = "'2024-01-25 00:00:00.000000'"

RATINGS_RAW = """
ratings_raw AS (
  SELECT CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS customer_id,
         CAST(event_id % 6 AS INT) AS branch_id,
         CAST(event_id % 10 + 1 AS INT) AS employee_id,
         CAST(event_id % 15 + 1 AS INT) AS treatment_id,
         CAST(value / 20 AS FLOAT) AS rating_value,
         CASE WHEN event_id % 7 = 0 THEN '   ' WHEN event_id % 11 = 0 THEN NULL ELSE props END
           AS comment,
         ts + dup * INTERVAL 1 HOUR AS "timestamp",
         'ratings' AS _kafka_topic,
         CAST(event_id % 4 AS INT) AS _kafka_partition,
         event_id * 10 + dup AS _kafka_offset
  FROM (SELECT *, unnest(CASE WHEN event_id % 9 = 0 THEN [0, 1] ELSE [0] END) AS dup FROM events)
)"""

RATINGS_VALID = f"""
ratings_valid AS (
  SELECT * REPLACE (
           CASE WHEN comment IS NULL OR trim(comment) = '' THEN 'No comment provided'
                ELSE trim(regexp_replace(comment, '[^\\w\\s.,!?-]', '', 'g')) END AS comment)
  FROM ratings_raw
  WHERE customer_id IS NOT NULL AND branch_id IS NOT NULL AND employee_id IS NOT NULL
    AND treatment_id IS NOT NULL AND rating_value IS NOT NULL AND "timestamp" IS NOT NULL
    AND rating_value BETWEEN 1.0 AND 5.0 AND NOT isnan(rating_value)
    AND "timestamp" <= {AS_OF} AND "timestamp" >= {OLDEST}
)"""

RATINGS_CLEAN = """
ratings_clean AS (
  SELECT * FROM ratings_valid
  QUALIFY row_number() OVER (
    PARTITION BY customer_id, branch_id, employee_id, treatment_id, rating_value, comment
    ORDER BY "timestamp" DESC, _kafka_topic DESC, _kafka_partition DESC, _kafka_offset DESC) = 1
)"""

RATINGS = f"{RATINGS_RAW}, {RATINGS_VALID}, {RATINGS_CLEAN}"

INVENTORY = """
inventory AS (
  SELECT l_orderkey AS record_id, CAST(l_suppkey % 5 AS INT) AS branch_id,
         CAST(l_partkey % 42 AS INT) AS color_id,
         CAST(floor(l_quantity - 5) AS INT) AS quantity_used, l_shipdate AS "timestamp"
  FROM lineitem
)"""

INVENTORY_CLEAN = f"""{INVENTORY},
inventory_clean AS (
  SELECT * FROM inventory
  WHERE record_id IS NOT NULL AND branch_id IS NOT NULL AND color_id IS NOT NULL
    AND quantity_used > 0 AND "timestamp" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY record_id, branch_id, color_id
                             ORDER BY "timestamp" DESC, quantity_used DESC) = 1
)"""

INSTAGRAM = """
instagram AS (
  SELECT o_orderkey AS post_id, CAST(o_custkey % 40 AS INT) AS color_id,
         CAST(floor(o_totalprice) AS INT) % 1000 - 20 AS likes,
         CAST(o_custkey % 60 - 2 AS INT) AS comments,
         CAST(o_orderdate AS DATE) AS post_date, CAST(o_orderdate AS DATE) AS ingestion_date
  FROM orders
)"""


def _calendar(first: str, last: str, source: str = "") -> str:
    return f"""
  SELECT strftime(d, '%Y%m%d') AS date_id, d AS date, strftime(d, '%A') AS day_of_week,
         CAST(day(d) AS INT) AS day_of_month, strftime(d, '%B') AS month,
         CAST(month(d) AS INT) AS month_number, CAST(quarter(d) AS INT) AS quarter,
         CAST(year(d) AS INT) AS year,
         CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
              WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
         isodow(d) >= 6 AS is_weekend, month(d) = 12 AND day(d) = 25 AS is_holiday
  FROM (SELECT CAST(unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS DATE) AS d {source})
"""


POST_CALENDAR = (
    "calendar AS ("
    + _calendar("TIMESTAMP '1996-01-01'", "TIMESTAMP '2000-12-31'")
    + ")"
)
RATINGS_CALENDAR = (
    "calendar AS ("
    + _calendar("TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-12-31'")
    + ")"
)
ORDER_CALENDAR = _calendar(
    "CAST(first AS TIMESTAMP)",
    "CAST(last AS TIMESTAMP)",
    "FROM (SELECT CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last"
    " FROM orders)",
)

INSTAGRAM_JOINED = f"""{INSTAGRAM}, {POST_CALENDAR},
instagram_joined AS (
  SELECT post_id, color_id, CAST(date_id AS INT) AS date_id, likes, comments, post_date,
         ingestion_date, season
  FROM instagram LEFT JOIN calendar ON post_date = date
)"""

INSTAGRAM_CLEAN = f"""{INSTAGRAM_JOINED},
instagram_clean AS (
  SELECT * FROM instagram_joined
  WHERE post_id IS NOT NULL AND color_id IS NOT NULL AND date_id IS NOT NULL
    AND post_date IS NOT NULL AND ingestion_date IS NOT NULL AND season IS NOT NULL
    AND likes >= 0 AND comments >= 0
  QUALIFY row_number() OVER (PARTITION BY post_id, color_id, date_id
                             ORDER BY ingestion_date DESC, likes DESC, comments DESC) = 1
)"""

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customer_id, version_id,
         CASE WHEN version_id = 2 THEN c_name ELSE 'old name' END AS first_name,
         c_mktsegment AS last_name,
         DATE '1997-01-01' + CAST((version_id - 1) * 365 AS INT) AS start_date,
         CASE WHEN version_id = 1 THEN DATE '1998-01-01' END AS end_date,
         version_id = 2 AS is_current
  FROM (SELECT *, unnest([1, 2]) AS version_id FROM customer)
)"""

SCD2_EVENTS = f"""
SELECT o_custkey AS customer_id,
       row_number() OVER w AS version_id,
       CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name,
       CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
       CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS city,
       strftime(CAST(o_orderdate AS DATE), {DAY}) AS start_date,
       strftime(lead(CAST(o_orderdate AS DATE)) OVER w, {DAY}) AS end_date,
       lead(o_orderkey) OVER w IS NULL AS is_current,
       {NOW_TEXT} AS created_timestamp
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
"""

PRIORITY_UPDATES = """
updates AS (
  SELECT o_custkey AS customer_id, o_orderpriority AS city, CAST(o_orderdate AS DATE) AS start_date
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                             ORDER BY o_orderkey DESC) = 1
)"""
EXISTING = """
existing AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN version_id = 1 THEN '1-URGENT' ELSE c_mktsegment END AS city,
         DATE '1997-01-01' + CAST((version_id - 1) * 365 AS INT) AS start_date, version_id,
         CASE WHEN version_id = 1 AND c_custkey % 3 = 0 THEN DATE '1997-07-20' END AS closed_on,
         'customer' || c_custkey || '-' || version_id AS email
  FROM (SELECT *, unnest(CASE WHEN c_acctbal > 0 THEN [1, 2] ELSE [1] END) AS version_id
        FROM customer)
)"""

SCD2_CHANGES = f"""
WITH {PRIORITY_UPDATES}, {EXISTING}, history AS (
  SELECT customer_id, city, start_date, 0 AS origin, version_id AS old FROM existing
  UNION ALL SELECT customer_id, city, start_date, 1, 0 FROM updates
), compared AS (
  SELECT *, lag(city) OVER (PARTITION BY customer_id ORDER BY start_date, origin, old) AS before
  FROM history
), kept AS (
  SELECT * FROM compared WHERE origin = 0 OR city IS DISTINCT FROM before
)
SELECT customer_id, city,
       CASE WHEN origin = 0 THEN old
            ELSE coalesce((SELECT max(version_id) FROM existing e
                           WHERE e.customer_id = kept.customer_id), 0)
                 + row_number() OVER (PARTITION BY customer_id, origin ORDER BY start_date)
       END AS version_id,
       strftime(start_date, {DAY}) AS start_date,
       strftime(lead(start_date) OVER w, {DAY}) AS end_date,
       lead(start_date) OVER w IS NULL AS is_current, {NOW_TEXT} AS created_timestamp
FROM kept
WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, origin, old)
"""

# By the rules: an update counts unless the version before it has its state and was not closed in
# between; a version ends at the next start or at the first stored end after its start.
SCD2_CLOSED = f"""
WITH {PRIORITY_UPDATES}, {EXISTING}, points AS (
  SELECT customer_id, city, start_date, version_id AS old, email, true AS is_old FROM existing
  UNION ALL SELECT customer_id, city, start_date, NULL, NULL, false FROM updates
), seen AS (
  SELECT *, lag(city) OVER w AS city_before, lag(start_date) OVER w AS start_before
  FROM points
  WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, is_old DESC, old)
), counted AS (
  SELECT s.* FROM seen s
  WHERE is_old OR city_before IS DISTINCT FROM city
     OR EXISTS (SELECT 1 FROM existing e WHERE e.customer_id = s.customer_id
                AND e.closed_on > s.start_before AND e.closed_on <= s.start_date)
), ended AS (
  SELECT *, least(
           lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date, is_old DESC, old),
           (SELECT min(e.closed_on) FROM existing e
            WHERE e.customer_id = counted.customer_id AND e.closed_on > counted.start_date)
         ) AS until,
         row_number() OVER (PARTITION BY customer_id, is_old ORDER BY start_date) AS nth
  FROM counted
), held AS (
  SELECT customer_id, max(version_id) AS most, arg_max(email, start_date) AS last_email
  FROM existing GROUP BY customer_id
)
SELECT ended.customer_id, city, coalesce(email, last_email) AS email,
       CASE WHEN is_old THEN old ELSE coalesce(most, 0) + nth END AS version_id,
       strftime(start_date, {DAY}) AS start_date, strftime(until, {DAY}) AS end_date,
       until IS NULL AS is_current,
       CASE WHEN is_old THEN '2020-01-01 00:00:00.000000' ELSE {NOW_TEXT} END AS created_timestamp
FROM ended LEFT JOIN held ON held.customer_id = ended.customer_id
"""

RATINGS_STAR = f"""
WITH {RATINGS}, {CUSTOMERS}, {RATINGS_CALENDAR}
SELECT r.customer_id, c.first_name, c.last_name, r_name AS branch_name, p_name AS treatment_name,
       CAST(r.rating_value AS DOUBLE) AS rating_value, d.season
FROM ratings_clean r
JOIN customers c ON r.customer_id = c.customer_id AND c.is_current
JOIN region ON r.branch_id = r_regionkey
JOIN part ON r.treatment_id = p_partkey
JOIN calendar d ON CAST(r."timestamp" AS DATE) = d.date
"""


def _null_counts(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS null_count,"
        f" count(*) AS row_count FROM ratings_raw"
        for c in columns
    )


def _funnel(source: str, prelude: str, rules: list[tuple[str, str]], keys: str) -> str:
    steps, passed = [], "true"
    for i, (name, rule) in enumerate(rules, 1):
        now = f"{passed} AND coalesce({rule}, false)"
        steps.append(
            f"SELECT {i} AS step, '{name}' AS rule, count(*) FILTER ({passed}) AS rows_in,"
            f" count(*) FILTER ({now}) AS rows_out FROM {source}"
        )
        passed = now
    steps.append(
        f"SELECT {len(rules) + 1}, 'duplicate', count(*), count(DISTINCT ({keys}))"
        f" FROM {source} WHERE {passed}"
    )
    return (
        f"WITH {prelude}, steps AS ({' UNION ALL '.join(steps)})"
        " SELECT *, rows_in - rows_out AS dropped FROM steps"
    )


RATING_COLUMNS = (
    "customer_id branch_id employee_id treatment_id rating_value comment timestamp"
    " _kafka_topic _kafka_partition _kafka_offset"
).split()
BAD_RATING = "(rating_value IS NULL OR isnan(rating_value) OR rating_value < 1 OR rating_value > 5)"
NULL_KEY = (
    '(customer_id IS NULL OR branch_id IS NULL OR employee_id IS NULL OR treatment_id IS NULL'
    ' OR "timestamp" IS NULL)'
)
BLANK = "coalesce(trim(comment) = '', false)"
FAULTS = {
    "bad_rating": BAD_RATING,
    "null_key": NULL_KEY,
    "blank_comment": BLANK,
    "future": f'"timestamp" > {AS_OF}',
    "old": f'"timestamp" < {OLDEST}',
}
RATING_RULES = [
    (
        "null_field",
        "customer_id IS NOT NULL AND branch_id IS NOT NULL AND employee_id IS NOT NULL"
        ' AND treatment_id IS NOT NULL AND rating_value IS NOT NULL AND "timestamp" IS NOT NULL',
    ),
    ("rating_range", "rating_value BETWEEN 1 AND 5 AND NOT isnan(rating_value)"),
    ("future", f'"timestamp" <= {AS_OF}'),
    ("old", f'"timestamp" >= {OLDEST}'),
]
CLEAN_COMMENT = (
    "CASE WHEN comment IS NULL OR trim(comment) = '' THEN 'No comment provided'"
    " ELSE trim(regexp_replace(comment, '[^\\w\\s.,!?-]', '', 'g')) END"
)

MESSAGES = f"""
messages AS (
  SELECT event_id % 13 <> 0 AS readable, event_id % 19 = 0 AS wrong_type, *
  FROM events
), parsed AS (
  SELECT CASE WHEN readable THEN user_id END AS customer_id,
         CASE WHEN readable THEN CAST(event_id % 6 AS INT) END AS branch_id,
         CASE WHEN readable THEN CAST(event_id % 10 + 1 AS INT) END AS employee_id,
         CASE WHEN readable THEN CAST(event_id % 15 + 1 AS INT) END AS treatment_id,
         CASE WHEN readable AND NOT wrong_type
              THEN CAST(CAST(value / 20 AS FLOAT) AS DOUBLE) END AS rating_value,
         CASE WHEN readable THEN props END AS comment,
         CASE WHEN readable THEN strftime(ts, {TIME}) END AS "timestamp",
         'ratings' AS _kafka_topic, CAST(event_id % 4 AS INT) AS _kafka_partition,
         event_id AS _kafka_offset,
         CASE WHEN readable THEN strftime(CAST(ts AS DATE), {DAY}) END AS event_date
  FROM messages
)"""

IDS_AS_TEXT = (
    "* REPLACE (CAST(customer_id AS VARCHAR) AS customer_id, CAST(branch_id AS VARCHAR) AS branch_id,"
    " CAST(employee_id AS VARCHAR) AS employee_id, CAST(treatment_id AS VARCHAR) AS treatment_id)"
)

DIMENSIONS = {
    "dim_colors": f"""
SELECT CAST(p_partkey AS INT) AS color_id, p_name AS name, p_brand AS hex_code,
       p_type AS category, p_size > 25 AS active, {NOW_TEXT} AS created_timestamp FROM part""",
    "dim_branches": f"""
SELECT CAST(s_suppkey AS INT) AS branch_id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS city,
       s_name || ', ' || s_nationkey AS address, s_acctbal > 0 AS active,
       '2020-01-31' AS opening_date, {NOW_TEXT} AS created_timestamp FROM supplier""",
    "dim_employees": f"""
SELECT CAST(c_custkey AS INT) AS employee_id, c_name AS first_name, c_mktsegment AS last_name,
       c_mktsegment AS role, c_nationkey AS experience_years, c_acctbal > 0 AS active,
       '2020-07-30' AS hire_date, c_nationkey % 5 AS branch_id, {NOW_TEXT} AS created_timestamp
FROM customer""",
    "dim_customers": f"""
WITH {CUSTOMERS}
SELECT customer_id, CAST(version_id AS BIGINT) AS version_id, first_name, last_name,
       'customer' || customer_id || '@example.com' AS email, CAST(NULL AS VARCHAR) AS phone,
       last_name AS address, last_name AS city, strftime(start_date, {DAY}) AS start_date,
       strftime(end_date, {DAY}) AS end_date, is_current, {NOW_TEXT} AS created_timestamp
FROM customers""",
    "dim_treatments": f"""
SELECT CAST(p_partkey AS INT) AS treatment_id, p_name AS name,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
       p_size AS duration_minutes, p_size > 25 AS active, {NOW_TEXT} AS created_timestamp
FROM part""",
    "dim_date": f"""
SELECT * REPLACE (strftime(date, {DAY}) AS date), {NOW_TEXT} AS created_timestamp
FROM ({ORDER_CALENDAR})""",
}

ORACLES: dict[str, str] = {
    "silver_ratings": f"""
WITH {RATINGS}
SELECT customer_id, branch_id, employee_id, treatment_id,
       CAST(rating_value AS DOUBLE) AS rating_value, comment,
       strftime("timestamp", {TIME}) AS "timestamp", {NOW_TEXT} AS processed_timestamp,
       _kafka_topic, _kafka_partition, _kafka_offset,
       row_number() OVER (ORDER BY "timestamp", customer_id, _kafka_topic, _kafka_partition,
                          _kafka_offset) AS rating_id,
       strftime(CAST("timestamp" AS DATE), {DAY}) AS rating_date, {NOW_TEXT} AS ingestion_time,
       CAST(CASE WHEN comment = 'No comment provided' THEN 0.8 ELSE 1.0 END AS DOUBLE)
         AS data_quality_score
FROM ratings_clean""",
    "silver_inventory": f"""
WITH {INVENTORY_CLEAN}
SELECT record_id, branch_id, color_id, quantity_used,
       strftime(CAST("timestamp" AS DATE), {DAY}) AS report_date, {NOW_TEXT} AS ingestion_time
FROM inventory_clean""",
    "silver_instagram": f"""
WITH {INSTAGRAM_CLEAN}
SELECT * REPLACE (strftime(post_date, {DAY}) AS post_date,
                  strftime(ingestion_date, {DAY}) AS ingestion_date)
FROM instagram_clean""",
    "gold_branch_kpis": f"""
WITH {RATINGS}, active AS (
  SELECT CAST(c_nationkey % 4 AS INT) AS branch_id, count(*) AS n FROM customer
  WHERE c_acctbal > 0 GROUP BY 1
)
SELECT branch_id, round(avg(rating_value), 6) AS avg_rating, count(*) AS total_ratings,
       any_value(r_name) AS branch_name, coalesce(any_value(n), 0) AS num_active_employees
FROM ratings_clean LEFT JOIN region ON branch_id = r_regionkey LEFT JOIN active USING (branch_id)
GROUP BY branch_id""",
    "gold_color_engagement": f"""
WITH {INVENTORY_CLEAN}, {INSTAGRAM_CLEAN}, usage AS (
  SELECT color_id, count(*) AS times_used, CAST(sum(quantity_used) AS BIGINT) AS total_quantity_used
  FROM inventory_clean GROUP BY 1
), social AS (
  SELECT color_id, CAST(sum(likes) AS BIGINT) AS total_likes,
         CAST(sum(comments) AS BIGINT) AS total_comments
  FROM instagram_clean GROUP BY 1
)
SELECT color_id, times_used, total_quantity_used, coalesce(total_likes, 0) AS total_likes,
       coalesce(total_comments, 0) AS total_comments,
       round(coalesce((total_likes + total_comments) / (times_used + CAST(1e-6 AS DOUBLE)), 0.0), 6)
         AS engagement_score
FROM usage LEFT JOIN social USING (color_id)""",
    "gold_customer_metrics": """
SELECT o_custkey AS customer_id, round(avg(CAST(o_totalprice / 100000 AS FLOAT)), 6) AS avg_rating,
       count(*) AS total_ratings,
       CAST(last(CAST(o_totalprice / 100000 AS FLOAT) ORDER BY o_orderdate, o_orderkey) AS DOUBLE)
         AS last_rating,
       count(*) >= 10 AS is_vip
FROM orders GROUP BY 1""",
    "dim_date": f"SELECT * REPLACE (strftime(date, {DAY}) AS date) FROM ({ORDER_CALENDAR})",
    "scd2_from_events": SCD2_EVENTS,
    "scd2_from_events_sliced": SCD2_EVENTS,
    "scd2_from_changes": SCD2_CHANGES,
    "scd2_from_changes_sliced": SCD2_CHANGES,
    "ratings_star": RATINGS_STAR,
    "ratings_star_salted": RATINGS_STAR,
    "sessions_star": f"""
WITH {RATINGS}, {CUSTOMERS}, {RATINGS_CALENDAR}
SELECT r.customer_id, c.first_name, c.last_name, r_name AS branch_name, e.c_name AS employee_name,
       p_name AS treatment_name, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
       CAST(r.rating_value AS DOUBLE) AS rating_value, d.season, d.is_weekend
FROM ratings_clean r
JOIN customers c ON r.customer_id = c.customer_id AND c.is_current
JOIN region ON r.branch_id = r_regionkey
JOIN customer e ON r.employee_id = e.c_custkey
JOIN part ON r.treatment_id = p_partkey
JOIN calendar d ON CAST(r."timestamp" AS DATE) = d.date""",
    "social_star": f"""
WITH {INSTAGRAM_CLEAN}
SELECT i.post_id, p_name AS color_name, p_type AS color_category, i.likes, i.comments, d.season,
       d.month
FROM instagram_clean i JOIN part ON i.color_id = p_partkey JOIN calendar d ON i.post_date = d.date""",
    "inventory_star": f"""
WITH {INVENTORY}, {POST_CALENDAR}
SELECT i.record_id, i.color_id, p_name AS color_name, r_name AS branch_name, i.quantity_used,
       d.month, d.quarter
FROM inventory i JOIN part ON i.color_id = p_partkey JOIN region ON i.branch_id = r_regionkey
JOIN calendar d ON CAST(i."timestamp" AS DATE) = d.date""",
    "dq_null_counts": f"""
WITH {RATINGS_RAW}
{_null_counts(RATING_COLUMNS)}
UNION ALL SELECT 'processed_timestamp', 0, count(*) FROM ratings_raw""",
    "dq_min_quantity": f"""
WITH {INVENTORY_CLEAN} SELECT min(quantity_used) AS min_quantity_used FROM inventory_clean""",
    "dq_null_rows": f"""
WITH {RATINGS_RAW}
SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id,
                  CAST(rating_value AS DOUBLE) AS rating_value,
                  strftime("timestamp", {TIME}) AS "timestamp"),
       {NOW_TEXT} AS processed_timestamp
FROM ratings_raw
WHERE {NULL_KEY} OR rating_value IS NULL OR comment IS NULL""",
    "dq_check_silver": f"""
WITH {INSTAGRAM_JOINED}
SELECT * REPLACE (CAST(date_id AS VARCHAR) AS date_id, strftime(post_date, {DAY}) AS post_date,
                  strftime(ingestion_date, {DAY}) AS ingestion_date)
FROM instagram_joined
WHERE post_id IS NULL OR color_id IS NULL OR date_id IS NULL OR likes IS NULL OR comments IS NULL
   OR post_date IS NULL OR ingestion_date IS NULL OR season IS NULL""",
    "dq_funnel_ratings": _funnel(
        "ratings_raw",
        RATINGS_RAW,
        RATING_RULES,
        f"customer_id, branch_id, employee_id, treatment_id, rating_value, {CLEAN_COMMENT}",
    ),
    "dq_funnel_inventory": _funnel(
        "inventory",
        INVENTORY,
        [
            (
                "null_field",
                "record_id IS NOT NULL AND branch_id IS NOT NULL AND color_id IS NOT NULL"
                ' AND quantity_used IS NOT NULL AND "timestamp" IS NOT NULL',
            ),
            ("quantity", "quantity_used > 0"),
        ],
        "record_id, branch_id, color_id",
    ),
    "dq_funnel_instagram": _funnel(
        "instagram_joined",
        INSTAGRAM_JOINED,
        [
            (
                "null_field",
                "post_id IS NOT NULL AND color_id IS NOT NULL AND likes IS NOT NULL AND"
                " comments IS NOT NULL AND post_date IS NOT NULL AND ingestion_date IS NOT NULL",
            ),
            ("outside_calendar", "date_id IS NOT NULL AND season IS NOT NULL"),
            ("negative_count", "likes >= 0 AND comments >= 0"),
        ],
        "post_id, color_id, date_id",
    ),
    "dq_layer_counts": f"""
WITH {RATINGS}, {INVENTORY_CLEAN}, {INSTAGRAM_CLEAN}
SELECT 'bronze_inventory' AS table_name, count(*) AS row_count FROM inventory
UNION ALL SELECT 'bronze_instagram', count(*) FROM instagram
UNION ALL SELECT 'bronze_ratings', count(*) FROM ratings_raw
UNION ALL SELECT 'silver_inventory', count(*) FROM inventory_clean
UNION ALL SELECT 'silver_instagram', count(*) FROM instagram_clean
UNION ALL SELECT 'silver_ratings', count(*) FROM ratings_clean""",
    "dq_reasons": f"WITH {RATINGS_RAW} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS reason, count(*) FILTER ({fault}) AS row_count FROM ratings_raw"
        for name, fault in FAULTS.items()
    ),
    "dq_classified": f"WITH {RATINGS_RAW} SELECT _kafka_offset, concat_ws(',', "
    + ", ".join(f"CASE WHEN {fault} THEN '{name}' END" for name, fault in FAULTS.items())
    + ") AS reasons FROM ratings_raw",
    "latest_rows": f"""
WITH {RATINGS_RAW}
SELECT * REPLACE (CAST(rating_value AS DOUBLE) AS rating_value,
                  strftime("timestamp", {TIME}) AS "timestamp"),
       {NOW_TEXT} AS processed_timestamp
FROM ratings_raw
ORDER BY ratings_raw."timestamp" DESC, _kafka_topic DESC, _kafka_partition DESC, _kafka_offset DESC
LIMIT 5""",
    "table_count_sql": f"WITH {RATINGS_RAW} SELECT count(*) AS total_rows FROM ratings_raw",
    "late_posts": f"""
WITH {INSTAGRAM}, merged AS (
  SELECT * FROM instagram
  UNION ALL
  SELECT * REPLACE (likes + 1000 AS likes, ingestion_date + 1 AS ingestion_date) FROM instagram
), newest AS (
  SELECT * FROM merged WHERE post_date >= DATE '1998-01-01'
  QUALIFY row_number() OVER (PARTITION BY post_id, color_id, post_date
                             ORDER BY ingestion_date DESC, likes DESC, comments DESC) = 1
)
SELECT * REPLACE (strftime(post_date, {DAY}) AS post_date,
                  strftime(ingestion_date, {DAY}) AS ingestion_date)
FROM newest""",
    "csv_instagram": f"""
WITH {INSTAGRAM}
SELECT * REPLACE (strftime(post_date, {DAY}) AS post_date,
                  strftime(ingestion_date, {DAY}) AS ingestion_date)
FROM instagram""",
    "csv_inventory": f"""
WITH {INVENTORY}
SELECT * REPLACE (strftime("timestamp", {TIME}) AS "timestamp") FROM inventory""",
    "csv_inferred": DIMENSIONS["dim_treatments"],
    **{f"load_{name}": sql for name, sql in DIMENSIONS.items()},
    "json_parse": f"""
WITH {MESSAGES} SELECT {IDS_AS_TEXT}, {NOW_TEXT} AS processed_timestamp FROM parsed""",
    "stream_bronze": f"WITH {MESSAGES} SELECT {IDS_AS_TEXT} FROM parsed",
    "stream_batch_counts": "SELECT count(*) AS total_rows FROM events",
    "stream_rejected": f"""
WITH {MESSAGES}
SELECT 'no json' AS raw, _kafka_topic, _kafka_partition, _kafka_offset
FROM parsed WHERE customer_id IS NULL""",
    "partition_overwrite": f"""
WITH {RATINGS_RAW}
SELECT * REPLACE (
         CAST(customer_id AS VARCHAR) AS customer_id,
         CAST(CASE WHEN CAST("timestamp" AS DATE) >= DATE '2024-01-20' THEN rating_value + 1
              ELSE rating_value END AS DOUBLE) AS rating_value,
         strftime("timestamp", {TIME}) AS "timestamp"),
       strftime(CAST(ratings_raw."timestamp" AS DATE), {DAY}) AS event_date
FROM ratings_raw""",
    "full_refresh": f"""
WITH {MESSAGES}, valid AS (
  SELECT * REPLACE ({CLEAN_COMMENT} AS comment) FROM parsed
  WHERE customer_id IS NOT NULL AND rating_value BETWEEN 1 AND 5
    AND "timestamp" <= {NOW_TEXT}
), cleaned AS (
  SELECT DISTINCT customer_id, branch_id, employee_id, treatment_id, rating_value, comment
  FROM valid
), {INSTAGRAM}, posts AS (
  SELECT * FROM instagram WHERE likes >= 0 AND comments >= 0
), used AS (
  SELECT * FROM events WHERE floor(value) - 5 > 0
)
SELECT 'bronze_inventory' AS table_name, count(*) AS row_count FROM events
UNION ALL SELECT 'bronze_instagram', count(*) FROM orders
UNION ALL SELECT 'bronze_ratings', count(*) FROM events
UNION ALL SELECT 'silver_inventory', count(*) FROM used
UNION ALL SELECT 'silver_instagram', count(*) FROM posts
UNION ALL SELECT 'silver_ratings', count(*) FROM cleaned
UNION ALL SELECT 'customer_rating_versions', count(*) FROM cleaned
UNION ALL SELECT 'gold_branch_kpis', count(DISTINCT branch_id) FROM cleaned
UNION ALL SELECT 'gold_color_engagement', count(DISTINCT user_id % 42) FROM used
UNION ALL SELECT 'gold_customer_metrics', count(DISTINCT customer_id) FROM cleaned""",
}

LATE = f"""
WITH {INSTAGRAM}, later AS (
  SELECT * REPLACE (likes + 1000 AS likes, ingestion_date + 1 AS ingestion_date) FROM instagram
), stored AS (
  SELECT * FROM instagram WHERE post_date < DATE '1998-01-01'
  UNION ALL
  SELECT * FROM (SELECT * FROM instagram UNION ALL SELECT * FROM later)
  WHERE post_date >= DATE '1998-01-01'
  QUALIFY row_number() OVER (PARTITION BY post_id, color_id, post_date
                             ORDER BY ingestion_date DESC, likes DESC, comments DESC) = 1
)
SELECT * REPLACE (strftime(post_date, {DAY}) AS post_date,
                  strftime(ingestion_date, {DAY}) AS ingestion_date)
"""

LATE_STREAM = f"""
WITH {MESSAGES}, mark AS (
  SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 48 HOUR AS oldest
  FROM messages WHERE event_id % 3 <> 0 AND readable
), second AS (
  SELECT event_id, readable AND ts <= oldest AS late, event_id % 3 <> 0 AS again
  FROM messages, mark WHERE event_id % 3 = 0 OR event_id % 15 = 1 AND readable
)"""
NOT_WRONG = """CAST("timestamp" AS DATE) <> DATE '2024-01-10'"""

ORACLES |= {
    "gold_customer_state": f"""
WITH {RATINGS}
SELECT customer_id, round(avg(rating_value), 6) AS avg_rating, count(*) AS total_ratings,
       CAST(last(rating_value ORDER BY "timestamp", _kafka_offset) AS DOUBLE) AS last_rating,
       count(*) >= 10 AS is_vip
FROM ratings_clean WHERE {NOT_WRONG} GROUP BY 1""",
    "gold_branch_state": ORACLES["gold_branch_kpis"].replace(
        "GROUP BY branch_id", f"WHERE {NOT_WRONG} GROUP BY branch_id"
    ),
    "gold_color_state": """
WITH usage AS (
  SELECT CAST(user_id % 42 AS INT) AS color_id, count(*) AS times_used,
         CAST(sum(floor(value) - 5) AS BIGINT) AS total_quantity_used
  FROM events WHERE floor(value) - 5 > 0 AND CAST(ts AS DATE) <> DATE '2024-01-10' GROUP BY 1
), social AS (
  SELECT CAST(user_id % 40 AS INT) AS color_id, CAST(sum(floor(value)) AS BIGINT) AS total_likes,
         CAST(sum(event_id % 60) AS BIGINT) AS total_comments
  FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-10' GROUP BY 1
)
SELECT color_id, times_used, total_quantity_used, coalesce(total_likes, 0) AS total_likes,
       coalesce(total_comments, 0) AS total_comments,
       round(coalesce((total_likes + total_comments) / (times_used + CAST(1e-6 AS DOUBLE)), 0.0), 6)
         AS engagement_score
FROM usage LEFT JOIN social USING (color_id)""",
    "refresh_resumed": """
SELECT unnest(['dimensions', 'bronze_inventory', 'bronze_instagram', 'late_instagram', 'bronze_ratings',
               'silver_inventory', 'silver_instagram', 'silver_ratings', 'customer_rating_versions',
               'gold_branch_kpis', 'gold_color_engagement', 'gold_customer_metrics']) AS job,
       CAST(1 AS BIGINT) AS times, count(*) AS bronze_ratings, count(*) AS bronze_instagram
FROM events""",
    "ratings_star_colocated": ORACLES["ratings_star"],
    "silver_ratings_colocated": f"""
WITH {RATINGS}
SELECT customer_id, CAST(rating_value AS DOUBLE) AS rating_value, comment,
       strftime("timestamp", {TIME}) AS "timestamp", _kafka_offset FROM ratings_clean""",
    "dq_counted_ratings": ORACLES["dq_funnel_ratings"],
    "dq_counted_inventory": ORACLES["dq_funnel_inventory"],
    "dq_counted_instagram": ORACLES["dq_funnel_instagram"],
    "silver_ratings_counted": ORACLES["silver_ratings"],
    "dq_footer_counts": f"""
WITH {RATINGS_RAW}
SELECT 'raw_posts' AS table_name, count(*) AS row_count, CAST(0 AS BIGINT) AS null_customers,
       CAST(0 AS BIGINT) AS null_comments FROM orders
UNION ALL SELECT 'silver_inventory', count(*), 0, 0 FROM events WHERE floor(value) - 5 > 0
UNION ALL SELECT 'raw_ratings', count(*), count(*) - count(customer_id), count(*) - count(comment)
FROM ratings_raw""",
    "table_since": f"""
WITH {RATINGS_RAW}
SELECT _kafka_offset, strftime("timestamp", {TIME}) AS "timestamp", branch_id FROM ratings_raw
WHERE ratings_raw."timestamp" BETWEEN TIMESTAMP '2024-01-05 12:00:00'
  AND TIMESTAMP '2024-01-09 06:00:00'""",
    "stream_late_counts": LATE_STREAM + """
SELECT first + more AS rows_in, first + kept AS rows_kept, repeated AS rows_repeated, late AS rows_late
FROM (SELECT count(*) AS first FROM messages WHERE event_id % 3 <> 0),
     (SELECT count(*) AS more, count(*) FILTER (NOT late AND NOT again) AS kept,
             count(*) FILTER (NOT late AND again) AS repeated, count(*) FILTER (late) AS late
      FROM second)""",
    "stream_late_kept": LATE_STREAM + f"""
SELECT {IDS_AS_TEXT} FROM parsed
WHERE _kafka_offset % 3 <> 0
   OR _kafka_offset IN (SELECT event_id FROM second WHERE NOT late AND NOT again)""",
    "stream_merged": ORACLES["stream_bronze"],
    "stream_stamped": "SELECT count(*) AS total_rows, count(*) AS stamped_rows FROM events",
    "stream_ledger": f"""
WITH {MESSAGES}
SELECT DISTINCT event_date, CAST(1 AS BIGINT) AS merge_id FROM parsed WHERE event_date IS NOT NULL""",
    "numbers_updated": f"""
WITH {RATINGS}
SELECT row_number() OVER (ORDER BY "timestamp", customer_id, _kafka_topic, _kafka_partition,
                          _kafka_offset) AS rating_id, customer_id,
       strftime("timestamp", {TIME}) AS "timestamp", _kafka_offset,
       strftime(CAST("timestamp" AS DATE), {DAY}) AS rating_date
FROM ratings_clean WHERE {NOT_WRONG}""",
    "stream_new_checkpoint": ORACLES["stream_bronze"],
    "stream_table": ORACLES["stream_bronze"],
    "stream_rejected_all": f"""
WITH {MESSAGES}
SELECT 'no json' AS raw, _kafka_topic, _kafka_partition, _kafka_offset,
       CAST(0 AS BIGINT) AS bronze_rows
FROM parsed WHERE customer_id IS NULL""",
    "replace_new_columns": "SELECT o_orderstatus AS status, o_custkey AS owner FROM orders",
    "table_append": """
SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer""",
    "store_tables": """
SELECT 'silver_inventory' AS table_name, count(*) AS row_count
FROM events WHERE floor(value) - 5 > 0
UNION ALL SELECT 'silver_ratings', CAST(0 AS BIGINT)""",
    "late_posts_stored": LATE + "FROM stored",
    "late_posts_rejected": LATE + "FROM later WHERE post_date < DATE '1998-01-01'",
    "scd2_closed": SCD2_CLOSED,
    "scd2_updated": SCD2_CLOSED,
    "scd2_updated_hot": SCD2_CLOSED,
    "scd2_events_updated": SCD2_EVENTS,
    "ratings_star_all_hot": ORACLES["ratings_star"],
    "refresh_silver_inventory": f"""
SELECT event_id AS record_id, CAST(event_id % 5 AS INT) AS branch_id,
       CAST(user_id % 42 AS INT) AS color_id, CAST(floor(value) AS INT) - 5 AS quantity_used,
       strftime(CAST(ts AS DATE), {DAY}) AS report_date, {NOW_TEXT} AS ingestion_time
FROM events WHERE floor(value) - 5 > 0""",
}
