"""The same results as DuckDB SQL over the same tables."""

from __future__ import annotations

from orderlayers import schema as S
from orderlayers.queries.dirty_orders import (
    DIRTY_SQL,
    ENGINE,
    RUN_ID,
    SOURCE_FILE,
)

# As in the query: the size, in MB, up to which a file counts as small.
INVENTORY_MB = 0.03

_FIELDS = ", ".join(S.ORDER_FIELDS)
_UNTOUCHED = ", ".join(f for f in S.ORDER_FIELDS if f not in S.REPAIRED_FIELDS)
_FROM_FILE = ", ".join(f"nullif({f}, '') AS {f}" for f in S.ORDER_FIELDS)

_MIXED = "CASE WHEN k % 3 = 1 THEN k::VARCHAR END AS note, " + ", ".join(
    "CASE WHEN k % 3 != 2 THEN district END AS district" if f == "district" else f
    for f in S.ORDER_FIELDS
)

_AMOUNT = (
    "regexp_replace(translate(total_amount, '٠١٢٣٤٥٦٧٨٩٫', '0123456789.'), "
    "'[^0-9.-]', '', 'g')"
)
_PHONE = r"regexp_replace(customer_phone, '\s+', '', 'g')"
_EMAIL = r"regexp_replace(regexp_replace(customer_email, '@+', '@', 'g'), '\.+', '.', 'g')"
_DATE = "strftime(try_cast(order_date AS timestamp), '%Y-%m-%d %H:%M:%S')"

_CORRECTED = (
    "coalesce(total_amount != c_amount, false) OR coalesce(customer_phone != c_phone, false) "
    "OR coalesce(customer_email != c_email, false) OR coalesce(city != c_city, false)"
)


def _chain(source: str) -> str:
    """CTEs from a relation with ``k`` and the order fields to ``done``: cleaned and judged."""
    return f"""
cleaned AS (
  SELECT *, {_AMOUNT} AS c_amount, {_PHONE} AS c_phone, {_EMAIL} AS c_email,
         trim(city) AS c_city, trim(status) AS c_status, {_DATE} AS c_date
  FROM {source}
),
judged AS (
  SELECT *, CASE
    WHEN order_id IS NULL OR trim(order_id) = '' THEN 'Quarantined: MISSING_ORDER_ID'
    WHEN customer_id IS NULL OR trim(customer_id) = '' THEN 'Quarantined: MISSING_CUSTOMER_ID'
    WHEN items_json IS NOT NULL AND NOT regexp_matches(items_json, '^["\\s]*[\\[\\{{]')
      THEN 'Quarantined: CORRUPTED_ITEMS_JSON'
    WHEN c_amount = '' THEN 'Quarantined: UNKNOWN_PRICE'
    WHEN {_CORRECTED} THEN 'Corrected'
    ELSE 'Valid' END AS record_status,
    concat_ws(',',
      CASE WHEN total_amount != c_amount THEN 'FIX_ARABIC_AND_SYMBOLS' END,
      CASE WHEN customer_phone != c_phone THEN 'TRIM_PHONE_SPACES' END,
      CASE WHEN customer_email != c_email THEN 'FIX_EMAIL_TYPOS' END,
      CASE WHEN city != c_city THEN 'TRIM_SPACES' END) AS rule_codes
  FROM cleaned
),
done AS (
  SELECT k, {_UNTOUCHED}, c_amount AS total_amount, c_phone AS customer_phone,
         c_email AS customer_email, c_city AS city, c_status AS status,
         c_date AS order_date, rule_codes, record_status
  FROM judged
)"""


_DIRTY = f"WITH dirty AS ({DIRTY_SQL})"
_FILE = f"{_DIRTY}, filed AS (SELECT k, {_FROM_FILE} FROM dirty)"
_DONE = f"{_DIRTY}, {_chain('dirty')}"
_ACCEPTED = "record_status IN ('Valid', 'Corrected')"
_HELD = "starts_with(record_status, 'Quarantined')"
_QUARANTINE_KEY = (
    "CASE WHEN order_id IS NOT NULL AND trim(order_id) != '' THEN order_id "
    "ELSE 'q_' || md5(coalesce(customer_id, 'unknown') || '_' || "
    "coalesce(order_date, 'unknown')) END"
)

# Accepted rows, then the later copies of every fiftieth order, as upsert input.
_UPSERT_INPUT = f"""
{_DONE},
kept AS (SELECT * FROM done WHERE {_ACCEPTED}),
incoming AS (
  SELECT *, k + 1 AS n FROM kept
  UNION ALL
  SELECT * REPLACE ('CITY-2' AS city), k + 1000000000001 AS n FROM kept WHERE k % 50 = 0
)"""

_NEWEST = """
newest AS (
  SELECT * FROM incoming
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY n DESC) = 1
)"""

_BLANK = "({0} IS NULL OR trim({0}) = '')"
_RULES = {
    "Order ID is Empty": _BLANK.format("order_id"),
    "Order Date is Empty": _BLANK.format("order_date"),
    "Unrecognized Status": "trim(status) NOT IN "
    "('مؤكد', 'قيد الانتظار', 'مرتجع', 'قيد الشحن', 'تم التسليم')",
    "Customer ID is Empty": _BLANK.format("customer_id"),
    "Phone Format Error": r"NOT regexp_matches(trim(customer_phone), '^\+?[0-9]{7,15}$')",
    "Email Format Error": r"NOT regexp_matches(trim(customer_email), '^[\w.-]+@[\w.-]+\.\w+$')",
    "Delivery Cost Cannot Be Negative": "try_cast(delivery_cost AS double) < 0",
    "Payment Must Be Greater Than Zero": "try_cast(total_amount AS double) <= 0",
}


def _errors(rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT k + 1 AS source_row_number, order_id, '{message}' AS error "
        f"FROM dirty WHERE {rule}"
        for message, rule in rules.items()
    )


_ANY_ERROR = " OR ".join(f"coalesce({rule}, false)" for rule in _RULES.values())


def _audit(field: str, clean: str, rule: str) -> str:
    return (
        f"SELECT k + 1 AS source_row_number, '{field}' AS field, {field} AS original_value, "
        f"{clean} AS corrected_value, '{rule}' AS rule_code FROM cleaned WHERE {field} != {clean}"
    )


_SUMMARY = f"""
  SELECT count(*) AS rows_read,
         count(*) FILTER (record_status = 'Valid') AS valid_count,
         count(*) FILTER (record_status = 'Corrected') AS corrected_count,
         count(*) FILTER ({_HELD}) AS quarantine_count,
         count(*) FILTER (order_date IS NULL) AS null_date_count
  FROM done"""


def oracle_sql() -> dict[str, str]:
    """SQL per query name."""
    return {
        "classify_orders": f"{_DONE} SELECT {_FIELDS}, rule_codes, record_status FROM done",
        "status_counts": f"{_DONE} {_SUMMARY}",
        "quarantine_reasons": f"{_DONE} SELECT record_status, count(*) AS row_count "
        f"FROM done WHERE {_HELD} GROUP BY record_status",
        "validated_rows": f"{_DONE} SELECT order_id AS _id, {_FIELDS}, rule_codes, "
        f"record_status FROM done WHERE {_ACCEPTED}",
        "quarantine_rows": f"{_DONE} SELECT {_QUARANTINE_KEY} AS _id, {_FIELDS}, rule_codes, "
        f"record_status FROM done WHERE {_HELD}",
        "clean_amount": f"{_DIRTY} SELECT k, total_amount, {_AMOUNT} AS cleaned FROM dirty",
        "clean_contact": f"{_DIRTY} SELECT k, customer_phone, {_PHONE} AS cleaned_phone, "
        f"customer_email, {_EMAIL} AS cleaned_email FROM dirty",
        "clean_city_status": f"{_DIRTY} SELECT k, city, trim(city) AS cleaned_city, status, "
        "trim(status) AS cleaned_status FROM dirty",
        "clean_date": f"{_DIRTY} SELECT k, order_date, {_DATE} AS cleaned FROM dirty",
        "audit_trail": f"{_DONE} "
        + " UNION ALL ".join(
            [
                _audit("total_amount", "c_amount", "FIX_ARABIC_AND_SYMBOLS"),
                _audit("customer_phone", "c_phone", "TRIM_PHONE_SPACES"),
                _audit("customer_email", "c_email", "FIX_EMAIL_TYPOS"),
                _audit("city", "c_city", "TRIM_SPACES"),
            ]
        ),
        "validation_errors": f"{_DIRTY} {_errors(_RULES)}",
        "validation_report": f"{_DIRTY} SELECT k + 1 AS source_row_number, concat_ws('; ', "
        + ", ".join(f"CASE WHEN {rule} THEN '{message}' END" for message, rule in _RULES.items())
        + ") AS errors FROM dirty",
        "validation_flags": f"{_DIRTY} SELECT k + 1 AS source_row_number, order_id, "
        f"NOT ({_ANY_ERROR}) AS is_clean_record FROM dirty",
        "validation_missing_columns": f"{_DIRTY} "
        + _errors(
            {
                **{
                    message: rule
                    for message, rule in _RULES.items()
                    if message not in
                    ("Delivery Cost Cannot Be Negative", "Payment Must Be Greater Than Zero")
                },
                "Payment Must Be Greater Than Zero": "try_cast(payment_amount AS double) <= 0",
            }
        ),
        "header_repair": f"{_DIRTY} SELECT CASE WHEN k % 3 = 0 THEN 'clean-' || k "
        "WHEN k % 3 = 1 THEN order_id END AS order_id, k, status, city FROM dirty",
        "envelope_roundtrip": f"{_DIRTY} SELECT '{RUN_ID}' AS run_id, "
        f"'{SOURCE_FILE}' AS source_file, k + 1 AS source_row_number, "
        f"'{ENGINE}' AS engine_used, {_FIELDS} FROM dirty",
        "csv_roundtrip": f"{_FILE} SELECT 'r1' AS run_id, 'pyspark' AS engine_used, {_FIELDS} "
        "FROM filed",
        "row_numbers": f"{_FILE} SELECT row_number() OVER (ORDER BY k) AS source_row_number, "
        f"{_FIELDS} FROM filed",
        "header_columns": f"{_FILE} SELECT k::VARCHAR AS note, k::VARCHAR || 'x' AS shop_id, "
        f"{_FIELDS} FROM filed",
        "mixed_headers": f"{_FILE} SELECT 'r1' AS run_id, {_MIXED} FROM filed",
        "stream_mixed_headers": f"{_FILE} SELECT 's1' AS run_id, {_MIXED}, "
        "true AS numbered_to_the_end FROM filed",
        "blank_lines": f"{_FILE} SELECT row_number() OVER (ORDER BY k) AS source_row_number, "
        f"{_FIELDS} FROM filed",
        "kept_classification": f"{_DONE} SELECT order_id AS _id, {_FIELDS}, rule_codes, "
        f"record_status FROM done WHERE {_ACCEPTED}",
        "row_number_totals": f"{_FILE} SELECT count(*) AS row_count, 0::BIGINT AS bad_files "
        "FROM filed",
        "stream_ingest": f"{_FILE} SELECT 's1' AS run_id, 'pyspark_stream' AS engine_used, "
        f"{_FIELDS} FROM filed",
        "stream_batches": f"{_FILE} SELECT count(*) AS row_count, count(*) AS rows_in_batches "
        "FROM filed",
        "stream_resumed": f"{_FILE} SELECT 's1' AS run_id, {_FIELDS}, 1::BIGINT AS batches_before, "
        "true AS more_after FROM filed",
        "upsert_one_key": f"{_DONE}, kept AS (SELECT * REPLACE (CASE WHEN order_id = ("
        f"SELECT min(order_id) FROM done WHERE {_ACCEPTED}) THEN 'CITY-2' ELSE city END AS city) FROM done "
        f"WHERE {_ACCEPTED}) SELECT order_id AS _id, {_FIELDS}, rule_codes, record_status, "
        "1::BIGINT AS buckets_written FROM kept",
        "latest_by_key": f"{_UPSERT_INPUT}, {_NEWEST} SELECT order_id AS _id, {_FIELDS}, "
        "rule_codes, record_status, n AS source_row_number FROM newest",
        "upsert_validated": f"{_UPSERT_INPUT}, {_NEWEST} SELECT order_id AS _id, {_FIELDS}, "
        "rule_codes, record_status, n AS source_row_number FROM newest",
        "upsert_quarantine": f"""{_DONE}, held AS (
              SELECT {_QUARANTINE_KEY} AS _id, * REPLACE (
                       CASE WHEN k % 3 = 0 THEN 'CITY-3' ELSE 'CITY-2' END AS city),
                     k + 1 + CASE WHEN k % 3 = 0 THEN 1000000000000 ELSE 0 END AS n
              FROM done WHERE {_HELD})
            SELECT _id, {_FIELDS}, rule_codes, record_status, n AS source_row_number FROM held
            QUALIFY row_number() OVER (PARTITION BY _id ORDER BY n DESC) = 1""",
        "upsert_counts": f"""{_UPSERT_INPUT}
            SELECT count(*) FILTER (k % 2 != 0) AS inserted_count,
                   count(*) FILTER (k % 2 = 0) AS updated_count,
                   count(DISTINCT order_id) FILTER (k % 2 != 0) AS inserted_keys,
                   count(DISTINCT order_id) FILTER (k % 2 = 0) AS updated_keys
            FROM incoming""",
        "stored_key_counts": f"""{_UPSERT_INPUT}
            SELECT count(*) FILTER (k % 2 != 0) AS inserted_count,
                   count(*) FILTER (k % 2 = 0) AS updated_count,
                   count(DISTINCT order_id) FILTER (k % 2 != 0) AS inserted_keys,
                   count(DISTINCT order_id) FILTER (k % 2 = 0) AS updated_keys
            FROM incoming""",
        "file_inventory": f"""
            SELECT least(o_orderkey % 16, 4) AS part,
                   cast(sum(length(o_orderkey::VARCHAR) + length(o_orderstatus) + 2) AS BIGINT) AS length,
                   CASE WHEN sum(length(o_orderkey::VARCHAR) + length(o_orderstatus) + 2)
                     <= {INVENTORY_MB} * 1048576 THEN 'python_batch' ELSE 'pyspark' END AS engine
            FROM orders GROUP BY 1""",
        "empty_upsert": f"""{_DONE}
            SELECT 'orders_validated' AS layer, 0::BIGINT AS keys, count(*) AS held_rows
            FROM done WHERE {_ACCEPTED}
            UNION ALL SELECT 'orders_quarantine', 0, 0""",
        "read_some_runs": f"""{_DIRTY} SELECT 'r2' AS run_id, k + 1 AS source_row_number, order_id
            FROM dirty""",
        "skipped_buckets": f"""{_DONE} SELECT min(order_id) AS _id, 1::BIGINT AS least_reads,
            0::BIGINT AS behind_reads FROM done WHERE {_ACCEPTED} AND k % 2 = 0""",
        "merged_new_runs": f"""{_DONE}
            SELECT order_id AS _id, k + 1 + CASE WHEN k % 3 = 0 THEN 1000000000000 ELSE 0 END
                     AS source_row_number, {_FIELDS}, rule_codes, record_status,
                   (SELECT count(*) FILTER (k % 3 = 0) FROM done) AS r1_read,
                   (SELECT count(*) FROM done) AS r3_read
            FROM done WHERE {_ACCEPTED}""",
        "run_metrics": f"""{_FILE}, {_chain('filed')}, counts AS ({_SUMMARY}),
            reasons AS (
              SELECT count(*) FILTER (record_status LIKE '%: MISSING_ORDER_ID') AS missing_order_id,
                     count(*) FILTER (record_status LIKE '%: MISSING_CUSTOMER_ID')
                       AS missing_customer_id,
                     count(*) FILTER (record_status LIKE '%: CORRUPTED_ITEMS_JSON')
                       AS corrupted_items_json,
                     count(*) FILTER (record_status LIKE '%: UNKNOWN_PRICE') AS unknown_price
              FROM done),
            keys AS (
              SELECT count(DISTINCT order_id) FILTER ({_ACCEPTED}) AS kept_keys,
                     count(DISTINCT {_QUARANTINE_KEY}) FILTER ({_HELD}) AS held_keys
              FROM done),
            runs AS (SELECT * FROM (VALUES ('ingest', 'r1'), ('elt', 'r1'), ('elt', 'r2'))
                     AS t(stage, run_id))
            SELECT stage, run_id,
                   CASE stage WHEN 'ingest' THEN 'pyspark' ELSE 'pyspark_elt' END AS engine_used,
                   rows_read, rows_read AS raw_loaded,
                   CASE stage WHEN 'elt' THEN valid_count ELSE 0 END AS valid_count,
                   CASE stage WHEN 'elt' THEN corrected_count ELSE 0 END AS corrected_count,
                   CASE stage WHEN 'elt' THEN quarantine_count ELSE 0 END AS quarantine_count,
                   CASE stage WHEN 'elt' THEN null_date_count ELSE 0 END AS null_date_count,
                   CASE stage WHEN 'elt' THEN missing_order_id ELSE 0 END AS missing_order_id,
                   CASE stage WHEN 'elt' THEN missing_customer_id ELSE 0 END AS missing_customer_id,
                   CASE stage WHEN 'elt' THEN corrupted_items_json ELSE 0 END AS corrupted_items_json,
                   CASE stage WHEN 'elt' THEN unknown_price ELSE 0 END AS unknown_price,
                   CASE WHEN stage = 'elt' AND run_id = 'r1'
                     THEN valid_count + corrected_count ELSE 0 END AS inserted_count,
                   CASE WHEN stage = 'elt' AND run_id = 'r2'
                     THEN valid_count + corrected_count ELSE 0 END AS updated_count,
                   CASE WHEN stage = 'elt' AND run_id = 'r2'
                     THEN valid_count + corrected_count ELSE 0 END AS unchanged_count,
                   CASE WHEN stage = 'elt' AND run_id = 'r1' THEN kept_keys ELSE 0 END AS inserted_keys,
                   CASE WHEN stage = 'elt' AND run_id = 'r2' THEN kept_keys ELSE 0 END AS updated_keys,
                   CASE stage WHEN 'elt' THEN held_keys ELSE 0 END AS quarantine_keys,
                   4::BIGINT AS source_file_count, true AS first_file_named,
                   true AS enough_partitions, true AS rate_adds_up
            FROM runs, counts, reasons, keys""",
        "latest_run": """
            WITH years AS (
              SELECT year(o_orderdate) AS y, count(*) AS rows_read,
                     count(DISTINCT o_custkey) AS valid_count
              FROM orders GROUP BY 1)
            SELECT 'run_' || y AS run_id, 'engine_' || y AS engine_used,
                   'orders_' || y || '.csv' AS file_name, rows_read, valid_count,
                   0::BIGINT AS corrected_count, cast(y AS double) AS elapsed_seconds
            FROM years ORDER BY y DESC LIMIT 1""",
        "sample_head": f"{_FILE} SELECT {_FIELDS} FROM filed ORDER BY k LIMIT 1000",
        "layer_preview": f"""{_DONE},
            raw AS (SELECT 'orders_raw' AS layer, order_id, NULL AS record_status FROM dirty
                    ORDER BY k LIMIT 10),
            kept AS (SELECT 'orders_validated' AS layer, order_id, record_status FROM done
                     WHERE {_ACCEPTED} ORDER BY order_id LIMIT 10),
            held AS (SELECT 'orders_quarantine' AS layer, order_id, record_status FROM (
                       SELECT *, {_QUARANTINE_KEY} AS _id FROM done WHERE {_HELD}
                       QUALIFY row_number() OVER (PARTITION BY _id ORDER BY k DESC) = 1)
                     ORDER BY _id LIMIT 10)
            SELECT * FROM raw UNION ALL SELECT * FROM kept UNION ALL SELECT * FROM held""",
        "layer_reset": f"""{_DONE},
            held AS (SELECT DISTINCT {_QUARANTINE_KEY} AS _id FROM done WHERE {_HELD})
            SELECT 'orders_raw' AS layer, count(*) AS rows_before, 0::BIGINT AS rows_after
            FROM dirty
            UNION ALL SELECT 'orders_validated', count(*), 0 FROM done WHERE {_ACCEPTED}
            UNION ALL SELECT 'orders_quarantine', count(*), 0 FROM held""",
        "unchanged_rows": f"""{_UPSERT_INPUT}, {_NEWEST}
            SELECT order_id AS _id, CASE WHEN k % 2 != 0 THEN 'inserted'
                   WHEN k % 50 = 0 THEN 'updated' ELSE 'unchanged' END AS effect
            FROM newest""",
        "currency_standard": f"{_DIRTY} SELECT k, currency, upper(trim(currency)) AS standard "
        "FROM dirty",
        "currency_aliases": """
            SELECT o_orderkey AS k,
                   CASE WHEN o_orderkey % 2 = 0 THEN ' ' || lower(n_name) || ' '
                        WHEN o_orderkey % 5 = 0 THEN 'us$' WHEN o_orderkey % 5 = 1 THEN 'eur' ELSE ' ' END AS currency,
                   CASE WHEN o_orderkey % 2 = 0 THEN 'C' || n_nationkey
                        WHEN o_orderkey % 5 = 0 THEN 'USD' WHEN o_orderkey % 5 = 1 THEN 'EUR' END AS standard_currency
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
        "order_item_totals": """
            SELECT l_orderkey AS k, count(*) AS n_items,
                   cast(cast(sum(cast(l_quantity AS decimal(18, 3)) * cast(l_extendedprice AS decimal(18, 2)))
                     AS decimal(38, 2)) AS double) AS items_total
            FROM lineitem GROUP BY 1""",
        "item_totals": f"""{_DIRTY} SELECT k, items_json,
            cast(try_cast(regexp_extract(items_json, '"qty"+:([0-9]+)', 1) AS decimal(18, 3))
              * try_cast(regexp_extract(items_json, '"price"+:([0-9.]+)', 1) AS decimal(18, 2))
              AS double) AS items_total FROM dirty""",
    }
