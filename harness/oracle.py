"""DuckDB statements that compute the registered queries independently of Spark."""

from __future__ import annotations

from feedwright.functions.text import WHITE_SPACE
from feedwright.schemas import DEFAULTS, TABLES, required_columns
from feedwright.spec import COMPLETENESS_FIELDS, EMAIL_PATTERN, FEED_COLUMNS, ZIP_PATTERN
from harness import fixtures as fx

_SPEC = fx.SPEC
_WINDOW = f"BETWEEN DATE '{_SPEC.window_start}' AND DATE '{_SPEC.as_of}'"
_BLANKS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)


def _select(rules: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(fx.columns(rules, fx.DUCKDB))} FROM {source}"


def _replaced(names: list[str], rules: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(fx.replaced(names, rules, fx.DUCKDB))} FROM {source}"


def _valid(c: str = "email") -> str:
    return f"COALESCE(regexp_matches({c}, '{EMAIL_PATTERN}'), FALSE)"


def _has(c: str) -> str:
    return f"(COALESCE({c}, '') <> '')"


def _pct(part: str, whole: str) -> str:
    return f"round(100.0 * ({part}) / NULLIF({whole}, 0), 1)"


def _nulled(name: str) -> str:
    rules = {c: f"CASE WHEN NOT COALESCE({when}, FALSE) THEN {c} END" for c, when in fx.NULLED[name].items()}
    return _replaced(TABLES[name].names, rules, f"src_{name}")


_MATCHABLE = f"({_valid()} AND {_has('hashed_email')})"

_FEED_OF = f"""
 SELECT d.customer_id, d.email, d.hashed_email, d.zip_code, 'PROMO' AS product_category,
        g.last_activity_date, ifnull(o.total_purchases, 0) AS total_purchases,
        CAST(ifnull(o.total_spend, 0) AS DECIMAL(20,2)) AS total_spend,
        g.engagement_score, g.premium_interaction_flag,
        CASE WHEN g.engagement_score < {_SPEC.medium_score} THEN 'low'
             WHEN g.engagement_score < {_SPEC.high_score} THEN 'medium' ELSE 'high' END AS engagement_tier
 FROM deduped d JOIN engagement g USING (customer_id) LEFT JOIN order_rollup o USING (customer_id)"""

_CTES = {
    "customer_copies": f"SELECT c_custkey AS k, unnest(range({fx.COPIES})) AS copy FROM customer",
    "customer_base": _select(fx.CUSTOMER_BASE, "customer_copies"),
    "src_customers": _select(fx.CUSTOMERS, "customer_base"),
    "src_events": _select(fx.EVENTS, "events"),
    "src_products": _select(fx.PRODUCTS, "part")
    + " UNION ALL "
    + _select(fx.SECOND_LISTING, "part")
    + f" WHERE {fx.LISTED_TWICE}",
    "src_orders": _select(fx.ORDERS, "orders"),
    "deduped": f"""
 SELECT * FROM src_customers
 QUALIFY 1 = row_number() OVER (PARTITION BY customer_id ORDER BY
   {_valid()} DESC, {_has('hashed_email')} DESC, created_date DESC NULLS LAST,
   opt_out_flag DESC NULLS LAST, {_has('zip_code')} DESC,
   email NULLS LAST, hashed_email NULLS LAST, zip_code NULLS LAST)""",
    "category_events": f"""
 SELECT e.*, p.product_name, p.price, p.premium_flag
 FROM src_events e, src_products p
 WHERE e.product_id = p.product_id AND p.category = 'PROMO' AND {_has('e.customer_id')} AND e.event_date {_WINDOW}""",
    "engagement": """
 SELECT customer_id, max(event_date) AS last_activity_date, count(*) AS total_events,
        count(*) FILTER (event_type = 'page_view') AS page_views, count(*) FILTER (event_type = 'product_view') AS product_views,
        count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts, count(*) FILTER (event_type = 'purchase') AS purchases,
        max(premium_flag) AS premium_interaction_flag,
        least(100, count(*) FILTER (event_type = 'page_view') + 2 * count(*) FILTER (event_type = 'product_view')
                   + 5 * count(*) FILTER (event_type = 'add_to_cart') + 10 * count(*) FILTER (event_type = 'purchase')) AS engagement_score
 FROM category_events GROUP BY ALL""",
    "order_rollup": f"""
 SELECT o.customer_id, count(*) AS total_purchases, CAST(sum(o.order_value) AS DECIMAL(20,2)) AS total_spend
 FROM src_orders o, src_products p
 WHERE o.product_id = p.product_id AND {_has('o.customer_id')} AND o.order_date {_WINDOW} GROUP BY ALL""",
    "everyone": _FEED_OF,
    "feed": f"{_FEED_OF} WHERE d.opt_out_flag = 0 AND {_valid('d.email')}",
    "leaky_feed": "SELECT * FROM feed UNION ALL SELECT * FROM everyone",
    "damaged_feed": _replaced(list(FEED_COLUMNS), fx.DAMAGED, "leaky_feed"),
    "priced_orders": "SELECT o.order_id, o.product_id, p.price AS list_price, "
    + fx.PRICED_VALUE.replace("order_id", "o.order_id")
    + " AS order_value FROM src_orders o LEFT JOIN"
    " (SELECT product_id, max(price) AS price FROM src_products GROUP BY ALL) p USING (product_id)",
}

_CTES |= {f"nulled_{name}": _nulled(name) for name in TABLES}

_PREFIX = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _CTES.items()) + "\n"


def _orphans(facts: str, key: str, dimension: str) -> str:
    return f"""(SELECT count(*) FROM {facts} f WHERE NOT EXISTS
      (SELECT 1 FROM {dimension} d WHERE d.{key} = f.{key} AND d.{key} <> ''))"""


def _leakage(feed: str) -> str:
    return f"""SELECT count(*) AS opted_out_in_feed FROM {feed}
 WHERE customer_id IN (SELECT customer_id FROM deduped WHERE opt_out_flag = 1)"""


def _duplicates(table: str) -> str:
    return f"""SELECT * FROM (SELECT customer_id, count(*) AS occurrences FROM {table} GROUP BY ALL)
 WHERE occurrences >= 2"""


def _clean(feed: str) -> str:
    trim = {c: f"trim(ifnull({c}, ''), {_BLANKS})" for c in ("email", "hashed_email", "zip_code")}
    return f"""SELECT * REPLACE (lower({trim['email']}) AS email),
   CAST({trim['hashed_email']} <> '' AND {_valid(trim['email'])} AS INT) AS matchable_flag,
   concat_ws(';', CASE WHEN {trim['hashed_email']} = '' THEN 'missing_hashed_email:unmatchable' END,
     CASE WHEN {trim['zip_code']} = '' THEN 'missing_zip' END) AS dq_notes
 FROM {feed}"""


def _report_rows(feed: str) -> str:
    """Eleven checks with their position, from one aggregate."""

    def trim(c: str) -> str:
        return f"trim(ifnull(CAST({c} AS VARCHAR), ''), {_BLANKS})"

    fields = ", ".join(f"count(*) FILTER ({trim(c)} <> '') AS c_{c}" for c in COMPLETENESS_FIELDS)
    good = f"({_valid(trim('email'))} AND {trim('hashed_email')} <> '')"

    def rounded(c: str) -> str:
        return f"(CASE WHEN n = 0 THEN 0.0 ELSE CAST(printf('%.1f', 100.0 * {c} / n) AS DOUBLE) END)"

    def status(condition: str) -> str:
        return f"if({condition}, 'PASS', 'FAIL')"

    checks = [
        ("required_columns_present", "'11/11'", "all", "'PASS'"),
        ("feed_row_count", "CAST(n AS VARCHAR)", "n/a (informational)", "'INFO'"),
        ("duplicate_customer_ids", "CAST(n - ids AS VARCHAR)", "0", status("n = ids")),
        ("invalid_or_missing_email", "CAST(bad_email AS VARCHAR)", "0", status("bad_email = 0")),
        *(
            (
                f"completeness:{c}",
                f"printf('%.1f%%', {rounded('c_' + c)})",
                ">=95.0%",
                status(f"{rounded('c_' + c)} >= 95.0"),
            )
            for c in COMPLETENESS_FIELDS
        ),
        *(
            (
                metric,
                f"printf('%.1f%% (%d/%d)', {rounded(c)}, {c}, n)",
                ">=70.0% (target)",
                status(f"{rounded(c)} >= 70.0"),
            )
            for metric, c in (("hashed_email_coverage", "hashed"), ("matchability: valid email + hash", "matchable"))
        ),
        ("malformed_zip_present", "CAST(bad_zip AS VARCHAR)", "0", status("bad_zip = 0")),
    ]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS i, '{metric}' AS metric, {value} AS value, '{threshold}' AS threshold, {state} AS status FROM t"
        for i, (metric, value, threshold, state) in enumerate(checks)
    )
    return f"""t AS (SELECT count(*) AS n, count(DISTINCT ifnull(customer_id, '')) AS ids,
   count(*) FILTER (NOT {_valid(trim('email'))}) AS bad_email, {fields},
   count(*) FILTER ({trim('hashed_email')} <> '') AS hashed, count(*) FILTER ({good}) AS matchable,
   count(*) FILTER ({trim('zip_code')} <> '' AND NOT regexp_matches({trim('zip_code')}, '{ZIP_PATTERN}')) AS bad_zip
  FROM {feed}),
 report AS ({rows})"""


def _landed(name: str) -> str:
    """Rows kept and set aside; the flag columns are not in the files, so every row has the default."""
    default = next(iter(DEFAULTS.get(name, {})), None)
    checked = [c for c in required_columns(TABLES[name]) if c != default]
    broken = " OR ".join(f"{c} IS NULL" for c in checked)
    flagged = f"count(*) FILTER (NOT ({broken}))" if default else "CAST(0 AS BIGINT)"
    return f"""SELECT '{name}' AS table_name, count(*) FILTER (NOT ({broken})) AS kept_rows,
   count(*) FILTER ({broken}) AS rejected_rows, {flagged} AS default_rows FROM nulled_{name}"""


def _report(feed: str) -> str:
    return f"WITH {_report_rows(feed)} SELECT metric, value, threshold, status FROM report"


def _gate(feed: str) -> str:
    return f"""WITH {_report_rows(feed)}
 SELECT count(*) FILTER (status LIKE 'FAIL%') = 0 AS passed, count(*) FILTER (status LIKE 'FAIL%') AS failed_checks,
   ifnull(string_agg(metric, ', ' ORDER BY i) FILTER (status LIKE 'FAIL%'), '') AS failed_metrics FROM report"""


_FUNNEL_STAGES = {
    "engaged_in_window": "engaged",
    "excluded_opt_out": "out",
    "excluded_bad_identifier": "bad",
    "final_feed": "delivered",
}

_FINAL = {
    "deduped_customers": "SELECT * FROM deduped",
    "category_events": "SELECT * FROM category_events",
    "customer_engagement": "SELECT * FROM engagement",
    "customer_engagement_direct": "SELECT * FROM engagement",
    "customer_orders": "SELECT * FROM order_rollup",
    "engagement_of_days": "SELECT * FROM engagement",
    "orders_of_days": "SELECT * FROM order_rollup",
    "audience_feed": "SELECT * FROM feed",
    "feed_preview": "SELECT * FROM feed ORDER BY engagement_score DESC, customer_id LIMIT 20",
    "exclusion_funnel": f"""WITH t AS (SELECT count(*) AS engaged, count(*) FILTER (opt_out_flag = 1) AS out,
   count(*) FILTER (opt_out_flag = 0 AND NOT {_valid()}) AS bad, (SELECT count(*) FROM feed) AS delivered
  FROM deduped WHERE customer_id IN (SELECT customer_id FROM engagement)) """
    + " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, {c} AS customer_count, {_pct(c, 'engaged')} AS pct_of_engaged FROM t"
        for stage, c in _FUNNEL_STAGES.items()
    ),
    "tier_composition": f"""SELECT engagement_tier, count(*) AS customers,
   {_pct('count(*)', '(SELECT count(*) FROM feed)')} AS pct_of_feed,
   round(avg(engagement_score), 1) AS avg_score,
   CAST(sum(premium_interaction_flag) AS BIGINT) AS premium_interactors,
   CAST(sum(total_spend) AS DECIMAL(30,2)) AS total_spend
  FROM feed GROUP BY ALL""",
    "field_completeness": " UNION ALL ".join(
        f"""SELECT '{c}' AS field, count(*) AS total_rows, count(NULLIF(CAST({c} AS VARCHAR), '')) AS populated_rows,
   {_pct(f"count(NULLIF(CAST({c} AS VARCHAR), ''))", 'count(*)')} AS completeness_pct FROM feed"""
        for c in COMPLETENESS_FIELDS
    ),
    "email_quality": f"""WITH t AS (SELECT CASE WHEN NOT {_has('email')} THEN 'missing' WHEN {_valid()} THEN 'valid'
    ELSE 'invalid' END AS kind, {_has('hashed_email')} AS hashed FROM deduped)
  SELECT count(*) AS total_customers,
   count(*) FILTER (kind = 'missing') AS missing_email, {_pct("count(*) FILTER (kind = 'missing')", 'count(*)')} AS missing_pct,
   count(*) FILTER (kind = 'invalid') AS invalid_email, {_pct("count(*) FILTER (kind = 'invalid')", 'count(*)')} AS invalid_pct,
   count(*) FILTER (kind = 'valid') AS valid_email, count(*) FILTER (hashed) AS with_hashed_email FROM t""",
    "hash_coverage": f"""SELECT count(*) AS feed_rows, count(NULLIF(hashed_email, '')) AS with_hash,
   {_pct("count(NULLIF(hashed_email, ''))", 'count(*)')} AS hash_coverage_pct,
   count(*) - count(NULLIF(hashed_email, '')) AS missing_hash FROM feed""",
    "duplicate_customers": _duplicates("src_customers"),
    "optout_leakage": _leakage("feed"),
    "optout_leakage_damaged": _leakage("damaged_feed"),
    "null_required_fields": f"""SELECT count(*) AS rows_with_null_required_fields FROM feed
  WHERE NOT ({_has('zip_code')} AND product_category IS NOT NULL AND last_activity_date IS NOT NULL
   AND engagement_score IS NOT NULL)""",
    "duplicate_feed_ids": _duplicates("feed"),
    "duplicate_feed_ids_damaged": _duplicates("damaged_feed"),
    "event_date_quality": f"""SELECT count(*) FILTER (event_date > DATE '{_SPEC.as_of}') AS future_dated_events,
   count(*) FILTER (event_date < DATE '{_SPEC.window_start}') AS outdated_events,
   count(*) - count(event_date) AS null_dated_events FROM nulled_events""",
    "orphan_records": f"""SELECT {_orphans('src_events', 'customer_id', 'deduped')} AS events_orphaned_customer,
   {_orphans('src_events', 'product_id', 'src_products')} AS events_unknown_product,
   {_orphans('src_orders', 'customer_id', 'deduped')} AS orders_orphaned_customer,
   {_orphans('src_orders', 'product_id', 'src_products')} AS orders_unknown_product""",
    "events_missing_customer": """SELECT count(*) AS events_missing_customer_id FROM src_events
  WHERE ifnull(customer_id, '') = ''""",
    "matchability": f"""SELECT CAST(70.0 AS DOUBLE) AS target_matchability_pct,
   {_pct(f'count(*) FILTER {_MATCHABLE}', 'count(*)')} AS actual_matchability_pct,
   count(*) AS feed_rows, count(*) FILTER {_MATCHABLE} AS matchable_rows, count(*) FILTER (NOT {_MATCHABLE}) AS unmatchable_rows,
   if(100.0 * count(*) FILTER {_MATCHABLE} >= 70.0 * count(*) AND count(*) > 0, 'PASS', 'FAIL — see diagnosis below') AS verdict
  FROM feed""",
    "missing_hash_diagnosis": f"""SELECT count(*) FILTER (NOT {_has('hashed_email')}) AS feed_rows_missing_hash,
   {_pct(f"count(*) FILTER (NOT {_has('hashed_email')})", 'count(*)')} AS pct_of_feed FROM feed""",
    "validation_report": _report("feed"),
    "validation_report_damaged": _report("damaged_feed"),
    "clean_feed": _clean("feed"),
    "clean_feed_damaged": _clean("damaged_feed"),
    "gate_result": _gate("feed"),
    "gate_result_damaged": _gate("damaged_feed"),
    "provision_hash": f"""SELECT * REPLACE (if({_valid()} AND NOT {_has('hashed_email')}, sha256(lower(email)),
   hashed_email) AS hashed_email) FROM deduped""",
    "hash_consistency": f"""SELECT count(hashed_email) AS hashed_rows,
   count(*) FILTER (hashed_email IS DISTINCT FROM sha256(lower(email)) AND hashed_email IS NOT NULL) AS inconsistent_hashes
  FROM ({_replaced(TABLES['customers'].names, {'hashed_email': fx.BAD_HASH}, 'src_customers')})""",
    "email_defects": f"""SELECT CASE WHEN strpos(email, ' ') > 0 THEN 'space'
    WHEN strpos(email, '@') = 0 THEN 'no_at' WHEN strpos(email, '@@') > 0 THEN 'double_at'
    WHEN right(email, 1) = '.' THEN 'trailing_dot'
    WHEN strpos(split_part(email, '@', -1), '.') = 0 THEN 'no_tld' ELSE 'other' END AS defect, count(*) AS customers
  FROM deduped WHERE {_has('email')} AND NOT {_valid()} GROUP BY ALL""",
    "order_value_reconcile": """SELECT count(*) AS total_orders,
   count(*) FILTER (order_value % ifnull(list_price, 50) = 0 AND order_value <= 3 * ifnull(list_price, 50)) AS consistent_orders,
   count(*) FILTER (order_value % ifnull(list_price, 50) <> 0 OR order_value > 3 * ifnull(list_price, 50)) AS inconsistent_orders
  FROM priced_orders""",
    "audience_tradeoff": f"""SELECT audience, count(*) AS customers,
   {_pct(f'count(*) FILTER {_MATCHABLE}', 'count(*)')} AS match_rate_pct, CAST(sum(total_spend) AS DECIMAL(30,2)) AS total_spend
  FROM feed, (VALUES ('expanded', FALSE), ('high_matchability', TRUE)) AS a(audience, only_matchable)
  WHERE NOT only_matchable OR {_MATCHABLE} GROUP BY ALL""",
    "contract_violations": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM nulled_{name}"
        for name, schema in TABLES.items()
        for c in required_columns(schema)
    ),
    "contract_rejects": " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, violations, count(*) AS rejected_rows FROM (SELECT concat_ws(';',
    {', '.join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in required_columns(schema))}) AS violations FROM nulled_{name}) WHERE violations <> '' GROUP BY ALL"""
        for name, schema in TABLES.items()
    ),
    "csv_roundtrip": "SELECT " + ", ".join(
        f"NULLIF(CAST({c} AS VARCHAR), '') AS {c}" for c in FEED_COLUMNS
    ) + " FROM feed",
    "validation_exit_status": "SELECT 'absent' AS delivery, 1 AS exit_status"
    f" UNION ALL SELECT 'damaged', if(passed, 0, 2) FROM ({_gate('damaged_feed')})"
    f" UNION ALL SELECT 'complete', if(passed, 0, 2) FROM ({_gate(f'(SELECT * FROM feed WHERE {fx.COMPLETE})')})",
    "csv_line_breaks": _replaced(TABLES["products"].names, {"product_name": fx.BROKEN_NAME}, "src_products"),
    "validated_csv_report": _report("damaged_feed"),
    "validated_csv_clean": "SELECT "
    + ", ".join(f"NULLIF(CAST({c} AS VARCHAR), '') AS {c}" for c in (*FEED_COLUMNS, "matchable_flag", "dq_notes"))
    + f" FROM ({_clean('damaged_feed')})",
    "landed_quarantine": " UNION ALL ".join(_landed(name) for name in TABLES),
    "view_preview": "SELECT * FROM feed ORDER BY engagement_score DESC, customer_id LIMIT 20",
    "feed_from_csv": "SELECT * REPLACE (NULLIF(zip_code, '') AS zip_code) FROM feed",
}


def statements() -> dict[str, str]:
    return {name: f"{_PREFIX}SELECT * FROM ({final})" for name, final in _FINAL.items()}
