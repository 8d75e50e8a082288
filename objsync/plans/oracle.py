"""The SQL that states what each catalogued query must return."""

from __future__ import annotations


def _padded(number: str, width: int) -> str:
    """Digits padded to a width, without cutting longer ones as lpad alone does."""
    return f"lpad({number}::varchar, greatest(length({number}::varchar), {width})::integer, '0')"


_ID = f"'001' || {_padded('c_custkey', 12)}"
_ACCOUNT = f"SELECT {_ID} AS \"Id\", c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_NEW = (
    f"SELECT '009' || {_padded('s_suppkey', 12)} AS \"Id\", s_name AS c_name, s_nationkey AS c_nationkey,"
    " s_acctbal AS c_acctbal, 'SUPPLIER' AS c_mktsegment FROM supplier"
)
_CHANGED = (
    f"SELECT \"Id\", c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment FROM ({_ACCOUNT})"
    f" WHERE c_mktsegment = 'BUILDING' UNION ALL {_NEW}"
)
_LOOKUP = f"'Customer#' || {_padded('o_custkey', 9)}"
_LINES = (
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'A' OR l_linestatus <> 'O' THEN l_partkey END AS l_partkey,"
    " l_suppkey, l_quantity, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem"
)
_LINE_CODE = (
    "CASE WHEN l_partkey IS NULL THEN 'REQUIRED_FIELD_MISSING' WHEN n > 1 THEN 'DUPLICATE_VALUE' END"
)
_ODD_DOCUMENTS = """
    SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '  ' || text || ' ' WHEN 1 THEN chr(10) || text || chr(10) || chr(9) WHEN 2 THEN ''
      WHEN 3 THEN text END AS text, CASE WHEN doc_id % 5 <> 2 THEN '' END AS note FROM documents"""
# Fixed value: the pattern of refused filter text.
_REFUSED = (
    r"(;|--|/\*|\*/|\x00|\b(DROP|DELETE|INSERT|UPDATE|TRUNCATE|ALTER|CREATE|EXEC|EXECUTE)\b|\(.*SELECT.*\))"
)
_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")


def _refusal(text: str) -> str:
    first = f"upper(regexp_extract({text}, '{_REFUSED}', 0, 'i'))"
    return (
        f"CASE WHEN regexp_matches({first}, 'DROP|DELETE|UPDATE|INSERT|SELECT') THEN 'keyword'"
        f" WHEN {first} <> '' THEN 'dangerous' END"
    )


def _name_verdict(name: str, dotted: bool) -> str:
    shape = r"^[a-zA-Z][a-zA-Z0-9_]*(\.[a-zA-Z][a-zA-Z0-9_]*)*\z" if dotted else r"^[a-zA-Z][a-zA-Z0-9_]*\z"
    return (
        f"CASE WHEN {name} IS NULL OR {name} = '' THEN 'empty'"
        f" WHEN NOT regexp_matches({name}, '{shape}') THEN 'invalid' ELSE coalesce({_refusal(name)}, 'ok') END"
    )


def _filter_verdict(text: str) -> str:
    odd = f"(length({text}) - length(replace({text}, '''', ''))) % 2 <> 0"
    return (
        f"CASE WHEN {text} IS NULL OR {text} = '' THEN 'ok'"
        f" ELSE coalesce({_refusal(text)}, CASE WHEN {odd} THEN 'unbalanced' END, 'ok') END"
    )


def _counts(names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS resource, count(*) AS n FROM {name}" for name in names)


ORACLE: dict[str, str] = {
    "extract_project": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "extract_filter": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'",
    "filter_operators": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
        WHERE (o_orderstatus = 'F' OR o_orderpriority LIKE '%URGENT') AND o_totalprice > 100000
          AND o_orderdate >= TIMESTAMP '1996-06-01' AND o_orderpriority IN ('1-URGENT', '5-LOW')""",
    "extract_relationship": """
        SELECT c_custkey, c_name, n_name AS nation_name, r_name AS region_name FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "extract_relationship_filter": """
        SELECT c_custkey, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""",
    "extract_incremental": """
        SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'""",
    "extract_filter_incremental": """
        SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
        WHERE o_orderstatus = 'O' AND o_orderdate > TIMESTAMP '1998-01-01'""",
    "extract_topn": """
        SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100""",
    "extract_all_counts": """
        SELECT 'accounts' AS resource, count(*) AS n FROM customer
        UNION ALL SELECT 'open_orders', count(*) FROM orders
          WHERE o_orderstatus = 'O' AND o_orderdate > TIMESTAMP '1998-01-01'
        UNION ALL SELECT 'lines', count(*) FROM lineitem""",
    "row_counts": f"""
        WITH c AS ({_counts(_TABLES)}) SELECT resource, n FROM c
        UNION ALL SELECT 'total', sum(n)::bigint FROM c""",
    "incremental_watermark": """
        SELECT 'orders' AS resource, 'o_orderdate' AS cursor_field, max(o_orderdate)::varchar AS last_value FROM orders
        UNION ALL SELECT 'lines', 'l_shipdate', max(l_shipdate)::varchar FROM lineitem
        UNION ALL SELECT 'events', 'event_id', max(event_id)::varchar FROM events""",
    "incremental_boundary": """
        SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders o WHERE o_orderdate >= TIMESTAMP '1998-01-01'
        AND NOT EXISTS (SELECT 1 FROM orders h WHERE h.o_orderkey = o.o_orderkey
                        AND h.o_orderdate <= TIMESTAMP '1998-01-01' AND h.o_orderstatus <> 'P')""",
    "normalize_csv": "SELECT * FROM customer",
    "normalize_chunks": "SELECT * FROM pages",
    "csv_roundtrip": "SELECT * FROM documents",
    "csv_roundtrip_pages": "SELECT * FROM pages",
    "csv_checked_read": "SELECT * FROM customer",
    "csv_split_pages": "SELECT * FROM pages",
    "csv_split_conversations": """
        SELECT conv_id, count(*) AS turns, count(text) AS texts, sum(length(text) + 6)::bigint AS chars,
               min(chr(10) || '"' || text || '",' || chr(10) || chr(10)) AS first_text
        FROM conversations GROUP BY conv_id""",
    "csv_roundtrip_blanks": _ODD_DOCUMENTS,
    "normalize_long_chunks": _ODD_DOCUMENTS,
    "chunk_stats": """
        SELECT c_custkey // 500 AS chunk, count(*) AS n, min(c_custkey) AS first_key, max(c_custkey) AS last_key
        FROM customer GROUP BY 1""",
    "batch_stats": """
        SELECT o_orderkey // 10000 AS chunk, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
        FROM orders GROUP BY 1""",
    "json_struct_get": """
        SELECT event_id, json_extract(props, '$.k')::bigint AS k, 'none' AS label FROM events""",
    "json_filter_nullsafe": """
        SELECT event_id, nullif(event_type, 'view') AS category FROM events
        WHERE nullif(event_type, 'view') IS DISTINCT FROM 'error'""",
    "map_rename": """
        SELECT o_orderkey AS order_ref, o_orderkey AS order_number, o_custkey AS account, o_orderstatus AS status
        FROM orders""",
    "map_missing_column": """
        SELECT c_name AS external_id, c_acctbal AS balance, NULL::varchar AS phone, NULL::varchar AS website
        FROM customer""",
    "map_constant": "SELECT c_name AS external_id, 'Prospect' AS type, 'France' AS country FROM customer",
    "map_concat_strip": r"""
        SELECT p_partkey, trim(concat(E' \t', p_brand, coalesce(nullif(p_type, 'SMALL'), ''), p_name, E'\n '),
                               E' \t\n\r') AS street FROM part""",
    "map_template": """
        SELECT p_partkey, concat('Legal Nature: ', coalesce(nullif(p_type, 'PROMO'), ''), '- Source: ', p_brand)
          AS description FROM part""",
    "map_required_key": """
        SELECT c_custkey, c_name AS external_id FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')""",
    "type_cast": """
        SELECT o_orderkey, o_orderdate AS placed, o_totalprice AS price, NULL::bigint AS rank FROM orders""",
    "flatten_struct": """
        SELECT c_custkey, c_nationkey AS place__nation, c_mktsegment AS place__market__c_mktsegment FROM customer""",
    "explode_child": """
        SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::int AS idx, unnest(embedding) AS value FROM embeddings""",
    "schema_evolve": """
        SELECT c_custkey, c_name, c_mktsegment, NULL::double AS c_acctbal FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
    "transform_map_in_pandas": """
        SELECT o_orderkey, 'status' AS kind, o_orderstatus AS content FROM orders
        UNION ALL SELECT o_orderkey, 'rank', substr(o_orderpriority, 3) FROM orders""",
    "key_distinct": "SELECT DISTINCT o_custkey::varchar AS key FROM orders",
    "keymap_full": f"SELECT {_ID} AS \"Id\", c_name AS key FROM customer WHERE c_name <> 'Customer#000000001'",
    "keymap_filtered": f"""
        SELECT {_ID} AS "Id", c_name AS key FROM customer WHERE c_name IN (SELECT {_LOOKUP} FROM orders)""",
    "keymap_missing": f"""
        SELECT DISTINCT {_LOOKUP} AS key FROM orders
        WHERE {_LOOKUP} NOT IN (SELECT c_name FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""",
    "keymap_merge": f"""
        SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '9' ELSE '' END || "Id" AS "Id", c_name AS key
        FROM ({_ACCOUNT}) UNION ALL SELECT "Id", c_name FROM ({_NEW})""",
    "keymap_ambiguous": f"""
        SELECT l_orderkey || '-' || l_linenumber AS key, count(*) AS n,
          min('01t' || {_padded('l_partkey', 12)}) AS first_id,
          max('01t' || {_padded('l_partkey', 12)}) AS last_id
        FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey) > 1""",
    "resolve_keys": f"""
        SELECT o_orderkey, {_LOOKUP} AS account_key, coalesce("Id", {_LOOKUP}) AS account_id FROM orders
        LEFT JOIN ({_ACCOUNT}) ON c_name = {_LOOKUP} AND c_mktsegment = 'BUILDING'""",
    "resolve_keys_hot": f"""
        WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Customer#000000001'
                     WHEN o_orderpriority <> '5-LOW' THEN {_LOOKUP} END AS account_key FROM orders)
        SELECT o_orderkey, account_key, "Id" AS account_id FROM o LEFT JOIN ({_ACCOUNT}) ON c_name = account_key""",
    "resolve_rejects": f"""
        SELECT o_orderkey, {_LOOKUP} AS account_key, 'INVALID_CROSS_REFERENCE_KEY' AS error_code,
          'No match for account_key: ' || {_LOOKUP} AS error_message
        FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'""",
    "resolve_unresolved": f"""
        SELECT {_LOOKUP} AS key, count(*) AS n FROM orders
        WHERE {_LOOKUP} NOT IN (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""",
    "insert_append": f"""
        {_ACCOUNT} UNION ALL SELECT "Id", c_name, NULL, c_acctbal, c_mktsegment FROM ({_NEW})""",
    "upsert_merge": f"""
        WITH b AS ({_CHANGED}) SELECT * FROM ({_ACCOUNT}) WHERE c_name NOT IN (SELECT c_name FROM b)
        UNION ALL SELECT * FROM b""",
    "upsert_partial": f"""
        WITH b AS (SELECT c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal + 100 END AS balance FROM ({_CHANGED}))
        SELECT a."Id", coalesce(a.c_name, b.c_name) AS c_name, a.c_nationkey, coalesce(b.balance, a.c_acctbal) AS c_acctbal,
          a.c_mktsegment FROM ({_ACCOUNT}) a FULL JOIN b ON a.c_name = b.c_name""",
    "upsert_labels": """
        SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, lang, source,
          CASE WHEN l.doc_id IS NULL THEN -1 ELSE quality END AS quality,
          CASE WHEN l.doc_id IS NULL THEN -1 ELSE toxic END AS toxic
        FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""",
    "upsert_split": f"""
        WITH b AS ({_CHANGED}), m AS (
          SELECT CASE WHEN a.c_name IS NULL THEN 'inserted' WHEN b.c_name IS NULL THEN 'unchanged' ELSE 'updated' END AS outcome
          FROM customer a FULL JOIN b ON a.c_name = b.c_name)
        SELECT outcome, count(*) AS n FROM m GROUP BY 1""",
    "upsert_keep_last": f"""
        WITH r AS (SELECT {_LOOKUP} AS c_name, o_orderstatus AS stage, o_totalprice AS last_price, o_orderdate, o_orderkey,
                     row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
        SELECT a."Id", coalesce(a.c_name, r.c_name) AS c_name, coalesce(r.stage, 'new') AS stage,
          coalesce(r.last_price, 0.0) AS last_price, o_orderdate, o_orderkey
        FROM ({_ACCOUNT}) a FULL JOIN (SELECT * FROM r WHERE rn = 1) r ON a.c_name = r.c_name""",
    "upsert_rejects": """
        WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
                   FROM lineitem WHERE l_linestatus = 'O'),
             t AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)
        SELECT b.l_orderkey, b.l_linenumber, l_quantity,
          CASE WHEN b.n > 1 THEN 'DUPLICATE_VALUE' ELSE 'DUPLICATE_EXTERNAL_ID' END AS error_code,
          CASE WHEN b.n > 1 THEN 'Duplicate value on: l_orderkey, l_linenumber'
               ELSE 'More than one record found for: l_orderkey, l_linenumber' END AS error_message
        FROM b LEFT JOIN t ON b.l_orderkey = t.l_orderkey AND b.l_linenumber = t.l_linenumber
        WHERE b.n > 1 OR t.n > 1""",
    "delete_by_id": f"""
        {_ACCOUNT} WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""",
    "delete_by_key": f"""
        {_ACCOUNT} WHERE c_name NOT IN (SELECT {_LOOKUP} FROM orders WHERE o_totalprice > 450000)""",
    "delete_unresolved": """
        SELECT s_name AS account_key, 'ENTITY_NOT_FOUND' AS error_code, 'No record found for: account_key' AS error_message
        FROM supplier""",
    "replace_wipe_ids": f"SELECT {_ID} AS \"Id\" FROM customer",
    "replace_table": f"""
        SELECT "Id", c_name, NULL::int AS c_nationkey, c_acctbal, c_mktsegment FROM ({_NEW})""",
    "merge_sync": """
        SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN '[edited] ' || text ELSE text END AS text
        FROM conversations UNION ALL SELECT conv_id, -1, role, text FROM conversations WHERE turn = 0""",
    "rejects": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {_LINE_CODE} AS error_code,
          CASE WHEN l_partkey IS NULL THEN 'Required fields are missing: l_partkey'
               ELSE 'Duplicate value on: l_orderkey, l_linenumber' END AS error_message
        FROM ({_LINES}) WHERE l_partkey IS NULL OR n > 1""",
    "job_results": f"""
        SELECT (l_orderkey // 10000)::varchar AS job_id, 'Line' AS object, 'upsert' AS operation,
          count(*) AS records_processed, count({_LINE_CODE}) AS records_failed FROM ({_LINES}) GROUP BY 1""",
    "literal_format": r"""
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS at_literal,
          strftime(o_orderdate, '%Y-%m-%d') AS day_literal, o_totalprice::varchar AS price_literal,
          CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS open_literal,
          coalesce(nullif(o_custkey, 1)::varchar, 'NULL') AS account_literal,
          '''' || replace('it''s ' || o_orderpriority, '''', '\''') || '''' AS note_literal FROM orders""",
    "audit_object_names": f"""
        WITH n AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN p_brand WHEN 'SMALL' THEN 'Delete' WHEN 'PROMO' THEN ''
                     WHEN 'STANDARD' THEN replace(p_brand, '#', '_') || '__c' WHEN 'LARGE' THEN p_type || E'\\n'
                     ELSE p_type END AS name FROM part)
        SELECT p_partkey, {_name_verdict('name', False)} AS verdict FROM n""",
    "audit_field_names": f"""
        WITH n AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Owner.' || replace(p_brand, '#', '_')
                     WHEN 'SMALL' THEN 'Account.Drop' WHEN 'PROMO' THEN 'Owner..Name' WHEN 'LARGE' THEN 'Update__c'
                     WHEN 'STANDARD' THEN replace(p_brand, '#', '_') || '__r.Account.Name' END AS name FROM part)
        SELECT p_partkey, {_name_verdict('name', True)} AS dotted, {_name_verdict('name', False)} AS strict FROM n""",
    "audit_filters": f"SELECT doc_id, {_filter_verdict('text')} AS verdict FROM documents",
    "audit_page_filters": f"SELECT page_id, {_filter_verdict('html')} AS verdict FROM pages",
    "flow_flagship": f"""
        SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN '801' || {_padded('o_orderkey', 12)} END AS "Id",
          o_orderkey::varchar AS "OrderNumber", o_orderstatus AS "Status", o_totalprice AS "Amount",
          coalesce("Id", {_LOOKUP}) AS "AccountId",
          CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_orderpriority END AS "Description"
        FROM orders LEFT JOIN ({_ACCOUNT}) ON c_name = {_LOOKUP} AND c_mktsegment <> 'HOUSEHOLD'""",
    "flow_prospects": """
        WITH b AS (SELECT p_partkey::varchar AS k, p_name, nullif(p_type, 'PROMO') AS nature, p_brand,
                     trim(concat(p_size::varchar, coalesce(nullif(p_type, 'SMALL'), ''), p_name)) AS street
                   FROM part WHERE p_type <> 'ECONOMY' AND p_type <> 'LARGE'),
             t AS (SELECT p_partkey::varchar AS k, p_retailprice FROM part WHERE p_size <= 25)
        SELECT coalesce(t.k, b.k) AS "ExternalId", CASE WHEN b.k IS NULL THEN 'old' ELSE p_name END AS "Name",
          CASE WHEN b.k IS NULL THEN 'Customer' ELSE 'Prospect' END AS "Type", coalesce(street, '') AS "BillingStreet",
          coalesce(p_brand, '') AS "BillingCity",
          CASE WHEN b.k IS NULL THEN '' ELSE concat('Legal Nature: ', coalesce(nature, ''), '- Source: API') END AS "Description",
          p_retailprice AS "Revenue"
        FROM t FULL JOIN b ON t.k = b.k""",
    "flow_accounts": f"""
        SELECT CASE WHEN c_mktsegment <> 'FURNITURE' THEN {_ID} END AS "Id", c_name AS "ExternalId", c_name AS "AccountNumber",
          c_acctbal AS "AnnualRevenue", NULL::varchar AS "Phone", c_mktsegment AS "Industry",
          CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'kept' END AS "Rating" FROM customer""",
    "flow_reset": 'SELECT p_name AS "Name", p_brand AS "FixedCode", p_type AS "FixedText" FROM part',
    "flow_sync": """
        SELECT o_orderkey AS order_id, o_orderstatus AS status, c_name AS account FROM orders
        LEFT JOIN customer ON c_custkey = o_custkey""",
    "flow_limited_sync": "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders",
    "flow_results": f"""
        SELECT 'Line' AS object, 'upsert' AS operation, count(*) AS records_processed,
          count(*) FILTER (WHERE n > 1) AS records_failed FROM ({_LINES})""",
    "stream_sync": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "stream_changes": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "compact_changes": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "file_stats": "SELECT count(*) AS n, true AS fits, true AS all_counted FROM documents",
    "text_stats": "SELECT count(*) AS n, (count(*) + 9999) // 10000 AS texts, count(*) // 10000 AS whole FROM orders",
    "delivery_batches": """
        SELECT (rn - 1) // 10000 AS batch, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1""",
    "batch_results": f"""
        SELECT ((rn - 1) // 10000)::varchar AS job_id, 'Line' AS object, 'upsert' AS operation,
          count(*) AS records_processed, count({_LINE_CODE}) AS records_failed
        FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS rn FROM ({_LINES})) GROUP BY 1""",
    "json_records": """
        SELECT p_partkey AS siren, coalesce(nullif(p_type, 'SMALL'), 'none') AS kind, p_brand AS town, NULL::varchar AS absent FROM part""",
    "keymap_two_loads": f"""
        WITH k AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority = '1-URGENT')
        SELECT o_orderkey, CASE WHEN o_custkey IN (FROM k) THEN "Id" END AS account_id
        FROM orders LEFT JOIN ({_ACCOUNT}) ON c_name = {_LOOKUP}""",
    "rejects_read_back": f"""
        SELECT l_orderkey || '-' || l_linenumber AS line_key, l_quantity::varchar AS l_quantity, 'DUPLICATE_VALUE' AS error_code,
          'Duplicate value on: line_key' AS error_message FROM ({_LINES}) WHERE n > 1""",
    "sync_late_ties": "SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders",
    "merge_text_keys": """
        SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer""",
    "keyed_fetch": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "delete_by_stats": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)""",
    "widening_loads": """
        SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN c_nationkey::decimal(15, 2)::varchar
          WHEN 'FURNITURE' THEN c_acctbal::decimal(15, 2)::varchar ELSE c_name END AS value FROM customer""",
    "column_types": """
        SELECT * FROM (SELECT unnest(['k', 'n', 't', 'b', 'd']) AS name,
          unnest([CASE WHEN max(c_custkey) < 2147483648 THEN 'int' ELSE 'bigint' END, 'int', 'string',
                  CASE WHEN count(c_custkey) > 0 THEN 'bigint' END, 'date']) AS type FROM customer)""",
}
