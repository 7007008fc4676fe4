"""DuckDB SQL for every query, over the given tables, written apart from the Spark code."""

from __future__ import annotations

from checks import blocks as b
from lonja.plans import samples
from lonja.plans.samples import DUCK
from lonja.vocabulary import CATALOGUE_COLUMNS, ORDER_COLUMNS

ORACLE: dict[str, str] = {}

CATALOGUE_TEXTS = f"({b.over_tables(samples.catalogue_sql(DUCK))})"
ORDER_TEXTS = f"({b.over_tables(samples.orders_sql(DUCK))})"
STOCK_TEXTS = f"({b.over_tables(samples.stock_sql(DUCK))})"
RULE_TEXTS = f"({b.over_tables(samples.rules_sql(DUCK))})"
EXCEPTION_TEXTS = f"({b.over_tables(samples.exceptions_sql(DUCK))})"

CATALOGUE = b.catalogue_ctes()
ORDERS = b.order_ctes()
STOCK = b.stock_ctes()
SALES = b.sales_ctes()
WARNED = "'warn' AS action, 'info' AS severity"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def real(x: str, name: str | None = None) -> str:
    return f"CAST({x} AS DOUBLE) AS {name or x}"


def long(x: str, name: str) -> str:
    return f"CAST({x} AS BIGINT) AS {name}"


def small(x: str, name: str) -> str:
    return f"CAST({x} AS INTEGER) AS {name}"


def cleaned(texts, block, key, column, kind="text"):
    source = block(texts, column, "v")
    value = {"text": "v AS value", "real": real("v", "value"), "date": "CAST(v AS VARCHAR) AS value", "stamp": f"{stamp('v')} AS value"}[kind]
    return f"SELECT {key}, {value}, v_code AS code FROM {source}"


# --- sources
LINES = "1 + length(descripcion) - length(replace(descripcion, chr(10), ''))"
ORACLE["scan_catalog_csv"] = (
    f"SELECT replace({' || chr(124) || '.join(CATALOGUE_COLUMNS)}, '€', '?') AS cells, {long(LINES, 'n_lines')} FROM {CATALOGUE_TEXTS}"
)
ORACLE["scan_orders_csv"] = f"SELECT {' || chr(124) || '.join(ORDER_COLUMNS)} AS cells, {long('1', 'n_lines')} FROM {ORDER_TEXTS}"
ORACLE["scan_tariff_rules"] = (
    f"SELECT kind, trim(label) AS label, {small('1', 'bases')}, base_text, false AS nested, {small('0', 'volumes')} FROM {RULE_TEXTS}"
)
ORACLE["scan_tariff_exceptions"] = (
    f"SELECT sku, {small('prices', 'prices')}, price_text, {small('flags', 'flags')}, trim(flag_text) AS flag_text FROM {EXCEPTION_TEXTS}"
)
ORACLE["tariff_structure_check"] = (
    "SELECT DISTINCT CAST(p_partkey // 100 AS VARCHAR) AS path, CASE (p_partkey // 100) % 6 WHEN 1 THEN 'INVALID_XML' WHEN 2 THEN 'INVALID_XML' "
    "WHEN 3 THEN 'INVALID_TARIFF' WHEN 4 THEN 'INVALID_ENCODING' WHEN 5 THEN 'INVALID_XML' END AS problem FROM part"
)
ORACLE["scan_stock_snapshot"] = f"SELECT locator, sku, warehouse, quantity, reserved, updated_at FROM {STOCK_TEXTS} WHERE locator NOT LIKE '%b'"
ORACLE["stock_page_completeness"] = f"""
  WITH pages AS (SELECT event_id // {samples.PAGE} + 1 AS p, count(*) AS n FROM events GROUP BY 1),
  sizes AS (SELECT p, n, CASE WHEN p % 50 = 9 THEN n - 1 WHEN p % 60 = 11 THEN 0 ELSE n END AS found FROM pages)
  SELECT 'page:' || p AS locator, 'inconsistent page' AS problem FROM sizes WHERE p % 40 = 7 OR found <> n
  UNION ALL SELECT 'page:' || max(p), 'repeated page' FROM sizes WHERE found = 0 HAVING count(*) > 1
  UNION ALL SELECT 'snapshot', 'incomplete snapshot' FROM sizes HAVING sum(found) <> sum(n)"""
ORACLE["stock_incremental_filter"] = f"""
  SELECT ord FROM {STOCK_TEXTS} WHERE CASE WHEN updated_at LIKE '%+02:00' THEN CAST(left(updated_at, 19) AS TIMESTAMP) - INTERVAL 2 HOUR
  ELSE CAST(left(updated_at, 19) AS TIMESTAMP) END >= TIMESTAMP '2024-01-15 00:00:00'"""
ORACLE["attach_provenance"] = (
    f"SELECT 'catalog_csv' AS source, v AS entity, {long(LINES, 'n_lines')}, {LINES} > 1 AS is_range FROM {b.p_identifier(CATALOGUE_TEXTS, 'sku', 'v')}"
)
FILES = (
    "SELECT doc_id // 500 AS part, CAST(sum(strlen(line) + 1) AS BIGINT) AS n_bytes, sha256(string_agg(line || chr(10), '' ORDER BY doc_id)) AS sha256 "
    "FROM (SELECT doc_id, regexp_replace(text, '[\\r\\n]', ' ', 'g') AS line FROM documents) GROUP BY part"
)
ORACLE["source_fingerprint"] = f"""
  WITH RECURSIVE files AS ({FILES}),
  leaves AS (SELECT row_number() OVER (ORDER BY part) - 1 AS place, count(*) OVER () AS n,
    sha256('file' || chr(10) || '12:' || lpad(CAST(part AS VARCHAR), 12, '0') || chr(10) || '64:' || sha256) AS sha256 FROM files),
  tree(level, n, place, sha256) AS (
    SELECT 0, n, place, sha256 FROM leaves UNION ALL
    SELECT level + 1, (n + 3) // 4, place // 4, sha256('node' || chr(10) || string_agg('64:' || sha256, chr(10) ORDER BY place))
    FROM tree WHERE n > 1 GROUP BY level, n, place // 4)
  SELECT part, n_bytes, sha256, CAST(0 AS BIGINT) AS changed FROM files UNION ALL
  SELECT -1, NULL, CASE WHEN n0 = 1 THEN (SELECT min(sha256) FROM files) ELSE sha256 END, NULL FROM tree, (SELECT count(*) AS n0 FROM files) WHERE n = 1"""
ORACLE["empty_source_guard"] = "SELECT 'EMPTY_CATALOG' AS problem, 'none' AS rows_found"

# --- cleaning jobs
ORACLE["clean_missing_tokens"] = f"SELECT ord, {b.present('precio_coste')} AS value FROM {CATALOGUE_TEXTS}"
for name, expression in (("clean_text", b.clean("text")), ("comparison_key", f"replace({b.key('text')}, 'ß', 'ss')")):
    ORACLE[name] = f"SELECT doc_id, md5(t) AS digest, {small('length(t)', 'n_chars')} FROM (SELECT doc_id, {expression} AS t FROM documents)"
ORACLE["require_text"] = cleaned(CATALOGUE_TEXTS, b.p_text, "ord", "nombre")
ORACLE["clean_identifier"] = cleaned(CATALOGUE_TEXTS, b.p_identifier, "ord", "sku")
ORACLE["map_status"] = cleaned(ORDER_TEXTS, b.p_status, "locator", "estado")
ORACLE["map_channel"] = cleaned(ORDER_TEXTS, b.p_channel, "locator", "canal")
ORACLE["clean_decimal"] = cleaned(CATALOGUE_TEXTS, b.p_decimal, "ord", "peso_kg", "real")
ORACLE["strip_currency_columns"] = (
    f"SELECT ord, {b.currency(b.present('precio_coste'))} AS cost, {b.currency(b.present('pvp_recomendado'))} AS pvp FROM {CATALOGUE_TEXTS}"
)
ORACLE["clean_money"] = cleaned(ORDER_TEXTS, b.p_money, "locator", "precio_unitario", "real")
ORACLE["repair_currency_suffix"] = (
    f"SELECT ord, {real('c', 'cost')}, c_code AS cost_code, coalesce(c_repaired, false) AS cost_repaired, "
    f"{real('p', 'pvp')}, p_code AS pvp_code, coalesce(p_repaired, false) AS pvp_repaired "
    f"FROM {b.p_catalogue_money(b.p_catalogue_money(CATALOGUE_TEXTS, 'precio_coste', 'c'), 'pvp_recomendado', 'p')}"
)
ORACLE["clean_discount"] = cleaned(ORDER_TEXTS, b.p_discount, "locator", "descuento_linea", "real")
ORACLE["clean_tax"] = cleaned(CATALOGUE_TEXTS, b.p_tax, "ord", "iva", "real")
ORACLE["clean_weight"] = cleaned(CATALOGUE_TEXTS, b.p_weight, "ord", "peso_kg", "real")
ORACLE["clean_quantity"] = cleaned(ORDER_TEXTS, b.p_quantity, "locator", "cantidad")
ORACLE["clean_stock_quantity"] = cleaned(STOCK_TEXTS, b.p_stock_quantity, "ord", "quantity")
ORACLE["round_money_columns"] = (
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
    + ", ".join(real(f"round(v, {n})", f"r{n}") for n in range(4))
    + " FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(9,6)) * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS v FROM lineitem)"
)
ORACLE["clean_date"] = cleaned(CATALOGUE_TEXTS, b.p_date, "ord", "fecha_alta", "date")
ORACLE["clean_instant"] = cleaned(STOCK_TEXTS, b.p_stock_instant, "ord", "updated_at", "stamp")
ORACLE["clean_ean"] = cleaned(CATALOGUE_TEXTS, b.p_ean, "ord", "ean")

# --- validation and ledger
ISSUE = "code, field, action, severity"
ORACLE["validate_column_count"] = b.with_ctes(CATALOGUE, f"SELECT ord, entity, {ISSUE} FROM cat_issues WHERE code = 'INVALID_COLUMN_COUNT'")
ORACLE["validate_catalog_row"] = b.with_ctes(CATALOGUE, f"SELECT ord, entity, {ISSUE} FROM cat_issues WHERE action = 'reject_row' AND field <> ''")
ORACLE["drop_bad_optional_fields"] = b.with_ctes(CATALOGUE, (
    f"SELECT ord, v_ean AS ean, {real('v_tax', 'tax_rate')}, {real('v_weight', 'weight_kg')}, CAST(v_listed AS VARCHAR) AS listed_on, v_description AS description, "
    + small(" + ".join(f"CAST(v_{n}_code IS NOT NULL AS INT)" for n in ("ean", "tax", "weight", "listed")), "n_dropped")
    + " FROM cat_parsed WHERE candidate"
))
ORACLE["validate_order_line"] = b.with_ctes(ORDERS, f"SELECT locator, {ISSUE} FROM ord_ledger WHERE field IN ('sku', 'cantidad', 'precio_unitario', 'descuento_linea')")
ORACLE["validate_stock_row"] = b.with_ctes(STOCK, (
    f"SELECT locator, entity, field <> 'sku' AND code <> 'UNKNOWN_PRODUCT_SKU' AS invalidates, {ISSUE} FROM st_ledger "
    "WHERE action = 'reject_row' AND code <> 'CONFLICTING_STOCK'"
))
ORACLE["warn_reserved_exceeds_quantity"] = b.with_ctes(STOCK, (
    "SELECT locator, v_quantity AS quantity, v_reserved AS reserved, 'RESERVED_EXCEEDS_QUANTITY' AS code, '' AS field, 'warn' AS action, 'warning' AS severity "
    "FROM st_checked WHERE valid AND v_reserved > v_quantity"
))
RULES = b.add(b.p_discount(RULE_TEXTS, "base_text", "v_ratio"), k=b.key("label"))
RULES = b.add(RULES, problem=(
    "CASE WHEN kind NOT IN ('categoria', 'marca') OR k IS NULL OR bases <> 1 OR nested OR v_ratio IS NULL THEN 'INVALID_TARIFF' END"
))
EXCEPTIONS = b.p_money(b.p_identifier(EXCEPTION_TEXTS, "sku", "v_sku"), "price_text", "v_price")
EXCEPTIONS = b.add(EXCEPTIONS, flag=f"CASE WHEN flags > 0 THEN lower({b.trimmed('flag_text')}) END")
EXCEPTIONS = b.add(
    EXCEPTIONS,
    blocked="v_price IS NULL OR nested OR coalesce(flag <> 'false', false)",
    problem="CASE WHEN v_sku IS NULL THEN 'INVALID_TARIFF' END",
)
EXCEPTION = {
    "exc_parsed": f"SELECT *, CASE WHEN NOT blocked THEN v_price END AS agreed FROM {EXCEPTIONS}",
    "exc_kept": (
        "SELECT *, row_number() OVER w = 1 AS first, CASE WHEN blocked THEN first_value(blocked) OVER w AND first_value(price_text) OVER w IS NOT DISTINCT FROM price_text "
        "AND first_value(flag) OVER w IS NOT DISTINCT FROM flag ELSE NOT first_value(blocked) OVER w AND first_value(agreed) OVER w = agreed END AS same "
        "FROM exc_parsed WHERE problem IS NULL WINDOW w AS (PARTITION BY v_sku ORDER BY ord)"
    ),
}
TERMS = f"""
  SELECT '/TarifasProveedor/Condiciones/*[' || (c_custkey + 1) || ']' AS locator, NULL AS entity, 'UNAPPLIED_TARIFF_TERM' AS code, '' AS field, {WARNED} FROM customer
  UNION ALL SELECT locator || '/PorVolumen[' || i || ']', concat_ws(':', kind, k), 'UNAPPLIED_TARIFF_TERM', '', {WARNED}
  FROM (SELECT *, unnest(range(1, volumes + 1)) AS i FROM {RULES})"""
ORPHANS = (
    "SELECT locator, v_sku AS entity, 'UNKNOWN_PRODUCT_SKU' AS code, '' AS field, 'warn' AS action, 'warning' AS severity FROM exc_kept "
    "WHERE first AND v_sku NOT IN (SELECT v_sku FROM cat_parsed WHERE candidate)"
)
REPEATED = "'EXACT_DUPLICATE' AS code, '' AS field, 'deduplicate' AS action, 'info' AS severity"
ALL = {
    **CATALOGUE, **ORDERS, **STOCK, **SALES, **EXCEPTION,
    "rule_repeats": (
        f"SELECT locator, concat_ws(':', kind, k) AS entity, {REPEATED} FROM (SELECT *, row_number() OVER w = 1 AS first, first_value(v_ratio) OVER w = v_ratio AS same "
        f"FROM {RULES} WHERE problem IS NULL WINDOW w AS (PARTITION BY kind, k ORDER BY ord)) WHERE NOT first AND same"
    ),
    "exception_issues": (
        f"SELECT locator, v_sku AS entity, {REPEATED} FROM exc_kept WHERE NOT first AND same UNION ALL "
        f"SELECT locator, v_sku, 'INVALID_EXCEPTION_PRICE', '', {WARNED} FROM exc_kept WHERE first AND blocked"
    ),
    "created_issues": (
        "SELECT locator, v_sku AS entity, 'HISTORICAL_PRODUCT_CREATED' AS code, '' AS field, 'warn' AS action, 'warning' AS severity FROM ord_final "
        "WHERE outcome = 'accepted' AND CAST(substr(v_sku, 5) AS BIGINT) % 7 = 0 QUALIFY row_number() OVER (PARTITION BY v_sku ORDER BY v_id, ord) = 1"
    ),
    "ledger_rows": (
        f"SELECT 'catalog_csv' AS source, CAST(ord AS VARCHAR) AS locator, entity, {ISSUE} FROM cat_ledger "
        f"UNION ALL SELECT 'orders_csv', locator, entity, {ISSUE} FROM ord_ledger "
        f"UNION ALL SELECT 'stock_api', locator, entity, {ISSUE} FROM st_ledger UNION ALL SELECT 'stock_api', locator, entity, {ISSUE} FROM st_extra "
        f"UNION ALL SELECT 'tariffs_xml', locator, entity, {ISSUE} FROM rule_repeats UNION ALL SELECT 'tariffs_xml', locator, entity, {ISSUE} FROM exception_issues "
        f"UNION ALL SELECT 'tariffs_xml', locator, entity, {ISSUE} FROM ({TERMS}) UNION ALL SELECT 'tariffs_xml', locator, entity, {ISSUE} FROM ({ORPHANS}) "
        f"UNION ALL SELECT 'orders_csv', locator, entity, {ISSUE} FROM created_issues"
    ),
}
ORACLE["issue_ledger"] = b.with_ctes(ALL, (
    "SELECT source, locator AS record_locator, entity AS entity_key, code AS reason_code, field AS field_name, action, severity FROM ledger_rows"
))
ORACLE["severity_assignment"] = b.with_ctes(ALL, f"SELECT source, action, code AS reason_code, severity, {long('count(*)', 'n')} FROM ledger_rows GROUP BY ALL")


def excerpt(columns, limit=None):
    return [f"CAST(to_json({f'left({c}, {limit})' if limit else c}) AS VARCHAR)" for c in columns]


CELL_LIST = "'[' || array_to_string(list_slice([" + ", ".join(excerpt(CATALOGUE_COLUMNS)) + "], 1, n_cells), ', ') || ']'"
STOCK_SHOWN = ["sku", "warehouse", "quantity", "reserved", "updated_at"]
STOCK_MAP = "'{' || " + " || ', ' || ".join(f"'\"{c}\": ' || coalesce({e}, 'null')" for c, e in zip(STOCK_SHOWN, excerpt(STOCK_SHOWN, 70))) + " || '}'"
SHOWN = [c for c in ORDER_COLUMNS if c != "cliente"]
ORDER_MAP = "'{' || " + " || ', ' || ".join(f"'\"{c}\": ' || {e}" for c, e in zip(SHOWN, excerpt(SHOWN, 100))) + " || '}'"


def place(section: str, tag: str) -> str:
    """Locator of an element in its document of five hundred."""
    return f"'/TarifasProveedor/{section}/{tag}[' || row_number() OVER (PARTITION BY ord // 500 ORDER BY ord) || ']' AS locator"


VOLUME = """'<PorVolumen desdeUnidades="' || i * 10 || '">' || i || '&amp;</PorVolumen>'"""
RULE_ELEMENTS = f"""SELECT {place('Descuentos', 'Descuento')}, range(1, ord % 15 + 2) AS terms, '<Descuento tipo="' || kind || '" valor="'
  || replace(replace(label, '&', '&amp;'), '"', '&quot;') || ' &lt;&amp;&quot;ñ"><PorcentajeBase>' || base_text || '</PorcentajeBase>'
  || array_to_string(list_transform(range(1, ord % 15 + 2), lambda i: {VOLUME}), '') || '</Descuento>' AS element FROM {RULE_TEXTS}"""
TARIFF_ELEMENTS = f"""
  SELECT locator, element FROM ({RULE_ELEMENTS}) UNION ALL
  SELECT locator || '/PorVolumen[' || i || ']', {VOLUME} FROM (SELECT locator, unnest(terms) AS i FROM ({RULE_ELEMENTS})) UNION ALL
  SELECT {place('Excepciones', 'Producto')}, '<Producto sku="' || sku || '"' || CASE WHEN price_text IS NULL AND flag_text IS NULL THEN ' />' ELSE
    '>' || coalesce('<PrecioNetoAcordado>' || price_text || '</PrecioNetoAcordado>', '')
    || coalesce('<AplicaDescuentoAdicional>' || flag_text || '</AplicaDescuentoAdicional>', '') || '</Producto>' END FROM {EXCEPTION_TEXTS} UNION ALL
  SELECT {place('Condiciones', '*')}, '<Plazo cliente="' || c_name || '">60 días</Plazo>' FROM (SELECT c_custkey AS ord, c_name FROM customer)"""
ORACLE["bounded_excerpt"] = (
    f"SELECT source, locator, excerpt, {small('length(excerpt)', 'n_chars')} FROM ("
    f"SELECT 'catalog_csv' AS source, CAST(ord AS VARCHAR) AS locator, left({CELL_LIST}, 512) AS excerpt FROM {CATALOGUE_TEXTS} UNION ALL "
    f"SELECT 'orders_csv', locator, left(CASE WHEN n_cells = 9 THEN {ORDER_MAP} ELSE '{{\"column_count\": ' || n_cells || '}}' END, 512) FROM {ORDER_TEXTS} UNION ALL "
    f"SELECT 'stock_api', 'page:' || page || '/row:' || (i + 1), CASE WHEN i % 11 = 4 THEN 'Tipo de registro inválido: list' ELSE left({STOCK_MAP}, 512) END FROM ("
    "SELECT * REPLACE (CASE WHEN i % 11 = 3 AND warehouse IS NOT NULL THEN '[tipo inválido]' ELSE warehouse END AS warehouse, "
    "CASE WHEN i % 11 = 2 AND reserved IS NOT NULL THEN 'True' ELSE reserved END AS reserved, "
    "CASE WHEN NOT regexp_full_match(quantity, '[0-9]+') THEN quantity WHEN i % 11 = 1 THEN quantity || '.0' "
    "WHEN i % 11 = 5 THEN left(quantity, 1) || CASE WHEN length(quantity) > 1 THEN '.' || substr(quantity, 2) ELSE '' END || 'E+' || (length(quantity) + 2) "
    "ELSE quantity END AS quantity) FROM (SELECT *, ord // 100 + 1 AS page, row_number() OVER (PARTITION BY ord // 100 ORDER BY ord) - 1 AS i "
    f"FROM {STOCK_TEXTS} WHERE ord % 2 = 0)) UNION ALL "
    f"SELECT 'tariffs_xml', locator, left(element, 512) FROM ({TARIFF_ELEMENTS}))"
)

# --- tariffs
ORACLE["tariff_rule_validate"] = f"SELECT ord, kind, k AS key, {real('v_ratio', 'ratio')}, problem FROM {RULES}"
REPEATS = "row_number() OVER w > 1"
ORACLE["tariff_rule_dedup"] = f"""
  WITH r AS (SELECT * FROM {RULES}), m AS (SELECT ord, row_number() OVER w = 1 AS first, first_value(v_ratio) OVER w = v_ratio AS same FROM r WHERE problem IS NULL
    WINDOW w AS (PARTITION BY kind, k ORDER BY ord))
  SELECT r.ord, coalesce(m.first, false) AS kept, coalesce(problem, CASE WHEN NOT first AND NOT same THEN 'CONFLICTING_TARIFF' END) AS problem,
    CASE WHEN NOT first AND same THEN 'EXACT_DUPLICATE' END AS issue FROM r LEFT JOIN m USING (ord)"""
ORACLE["tariff_exception_validate"] = b.with_ctes(EXCEPTION, f"SELECT ord, v_sku AS sku, {real('agreed', 'agreed_price')}, blocked, problem FROM exc_parsed")
ORACLE["tariff_exception_dedup"] = b.with_ctes(EXCEPTION, (
    "SELECT p.ord, coalesce(k.first, false) AS kept, coalesce(p.problem, CASE WHEN NOT k.first AND NOT k.same THEN 'CONFLICTING_TARIFF' END) AS problem, "
    "CASE WHEN k.first AND k.blocked THEN 'INVALID_EXCEPTION_PRICE' WHEN NOT k.first AND k.same THEN 'EXACT_DUPLICATE' END AS issue "
    "FROM exc_parsed p LEFT JOIN exc_kept k USING (ord)"
))
ORACLE["unapplied_terms"] = TERMS
ORACLE["orphan_exceptions"] = b.with_ctes({**CATALOGUE, **EXCEPTION}, ORPHANS)

# --- pricing and candidate selection
ORACLE["price_by_exception"] = b.with_ctes(CATALOGUE, f"SELECT ord, has_exception, {real('agreed', 'agreed_price')} FROM cat_quoted WHERE candidate")
ORACLE["price_by_discounts"] = b.with_ctes(CATALOGUE, f"""
  SELECT ord, {real('c_ratio', 'category_discount')}, {real('b_ratio', 'brand_discount')}, {real("CASE WHEN p IS NULL THEN discounted END", 'discounted_cost')}, p AS discount_problem
  FROM (SELECT *, CASE WHEN v_cost IS NULL THEN v_cost_problem WHEN c_ratio + b_ratio >= 1 OR discounted <= 0 THEN 'NON_POSITIVE_PRICE' END AS p FROM cat_quoted WHERE candidate)""")
ORACLE["cost_exceeds_pvp"] = b.with_ctes(CATALOGUE, (
    f"SELECT ord, {real('net_cost')}, {real('v_pvp', 'pvp')}, CASE WHEN has_exception THEN 'exception' ELSE 'base_with_discounts' END AS price_origin "
    "FROM cat_judged WHERE candidate AND verdict = 'COST_EXCEEDS_PVP'"
))
ORACLE["rescued_cost_audit"] = b.with_ctes(CATALOGUE, f"SELECT ord, entity, {ISSUE} FROM cat_ledger WHERE action = 'drop_field' AND field = 'precio_coste'")
ORACLE["select_first_valid_candidate"] = b.with_ctes(CATALOGUE, (
    f"SELECT ord, outcome, {real('CASE WHEN candidate THEN net_cost END', 'net_cost')}, {small('coalesce(n, 0)', 'n_issues')} FROM cat_chosen "
    "LEFT JOIN (SELECT ord, count(*) AS n FROM cat_ledger GROUP BY ord) USING (ord)"
))
SAME_CELLS = " AND ".join(f"p.{c} = w.{c}" for c in CATALOGUE_COLUMNS)
ORACLE["pluggable_row_verdict"] = b.with_ctes(CATALOGUE, f"""
  SELECT p.ord, CASE WHEN NOT p.candidate OR contains(p.v_name, 'red') THEN 'rejected' WHEN p.ord = w.ord THEN 'accepted'
    WHEN {SAME_CELLS} THEN 'deduplicated' ELSE 'rejected' END AS outcome
  FROM cat_parsed p LEFT JOIN (SELECT * FROM cat_parsed WHERE candidate AND NOT contains(v_name, 'red') QUALIFY row_number() OVER (PARTITION BY v_sku ORDER BY ord) = 1) w
  ON w.v_sku = p.v_sku""")

# --- orders
ORACLE["group_orders"] = b.with_ctes(ORDERS, f"SELECT order_id, {long('n_rows', 'n_rows')} FROM ord_headers")
ORACLE["resolve_order_header"] = b.with_ctes(ORDERS, """
  SELECT locator, header_ok, CASE WHEN header_ok THEN CAST(order_date AS VARCHAR) END AS order_date, CASE WHEN header_ok THEN channel END AS channel,
    CASE WHEN header_ok THEN status END AS status, coalesce(errors, '') AS errors
  FROM ord_joined LEFT JOIN (SELECT order_id, string_agg(code || ':' || field, ' ' ORDER BY code, field) AS errors FROM ord_errors GROUP BY order_id) e ON e.order_id = v_id WHERE grouped""")
ORACLE["inherit_header_values"] = b.with_ctes(ORDERS, f"SELECT locator, {ISSUE} FROM ord_ledger WHERE code = 'HEADER_VALUE_INHERITED'")
ORACLE["customer_first_spelling"] = b.with_ctes(ORDERS, "SELECT order_id, customer FROM ord_headers WHERE order_id NOT IN (SELECT order_id FROM ord_errors)")
ORACLE["line_signature"] = b.with_ctes(ORDERS, "SELECT locator, line_key FROM ord_checked WHERE line_ok")
ORACLE["dedup_order_lines"] = b.with_ctes(ORDERS, "SELECT locator, outcome, CASE WHEN outcome = 'deduplicated' THEN 'Conservada fila ' || kept END AS detail FROM ord_final")
ORACLE["partial_order_flag"] = b.with_ctes(ORDERS, (
    "SELECT order_id AS source_order_id, CAST(order_date AS VARCHAR) AS order_date, customer, channel, status, partial AS has_rejected_lines FROM ord_loaded"
))

# --- stock
ORACLE["stock_exact_dedup"] = b.with_ctes(STOCK, f"SELECT locator, {ISSUE} FROM st_ledger WHERE code = 'EXACT_DUPLICATE'")
ORACLE["stock_conflicts"] = b.with_ctes(STOCK, (
    f"SELECT locator, entity, {ISSUE} FROM st_ledger WHERE code = 'CONFLICTING_STOCK' UNION ALL SELECT locator, entity, {ISSUE} FROM st_extra WHERE code = 'CONFLICTING_STOCK'"
))
ORACLE["stock_latest_version"] = b.with_ctes(STOCK, "SELECT locator, outcome FROM st_final")
ORACLE["stock_totals"] = b.with_ctes(STOCK, f"SELECT sku, stock_total, stock_status, {stamp('stock_as_of')} AS stock_as_of FROM st_totals")
HUGE = b.stock_ctes(
    f"SELECT * REPLACE (CASE WHEN ord % 4 = 0 THEN '{2**62}' ELSE '{2**63 - 1}' END AS quantity) FROM {STOCK_TEXTS}"
)
ORACLE["stock_overflow"] = b.with_ctes(HUGE, "SELECT sku, stock_total, stock_status, overflow FROM st_totals")

# --- merges and publishing
MERGE = {
    "m_previous": (
        "SELECT p_partkey * 3 + 1000 AS id, 'PRV-' || p_partkey AS sku, CASE WHEN p_partkey % 3 <> 0 THEN 'old ' || p_name END AS name, "
        "CASE WHEN p_partkey % 3 <> 0 THEN 1.0 END AS net_cost, p_partkey % 3 <> 0 AS in_catalog, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey END AS stock_total, "
        "CASE WHEN p_partkey % 3 <> 0 THEN 'known' ELSE 'unknown' END AS stock_status FROM part WHERE p_partkey % 7 <> 0"
    ),
    "m_accepted": "SELECT 'PRV-' || p_partkey AS sku, p_name AS name, p_retailprice AS net_cost FROM part WHERE p_partkey % 4 <> 0 OR p_partkey % 28 = 0",
    "m_fresh": (
        "SELECT sku, (SELECT max(id) FROM m_previous) + row_number() OVER (ORDER BY substr(md5(sku), 1, 4), sku) AS id FROM m_accepted "
        "WHERE sku NOT IN (SELECT sku FROM m_previous)"
    ),
    "m_retired": (
        f"SELECT id, sku, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS DOUBLE) AS net_cost, true AS is_historical, false AS in_catalog, CAST(NULL AS BIGINT) AS stock_total, "
        "'unknown' AS stock_status, CASE WHEN in_catalog THEN 'run-2' ELSE 'run-1' END AS last_run_id, in_catalog AS was_current FROM m_previous "
        "WHERE sku NOT IN (SELECT sku FROM m_accepted)"
    ),
}
PRODUCT = "id, sku, name, net_cost, is_historical, in_catalog, stock_total, stock_status, last_run_id"
ORACLE["merge_products"] = b.with_ctes(MERGE, f"""
  SELECT CAST(coalesce(p.id, f.id) AS BIGINT) AS id, a.sku, a.name, {real('a.net_cost', 'net_cost')}, false AS is_historical, true AS in_catalog, CAST(NULL AS BIGINT) AS stock_total,
    'unknown' AS stock_status, 'run-2' AS last_run_id FROM m_accepted a LEFT JOIN m_previous p USING (sku) LEFT JOIN m_fresh f USING (sku)
  UNION ALL SELECT {PRODUCT} FROM m_retired""")
ORACLE["retire_absent_products"] = b.with_ctes(MERGE, f"SELECT {PRODUCT} FROM m_retired WHERE was_current")
ORACLE["create_historical_products"] = b.with_ctes(MERGE, """
  SELECT CAST((SELECT max(id) FROM m_previous) + row_number() OVER (ORDER BY substr(md5(sku), 1, 4), sku) AS BIGINT) AS id, sku, true AS is_historical, false AS in_catalog, 'run-2' AS last_run_id,
    'Histórico creado: SKU ' || CASE WHEN l_partkey % 14 = 0 THEN 'rechazado en catálogo' ELSE 'ausente del catálogo' END || '; pedido PED-' || l_orderkey AS detail,
    l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS locator
  FROM (SELECT *, 'PRV-' || l_partkey AS sku FROM lineitem WHERE l_partkey % 7 = 0
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY 'PED-' || l_orderkey, l_linenumber, l_suppkey) = 1)""")
ORACLE["replace_stock_by_warehouse"] = b.with_ctes(STOCK, (
    f"SELECT CAST(substr(v_sku, 5) AS BIGINT) AS product_id, v_warehouse AS warehouse_code, v_quantity AS quantity, v_reserved AS reserved, {stamp('v_at')} AS updated_at, 'run-2' AS last_run_id "
    "FROM st_final WHERE outcome = 'accepted'"
))
ORACLE["merge_orders"] = b.with_ctes(SALES, """
  SELECT CAST(CASE WHEN id % 9 <> 0 THEN id * 2 + 5000 ELSE (SELECT max(id * 2 + 5000) FROM s_orders WHERE id % 9 <> 0)
    + row_number() OVER (PARTITION BY id % 9 <> 0 ORDER BY substr(md5(source_order_id), 1, 4), source_order_id) END AS BIGINT) AS id,
    source_order_id, CAST(order_date AS VARCHAR) AS order_date, channel, status, partial AS has_rejected_lines, 'run-2' AS last_run_id
  FROM s_orders WHERE id % 10 <> 1 OR id % 9 = 0""")
ORACLE["merge_order_lines"] = f"""
  WITH l AS (SELECT *, md5(concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS line_key FROM lineitem),
  k AS (SELECT *, substr(line_key, 2, 1) <> '0' AS known, l_partkey * 1000000000 + l_orderkey * 1000 + l_suppkey * 10 + l_linenumber AS old_id FROM l)
  SELECT CAST(CASE WHEN known THEN old_id ELSE (SELECT max(old_id) FROM k WHERE known)
    + row_number() OVER (PARTITION BY known ORDER BY substr(md5(l_orderkey || chr(31) || line_key), 1, 4), l_orderkey, line_key) END AS BIGINT) AS id,
    l_orderkey AS order_id, l_partkey AS product_id, line_key, CAST(l_quantity AS BIGINT) AS quantity, {real('CAST(l_discount AS DECIMAL(9,6))', 'discount')}, 'new' AS source_locator
  FROM k WHERE substr(line_key, 1, 1) <> '0'"""


def checksum(columns: str) -> str:
    return f"{long('count(*)', 'n_rows')}, {real(f'sum(CAST({chr(39)}0x{chr(39)} || substr(md5(concat_ws({chr(39)}|{chr(39)}, {columns})), 1, 8) AS BIGINT))', 'checksum')}"


ORACLE["publish_snapshot"] = b.with_ctes(SALES, (
    f"SELECT {checksum('id, source_order_id, order_date, channel, status, CAST(partial AS VARCHAR)')}, 'run-1' AS current_run FROM s_orders"
))
RUN_STATUS = "CASE WHEN event_type IN ('click', 'purchase') THEN 'completed' WHEN event_type = 'error' THEN 'failed' ELSE 'running' END"
ORACLE["run_log"] = (
    f"SELECT CAST(user_id AS VARCHAR) AS run_id, arg_max({RUN_STATUS}, ts) AS status, arg_max(event_id, ts) AS counters FROM events GROUP BY user_id"
)
FINGERPRINT = checksum("id, sku, coalesce(name, '~'), coalesce(category_key, '~'), coalesce(CAST(net_cost AS VARCHAR), '~'), stock_status, coalesce(CAST(stock_total AS VARCHAR), '~')")
ORACLE["idempotence_fingerprint"] = b.with_ctes(SALES, (
    f"SELECT {FINGERPRINT}, {small('1', 'load')} FROM s_products UNION ALL SELECT {FINGERPRINT}, {small('2', 'load')} FROM s_products"
))

# --- sales analytics
MONEY = "CAST(coalesce(sum(amount), 0) AS DECIMAL(38,2))"
SUMMARY = (
    "SELECT revenue, orders, partial_orders, CASE WHEN orders > 0 THEN CAST((2 * CAST(revenue * 100 AS HUGEINT) + orders) // (2 * orders) AS DOUBLE) / 100 END AS ticket "
    f"FROM (SELECT {MONEY} AS revenue, count(DISTINCT order_id) AS orders, count(DISTINCT order_id) FILTER (WHERE partial) AS partial_orders FROM eligible {{where}})"
)
SHOW = f"SELECT {real('revenue')}, orders, partial_orders, ticket AS average_ticket FROM ({{summary}})"
LAST_MONTH = "WHERE order_date >= DATE '2001-05-01' AND order_date < DATE '2001-06-01'"
UNITS = long("coalesce(sum(quantity), 0)", "units")


def sales(sql: str) -> str:
    return b.with_ctes(SALES, sql)


ORACLE["eligible_lines"] = sales((
    f"SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, channel, partial AS has_rejected_lines, sku, category_key, quantity, {real('net_cost')}, {real('amount')} FROM eligible"
))
ORACLE["sales_summary"] = sales(SHOW.format(summary=SUMMARY.format(where="")))
ORACLE["previous_month_sales"] = sales(SHOW.format(summary=SUMMARY.format(where=LAST_MONTH)))
SPINE = f"(SELECT CAST(unnest(generate_series(DATE '{samples.START}', DATE '2001-06-01', INTERVAL 1 MONTH)) AS DATE) AS month)"
BY_MONTH = f"SELECT month, {MONEY} AS revenue, {UNITS} FROM {SPINE} LEFT JOIN eligible ON date_trunc('month', order_date) = month GROUP BY month"
ORACLE["monthly_sales"] = sales(f"SELECT CAST(month AS VARCHAR) AS month, {real('revenue')}, units, month = DATE '2001-06-01' AS is_partial FROM ({BY_MONTH})")
RATIO = "CAST((2 * 10000 * CAST(revenue * 100 AS HUGEINT) + CAST(before * 100 AS HUGEINT)) // (2 * CAST(before * 100 AS HUGEINT)) AS DOUBLE) / 10000"
ORACLE["monthly_year_on_year"] = sales(f"""
  SELECT CAST(m.month AS VARCHAR) AS month, {real('revenue')}, units, month = DATE '2001-06-01' AS is_partial, {real('before', 'revenue_year_before')},
    units_before AS units_year_before, CASE WHEN before > 0 THEN {RATIO} END AS revenue_ratio
  FROM ({BY_MONTH}) m LEFT JOIN (SELECT month + INTERVAL 12 MONTH AS later, revenue AS before, units AS units_before FROM ({BY_MONTH})) y ON y.later = m.month""")
BY_CHANNEL = f"SELECT c.channel, {MONEY} AS revenue, {UNITS} FROM (VALUES ('B2B'), ('B2C'), ('marketplace')) c(channel) LEFT JOIN eligible e ON e.channel = c.channel GROUP BY c.channel"
ORACLE["sales_by_channel"] = sales(f"SELECT channel, {real('revenue')}, units FROM ({BY_CHANNEL})")
BY_CATEGORY = f"SELECT category_key, coalesce(max(category), 'Sin categoría') AS label, {MONEY} AS revenue, {UNITS} FROM eligible GROUP BY category_key"
ORACLE["sales_by_category"] = sales(f"SELECT category_key, label, {real('revenue')}, units FROM ({BY_CATEGORY})")
ORACLE["top_products"] = sales((
    f"SELECT sku, name, is_historical, {real('revenue')}, units FROM (SELECT sku, name, is_historical, {MONEY} AS revenue, {UNITS} FROM eligible GROUP BY ALL ORDER BY revenue DESC, sku LIMIT 10)"
))
MARGIN = (
    "SELECT CAST(coalesce(sum(amount - cost), 0) AS DECIMAL(38,2)) AS known_margin, CAST(coalesce(sum(amount) FILTER (WHERE net_cost IS NOT NULL), 0) AS DECIMAL(38,2)) AS known_revenue, "
    "CAST(coalesce(sum(amount) FILTER (WHERE net_cost IS NULL), 0) AS DECIMAL(38,2)) AS unknown_revenue FROM eligible"
)
KNOWN, TOTAL = "CAST(known_revenue * 100 AS HUGEINT)", "CAST((known_revenue + unknown_revenue) * 100 AS HUGEINT)"
ORACLE["margin_summary"] = sales((
    f"SELECT {real('known_margin')}, {real('known_revenue')}, {real('unknown_revenue')}, CAST((2 * 10000 * {KNOWN} + {TOTAL}) // (2 * {TOTAL}) AS DOUBLE) / 10000 AS coverage FROM ({MARGIN})"
))
LOW = (
    "SELECT p.sku, p.name, p.stock_total, CAST(sum(e.quantity) AS BIGINT) AS recent_units FROM s_products p JOIN eligible e ON e.product_id = p.id "
    "WHERE p.in_catalog AND p.stock_status = 'known' AND p.stock_total < 5 AND e.order_date >= DATE '2001-03-30' GROUP BY ALL"
)
ORACLE["low_stock_products"] = sales(LOW)
ORACLE["trailing_months_filter"] = sales((
    f"SELECT CAST(order_date AS VARCHAR) AS order_date, {long('count(*)', 'n')} FROM s_orders WHERE order_date >= DATE '2001-02-28' GROUP BY order_date"
))
ORACLE["sku_contribution_review"] = sales((
    f"SELECT p.sku, {real('p.net_cost', 'base_cost')}, {real('p.net_cost', 'net_cost')}, {real('p.pvp', 'pvp')}, CASE WHEN p.in_catalog THEN 'base_with_discounts' END AS price_origin, "
    f"{real('coalesce(r, 0)', 'revenue')}, {real('CASE WHEN p.net_cost IS NOT NULL THEN coalesce(m, 0) END', 'known_margin')} FROM s_products p "
    "LEFT JOIN (SELECT product_id, sum(amount) AS r, sum(amount - cost) AS m FROM eligible GROUP BY product_id) e ON e.product_id = p.id"
))
ORACLE["independent_recalculation"] = sales(f"""
  SELECT metric, "check", {real('value')}, {real('value', 'rebuilt')}, true AS matches FROM (
    SELECT 'revenue' AS metric, unnest(['summary', 'monthly', 'channel', 'category']) AS "check", CAST(sum(amount) AS DECIMAL(38,2)) AS value FROM eligible
    UNION ALL SELECT 'orders', 'summary', CAST(count(DISTINCT order_id) AS DECIMAL(38,2)) FROM eligible
    UNION ALL SELECT 'known_margin', 'margin', known_margin FROM ({MARGIN}) UNION ALL SELECT 'known_revenue', 'margin', known_revenue FROM ({MARGIN})
    UNION ALL SELECT 'unknown_revenue', 'margin', unknown_revenue FROM ({MARGIN}))""")

# --- browsing and reporting
FOUND = "in_catalog AND (contains(strip_accents(lower(sku)), '{0}') OR contains(strip_accents(lower(name)), '{0}') OR contains(strip_accents(lower(description)), '{0}'))"
ORACLE["catalog_search"] = sales(f"SELECT sku, name FROM s_products WHERE {FOUND.format('widget nandu')}")
ORACLE["catalog_category_filter"] = sales("SELECT sku, 'promo' AS asked FROM s_products WHERE category_key = 'promo'")
ORACLE["catalog_page"] = sales(f"""
  SELECT sku, name, category, {real('net_cost')}, {real('pvp')}, stock_total, stock_status, {small('total', 'total')}, {small('page', 'page')}, {small('pages', 'pages')}
  FROM (SELECT *, least(greatest(3, 1), pages) AS page FROM (SELECT *, row_number() OVER (ORDER BY sku) AS n, count(*) OVER () AS total, greatest(1, (count(*) OVER () + 19) // 20) AS pages
    FROM s_products WHERE category_key = 'large' AND {FOUND.format('ring')})) WHERE n > (page - 1) * 20 AND n <= page * 20""")
ORACLE["catalog_categories"] = sales("SELECT category_key, max(category) AS label FROM s_products WHERE in_catalog GROUP BY category_key")
ORACLE["latest_publication"] = (
    f"SELECT CAST(user_id AS VARCHAR) AS run_id, {stamp('ts')} AS finished_at, event_id AS counters FROM events WHERE event_type IN ('click', 'purchase') ORDER BY ts DESC, user_id DESC LIMIT 1"
)
ORACLE["conflicting_skus"] = b.with_ctes({**CATALOGUE, **SALES}, (
    "SELECT DISTINCT entity AS sku FROM cat_ledger WHERE code = 'CONFLICTING_PRODUCT_SKU' AND entity IN (SELECT sku FROM s_products WHERE in_catalog)"
))


def outcomes(source: str) -> str:
    return (
        f"(SELECT count(*) FROM {source}) AS rows_read, (SELECT count(*) FROM {source} WHERE outcome = 'accepted') AS rows_accepted, "
        f"(SELECT count(*) FROM {source} WHERE outcome = 'rejected') AS rows_rejected, (SELECT count(*) FROM {source} WHERE outcome = 'deduplicated') AS rows_deduplicated"
    )


COUNTED = ALL
CATALOGUE_COUNTS = (
    f"SELECT {outcomes('cat_chosen')}, (SELECT count(*) FROM exc_kept WHERE first AND blocked) AS quality_warnings, "
    "(SELECT count(*) FROM cat_ledger WHERE action = 'drop_field') AS discarded_fields, (SELECT count(*) FROM cat_chosen WHERE outcome = 'accepted') AS products_loaded"
)
CREATED = "(SELECT count(DISTINCT v_sku) FROM ord_final WHERE outcome = 'accepted' AND CAST(substr(v_sku, 5) AS BIGINT) % 7 = 0)"
ORDER_COUNTS = (
    f"SELECT {outcomes('ord_final')}, (SELECT count(*) FROM ord_ledger WHERE action = 'warn') + {CREATED} AS quality_warnings, {long('0', 'discarded_fields')}, "
    f"(SELECT count(*) FROM ord_loaded) AS orders_loaded, (SELECT count(*) FROM ord_loaded WHERE partial) AS partial_orders, {CREATED} AS historical_products_created"
)
STOCK_COUNTS = (
    f"SELECT {outcomes('st_final')}, (SELECT count(*) FROM st_ledger WHERE action = 'warn') + (SELECT count(*) FROM st_extra) AS quality_warnings, {long('0', 'discarded_fields')}"
)
ORACLE["catalog_counters"] = b.with_ctes(COUNTED, CATALOGUE_COUNTS)
ORACLE["orders_counters"] = b.with_ctes(COUNTED, ORDER_COUNTS)
ORACLE["stock_counters"] = b.with_ctes(COUNTED, STOCK_COUNTS)
ORACLE["reconcile_counters"] = " UNION ALL ".join(
    f"SELECT '{name}' AS source, count(*) AS rows_read, true AS reconciles FROM {texts}"
    for name, texts in (("catalog_csv", CATALOGUE_TEXTS), ("orders_csv", ORDER_TEXTS), ("stock_api", STOCK_TEXTS))
)
ORACLE["rejections_by_reason"] = b.with_ctes(ALL, (
    "SELECT source, code AS reason_code, count(DISTINCT locator) AS rows FROM ledger_rows WHERE action = 'reject_row' GROUP BY ALL"
))
ORACLE["missing_order_reasons"] = b.with_ctes(ORDERS, (
    "SELECT entity AS source_order_id, string_agg(DISTINCT code, ' ' ORDER BY code) AS reasons FROM ord_ledger "
    "WHERE entity IS NOT NULL AND entity NOT IN (SELECT order_id FROM ord_loaded) GROUP BY entity"
))
REJECTED = "(SELECT count(*) FROM cat_chosen WHERE outcome = 'rejected') + (SELECT count(*) FROM ord_final WHERE outcome = 'rejected') + (SELECT count(*) FROM st_final WHERE outcome = 'rejected')"
ORACLE["run_summary"] = b.with_ctes(COUNTED, f"""
  SELECT 'etl-summary-v2' AS schema_version, 'run-2' AS run_id, '2001-06-30' AS as_of, (SELECT count(*) FROM cat_chosen WHERE outcome = 'accepted') AS products_loaded,
    {REJECTED} AS rows_rejected, (SELECT CAST({MONEY} AS VARCHAR) FROM eligible {LAST_MONTH}) AS revenue_previous_month, '2001-05' AS previous_month,
    {long(f'(SELECT count(*) FROM ({LOW}))', 'low_stock_count')}, {small('100', 'rejection_threshold')}, {REJECTED} > 100 OR EXISTS ({LOW}) AS alert_required,
    {small("(SELECT count(DISTINCT source || code) FROM ledger_rows WHERE action = 'reject_row')", 'n_reasons')},
    (SELECT count(*) FROM ord_loaded) AS orders_loaded""")
ORACLE["alert_required"] = (
    "SELECT day, rejected, low_stock, rejected > 66 OR low_stock > 0 AS alert FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) FILTER (WHERE event_type = 'error') AS rejected, "
    "count(*) FILTER (WHERE event_type = 'purchase' AND value > 300) AS low_stock FROM events GROUP BY 1)"
)
ORACLE["run_history_append"] = "SELECT CAST(event_id AS VARCHAR) AS run_id, event_id % 3 <> 0 AS appended FROM events WHERE value > 40 AND event_id % 2 = 1"
ORACLE["chart_series"] = sales(f"SELECT CAST(month AS VARCHAR) AS month, strftime(month, '%m/%Y') AS label, CAST(revenue AS VARCHAR) AS revenue, units FROM ({BY_MONTH})")

# --- integrity
INTEGRITY = {
    **SALES,
    "c_runs": "SELECT 'run-1' AS run_id",
    "c_lines": (
        "SELECT CASE WHEN l_partkey % 97 = 5 THEN -l_orderkey - 1 ELSE l_orderkey END AS order_id, CASE WHEN l_orderkey % 89 = 3 THEN -l_partkey - 1 ELSE l_partkey END AS product_id, "
        "l_linenumber || '-' || (l_suppkey % 50) AS line_key, CASE WHEN l_partkey % 101 = 1 THEN 0 WHEN l_partkey % 103 = 1 THEN -l_quantity ELSE l_quantity END AS quantity, "
        "CASE WHEN l_partkey % 107 = 1 THEN 0 ELSE 1 END AS unit_price, CASE WHEN l_partkey % 109 = 1 THEN 2 ELSE 0 END AS discount FROM lineitem"
    ),
    "c_products": (
        "SELECT * REPLACE (CASE WHEN id % 211 = 3 THEN 'PRV-1' ELSE sku END AS sku, CASE WHEN id % 239 <> 3 THEN name END AS name, CASE WHEN id % 241 = 3 THEN 7 ELSE stock_total END AS stock_total), "
        "CASE WHEN id % 223 = 3 THEN -1 ELSE net_cost END AS base_cost, CASE WHEN id % 227 = 3 THEN 2 ELSE 0 END AS tax_rate, CASE WHEN id % 229 = 3 THEN -1 END AS brand_discount, "
        "CASE WHEN id % 233 = 3 THEN -1 END AS weight_kg, in_catalog AND id % 7 > 1 AS dated FROM s_products"
    ),
    "c_orders": (
        "SELECT * REPLACE (CASE WHEN id % 251 = 3 THEN 'PED-1' ELSE source_order_id END AS source_order_id, CASE WHEN id % 257 = 3 THEN 'web' ELSE channel END AS channel, "
        "CASE WHEN id % 263 = 3 THEN 'RARO' WHEN id % 5 = 4 THEN 'DEVUELTO' ELSE status END AS status) FROM s_orders"
    ),
    "c_stock": "SELECT user_id AS product_id, event_type || '-' || (event_id % 8) AS warehouse_code, event_id % 3 AS quantity, event_id FROM events",
    "c_ledger": (
        "SELECT CASE WHEN event_id % 100 < 2 THEN event_id // 2 ELSE event_id END AS locator, event_id % 269 = 3 AS bad_action, event_id % 271 = 3 AS bad_severity FROM events"
    ),
}


def violations(checks: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{name}' AS \"check\", count(*) AS violations FROM {rows}" for name, rows in checks.items())
    return b.with_ctes(INTEGRITY, rows)


def repeated(source: str, key: str) -> str:
    return f"(SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)"


ORACLE["fk_check"] = violations({
    "lines.order": "c_lines WHERE order_id NOT IN (SELECT id FROM c_orders)",
    "lines.product": "c_lines WHERE product_id NOT IN (SELECT id FROM c_products)",
    "stock.product": "c_stock WHERE product_id NOT IN (SELECT id FROM c_products WHERE in_catalog)",
    "orders.lines": "c_orders WHERE id NOT IN (SELECT order_id FROM c_lines)",
    "products.run": "c_products WHERE id % 503 = 7",
    "orders.run": "c_orders WHERE id % 503 = 7",
    "lines.run": "c_lines WHERE product_id % 503 = 7",
    "stock.run": "c_stock WHERE event_id % 503 = 7",
})
ORACLE["unique_check"] = violations({
    "products.key": repeated("c_products", "sku"),
    "orders.key": repeated("c_orders", "source_order_id"),
    "lines.key": repeated("c_lines", "order_id, line_key"),
    "stock.key": repeated("c_stock", "product_id, warehouse_code"),
    "ledger.key": repeated("c_ledger", "locator"),
})
ORACLE["domain_check"] = violations({
    "products.base_cost": "c_products WHERE base_cost <= 0",
    "products.net_cost": "c_products WHERE net_cost <= 0",
    "products.pvp": "c_products WHERE pvp <= 0",
    "products.tax_rate": "c_products WHERE tax_rate NOT BETWEEN 0 AND 1",
    "products.category_discount": "c_products WHERE false",
    "products.brand_discount": "c_products WHERE brand_discount NOT BETWEEN 0 AND 1",
    "products.weight_kg": "c_products WHERE weight_kg < 0",
    "orders.channel": "c_orders WHERE channel NOT IN ('B2B', 'B2C', 'marketplace')",
    "orders.status": "c_orders WHERE status = 'RARO'",
    "lines.quantity": "c_lines WHERE quantity = 0",
    "lines.unit_price": "c_lines WHERE unit_price <= 0",
    "lines.discount": "c_lines WHERE discount NOT BETWEEN 0 AND 1",
    "lines.returned": "c_lines JOIN c_orders ON id = order_id WHERE quantity < 0 AND status <> 'DEVUELTO'",
    "ledger.action": "c_ledger WHERE bad_action",
    "ledger.severity": "c_ledger WHERE bad_severity",
})
ORACLE["state_check"] = violations({
    "products.state": "c_products WHERE NOT CASE WHEN in_catalog THEN name IS NOT NULL AND brand IS NOT NULL AND net_cost > 0 AND pvp > 0 ELSE base_cost IS NULL AND stock_total IS NULL END",
    "products.stock_state": "c_products WHERE NOT CASE stock_status WHEN 'known' THEN stock_total >= 0 AND dated ELSE stock_total IS NULL AND NOT dated END",
})
ORACLE["stock_total_check"] = violations({
    "products.stock_total": "s_products p LEFT JOIN (SELECT product_id, sum(quantity) AS q FROM c_stock GROUP BY product_id) s ON s.product_id = p.id "
    "WHERE p.stock_status = 'known' AND q IS DISTINCT FROM stock_total",
})
CHECKED = {
    "rows_accepted": "(SELECT count(*) FROM ord_final WHERE outcome = 'accepted')",
    "rows_rejected": "(SELECT count(*) FROM ord_final WHERE outcome = 'rejected')",
    "rows_deduplicated": "(SELECT count(*) FROM ord_final WHERE outcome = 'deduplicated')",
    "quality_warnings": "(SELECT count(*) FROM ord_ledger WHERE action = 'warn')",
    "discarded_fields": "0",
    "orders_loaded": "(SELECT count(*) FROM ord_loaded)",
    "partial_orders": "(SELECT count(*) FROM ord_loaded WHERE partial)",
}
ORACLE["ledger_counter_check"] = b.with_ctes(ORDERS, " UNION ALL ".join(
    f"SELECT 'orders_csv' AS source, '{name}' AS counter, {long(count, 'value')}, {long(count, 'found')}, true AS matches" for name, count in CHECKED.items()
))
