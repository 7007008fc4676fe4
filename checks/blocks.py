"""Building blocks of the DuckDB SQL the query results are checked against.

Written apart from the Spark code: plain SQL over the given tables, parsing included. A source is any text
that may stand after FROM; the ``p_*`` blocks add a value column and a ``_code`` column to it.
"""

from __future__ import annotations

from lonja.functions.text import BLANKS
from lonja.plans import samples
from lonja.plans.samples import DUCK

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def over_tables(sql: str) -> str:
    for name in TABLES:
        sql = sql.replace("{" + name + "}", name)
    return sql


def add(source: str, **columns: str) -> str:
    listed = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"(SELECT *, {listed} FROM {source})"


def trimmed(x: str) -> str:
    return f"trim({x}, '{BLANKS}')"


def present(x: str) -> str:
    return f"CASE WHEN lower({trimmed(x)}) NOT IN ('', 'n/d', 'null', '-', 'n/a') THEN {trimmed(x)} END"


def clean(x: str) -> str:
    return f"regexp_replace(nfc_normalize({present(x)}), '[{BLANKS}]+', ' ', 'g')"


def key(x: str) -> str:
    return f"lower({clean(x)})"


def full(x: str, pattern: str) -> str:
    return f"regexp_full_match({x}, '{pattern}')"


def p_text(source, column, out):
    s = add(source, **{out: clean(column)})
    return add(s, **{f"{out}_code": f"CASE WHEN {out} IS NULL THEN 'MISSING_REQUIRED_FIELD' END"})


def p_identifier(source, column, out):
    s = add(source, **{f"{out}_t": clean(column)})
    s = add(s, **{f"{out}_code": (
        f"CASE WHEN regexp_matches({column}, '[\\x00-\\x1f\\x7f]') THEN 'INVALID_IDENTIFIER' "
        f"WHEN {out}_t IS NULL THEN 'MISSING_REQUIRED_FIELD' WHEN length({out}_t) > 64 THEN 'INVALID_IDENTIFIER' END"
    )})
    return add(s, **{out: f"CASE WHEN {out}_code IS NULL THEN upper({out}_t) END"})


def p_status(source, column, out):
    s = add(source, **{f"{out}_t": f"upper({clean(column)})"})
    known = f"{out}_t IN ('COMPLETADO', 'ENVIADO', 'PENDIENTE', 'CANCELADO', 'DEVUELTO')"
    return add(s, **{
        out: f"CASE WHEN {known} THEN {out}_t END",
        f"{out}_code": f"CASE WHEN NOT {known} THEN 'UNKNOWN_ORDER_STATUS' END",
    })


def p_channel(source, column, out):
    s = add(source, **{f"{out}_t": key(column)})
    return add(s, **{
        out: f"CASE {out}_t WHEN 'b2b' THEN 'B2B' WHEN 'b2c' THEN 'B2C' WHEN 'marketplace' THEN 'marketplace' END",
        f"{out}_code": f"CASE WHEN {out}_t NOT IN ('b2b', 'b2c', 'marketplace') THEN 'UNKNOWN_CHANNEL' END",
    })


def p_decimal(source, column, out):
    s = add(source, **{f"{out}_t": present(column)})
    s = add(s, **{out: f"CASE WHEN {full(f'{out}_t', '[+-]?[0-9]+([.,][0-9]+)?')} THEN CAST(replace({out}_t, ',', '.') AS DECIMAL(38,10)) END"})
    return add(s, **{f"{out}_code": f"CASE WHEN {out}_t IS NOT NULL AND {out} IS NULL THEN 'INVALID_DECIMAL' END"})


def currency(x: str) -> str:
    head = f"regexp_replace({x}, '^(€|[eE][uU][rR])[{BLANKS}]*', '')"
    return f"regexp_replace({head}, '[{BLANKS}]*(€|[eE][uU][rR])$', '')"


def p_money(source, column, out, is_text=False):
    t = f"{out}_t"
    s = add(source, **{t: f"translate({currency(column if is_text else present(column))}, '  ', '  ')"})
    spaced = full(t, "[+-]?[0-9]{1,3}( [0-9]{3})+([.,][0-9]{1,4})?")
    s = add(s, **{f"{out}_u": f"CASE WHEN NOT contains({t}, ' ') THEN {t} WHEN {spaced} THEN replace({t}, ' ', '') WHEN {t} IS NOT NULL THEN 'bad' END"})
    u = f"{out}_u"
    s = add(s, **{
        f"{out}_commas": f"length({u}) - length(replace({u}, ',', ''))",
        f"{out}_dots": f"length({u}) - length(replace({u}, '.', ''))",
    })
    both = f"{out}_commas > 0 AND {out}_dots > 0"
    s = add(s, **{
        f"{out}_plain": (
            f"CASE WHEN {both} THEN CASE WHEN {full(u, '[+-]?[0-9]{1,3}([.][0-9]{3})+,[0-9]{1,4}')} THEN replace(replace({u}, '.', ''), ',', '.') "
            f"WHEN {full(u, '[+-]?[0-9]{1,3}(,[0-9]{3})+[.][0-9]{1,4}')} THEN replace({u}, ',', '') END "
            f"WHEN {out}_commas + {out}_dots > 1 THEN CASE WHEN {full(u, '[+-]?[0-9]{1,3}([.,][0-9]{3})+')} THEN replace(replace({u}, '.', ''), ',', '') END "
            f"WHEN {out}_commas + {out}_dots = 1 THEN CASE WHEN {full(u, '[+-]?[0-9]+[.,]([0-9]{1,2}|[0-9]{4})')} THEN replace({u}, ',', '.') END "
            f"WHEN {full(u, '[+-]?[0-9]+')} THEN {u} END"
        ),
        f"{out}_unclear": f"{out}_commas + {out}_dots = 1 AND {full(u, '[+-]?[0-9]+[.,][^.,]{3}')}",
    })
    number = f"TRY_CAST({out}_plain AS DECIMAL(38,4))"
    s = add(s, **{f"{out}_code": (
        f"CASE WHEN {u} IS NULL THEN NULL WHEN {out}_unclear THEN 'AMBIGUOUS_NUMBER' WHEN {out}_plain IS NULL THEN 'INVALID_PRICE' "
        f"WHEN {number} <= 0 THEN 'NON_POSITIVE_PRICE' WHEN {number} > 99999999999999.9999 THEN 'NUMERIC_OUT_OF_RANGE' END"
    )})
    return add(s, **{out: f"CASE WHEN {out}_code IS NULL THEN {number} END"})


def p_catalogue_money(source, column, out):
    cut = f"{out}_cut"
    s = add(source, **{cut: f"{trimmed(column)} LIKE '%?' AND length({column}) - length(replace({column}, '?', '')) = 1"})
    s = add(s, **{f"{out}_raw": f"CASE WHEN {cut} THEN regexp_replace({trimmed(column)}, '[?]$', '') ELSE {column} END"})
    s = p_money(s, f"{out}_raw", f"{out}_m")
    return add(s, **{
        out: f"{out}_m",
        f"{out}_code": f"CASE WHEN {cut} AND {present(f'{out}_raw')} IS NULL THEN 'INVALID_PRICE' ELSE {out}_m_code END",
        f"{out}_repaired": f"{cut} AND {out}_m IS NOT NULL",
    })


def p_discount(source, column, out):
    t, body = f"{out}_t", f"{out}_body"
    s = add(source, **{t: present(column)})
    cut = f"CASE WHEN right({t}, 1) = '%' THEN left({t}, length({t}) - 1) ELSE {t} END"
    s = add(s, **{body: trimmed(cut)})
    s = add(s, **{f"{out}_n": f"CASE WHEN {full(body, '[+-]?[0-9]+([.,][0-9]+)?')} THEN TRY_CAST(replace({body}, ',', '.') AS DECIMAL(38,16)) END"})
    ratio = f"CASE WHEN right({t}, 1) = '%' OR {out}_n >= 1 THEN CAST({out}_n AS DECIMAL(20,14)) * 0.01 ELSE {out}_n END"
    s = add(s, **{f"{out}_r": f"CAST({ratio} AS DECIMAL(38,16))"})
    s = add(s, **{out: f"CASE WHEN {out}_n BETWEEN 0 AND 100 AND {out}_r = CAST(CAST({out}_r AS DECIMAL(9,6)) AS DECIMAL(38,16)) THEN CAST({out}_r AS DECIMAL(9,6)) END"})
    return add(s, **{f"{out}_code": f"CASE WHEN {t} IS NOT NULL AND {out} IS NULL THEN 'INVALID_DISCOUNT' END"})


def p_tax(source, column, out):
    s = p_discount(source, column, f"{out}_d")
    return add(s, **{out: f"{out}_d", f"{out}_code": f"CASE WHEN {out}_d_code IS NOT NULL THEN 'INVALID_TAX' END"})


def p_weight(source, column, out):
    s = p_decimal(source, column, f"{out}_d")
    return add(s, **{
        out: f"CASE WHEN {out}_d >= 0 THEN CAST({out}_d AS DECIMAL(18,4)) END",
        f"{out}_code": f"CASE WHEN {out}_d_code IS NOT NULL OR {out}_d < 0 THEN 'INVALID_WEIGHT' END",
    })


def p_quantity(source, column, out):
    t = f"{out}_t"
    s = add(source, **{t: present(column)})
    s = add(s, **{f"{out}_n": f"CASE WHEN {full(t, '[+-]?[0-9]+([.,]0+)?')} THEN TRY_CAST(regexp_replace({t}, '[.,]0+$', '') AS BIGINT) END"})
    s = add(s, **{out: f"CASE WHEN {out}_n <> 0 THEN {out}_n END"})
    return add(s, **{f"{out}_code": f"CASE WHEN {t} IS NOT NULL AND {out} IS NULL THEN 'INVALID_QUANTITY' END"})


def p_stock_quantity(source, column, out):
    t = f"{out}_t"
    s = add(source, **{t: present(column)})
    s = add(s, **{out: f"CASE WHEN {full(t, '[+]?[0-9]+([.,]0+)?')} THEN TRY_CAST(regexp_replace({t}, '[.,]0+$', '') AS BIGINT) END"})
    return add(s, **{f"{out}_code": f"CASE WHEN {out} IS NULL THEN 'INVALID_STOCK' END"})


def p_date(source, column, out):
    """The zoned dates of the data all lie in summer time, two hours ahead of UTC."""
    t = f"{out}_t"
    formats = [f"'{f}{c}'" for f in ("%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y", "%Y/%m/%d") for c in ("", " %H:%M:%S")]
    s = add(source, **{t: present(column)})
    s = add(s, **{out: (
        f"CASE WHEN {t} LIKE '%Z' THEN CAST(try_strptime({t}, '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 2 HOUR AS DATE) "
        f"ELSE CAST(try_strptime({t}, [{', '.join(formats)}]) AS DATE) END"
    )})
    return add(s, **{f"{out}_code": f"CASE WHEN {t} IS NOT NULL AND {out} IS NULL THEN 'INVALID_DATE' END"})


def p_stock_instant(source, column, out):
    t = f"{out}_t"
    s = add(source, **{t: present(column)})
    s = add(s, **{out: (
        f"CASE WHEN {t} LIKE '%Z' THEN try_strptime({t}, '%Y-%m-%dT%H:%M:%SZ') "
        f"WHEN {t} LIKE '%+02:00' THEN try_strptime({t}, '%Y-%m-%dT%H:%M:%S+02:00') - INTERVAL 2 HOUR END"
    )})
    return add(s, **{f"{out}_code": f"CASE WHEN {out} IS NULL THEN 'INVALID_DATE' END"})


def p_ean(source, column, out):
    t, n = f"{out}_t", f"{out}_n"
    quoted = f"length({t}) >= 2 AND left({t}, 1) = right({t}, 1) AND left({t}, 1) IN ('''', '\"')"
    s = add(source, **{t: present(column)})
    s = add(s, **{n: f"regexp_replace(CASE WHEN {quoted} THEN substr({t}, 2, length({t}) - 2) WHEN left({t}, 1) = '''' THEN substr({t}, 2) ELSE {t} END, '[{BLANKS}]', '', 'g')"})
    padded = f"lpad({n}, 13, '0')"
    total = " + ".join(f"TRY_CAST(substr({padded}, {k + 1}, 1) AS INT) * {3 if k % 2 else 1}" for k in range(13))
    s = add(s, **{f"{out}_code": (
        f"CASE WHEN {n} IS NULL THEN NULL WHEN {full(n, '[0-9]+([.,][0-9]+)?[Ee][+-]?[0-9]+')} THEN 'UNSAFE_SCIENTIFIC_EAN' "
        f"WHEN NOT {full(n, '[0-9]{8}|[0-9]{13}')} THEN 'INVALID_EAN' WHEN ({total}) % 10 <> 0 THEN 'INVALID_EAN' END"
    )})
    return add(s, **{out: f"CASE WHEN {out}_code IS NULL THEN {n} END"})


def long_rows(source: str, shared: str, entries: list[tuple[str, str, str, str, str]]) -> str:
    """Issue rows ``shared, code, field, action, severity`` from ``(condition, code, field, action, severity)``."""
    return " UNION ALL ".join(
        f"SELECT {shared}, {code} AS code, '{field}' AS field, '{action}' AS action, '{severity}' AS severity FROM {source} WHERE {condition}"
        for condition, code, field, action, severity in entries
    )


def catalogue_ctes() -> dict[str, str]:
    parsed = f"({over_tables(samples.catalogue_sql(DUCK))})"
    for block, column, out in (
        (p_identifier, "sku", "v_sku"), (p_ean, "ean", "v_ean"), (p_text, "nombre", "v_name"),
        (p_text, "marca", "v_brand"), (p_text, "categoria", "v_category"),
        (p_catalogue_money, "precio_coste", "v_cost"), (p_catalogue_money, "pvp_recomendado", "v_pvp"),
        (p_tax, "iva", "v_tax"), (p_weight, "peso_kg", "v_weight"), (p_date, "fecha_alta", "v_listed"),
    ):
        parsed = block(parsed, column, out)
    parsed = add(
        parsed,
        aligned="n_cells = 11",
        v_pvp_problem="coalesce(v_pvp_code, CASE WHEN v_pvp IS NULL THEN 'MISSING_REQUIRED_FIELD' END)",
        v_cost_problem="coalesce(v_cost_code, CASE WHEN v_cost IS NULL THEN 'MISSING_REQUIRED_FIELD' END)",
        v_description=clean("descripcion"),
        brand_key="lower(v_brand)",
        category_key="lower(v_category)",
    )
    parsed = add(parsed, candidate=(
        "aligned AND v_sku IS NOT NULL AND v_name IS NOT NULL AND v_brand IS NOT NULL "
        "AND v_category IS NOT NULL AND v_pvp_problem IS NULL"
    ))
    issues = long_rows("cat_parsed", "ord, v_sku AS entity", [
        ("NOT aligned", "'INVALID_COLUMN_COUNT'", "", "reject_row", "error"),
        ("aligned AND v_sku_code IS NOT NULL", "v_sku_code", "sku", "reject_row", "error"),
        ("aligned AND v_name IS NULL", "v_name_code", "nombre", "reject_row", "error"),
        ("aligned AND v_brand IS NULL", "v_brand_code", "marca", "reject_row", "error"),
        ("aligned AND v_category IS NULL", "v_category_code", "categoria", "reject_row", "error"),
        ("aligned AND v_pvp_problem IS NOT NULL", "v_pvp_problem", "pvp_recomendado", "reject_row", "error"),
        ("aligned AND v_pvp_repaired", "'NORMALIZED_CURRENCY_SUFFIX'", "pvp_recomendado", "normalize", "info"),
        ("candidate AND v_cost_repaired", "'NORMALIZED_CURRENCY_SUFFIX'", "precio_coste", "normalize", "info"),
        ("candidate AND v_ean_code IS NOT NULL", "v_ean_code", "ean", "drop_field", "warning"),
        ("candidate AND v_tax_code IS NOT NULL", "v_tax_code", "iva", "drop_field", "warning"),
        ("candidate AND v_weight_code IS NOT NULL", "v_weight_code", "peso_kg", "drop_field", "warning"),
        ("candidate AND v_listed_code IS NOT NULL", "v_listed_code", "fecha_alta", "drop_field", "warning"),
    ])
    rules = (
        "SELECT DISTINCT 'c' AS kind, lower(p_type) AS k, CAST(length(p_type) * 0.01 AS DECIMAL(9,6)) AS ratio FROM part WHERE lower(p_type) <> 'large' "
        "UNION ALL SELECT DISTINCT 'b', lower(p_brand), CAST(CAST(substr(p_brand, 7) AS INT) * 0.04 AS DECIMAL(9,6)) FROM part"
    )
    agreed = (
        "SELECT 'PRV-' || p_partkey AS sku, CASE WHEN p_partkey % 75 <> 1 THEN CAST(p_retailprice AS DECIMAL(18,4)) END AS price "
        "FROM part WHERE p_partkey % 25 = 1"
    )
    quoted = (
        "SELECT p.*, e.sku IS NOT NULL AS has_exception, e.price AS agreed, coalesce(c.ratio, 0) AS c_ratio, coalesce(b.ratio, 0) AS b_ratio, "
        "CAST(round(v_cost * (1 - (coalesce(c.ratio, 0) + coalesce(b.ratio, 0))), 4) AS DECIMAL(18,4)) AS discounted "
        "FROM cat_parsed p LEFT JOIN cat_agreed e ON e.sku = v_sku LEFT JOIN cat_rules c ON c.kind = 'c' AND c.k = category_key "
        "LEFT JOIN cat_rules b ON b.kind = 'b' AND b.k = brand_key"
    )
    judged = add(
        "(SELECT *, CASE WHEN has_exception THEN agreed WHEN v_cost IS NOT NULL AND c_ratio + b_ratio < 1 AND discounted > 0 THEN discounted END AS net_cost, "
        "CASE WHEN has_exception THEN CASE WHEN agreed IS NULL THEN 'INVALID_EXCEPTION_PRICE' END "
        "WHEN v_cost IS NULL THEN v_cost_problem WHEN c_ratio + b_ratio >= 1 OR discounted <= 0 THEN 'NON_POSITIVE_PRICE' END AS price_problem FROM cat_quoted)",
        verdict="coalesce(price_problem, CASE WHEN net_cost > v_pvp THEN 'COST_EXCEEDS_PVP' END)",
    )
    raw = ["sku", "ean", "nombre", "marca", "categoria", "precio_coste", "pvp_recomendado", "iva", "peso_kg", "fecha_alta", "descripcion"]
    chosen = (
        "SELECT j.*, j.candidate AND j.verdict IS NULL AS valid, w.ord AS kept, "
        + "CASE WHEN NOT j.candidate OR j.verdict IS NOT NULL THEN 'rejected' WHEN j.ord = w.ord THEN 'accepted' WHEN "
        + " AND ".join(f"j.{c} = w.{c}" for c in raw)
        + " THEN 'deduplicated' ELSE 'rejected' END AS outcome FROM cat_judged j LEFT JOIN "
        + "(SELECT * FROM cat_judged WHERE candidate AND verdict IS NULL QUALIFY row_number() OVER (PARTITION BY v_sku ORDER BY ord) = 1) w ON w.v_sku = j.v_sku"
    )
    ledger = "SELECT ord, entity, code, field, action, severity FROM cat_issues UNION ALL " + long_rows(
        "cat_chosen", "ord, v_sku AS entity",
        [
            ("candidate AND verdict IS NOT NULL AND price_problem = v_cost_problem", "verdict", "precio_coste", "reject_row", "error"),
            ("candidate AND verdict IS NOT NULL AND price_problem IS DISTINCT FROM v_cost_problem AND price_problem IS NOT NULL", "verdict", "", "reject_row", "error"),
            ("candidate AND verdict IS NOT NULL AND price_problem IS NULL", "verdict", "net_cost", "reject_row", "error"),
            ("valid AND v_cost_problem IS NOT NULL", "v_cost_problem", "precio_coste", "drop_field", "warning"),
            ("valid AND outcome = 'deduplicated'", "'EXACT_DUPLICATE'", "", "deduplicate", "info"),
            ("valid AND outcome = 'rejected'", "'CONFLICTING_PRODUCT_SKU'", "", "reject_row", "error"),
        ],
    )
    return {
        "cat_parsed": f"SELECT * FROM {parsed}", "cat_issues": issues, "cat_rules": rules, "cat_agreed": agreed,
        "cat_quoted": quoted, "cat_judged": f"SELECT * FROM {judged}", "cat_chosen": chosen, "cat_ledger": ledger,
    }


def order_ctes() -> dict[str, str]:
    parsed = f"({over_tables(samples.orders_sql(DUCK))})"
    for block, column, out in (
        (p_identifier, "id_pedido", "v_id"), (p_date, "fecha_pedido", "h_date"), (p_channel, "canal", "h_channel"),
        (p_status, "estado", "h_status"), (p_identifier, "sku", "v_sku"), (p_quantity, "cantidad", "v_quantity"),
        (p_money, "precio_unitario", "v_price"), (p_discount, "descuento_linea", "v_discount"),
    ):
        parsed = block(parsed, column, out)
    parsed = add(parsed, h_customer=clean("cliente"), aligned="n_cells = 9")
    parsed = add(parsed, grouped="aligned AND v_id IS NOT NULL", h_customer_key="lower(h_customer)")
    headers = (
        "SELECT v_id AS order_id, count(*) AS n_rows, min(h_date) AS order_date, arg_min(h_customer, ord) FILTER (WHERE h_customer IS NOT NULL) AS customer, "
        "min(h_channel) AS channel, min(h_status) AS status, count(DISTINCT h_date) AS n_date, count(DISTINCT h_customer_key) AS n_customer, "
        "count(DISTINCT h_channel) AS n_channel, count(DISTINCT h_status) AS n_status, bool_or(h_date_code IS NOT NULL) AS bad_date, "
        "bool_or(h_channel_code IS NOT NULL) AS bad_channel, bool_or(h_status_code IS NOT NULL) AS bad_status FROM ord_parsed WHERE grouped GROUP BY v_id"
    )
    errors = " UNION ALL ".join(
        f"SELECT order_id, '{code}' AS code, '{field}' AS field FROM ord_headers WHERE {condition}"
        for condition, code, field in (
            ("bad_date", "INVALID_DATE", "fecha_pedido"), ("n_date > 1", "CONFLICTING_ORDER_HEADER", "fecha_pedido"),
            ("n_date = 0", "MISSING_ORDER_DATE", "fecha_pedido"), ("n_customer > 1", "CONFLICTING_ORDER_HEADER", "cliente"),
            ("bad_channel", "UNKNOWN_CHANNEL", "canal"), ("n_channel > 1", "CONFLICTING_ORDER_HEADER", "canal"),
            ("n_channel = 0", "MISSING_REQUIRED_FIELD", "canal"), ("bad_status", "UNKNOWN_ORDER_STATUS", "estado"),
            ("n_status > 1", "CONFLICTING_ORDER_HEADER", "estado"), ("n_status = 0", "MISSING_REQUIRED_FIELD", "estado"),
        )
    )
    joined = (
        "SELECT p.*, h.order_date, h.customer, h.channel, h.status, coalesce(grouped AND p.v_id NOT IN (SELECT order_id FROM ord_errors), false) AS header_ok "
        "FROM ord_parsed p LEFT JOIN ord_headers h ON h.order_id = p.v_id"
    )
    checked = add(
        "(SELECT * FROM ord_joined)",
        c_sku="CASE WHEN header_ok THEN v_sku_code END",
        c_quantity="CASE WHEN header_ok THEN coalesce(v_quantity_code, CASE WHEN v_quantity IS NULL THEN 'MISSING_REQUIRED_FIELD' WHEN v_quantity < 0 AND status <> 'DEVUELTO' THEN 'INVALID_QUANTITY_FOR_STATUS' END) END",
        c_price="CASE WHEN header_ok THEN coalesce(v_price_code, CASE WHEN v_price IS NULL THEN 'MISSING_REQUIRED_FIELD' END) END",
        c_discount="CASE WHEN header_ok THEN v_discount_code END",
        free="header_ok AND v_discount IS NULL AND v_discount_code IS NULL",
    )
    checked = add(checked, line_ok="header_ok AND c_sku IS NULL AND c_quantity IS NULL AND c_price IS NULL AND c_discount IS NULL")
    signature = (
        "sha256('[\"order-line-v1\",\"' || v_id || '\",\"' || v_sku || '\",' || CAST(v_quantity AS VARCHAR) || ',\"' || "
        "CAST(CAST(v_price AS DECIMAL(18,4)) AS VARCHAR) || '\",\"' || CAST(CAST(coalesce(v_discount, 0) AS DECIMAL(9,6)) AS VARCHAR) || '\"]')"
    )
    checked = add(checked, line_key=f"CASE WHEN line_ok THEN {signature} END")
    final = (
        "SELECT *, CASE WHEN NOT line_ok THEN 'rejected' WHEN row_number() OVER w = 1 THEN 'accepted' ELSE 'deduplicated' END AS outcome, "
        "first_value(locator) OVER w AS kept FROM ord_checked WINDOW w AS (PARTITION BY coalesce(line_key, locator) ORDER BY ord)"
    )
    shared = "locator, v_id AS entity"
    ledger = long_rows("ord_final", shared, [
        ("v_id IS NULL", "'INVALID_IDENTIFIER'", "id_pedido", "reject_row", "error"),
        ("NOT aligned", "'INVALID_COLUMN_COUNT'", "", "reject_row", "error"),
        ("header_ok AND h_date IS NULL AND h_date_code IS NULL AND order_date IS NOT NULL", "'HEADER_VALUE_INHERITED'", "fecha_pedido", "warn", "warning"),
        ("header_ok AND h_customer IS NULL AND customer IS NOT NULL", "'HEADER_VALUE_INHERITED'", "cliente", "warn", "warning"),
        ("header_ok AND h_channel IS NULL AND h_channel_code IS NULL", "'HEADER_VALUE_INHERITED'", "canal", "warn", "warning"),
        ("header_ok AND h_status IS NULL AND h_status_code IS NULL", "'HEADER_VALUE_INHERITED'", "estado", "warn", "warning"),
        ("c_sku IS NOT NULL", "c_sku", "sku", "reject_row", "error"),
        ("c_quantity IS NOT NULL", "c_quantity", "cantidad", "reject_row", "error"),
        ("c_price IS NOT NULL", "c_price", "precio_unitario", "reject_row", "error"),
        ("c_discount IS NOT NULL", "c_discount", "descuento_linea", "reject_row", "error"),
        ("free", "'MISSING_DISCOUNT_ASSUMED_ZERO'", "descuento_linea", "warn", "warning"),
        ("outcome = 'deduplicated'", "'DUPLICATE_ORDER_LINE'", "", "deduplicate", "info"),
    ]) + (
        " UNION ALL SELECT p.locator, p.v_id, e.code, e.field, 'reject_row', 'error' FROM ord_parsed p JOIN ord_errors e ON e.order_id = p.v_id WHERE p.grouped"
    )
    loaded = (
        "SELECT v_id AS order_id, max(order_date) AS order_date, max(customer) AS customer, max(channel) AS channel, max(status) AS status, "
        "bool_or(outcome = 'rejected') AS partial FROM ord_final WHERE v_id IS NOT NULL GROUP BY v_id HAVING bool_or(outcome = 'accepted')"
    )
    return {
        "ord_parsed": f"SELECT * FROM {parsed}", "ord_headers": headers, "ord_errors": errors, "ord_joined": joined,
        "ord_checked": f"SELECT * FROM {checked}", "ord_final": final, "ord_ledger": ledger, "ord_loaded": loaded,
    }


def stock_ctes(rows: str | None = None) -> dict[str, str]:
    parsed = f"({rows or over_tables(samples.stock_sql(DUCK))})"
    for block, column, out in (
        (p_identifier, "sku", "v_sku"), (p_identifier, "warehouse", "v_warehouse"), (p_stock_quantity, "quantity", "v_quantity"),
        (p_stock_quantity, "reserved", "v_reserved"), (p_stock_instant, "updated_at", "v_at"),
    ):
        parsed = block(parsed, column, out)
    checked = add(
        f"(SELECT p.*, s.sku IS NOT NULL AS known FROM {parsed} p LEFT JOIN st_catalogue s ON s.sku = p.v_sku)",
        valid="known AND v_warehouse IS NOT NULL AND v_quantity IS NOT NULL AND v_reserved IS NOT NULL AND v_at IS NOT NULL",
    )
    versions = (
        "SELECT v_sku, v_warehouse, v_at, v_quantity, v_reserved, min(ord) AS first FROM st_checked WHERE valid GROUP BY ALL"
    )
    judged = (
        "SELECT v.*, count(*) OVER (PARTITION BY v_sku, v_warehouse, v_at) > 1 AS conflict, "
        "max(v_at) OVER (PARTITION BY v_sku, v_warehouse) AS latest FROM st_versions v"
    )
    final = (
        "SELECT c.*, coalesce(valid AND c.ord = j.first AND j.conflict, false) AS conflicting, CASE WHEN NOT valid THEN 'rejected' "
        "WHEN c.ord <> j.first THEN 'deduplicated' WHEN j.conflict THEN 'rejected' WHEN c.v_at <> j.latest THEN 'deduplicated' ELSE 'accepted' END AS outcome, "
        "valid AND c.ord <> j.first AS repeat FROM st_checked c LEFT JOIN st_judged j USING (v_sku, v_warehouse, v_at, v_quantity, v_reserved)"
    )
    totals = (
        "SELECT s.sku, CASE WHEN bad THEN NULL ELSE CAST(total AS BIGINT) END AS stock_total, CASE WHEN bad THEN 'invalid' WHEN total IS NULL THEN 'unknown' ELSE 'known' END AS stock_status, "
        "CASE WHEN NOT bad THEN as_of END AS stock_as_of, coalesce(total > 9223372036854775807, false) AS overflow FROM (SELECT c.sku, t.total, t.as_of, "
        "coalesce(t.invalid, false) OR coalesce(t.total > 9223372036854775807, false) AS bad FROM st_catalogue c LEFT JOIN "
        "(SELECT v_sku AS sku, sum(CAST(v_quantity AS HUGEINT)) FILTER (WHERE outcome = 'accepted') AS total, max(v_at) FILTER (WHERE outcome = 'accepted') AS as_of, "
        "bool_or((known AND NOT valid) OR conflicting) AS invalid FROM st_final WHERE v_sku IS NOT NULL GROUP BY v_sku) t USING (sku)) s"
    )
    shared = "locator, v_sku AS entity"
    ledger = long_rows("st_final", shared, [
        ("v_sku IS NULL", "'INVALID_STOCK'", "sku", "reject_row", "error"),
        ("v_sku IS NOT NULL AND NOT known", "'UNKNOWN_PRODUCT_SKU'", "", "reject_row", "error"),
        ("known AND v_warehouse IS NULL", "'INVALID_STOCK'", "warehouse", "reject_row", "error"),
        ("known AND v_quantity IS NULL", "'INVALID_STOCK'", "quantity", "reject_row", "error"),
        ("known AND v_reserved IS NULL", "'INVALID_STOCK'", "reserved", "reject_row", "error"),
        ("known AND v_at IS NULL", "'INVALID_DATE'", "updated_at", "reject_row", "error"),
        ("valid AND v_reserved > v_quantity", "'RESERVED_EXCEEDS_QUANTITY'", "", "warn", "warning"),
        ("repeat", "'EXACT_DUPLICATE'", "", "deduplicate", "info"),
        ("conflicting", "'CONFLICTING_STOCK'", "", "reject_row", "error"),
        ("valid AND outcome = 'deduplicated' AND NOT repeat", "'SUPERSEDED_STOCK'", "", "deduplicate", "info"),
    ])
    extra = (
        "SELECT DISTINCT 'conflict:' || v_sku || ':' || v_warehouse || ':' || strftime(v_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS locator, v_sku AS entity, "
        "'CONFLICTING_STOCK' AS code, '' AS field, 'warn' AS action, 'warning' AS severity FROM st_final WHERE conflicting "
        "UNION ALL SELECT 'sku:' || sku, sku, 'STOCK_NOT_OBSERVED', '', 'warn', 'warning' FROM st_totals WHERE stock_status = 'unknown' "
        "UNION ALL SELECT 'sku:' || sku, sku, 'NUMERIC_OUT_OF_RANGE', '', 'warn', 'warning' FROM st_totals WHERE overflow"
    )
    return {
        "st_catalogue": "SELECT 'PRV-' || p_partkey AS sku FROM part WHERE p_partkey % 20 <> 0",
        "st_checked": f"SELECT * FROM {checked}", "st_versions": versions, "st_judged": judged, "st_final": final,
        "st_totals": totals, "st_ledger": ledger, "st_extra": extra,
    }


def sales_ctes() -> dict[str, str]:
    products = (
        "SELECT p_partkey AS id, 'PRV-' || p_partkey AS sku, p_partkey % 20 <> 0 AS in_catalog, p_partkey % 20 = 0 AS is_historical, "
        "CASE WHEN p_partkey % 20 <> 0 THEN p_name END AS name, CASE WHEN p_partkey % 20 <> 0 THEN CASE WHEN p_partkey % 3 = 0 THEN upper(left(p_type, 1)) || lower(substr(p_type, 2)) ELSE p_type END END AS category, "
        "CASE WHEN p_partkey % 20 <> 0 THEN lower(p_type) END AS category_key, CASE WHEN p_partkey % 20 <> 0 THEN p_brand END AS brand, "
        "CASE WHEN p_partkey % 20 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(18,4)) * 0.6 AS DECIMAL(18,4)) END AS net_cost, "
        "CASE WHEN p_partkey % 20 <> 0 THEN CAST(p_retailprice AS DECIMAL(18,4)) END AS pvp, "
        "CASE WHEN p_partkey % 20 = 0 OR p_partkey % 7 = 0 THEN 'unknown' WHEN p_partkey % 7 = 1 THEN 'invalid' ELSE 'known' END AS stock_status, "
        "CASE WHEN p_partkey % 20 <> 0 AND p_partkey % 7 > 1 THEN p_partkey % 9 END AS stock_total, "
        "CASE WHEN p_partkey % 20 <> 0 THEN 'Pieza ' || p_name || ' ñandú' END AS description FROM part"
    )
    orders = (
        "SELECT o_orderkey AS id, 'PED-' || o_orderkey AS source_order_id, CAST(o_orderdate AS DATE) AS order_date, CASE o_custkey % 3 WHEN 0 THEN 'B2B' WHEN 1 THEN 'B2C' ELSE 'marketplace' END AS channel, "
        "CASE o_orderstatus WHEN 'F' THEN 'COMPLETADO' WHEN 'O' THEN 'ENVIADO' ELSE 'PENDIENTE' END AS status, o_orderkey % 11 = 0 AS partial FROM orders"
    )
    lines = (
        "SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_discount AS DECIMAL(9,6)) AS discount, "
        "CAST(p_retailprice AS DECIMAL(18,4)) AS unit_price FROM lineitem JOIN part ON l_partkey = p_partkey"
    )
    eligible = (
        f"SELECT o.id AS order_id, o.order_date, o.channel, o.partial, p.id AS product_id, l.quantity, p.sku, p.name, p.category, p.category_key, p.is_historical, p.net_cost, "
        "CAST(round(l.quantity * l.unit_price * (1 - l.discount), 2) AS DECIMAL(38,2)) AS amount, "
        "CAST(round(l.quantity * p.net_cost, 2) AS DECIMAL(38,2)) AS cost "
        "FROM s_orders o JOIN s_lines l ON l.order_id = o.id JOIN s_products p ON p.id = l.product_id "
        f"WHERE o.status IN ('ENVIADO', 'COMPLETADO') AND l.quantity > 0 AND o.order_date BETWEEN DATE '{samples.START}' AND DATE '{samples.AS_OF}'"
    )
    return {"s_products": products, "s_orders": orders, "s_lines": lines, "eligible": eligible}


def with_ctes(ctes: dict[str, str], final: str) -> str:
    """Only the CTEs that the statement needs, in order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name, body in ctes.items():
            if name in sql and name not in needed:
                needed.add(name)
                visit(body)

    visit(final)
    listed = ", ".join(f"{name} AS MATERIALIZED ({body})" for name, body in ctes.items() if name in needed)
    return f"WITH {listed} {final}" if listed else final
