"""Fixed values of the business vocabulary: they appear verbatim in results."""

# Text that means "no value", compared after trimming and lower-casing.
MISSING_TOKENS = ["", "n/d", "null", "-", "n/a"]

# Order states and sales channels.
STATUSES = ["COMPLETADO", "ENVIADO", "PENDIENTE", "CANCELADO", "DEVUELTO"]
SOLD_STATUSES = ["ENVIADO", "COMPLETADO"]
RETURNED = "DEVUELTO"
CHANNELS = ["B2B", "B2C", "marketplace"]

# Column order of the two CSV sources.
CATALOGUE_COLUMNS = [
    "sku", "ean", "nombre", "marca", "categoria", "precio_coste",
    "pvp_recomendado", "iva", "peso_kg", "fecha_alta", "descripcion",
]
ORDER_COLUMNS = [
    "id_pedido", "fecha_pedido", "cliente", "canal", "estado",
    "sku", "cantidad", "precio_unitario", "descuento_linea",
]
STOCK_FIELDS = ["sku", "warehouse", "quantity", "reserved", "updated_at"]

# Names of the sources in the issue ledger.
CATALOGUE = "catalog_csv"
TARIFFS = "tariffs_xml"
ORDERS = "orders_csv"
STOCK = "stock_api"

# Issue actions and severities.
NORMALIZE = "normalize"
REJECT = "reject_row"
DROP = "drop_field"
DEDUPLICATE = "deduplicate"
WARN = "warn"
FAIL = "fail_run"
ACTIONS = [NORMALIZE, REJECT, DROP, DEDUPLICATE, WARN, FAIL]
SEVERITIES = ["info", "warning", "error"]

# Limits and versions.
MAX_LONG = 2**63 - 1
MAX_IDENTIFIER = 64
MAX_CUSTOMER = 255
EXCERPT = 512
LINE_KEY_VERSION = "order-line-v1"
RULES_VERSION = "catalog-stock-orders-v3"
SUMMARY_VERSION = "etl-summary-v2"
SALES_START = "2025-04-01"
BUSINESS_ZONE = "Europe/Madrid"
LOW_STOCK = 5
LOW_STOCK_MONTHS = 3
PAGE_SIZE = 20
NO_CATEGORY = "Sin categoría"

# Ledger detail texts.
DETAIL = {
    "sku": "SKU inválido",
    "required": "Campo obligatorio inválido",
    "pvp": "PVP obligatorio inválido",
    "suffix": "Sufijo monetario degradado normalizado a ",
    "ean": "EAN descartado",
    "iva": "IVA descartado",
    "peso_kg": "Peso descartado",
    "fecha_alta": "Fecha de alta descartada",
    "column_count": "Número de columnas incorrecto",
    "price": "Precio final inválido",
    "rescued": "Coste CSV sustituido por precio válido",
    "same_row": "Fila idéntica; conservada fila ",
    "other_row": "SKU conflictivo; conservada fila ",
    "kept_line": "Conservada fila ",
    "same_rule": "Regla idéntica; conservada ",
    "same_exception": "Excepción idéntica; conservada ",
    "volume": "Descuento por volumen no aplicado sin compra conocida",
    "condition": "Condición comercial no aplicada al coste unitario",
    "bad_exception": "Excepción inválida; producto afectado se rechazará",
    "orphan": "Excepción sin candidato de catálogo",
    "historical": "Histórico creado: SKU ",
    "was_rejected": "rechazado en catálogo",
    "was_absent": "ausente del catálogo",
}
