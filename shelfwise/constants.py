"""Labels and texts that stored data and results must carry."""

# --- warehouse and brand vocabulary (fixed values) ---
SALES_POINT = "Venta"
MAIN_BRANDS = "PRINCIPAL"
OTHER_BRANDS = "OTRAS"

# --- stock states (fixed values) ---
CRITICAL = "CRITICO"
LOW = "BAJO"
MEDIUM = "MEDIO"
NORMAL = "NORMAL"
OVER = "SOBRE"
EXCESS = "EXCESO"
NO_DATA = "SIN_DATOS"

# --- alert types and levels (fixed values) ---
ALERT_CRITICAL = "STOCK_CRITICO"
ALERT_LOW = "STOCK_BAJO"
ALERT_MEDIUM = "STOCK_MEDIO"
ALERT_OVER = "SOBREINVENTARIO"
ALERT_SLOW = "BAJA_ROTACION"
ALERT_NO_ROTATION = "SIN_ROTACION"
ALERT_STOCKOUT = "STOCK_AGOTADO"
LEVEL_CRITICAL = "CRITICO"
LEVEL_HIGH = "ALTO"
LEVEL_MEDIUM = "MEDIO"

# --- priorities and lifecycle states (fixed values) ---
URGENT = "URGENTE"
HIGH = "ALTA"
MID = "MEDIA"
LOWEST = "BAJA"
PENDING = "PENDIENTE"
COMPUTED = "CALCULADO"
ALERT_STATES = ["VISTA", "ATENDIDA", "IGNORADA"]
TRANSFER_STATES = ["APROBADO", "RECHAZADO", "EJECUTADO"]
EXECUTED = "EJECUTADO"

# --- stock tags (fixed values) ---
TAG_PLAIN = "INVENTARIO"
TAG_PROJECTS = "PROYECTOS"
TAG_MISSING = "SIN_OBSERVACION"
BRAND_MISSING = "Sin marca"

# --- inventory health classes, best match first (fixed values) ---
HEALTH = {
    1: "agotado",
    2: "critico",
    3: "bajo",
    4: "sobreinventario",
    5: "baja_rotacion",
    6: "sin_rotacion",
    7: "sano",
}

# --- labels of the low-rotation and critical-product reports (fixed values) ---
ROTATION_EXPECTED = "ESPERADO (Marca clase D)"
ROTATION_NONE = "SIN MOVIMIENTO 90 DÍAS"
ROTATION_VERY_LOW = "ROTACIÓN MUY BAJA"
ROTATION_LOW = "ROTACIÓN BAJA"
BAND_CRITICAL = "CRÍTICO - Menos de 3 días"
BAND_HIGH = "ALTO - Menos de 7 días"
BAND_MEDIUM = "MEDIO - Menos de 15 días"

# --- alert message texts, {} marks a number (fixed values) ---
MSG_LOW = "Stock para {} días. Venta diaria: {} uds. Se recomienda reabastecer."
MSG_OVER = "Stock para {} días (objetivo: {}). Considerar traslado a otro almacén."
MSG_SLOW_NONE = "Sin movimiento en 90 días. Valor en stock: ${}"
MSG_SLOW_SOME = "Solo {} uds vendidas en 90 días. Evaluar promoción o descontinuar."
MSG_NO_ROTATION = (
    "Sin ventas en 30 días. Stock: {} uds. Valor: ${}."
    " Evaluar promoción/oferta o redistribución."
)
MSG_STOCKOUT = (
    "Agotado con demanda activa. Venta diaria: {} uds ({} en 30d). Reabastecer urgente."
)

# --- filter choices offered by the dashboard (fixed values) ---
CHOICES = {
    "alert_types": [
        "STOCK_CRITICO", "STOCK_BAJO", "SOBREINVENTARIO",
        "BAJA_ROTACION", "SIN_ROTACION", "STOCK_AGOTADO",
    ],
    "alert_levels": ["CRITICO", "ALTO", "MEDIO", "BAJO"],
    "priorities": ["URGENTE", "ALTA", "MEDIA", "BAJA"],
}
