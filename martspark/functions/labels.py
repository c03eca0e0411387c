"""Fixed values that must equal the reference's: code decodes and label strings.

All label strings are business data and are kept verbatim (Spanish, accents and
emoji included).  They are listed in natural order, one table per domain.
"""

# Sales document type (SOPTYPE) decode.
SOP_TYPE_LABELS = {
    1: "Quote",
    2: "Order",
    3: "Invoice",
    4: "Return",
    5: "Backorder",
    6: "Fulfillment Order",
}
SOP_TYPE_DEFAULT = "Unknown"

# Receivables document type (RMDTYPAL) decode, staging layer.
AR_TYPE_LABELS = {
    1: "Factura",
    3: "Nota de Débito",
    7: "Nota de Crédito",
    8: "Pago / Cobro no Aplicado",
    9: "Devolución",
}
AR_TYPE_DEFAULT = "Otro"

# Receivables document type decode, analytics-service layer.
AR_SERVICE_TYPE_LABELS = {
    1: "Factura",
    3: "Nota de Débito",
    7: "Nota de Crédito (-)",
    8: "Cobro no Aplicado (-)",
    9: "Devolución (-)",
}
AR_CREDIT_TYPES = (7, 8, 9)

# Inventory transaction type (IV30300.DOCTYPE) decode.
IV_DOC_TYPE_LABELS = {
    1: "Ajuste Entrada (+)",
    2: "Ajuste Salida (-)",
    3: "Transferencia",
    4: "Venta",
    5: "Recepción Compra",
    6: "Devolución",
}
IV_DOC_TYPE_DEFAULT = "Otro"

# Defaults and sentinels.
UNKNOWN_SP = "UNKNOWN_SP"
UNKNOWN_TERR = "UNKNOWN_TERR"
UNKNOWN_CUSTOMER = "UNKNOWN_CUSTOMER"
UNKNOWN_PRODUCT = "UNKNOWN_PRODUCT"
TOTAL_LOCATION = "TOTAL_GENERAL"
DEFAULT_LOCATION = "DEFAULT_LOC"
FX_TABLE = "USD-VENTAS"
SERVICE_GENERAL = "GENERAL"
SERVICE_NO_SALESPERSON_ID = "SIN_VENDEDOR"
SERVICE_UNASSIGNED = "No Asignado"
SERVICE_NO_ZONE = "Sin Zona"
SERVICE_NO_ZONE_ASSIGNED = "Sin Zona Asignada"
SERVICE_DEFAULT_LOCATION_NAME = "Almacén General"
DOC_LABEL_INVOICE = "Factura"
DOC_LABEL_RETURN = "Devolución"
CLASS_UNKNOWN = "UNKNOWN"
CLASS_UNKNOWN_DESC = "Sin Clasificación"
ITEM_CLASS_UNASSIGNED = "UNASSIGNED"
ITEM_GENERIC_DEFAULT = "General"

# Churn status of the customer summary.
CHURN_NEVER = "Never Purchased"
CHURN_CHURNED = "Churned / Inactive"
CHURN_ACTIVE = "Active"

# RFM quintile segments (analysis layer), in rule order.
RFM_CHAMPIONS = "Champions / VIP"
RFM_LOYAL = "Loyal Customers"
RFM_PROMISING = "Promising / Recent Buyers"
RFM_AT_RISK = "At Risk / Need Attention"
RFM_HIBERNATING = "Hibernating / Churned"
RFM_STANDARD = "Standard Customers"

# RFM median segments (service layer), in rule order.
SEG_VIP = "Campeones / VIP"
SEG_LOYAL = "Leales Potenciales"
SEG_PROMISING = "Prometedores / Recientes"
SEG_AT_RISK = "En Riesgo"
SEG_LOST = "Inactivos / Perdidos"
SEG_STANDARD = "Estándar"

# Inventory health (model layer and service layer differ in the optimal label).
HEALTH_STOCKOUT = "Quiebre de Stock (Stockout)"
HEALTH_CRITICAL = "Riesgo Crítico"
HEALTH_EXCESS = "Sobreinventario"
HEALTH_OPTIMAL_MODEL = "Óptimo"
HEALTH_OPTIMAL_SERVICE = "Nivel Óptimo"

# SKU types.
SKU_TYPE_DESC = {
    "MP": "MP - Materia Prima",
    "ME": "ME - Material de Empaque",
    "PT": "PT - Producto Terminado",
}

# Receivables aging buckets, in display order.
AGING_BUCKETS = [
    "Corriente / Al Día",
    "Vencido 1-30 Días",
    "Vencido 31-60 Días",
    "Vencido 61-90 Días",
    "Vencido >90 Días",
]

# Customer credit risk labels.
RISK_HIGH = "🔴 Riesgo Alto / Moroso"
RISK_MODERATE = "🟡 Vencido Moderado"
RISK_OK = "🟢 Al Día"

# Filter-facet exclusions.
FACET_EXCLUDED_TERRITORIES = ("INACTIVO", "Sin Zona")
FACET_INACTIVE_MARK = "INACTIVO"
