"""Fixed business values: labels, code lists and thresholds, all usable as defaults."""

from __future__ import annotations

# --- Fixed values: order and payment codes -------------------------------------------
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved",
)
VOID_STATUSES = ("canceled", "unavailable")
UNDEFINED_PAYMENT = "not_defined"
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")

# --- Fixed values: payment type -> (name, category, supports instalments, offline) ---
PAYMENT_LABELS = {
    "credit_card": ("Credit Card", "Card", True, False),
    "boleto": ("Boleto Bancário", "Bank Transfer", False, True),
    "voucher": ("Voucher", "Voucher", False, False),
    "debit_card": ("Debit Card", "Card", True, False),
}

# --- Fixed values: channel -> (name, type) -------------------------------------------
CHANNEL_LABELS = {
    "paid_search": ("Paid Search", "Paid"),
    "organic_search": ("Organic Search", "Organic"),
    "social": ("Social Media", "Paid"),
    "email": ("Email", "Owned"),
    "referral": ("Referral", "Earned"),
    "direct_traffic": ("Direct Traffic", "Organic"),
    "display": ("Display Ads", "Paid"),
    "other_publicities": ("Other Paid", "Other"),
}

# --- Fixed values: calendar ----------------------------------------------------------
CALENDAR_START = "2016-01-01"
CALENDAR_DAYS = 1827
HOLIDAYS = ("01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25")
PROJECT_END = "2018-12-31"

# --- Fixed values: bounding box (lat_min, lat_max, lng_min, lng_max) ------------------
BOX = (-35.0, 5.3, -74.0, -28.0)

# --- Fixed values: state code, name, region, frontier flag, population ---------------
STATES = (
    ("AC", "Acre", "North", False, 906876),
    ("AL", "Alagoas", "Northeast", False, 3351543),
    ("AM", "Amazonas", "North", False, 4207714),
    ("AP", "Amapá", "North", False, 877613),
    ("BA", "Bahia", "Northeast", True, 14930634),
    ("CE", "Ceará", "Northeast", True, 9240580),
    ("DF", "Distrito Federal", "Midwest", True, 3094325),
    ("ES", "Espírito Santo", "Southeast", True, 4108508),
    ("GO", "Goiás", "Midwest", True, 7206589),
    ("MA", "Maranhão", "Northeast", False, 7153262),
    ("MG", "Minas Gerais", "Southeast", True, 21292666),
    ("MS", "Mato Grosso do Sul", "Midwest", True, 2839188),
    ("MT", "Mato Grosso", "Midwest", True, 3567234),
    ("PA", "Pará", "North", True, 8777124),
    ("PB", "Paraíba", "Northeast", False, 4059905),
    ("PE", "Pernambuco", "Northeast", True, 9674793),
    ("PI", "Piauí", "Northeast", True, 3289290),
    ("PR", "Paraná", "South", True, 11516840),
    ("RJ", "Rio de Janeiro", "Southeast", True, 17366189),
    ("RN", "Rio Grande do Norte", "Northeast", False, 3560903),
    ("RO", "Rondônia", "North", False, 1815278),
    ("RR", "Roraima", "North", False, 652713),
    ("RS", "Rio Grande do Sul", "South", True, 11466630),
    ("SC", "Santa Catarina", "South", True, 7338473),
    ("SE", "Sergipe", "Northeast", True, 2338474),
    ("SP", "São Paulo", "Southeast", True, 46649132),
    ("TO", "Tocantins", "North", False, 1607363),
)
STATE_CODES = tuple(row[0] for row in STATES)
REGIONS = ("Southeast", "South", "Midwest", "Northeast", "North")

# --- Fixed values: result labels ------------------------------------------------------
RFM_SEGMENTS = (
    "Champions", "Loyal Customers", "New Customers", "Potential Loyalists",
    "At Risk", "Cant Lose Them", "Sleeping Giants", "Hibernating",
)
VALUE_TIERS = ("High Value", "Medium Value", "Low Value")
SELLER_TIERS = ("Platinum", "Gold", "Silver", "Bronze")
CONVERSION_TIERS = ("High Converting", "Mid Converting", "Low Converting")
SLA_BANDS = ("Excellent", "Good", "Needs Improvement", "Critical")
PRODUCT_TIERS = ("Tier 1 — Core", "Tier 2 — Growth", "Tier 3 — Niche", "Tier 4 — Tail")
ZONES = ("Coastal", "Amazon Basin", "Central Plateau", "Southern Cone")
