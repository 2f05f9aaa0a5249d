"""Labels, rates, thresholds and formats that published results depend on."""

# Domains, and the tables that published layouts name.
DOMAINS = ("products", "users", "carts")
BRONZE_TABLES = {"products": "raw_products", "users": "raw_users", "carts": "raw_carts"}
SILVER_TABLES = {"products": "dim_products", "users": "dim_customers", "carts": "fct_order_items"}
GOLD_TABLES = {
    "catalog_kpi": "gold_catalog_daily_kpi",
    "price_trend": "gold_product_price_trend",
    "sales_daily": "gold_sales_by_category_daily",
    "customer_360": "gold_customer_360",
}

# Category labels of the sales and catalogue tables.
TOTAL_SLUG = "TOTAL"
UNKNOWN_SLUG = "inconnu"
UNMATCHED_LABEL = "Non rattache"
ALL_SALES_LABEL = "Toutes categories"
ALL_CATALOGUE_LABEL = "Tous rayons"

# Price bands, upper bounds exclusive.
PRICE_BAND_BOUNDS = (25, 100, 500)
PRICE_BAND_LABELS = ("entree_de_gamme", "milieu_de_gamme", "premium", "luxe")

# Customer segments.
SEGMENT_NEVER = "jamais_acheteur"
SEGMENT_CHAMPION = "champion"
SEGMENT_LOYAL = "fidele_a_forte_valeur"
SEGMENT_ACTIVE = "client_actif"
SEGMENT_REACTIVATE = "a_reactiver"
SEGMENT_AT_RISK = "a_risque"

# Reject reasons.
REASON_UNREADABLE = "JSON illisible"
REASON_NO_ID = "id absent"
REASON_NO_TITLE = "title absent"
REASON_NO_PRICE = "price absent"
REASON_NEGATIVE_PRICE = "price negatif"
REASON_NO_EMAIL = "email absent"
REASON_BAD_EMAIL = "email non conforme"
REASON_NO_USER = "userId absent"
REASON_EMPTY_CART = "panier vide"

# History model.
HISTORY_DAYS = 180
HISTORY_SEED = 20260909
TREND_AMPLITUDE = 0.06
SEASON_AMPLITUDE = 0.04
SEASON_PERIOD_DAYS = 91.0
JITTER_AMPLITUDE = 0.04
PI = 3.14159265
FULL_TURN = 6.2831853
FACTOR_FLOOR = 0.55
FACTOR_CEILING = 1.35
GROWTH_START = 0.68
GROWTH_SPAN = 0.32
GROWTH_POWER = 0.85

# Share of template orders kept per weekday (1 = Sunday).
WEEKDAY_KEEP_RATE = {1: 0.80, 2: 0.45, 3: 0.40, 4: 0.42, 5: 0.50, 6: 0.70, 7: 0.85}
ORDER_REPLICAS = 3
ORDER_FIRST_HOUR = 8
ORDER_HOURS = 13

# Raw zone naming, <domain>_<date>_<epoch ms>_<uuid>.json.
OBJECT_NAME_PATTERN = r".*/([a-z]+)_(\d{4}-\d{2}-\d{2})_(\d+)_([0-9a-fA-F-]+)\.json$"
DEAD_LETTER_NO_DOMAIN = "inconnu"
DEAD_LETTER_NO_DATE = "sans-date"

# Landing and monitoring thresholds.
OK_STATUS = 200
MIN_BODY_BYTES = 20
DEDUP_TTL = "24 hours"
MAX_RETRIES = 3
COVERAGE_TARGET = 0.95
DEPTH_TARGET = 0.9
MANDATORY_DOMAINS = ("products", "users")
COMPACTION_TARGET_BYTES = 64 * 1024 * 1024
COMPACTION_MIN_FILES = 3
RETAIN_LAST = 5
RETAIN_DAYS = 7
