"""Column layouts of the stage tables (DDL strings)."""

CATALOG = (
    "asin string, product_title string, product_price double, product_original_price double, "
    "discount double, product_star_rating double, product_num_ratings double, sales_volume string, "
    "is_prime boolean, is_best_seller boolean, is_amazon_choice boolean, currency string, "
    "product_url string"
)

PRICE_HISTORY = "asin string, date timestamp_ntz, price double"

ERRORS = "asin string, page int, error string"

INVENTORY = "asin string, title string, available_amazon string, available_third string, condition string"

# One row per landed API response. ``body`` is the JSON text as received; ``status_code`` and
# ``error`` are null when the request itself succeeded.
LANDED = "asin string, page int, status_code int, error string, body string"

DETAIL_COLUMNS = (
    "asin string, product_title string, product_price double, product_original_price double, "
    "currency string, country string, product_byline string, product_star_rating double, "
    "product_num_ratings bigint, product_num_offers bigint, sales_volume string, "
    "rating_distribution string, is_amazon_choice boolean, is_prime boolean, "
    "climate_pledge_friendly boolean, has_aplus boolean, has_brandstory boolean, deal_badge string, "
    "category string, landing_asin string, parent_asin string"
)

BADGE_FLAGS = ("is_amazon_choice", "is_prime", "has_aplus", "has_brandstory")

CLUSTER_BASE = ("price", "product_star_rating", "discount_pct", "rating_balance")
CLUSTER_LOG = ("product_num_ratings", "sales_volume_num")

MODEL_FEATURES = (
    "product_price",
    "discount",
    "discount_pct",
    "product_star_rating",
    "product_num_ratings",
    "popularity_score",
    "premium_badge_count",
    "rating_balance",
)
MODEL_TARGET = "sales_volume_num"
