"""Listing-domain presets.

Every operator in the package takes column names and parameters; the values
below are only defaults that reproduce the rental-listings workflow.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must stay exactly as written for results to agree with
# the original listings workflow (vocabularies, bounds, patterns, keys).
# ---------------------------------------------------------------------------

SEED = 42

TARGET = "price"

# CSV export: semicolon separated, Windows-1252 encoded.
CSV_SEP = ";"
CSV_ENCODING = "windows-1252"

# Tokens read as missing in the raw export: its own, and the usual defaults of CSV readers.
NULL_TOKENS = [
    "null", "NULL", "", "none", "None",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NaN", "n/a", "nan",
]

# Columns that restate the target in another form.
LEAKY_COLUMNS = ["price_display", "price_type", "currency"]

ID_COLUMNS = ["id"]

# Inclusive cleaning bounds.
PRICE_MIN = 200
PRICE_MAX = 10_000
SQFT_MIN = 100
SQFT_MAX = 6_000

# Split sizes: test share of groups, then validation share of the rest.
TEST_SIZE = 0.2
VAL_SIZE = 0.2

# Weekly -> monthly price factor.
WEEKS_PER_MONTH = 52 / 12

# Numeric columns coerced at cast time.
NUMERIC_COLUMNS = ["bathrooms", "bedrooms", "price", "square_feet", "latitude", "longitude"]

# Categorical string columns trimmed at cast time.
TRIM_COLUMNS = ["category", "fee", "has_photo", "price_type", "currency", "source", "state"]

# Geo columns that must all be present.
GEO_COLUMNS = ["cityname", "state", "latitude", "longitude"]

# Multi-select columns (comma-joined strings).
MULTI_SELECT_COLUMNS = ["amenities", "pets_allowed"]

# Columns filled with the table median.
MEDIAN_FILL_COLUMNS = ["bathrooms", "bedrooms"]

SPARSE_COLUMNS = ["address"]

# Amenities: flag column -> the value looked for (27, in this order).
AMENITY_FLAGS = {
    "am_parking": "Parking",
    "am_pool": "Pool",
    "am_gym": "Gym",
    "am_patio_deck": "Patio/Deck",
    "am_washer_dryer": "Washer Dryer",
    "am_storage": "Storage",
    "am_clubhouse": "Clubhouse",
    "am_dishwasher": "Dishwasher",
    "am_ac": "AC",
    "am_refrigerator": "Refrigerator",
    "am_fireplace": "Fireplace",
    "am_cable_or_satellite": "Cable or Satellite",
    "am_playground": "Playground",
    "am_internet_access": "Internet Access",
    "am_wood_floors": "Wood Floors",
    "am_gated": "Gated",
    "am_tennis": "Tennis",
    "am_tv": "TV",
    "am_elevator": "Elevator",
    "am_basketball": "Basketball",
    "am_hot_tub": "Hot Tub",
    "am_garbage_disposal": "Garbage Disposal",
    "am_view": "View",
    "am_alarm": "Alarm",
    "am_doorman": "Doorman",
    "am_luxury": "Luxury",
    "am_golf": "Golf",
}
AMENITIES_VOCAB = list(AMENITY_FLAGS.values())

PETS_VOCAB = ["Cats", "Dogs"]

# Price mentions in free text: "$1,250", "1250$", "1250 usd", "1250 per month", "1250/mo".
# Case-insensitive; the three alternatives are kept as written.
PRICE_PATTERN = (
    r"\$\s?\d[\d,.]*"
    r"|\b\d{3,5}\s?\$"
    r"|\b\d{3,5}\s?(?:usd|per\s+month|/\s?mo(?:nth)?)\b"
)

# Segment markers searched in the cleaned body text (case-insensitive).
LUXURY_PATTERN = r"luxur|upscale|premium|high[- ]end"
RENOVATED_PATTERN = r"renovat|remodel|updated|newly"

# First number of a money string, e.g. "$1,782 - $1,917" -> "1,782".
MONEY_FIRST_NUMBER_PATTERN = r"\$?\s*([\d,]+)"

# Columns that together identify one physical property.
DEDUP_KEYS = ["latitude", "longitude", "square_feet", "bedrooms", "bathrooms"]
DEDUP_KEY_DECIMALS = 6

# Raw numeric features and low-cardinality categoricals of the baseline.
RAW_NUMERIC = ["bathrooms", "bedrooms", "square_feet", "latitude", "longitude"]
LOW_CARD_CATEGORICAL = ["category", "fee", "has_photo", "source", "state"]
HIGH_CARD_CATEGORICAL = ["cityname", "state"]
TEXT_COLUMNS = ["title_clean", "body_clean"]

# How a model uses a column; columns not named here are numeric if their type is.
COLUMN_ROLES = {
    "category": ("low_card",),
    "fee": ("low_card",),
    "has_photo": ("low_card",),
    "source": ("low_card",),
    "state": ("low_card", "high_card"),
    "cityname": ("high_card",),
}

# Columns never fed to a model directly.
NON_FEATURE_COLUMNS = [
    "id",
    "title",
    "body",
    "title_clean",
    "body_clean",
    "amenities",
    "pets_allowed",
    "time",
    "posted_at",
    "listing_group",
]

# Feature-name prefixes -> importance group, first match wins.
IMPORTANCE_GROUPS = [
    ("am_", "amenities"),
    ("pets_", "pets"),
    ("text_svd_", "listing text"),
    ("high_card__", "city and state"),
    ("low_card__", "categorical"),
]
IMPORTANCE_DEFAULT_GROUP = "numeric"

# One-hot: levels seen fewer times than this are pooled.
ONEHOT_MIN_FREQUENCY = 50
ONEHOT_INFREQUENT_LABEL = "infrequent_sklearn"

# Target encoding folds; TF-IDF / SVD sizes; KNN neighbours.
TE_FOLDS = 5
TFIDF_MAX_FEATURES = 20_000
TFIDF_MIN_DF = 5
SVD_COMPONENTS = 100
KNN_K = 10

# PCA grid of the dimensionality sweep.
PCA_GRID = [2, 5, 10, 20, 40, 80]

# Scoring fallback MAE when no run log is available.
FALLBACK_MAE = 160.2

# Scoring request bounds.
REQUEST_BOUNDS = {
    "square_feet": (100.0, 6000.0),
    "bedrooms": (0.0, 9.0),
    "bathrooms": (1.0, 9.0),
    "latitude": (-90.0, 90.0),
    "longitude": (-180.0, 180.0),
}
REQUEST_MAX_TITLE = 500
REQUEST_MAX_BODY = 5000

# ---------------------------------------------------------------------------
# Our own defaults (not taken from anywhere else).
# ---------------------------------------------------------------------------

# English stop words used by the relational TF-IDF (a parameter; pass your own).
ENGLISH_STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and",
    "any", "are", "as", "at", "be", "because", "been", "before", "being", "below",
    "between", "both", "but", "by", "can", "could", "did", "do", "does", "doing",
    "down", "during", "each", "few", "for", "from", "further", "had", "has", "have",
    "having", "he", "her", "here", "hers", "herself", "him", "himself", "his", "how",
    "i", "if", "in", "into", "is", "it", "its", "itself", "just", "me", "more", "most",
    "my", "myself", "no", "nor", "not", "now", "of", "off", "on", "once", "only", "or",
    "other", "our", "ours", "ourselves", "out", "over", "own", "same", "she", "should",
    "so", "some", "such", "than", "that", "the", "their", "theirs", "them",
    "themselves", "then", "there", "these", "they", "this", "those", "through", "to",
    "too", "under", "until", "up", "very", "was", "we", "were", "what", "when",
    "where", "which", "while", "who", "whom", "why", "will", "with", "would", "you",
    "your", "yours", "yourself", "yourselves",
]

# Accent folding for Latin letters (same positions in both strings).
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


assert len(ACCENTED) == len(UNACCENTED)
