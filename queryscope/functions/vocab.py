"""Fixed values that must equal the reference's for identical results.

They are stated here plainly, in one place, so that every operator and the
SQL oracle use the same spelling.
"""

# --- fixed values: event vocabulary ---------------------------------------
SEARCH_CATEGORY = "global search"
SUBMIT = "global_search_submit"
CLICK = "global_search_click_result"
REFINEMENT = "global_search_refinement"
PAGE_VIEW = "page_view"
RESULT_PAGE = "search result page"

# --- fixed values: submit-label suffix -> search_type (first match wins) ---
SEARCH_TYPE_SUFFIXES = [
    ("default", "default_search"),
    ("auto suggestion", "auto_suggestion"),
    ("keyword box", "keyword_box"),
]
SEARCH_TYPE_OTHER = "other"

# --- fixed values: country -> region buckets (anything else -> Other) -------
REGION_COUNTRIES = [
    ("North America", ["US", "CA"]),
    ("Europe", ["GB", "DE", "SE", "FR", "IT", "ES"]),
    ("Asia", ["CN", "JP", "KR"]),
]
REGION_OTHER = "Other"

# --- fixed values: zero-result term categories (first match wins) ----------
TERM_CATEGORIES = [
    ("Comparison Query", ["vs", "versus", "compare", "or"]),
    ("Pricing Query", ["price", "cost", "msrp", "lease"]),
    ("Feature/Spec Query", ["mpg", "horsepower", "hp", "range", "battery"]),
]
TERM_SINGLE_WORD = "Single Word (Broad)"
TERM_OTHER = "Other"

# --- fixed values: dashboard data-quality labels and colour bands ----------
DQ_COMPLETE = "✅ Complete"
DQ_MINOR = "⚠️ Minor Issues (<5%)"
DQ_MODERATE = "⚠️ Moderate Issues (5-15%)"
DQ_MAJOR = "🔴 Major Issues (>15%)"
DQ_MINOR_MAX = 0.05
DQ_MODERATE_MAX = 0.15

COLOR_GOOD = "#10B981"
COLOR_OK = "#F59E0B"
COLOR_BAD = "#EF4444"
ENGAGEMENT_GOOD_MIN = 0.65
ENGAGEMENT_OK_MIN = 0.50
ZERO_RATE_GOOD_MAX = 0.05
ZERO_RATE_OK_MAX = 0.15

# --- fixed values: pipeline parameters stated by the reference -------------
ATTRIBUTION_WINDOW_DAYS = 30
METRIC_WINDOW_DAYS = 30
RECORD_COUNT_TOLERANCE = 100
RETENTION_CURATED_MONTHS = 13
RETENTION_RAW_MONTHS = 3
TOP_ZERO_TERMS_SQL = 50
TOP_ZERO_TERMS_REPORT = 20
TYPO_MAX_MATCHES = 3
TYPO_CUTOFF = 0.6
