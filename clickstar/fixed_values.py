"""Fixed values.

Event names, rule tables, thresholds and formats that have to be exactly these
for results to be right. They are data: the functions that apply them live in
``clickstar.functions`` and ``clickstar.operators``.
"""

UNKNOWN = "unknown"
KEY_SEPARATOR = "|"

# Event names that carry a flag.
CONVERSION_EVENTS = ["purchase", "conversion", "generate_lead"]
LEAD_EVENTS = ["generate_lead", "form_submit", "contact"]
PAGE_VIEW_EVENT = "page_view"
SCROLL_EVENT = "scroll"

# Event parameter keys read as text.
TEXT_PARAMS = [
    "page_location", "page_title", "page_referrer",
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "lead_id", "conversion_value",
]
# Event parameter keys read as integers.
INT_PARAMS = ["ga_session_id", "session_engaged"]

# Fixed value: the host part of a page address.
PAGE_DOMAIN_PATTERN = "https?://([^/]+)"

# Category of an event name, first hit wins, else "Other".
EVENT_CATEGORIES = [
    ("View", ["page_view", "view_item", "view_item_list"]),
    ("Engagement", ["click", "select_content", "file_download"]),
    ("Lead", ["generate_lead", "form_submit", "contact"]),
    ("Conversion", ["purchase", "conversion", "add_to_cart", "begin_checkout"]),
    ("Search", ["search", "view_search_results"]),
    ("Engagement", ["scroll", "video_start", "video_progress"]),
]

# Device type of a device category, else "Other".
DEVICE_TYPES = [
    ("Mobile", ["mobile"]),
    ("Tablet", ["tablet"]),
    ("Desktop", ["desktop"]),
]

# Region group of a country, else "Other".
REGION_GROUPS = [
    ("North America", ["United States", "Canada", "Mexico"]),
    ("Latin America", ["Brazil", "Argentina", "Chile", "Colombia"]),
    ("Europe", ["Spain", "United Kingdom", "France", "Germany", "Italy"]),
    ("Asia", ["China", "Japan", "India", "South Korea"]),
]

# Channel group of (source, medium), first hit wins, else "Other".
CHANNEL_GROUPS = [
    ("Organic Search", {"medium": ["organic"], "source": ["google", "bing", "yahoo"]}),
    ("Paid Search", {"medium": ["cpc", "ppc", "paidsearch"]}),
    ("Paid Search", {"source": ["google", "bing"], "medium_contains": "cpc"}),
    ("Social", {"medium": ["social", "social-network", "social-media", "sm",
                           "social advertising"]}),
    ("Social", {"source": ["facebook", "instagram", "twitter", "linkedin", "pinterest",
                           "tiktok"]}),
    ("Email", {"medium": ["email"]}),
    ("Direct", {"source": ["(direct)"], "medium": ["(none)", "(not set)"]}),
    ("Referral", {"medium": ["referral"]}),
    ("Display", {"medium": ["display", "banner", "cpm"]}),
]

# Channel type of a medium, else "Other".
CHANNEL_TYPES = [
    ("Organic", ["organic"]),
    ("Paid", ["cpc", "ppc", "paidsearch"]),
    ("Social", ["social", "social-network"]),
    ("Email", ["email"]),
    ("Referral", ["referral"]),
    ("Display", ["display", "banner"]),
]
OTHER = "Other"

# Calendar range and public holidays.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"
HOLIDAYS = ["2024-01-01", "2024-12-25", "2024-12-31"]

# Alert and report thresholds.
GB = 1e9
TB = 1e12
VOLUME_DROP = -0.20
HIGH_COST_QUERY_TB = 1
HIGH_COST_DAY_TB = 5
LARGE_PARTITION_GB = 2
SMALL_PARTITION_GB = 0.5
LARGE_QUERY_GB = 1
CLUSTERING_BENEFIT = 0.5
MISSING_SESSION_SHARE = 0.01
FACT_STAGE_TOLERANCE = 5
EVENTS_PER_SESSION_RANGE = (1, 1000)
EXPECTED_EVENTS = 100
EXPECTED_SESSIONS = 10
EXPECTED_FACTS = 10
VALUE_TOLERANCE = 0.1
RETENTION_YEARS = 2
STALE_DAYS = 2

# Labels of the partition-size report.
PARTITION_TOO_SMALL = "Muy pequeña - considerar consolidar"
PARTITION_TOO_LARGE = "Muy grande - considerar subparticionar"
PARTITION_OPTIMAL = "Tamaño óptimo"
# Labels of the clustering report.
CLUSTERING_EFFECTIVE = "Clustering efectivo"
CLUSTERING_NOT_EFFECTIVE = "Clustering no efectivo"
# Fixed value: a partition literal in query text.
PARTITION_LITERAL_PATTERN = r"""event_date_partition\s*=\s*['"]?([^'"]+)"""
