"""Fixed values of the search domain. They decide results, so they are listed plainly."""

from __future__ import annotations

# --- fixed values: genre codes -------------------------------------------------------------
GENRES = (
    "PHIM_TRUNG", "PHIM_VIET", "PHIM_HAN", "PHIM_AU_MY", "ANIME",
    "THE_THAO", "NHAC", "TRUYEN_HINH", "UNKNOWN", "EMPTY_QUERY",
)
UNKNOWN = "UNKNOWN"
EMPTY_QUERY = "EMPTY_QUERY"
#: genres a classifier may answer with
VERDICT_CODES = tuple(g for g in GENRES if g != EMPTY_QUERY)
#: buckets that are not a real genre
UNCLASSIFIED = (UNKNOWN, EMPTY_QUERY)

# --- fixed values: spellings a classifier uses for a genre ----------------------------------
GENRE_ALIASES = {
    "PHIM_CHINA": "PHIM_TRUNG", "PHIM_TQ": "PHIM_TRUNG", "PHIM_TRUNG_QUOC": "PHIM_TRUNG",
    "PHIM_KOREAN": "PHIM_HAN", "KDRAMA": "PHIM_HAN", "K_DRAMA": "PHIM_HAN",
    "PHIM_JAPAN": "ANIME", "PHIM_NHAT": "ANIME", "CARTOON": "ANIME", "HOAT_HINH": "ANIME",
    "KPOP": "NHAC", "K_POP": "NHAC",
    "VARIETY": "TRUYEN_HINH", "SHOW": "TRUYEN_HINH",
    "PHIM_CHIEU_RAP": "PHIM_AU_MY",
}

# --- fixed values: keyword patterns, first match wins ---------------------------------------
# Each pattern is searched for between word boundaries, ignoring case.
GENRE_PATTERNS = (
    ("ANIME", r"anime|manga|naruto|one[\s-]?piece|doraemon|conan"),
    ("THE_THAO", r"bong[\s-]?da|world[\s-]?cup|premier[\s-]?league|champions[\s-]?league|the[\s-]?thao|euro"),
    ("NHAC", r"nhac|music|mv|karaoke|sing|son[\s-]?tung"),
    ("PHIM_VIET", r"phim[\s-]?(viet|vn|vietnam)"),
    ("PHIM_HAN", r"phim[\s-]?(han|korea|kbs|sbs)"),
    ("PHIM_TRUNG", r"phim[\s-]?(trung|tq|hoa|china)"),
    ("PHIM_AU_MY", r"phim[\s-]?(my|au[\s-]?my|hollywood)"),
    ("TRUYEN_HINH", r"vtv|htv|vtc|truyen[\s-]?hinh"),
)

# --- fixed values: device and network groups ------------------------------------------------
PLATFORM_GROUPS = {
    "android": "Mobile", "androidtv": "TV", "ios": "Mobile",
    "iphone": "Mobile", "ipad": "Mobile", "smarttv": "TV",
    "samsung": "TV", "lg": "TV", "web": "Web", "browser": "Web",
}
OTHER_PLATFORM = "Other"
NETWORK_GROUPS = {"wifi": "wifi", "4g": "mobile", "5g": "mobile", "3g": "mobile"}
OTHER_NETWORK = "unknown"

# --- fixed values: plans, queries that are interface artefacts ------------------------------
PREMIUM_PLANS = ("VIP", "HBO GO+", "K+", "MAX")
META_QUERIES = ("tìm kiếm bằng giọng nói",)

# --- fixed values: characters not sent to a classifier, and the fences around its replies ------
UNSENDABLE = r"[\x00-\x1f\x7f\\]"
REPLY_FENCE = r"(?dm)^```(?:json)?\s*|\s*```$"

# --- fixed values: digits found in event times ------------------------------------------------
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
EXTENDED_ARABIC_DIGITS = "۰۱۲۳۴۵۶۷۸۹"

# --- fixed values: numbers ------------------------------------------------------------------
FIRST_GOOD_YEAR = 2015
LOCAL_OFFSET_HOURS = 7
SESSION_SECONDS = 1800
RETENTION_FLOOR = 0.7

# --- fixed values: columns a role may not see -----------------------------------------------
HIDDEN_COLUMNS = {
    "lut_refresh": ("user_id_hashed", "search_session_id", "has_premium", "subscription_count"),
    "reports": (),
    "quality": (),
    "curation": (),
}
