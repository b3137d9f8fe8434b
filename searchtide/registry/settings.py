"""Parameters shared by the registered queries and their SQL."""

from __future__ import annotations

from searchtide.operators.quality import at_most, listed, unique
from searchtide.plans.trending import TrendRules
from searchtide.vocab import GENRES

RUN_ID = "check"
SINCE = "2024-01-20"
LOOKUP_DAY = "2024-01-12"
#: from this day on the trending query has new keywords; until this day folder the first arrival of a stream reaches
NEW_SINCE, ARRIVED_UNTIL = "2024-01-25", "20240122"
#: what the patterns know, each of them at least once, and near misses of them
PHRASES = (
    "anime", "One-Piece", "one piece", "animes", "bong da", "bong-da", "bongda", "bong  da", "World Cup", "euro", "europe", "nhac", "nhac-tre", "mv", "mvp",
    "phim viet", "phim-vn", "phim vienam", "phim han", "phim kbs", "phim trung", "phim tq", "phim my", "phim au my", "phim mym", "vtv", "vtv3", "HTV 7", "truyen hinh",
    "truyen_hinh", "anime nhac", "nhac anime", "phim", "bóng đá",
)
#: the benchmark events span thirty days, so the baseline lies three weeks back
TREND = TrendRules(baseline_age=21, min_growth=1.05)
FILTER_TEXT, FILTER_GENRE = "BLUE", "THE_THAO"

#: keyword table made of part names: last word -> genre
LUT_WORDS = (("rod", "PHIM_VIET"), ("plate", "PHIM_AU_MY"))
RESOLVED_WORD = "anvil"
#: answers of a made-up classifier: last word -> what it writes
VERDICT_WORDS = (("gizmo", "KDRAMA"), ("ring", "NHAC"), ("widget", "CARTOON"), ("bolt", "THE_THAO"))

QUALITY_RULES = (
    listed("derived_genre", GENRES),
    listed("derived_genre", ("PHIM_HAN", "NHAC")),
    listed("subscription_count", ("0", "2"), 0.7),
    listed("subscription_count", ("0", "1"), 0.93),
    at_most("subscription_count", 15),
    at_most("subscription_count", 1),
    unique("event_id", 0.85),
    unique("keyword_norm", 0.1),
)
