"""Raw events to the curated table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from searchtide import vocab
from searchtide.functions import identity, moments, subscriptions, text
from searchtide.operators.classify import NEAR_MIN_LENGTH, Patterns, classify
from searchtide.operators.dedup import keep_first_event
from searchtide.operators.repeats import HOT_ROWS, mark_repeats
from searchtide.schemas import CURATED


@dataclass(frozen=True)
class CurationRules:
    """What a deployment may change. The defaults are the built-in fallback tables."""

    patterns: Patterns = vocab.GENRE_PATTERNS
    platforms: Mapping[str, str] = field(default_factory=lambda: vocab.PLATFORM_GROUPS)
    networks: Mapping[str, str] = field(default_factory=lambda: vocab.NETWORK_GROUPS)
    premium_plans: Sequence[str] = vocab.PREMIUM_PLANS
    near_spellings: bool = False
    #: shorter keywords take no near spelling
    near_min_length: int = NEAR_MIN_LENGTH
    near_edits: int = 1
    split_null_sessions: bool = False
    #: sessions with more rows are cut into pieces for the repeat flag
    hot_session_rows: int = HOT_ROWS


def usable_events(raw: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Add ``event_ts`` and drop events whose time is unreadable or from a corrupt year.

    ``seen`` counts the events before they are dropped.
    """
    timed = raw.withColumn("event_ts", moments.event_moment(F.col("datetime")))
    if seen is not None:
        # also keeps the condition above the parsed column, so each time is parsed once
        timed = timed.observe(seen, F.count(F.lit(1)).alias("rows"))
    return timed.where(F.year("event_ts") >= vocab.FIRST_GOOD_YEAR)


def with_session_key(events: DataFrame) -> DataFrame:
    return events.withColumn(
        "session_key",
        identity.session_text(F.col("user_id"), F.col("proxy_isp"), F.col("platform"), F.col("event_ts")),
    )


def with_keyword(events: DataFrame) -> DataFrame:
    return events.withColumn("keyword_norm", text.normalize_keyword(F.col("keyword")))


def prepared_events(
    events: DataFrame,
    lut: DataFrame | None = None,
    rules: CurationRules = CurationRules(),
    repeats: bool = True,
) -> DataFrame:
    """Deduplicated events with genre, ISO day and repeat flag, still with the narrow raw columns.

    Everything wide (hashes, plan arrays) is left to :func:`finished`, after the last shuffle.
    ``repeats=False`` skips the repeat flag for readers that do not need it.
    """
    return with_genre(marked_events(events, rules, repeats), lut, rules)


def marked_events(events: DataFrame, rules: CurationRules = CurationRules(), repeats: bool = True) -> DataFrame:
    """Deduplicated events with keyword, session and repeat flag: what does not depend on the keyword table."""
    narrow = with_session_key(with_keyword(keep_first_event(events)))
    if repeats:
        # sessions are counted before copies are removed, which spares a second deduplication
        return mark_repeats(narrow, rules.split_null_sessions, with_session_key(events), rules.hot_session_rows)
    return narrow.withColumn("is_repeat_search", F.lit(None).cast("boolean"))


def with_genre(marked: DataFrame, lut: DataFrame | None = None, rules: CurationRules = CurationRules()) -> DataFrame:
    """Marked events with genre and ISO day."""
    classified = classify(marked, lut, rules.patterns, rules.near_spellings, rules.near_min_length, rules.near_edits)
    return classified.withColumn("dt", moments.iso_day(F.col("dt")))


def finished(prepared: DataFrame, run_id: str = "unknown", rules: CurationRules = CurationRules()) -> DataFrame:
    """The curated columns in their declared order."""
    plans = F.col("userplansmap")
    derived = {
        "event_id": F.col("eventid"),
        "hour_of_day_vn": moments.local_hour(F.col("event_ts")),
        "user_id_hashed": identity.hashed(F.col("user_id")),
        "user_is_authenticated": F.col("user_id").isNotNull(),
        "session_action": identity.session_action(F.col("category")),
        "is_search_abandoned": identity.is_abandoned(F.col("category")),
        "platform_group": text.grouped(F.col("platform"), rules.platforms, vocab.OTHER_PLATFORM),
        "network_type_norm": text.grouped(F.col("networktype"), rules.networks, vocab.OTHER_NETWORK),
        "isp_segment": F.upper("proxy_isp"),
        "has_premium": subscriptions.has_premium(plans, rules.premium_plans),
        "subscription_count": subscriptions.plan_count(plans),
        "plan_names": subscriptions.plan_names(plans),
        "search_session_id": identity.hashed(F.col("session_key")),
        "_pipeline_run_id": F.lit(run_id),
    }
    return prepared.select(*[derived.get(name, F.col(name)).alias(name) for name in CURATED.names])


def curated(
    raw: DataFrame,
    lut: DataFrame | None = None,
    rules: CurationRules = CurationRules(),
    run_id: str = "unknown",
    repeats: bool = True,
) -> DataFrame:
    """The curated table as a query over raw events."""
    return finished(prepared_events(usable_events(raw), lut, rules, repeats), run_id, rules)
