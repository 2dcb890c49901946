"""Default tables of points and limits; every one of them is a parameter of the operator that reads it."""

from __future__ import annotations

# Points of a source by its tier, group and role, and the most they may add up to.
TIER_POINTS = {"T1": 14.0, "T1_5": 11.0, "T2": 7.0}
GROUP_POINTS = {"regulator": 7.0, "exchange": 7.0, "official": 7.0, "wire": 6.0, "media": 4.5, "sector_media": 3.5, "technical_platform": 3.0, "social": 1.5, "kol": 1.0}
ROLE_POINTS = {"verification": 4.0, "discovery_and_verification": 3.5, "discovery_and_context": 2.5, "context": 2.0, "directed_monitoring": 1.5, "discovery": 1.5, "discovery_only": 0.5}
OTHER_TIER, OTHER_GROUP, OTHER_ROLE = 6.0, 3.0, 1.5
MISSING_SOURCE = {"tier": "T2", "source_group": "media", "role": "discovery_and_context"}
MOST_POINTS = 25.0

# Points of a place in a ranking and of the ranking's name.
PLACE_STEPS = [(1, 15.0), (3, 13.0), (5, 11.0), (10, 8.0), (20, 5.0)]
PLACE_BEYOND, UNRANKED = 3.0, 6.0
LIST_NAMES = [
    (10.0, ["homepage_top", "news_homepage", "business_homepage", "technology_homepage", "top_headlines"]),
    (8.0, ["homepage_rank_proxy", "important_flash", "headline", "hot_article", "latest"]),
    (6.0, ["most_popular", "hotrank", "hot_rank", "trending"]),
]
LIST_PARTS = [(8.0, ["homepage", "top"]), (6.0, ["hot", "popular", "trend"])]
LIST_BLANK, LIST_OTHER = 2.0, 4.0

# Points by age in hours, and what a main and a related report gain.
RECENCY_STEPS = [(6, 4.0), (24, 2.0), (48, -3.0)]
RECENCY_BEYOND = -8.0
MAIN_BONUS, RELATED_BONUS = 4, -12
KNEE, SLOPE = 88, 0.5

# Weights of a source's tier and of the surface an item was found on, for the rank signal.
TIER_WEIGHTS = {"T1": 1.2, "T1_5": 1.05, "T2": 0.9}
SURFACE_WEIGHTS = {"homepage": 1.0, "frontpage": 1.0, "top-news": 0.95, "hot": 0.95, "popular": 0.9, "trending": 0.9, "rss": 0.72, "feed": 0.72, "search": 0.62, "profile": 0.55, "keyword": 0.55}
OTHER_TIER_WEIGHT, OTHER_SURFACE_WEIGHT = 0.9, 0.7
PLACE_LOSS, LEAST_PLACE, UNRANKED_PLACE, SIGNAL_SCALE = 0.075, 0.15, 0.55, 1.2
FRESH_HOURS, LEAST_FRESH, UNKNOWN_FRESH = 36.0, 0.05, 0.35

# Parts of an event's score inside its section.
SIGNAL_SHARE, FRESH_SHARE = 0.38, 0.22
SOURCE_BONUS, SOURCE_BONUS_MOST = 0.06, 0.25
ITEM_BONUS, ITEM_BONUS_MOST = 0.03, 0.12
TIER_BONUS = {"T1": 0.18, "T1_5": 0.1, "T2": 0.04}

# Which tier and which group of sources an event's main report comes from first.
TIER_ORDER = {"T1": 0, "T1_5": 1, "T2": 2}
GROUP_ORDER = {"official": 0, "regulator": 0, "exchange": 0, "wire": 1, "media": 2, "sector_media": 3, "technical_platform": 4, "trend": 5, "social": 6, "kol": 7}
OTHER_TIER_ORDER, OTHER_GROUP_ORDER = 9, 8
