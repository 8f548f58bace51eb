"""They must equal the published ones for results to match.

Thresholds, colours, axis names, texts and the demo rows. Nothing here is derived.
"""

# Win-rate tiers are right-closed ranges; a rate outside all of them is B-Tier.
TIER_RANGES = [
    ("C-Tier", 0.0, 49.0),
    ("B-Tier", 49.0, 51.0),
    ("A-Tier", 51.0, 53.0),
    ("S-Tier", 53.0, 100.0),
]
DEFAULT_TIER = "B-Tier"
TIERS_BEST_FIRST = ["S-Tier", "A-Tier", "B-Tier", "C-Tier"]
TIERS_WORST_FIRST = ["C-Tier", "B-Tier", "A-Tier", "S-Tier"]

BASELINE_RATE = 50.0
DEFAULT_MATCHES_PLAYED = 1000
SMALL_FEED_ROWS = 3
SMALL_FEED_SCORE = 50.0

# Colours of the tier map and of the comparison bars, with their defaults.
TIER_MAP_COLORS = {
    "S-Tier": "#FFD700",
    "A-Tier": "#9B59B6",
    "B-Tier": "#3498DB",
    "C-Tier": "#64748B",
}
TIER_MAP_DEFAULT = "#64748b"
TIER_BAR_COLORS = {
    "S-Tier": "#ffd700",
    "A-Tier": "#9b59b6",
    "B-Tier": "#3498db",
    "C-Tier": "#64748b",
}
TIER_BAR_DEFAULT = "#00f2fe"

ICON_URL_PREFIX = "https://cdn.communitydragon.org/latest/champion/"
ICON_URL_SUFFIX = "/square"

# Panel sizes and ranges.
LATEST_MATCHES = 20
PREVIEW_ROWS = 5
TOP_BARS = 10
TOP_SERIES = 5
MAX_SELECTION = 5
HISTOGRAM_BINS = 15
CURVE_POINTS = 300
SLIDER_DEFAULT = (40.0, 60.0)
SLIDER_INITIAL = (44.0, 57.0)
AXIS_START = 40.0
TOP_AXIS = (2.5, 53.0)
SELECTED_AXIS = (3.5, 54.0)
ABOVE_BASELINE_SHIFT = 10
ABOVE_BASELINE_SCALE = 5
BUBBLE_SPAN = 26
BUBBLE_MIN = 8
HIGHLIGHT_SCALE = 1.9

RADAR_AXES = ["Win Rate", "Popularity", "Above Baseline", "Overall Score"]
QUADRANT_DOMINANT = "Meta Dominants"
QUADRANT_GEM = "Hidden Gems"
QUADRANT_HIGH_VOLUME = "High-Volume low WR"
QUADRANT_NICHE = "Niche & Weak"

# Demo feed: champion, win_rate_pct, matches_played.
DEMO_ROWS = [
    ("Jinx", 55.8, 38000),
    ("Katarina", 54.3, 22000),
    ("Fiora", 53.9, 15000),
    ("Lux", 52.7, 42000),
    ("Ahri", 52.1, 35000),
    ("Yasuo", 51.8, 45000),
    ("Zed", 51.4, 30000),
    ("Thresh", 51.1, 28000),
    ("Leona", 51.0, 19000),
    ("Orianna", 51.2, 17000),
    ("Lee Sin", 50.6, 40000),
    ("Jhin", 50.4, 33000),
    ("Ezreal", 50.1, 36000),
    ("Tristana", 49.8, 25000),
    ("Vayne", 49.6, 29000),
    ("Syndra", 49.9, 14000),
    ("Viktor", 50.3, 12000),
    ("Cassiopeia", 49.7, 8000),
    ("Garen", 49.5, 6000),
    ("Renekton", 50.2, 18000),
    ("Camille", 50.0, 11000),
    ("Akali", 49.3, 16000),
    ("Azir", 48.4, 9000),
    ("Ryze", 47.9, 13000),
    ("Kalista", 47.2, 5000),
    ("Irelia", 46.8, 21000),
    ("Gangplank", 46.1, 7000),
    ("Taliyah", 45.5, 4000),
    ("Corki", 44.9, 3500),
    ("Shaco", 44.1, 3000),
]
