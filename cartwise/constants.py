"""Fixed values that must equal the original pipeline's for equal results.

They are stated here once, in natural order, and imported everywhere else.
"""

# --- fixed values -----------------------------------------------------------

# Shop screens (``child_tab``) counted by the click features.
TAB_CLOTH = "UIMallCloth"
TAB_MALL = "UIMall"
TAB_APPEARANCE = "UIDtsAppearanceMall"
CLICK_TABS = (TAB_CLOTH, TAB_MALL, TAB_APPEARANCE)
# Screens whose records count as "opens".
OPEN_TABS = (TAB_CLOTH, TAB_MALL)

# Shop types counted as purchases by the role x item feature table.
BUY_MALL_TYPES = ("MallCloth", "MallGiftBag", "AppearanceMallHot")

# Items never recommended nor scored by the ranking evaluation.
RANK_BLACKLIST = (978, 988, 989, 990, 991, 992, 993, 994, 995)
# Items removed from the factorisation interactions.
MF_INTERACTION_BLACKLIST = (1, 10000, 9, 9001, 9019, 1020, 1018, 1014, 0, 2, 45)
# Items removed from the factorisation recommender's catalog.
MF_CATALOG_BLACKLIST = (991, 992, 993, 994, 995)

# Look-back windows (days) of the pair / role / item features.
PAIR_CLICK_WINDOWS = (1, 3, 7, 14, 21)
PAIR_BUY_WINDOWS = (1, 3, 7, 21)
ROLE_CLICK_WINDOWS = (1, 3, 7)
ROLE_BUY_WINDOWS = (1, 3, 7, 14, 21)
ITEM_CLICK_WINDOWS = (1, 3, 7, 21)
ITEM_BUY_WINDOWS = (1, 3, 7, 14, 21)
RECENCY_FLAG_WINDOWS = (1, 3, 7)
# Masked per-day windows of the early feature variant (names: 1, 3, week, month).
MASKED_WINDOWS = ((1, "1"), (3, "3"), (7, "week"), (30, "month"))

# Role x item table: window names and upper ages (ages <= N; "month" = whole scan).
RI_WINDOWS = (("day", 1), ("day3", 3), ("week", 7))
# Open windows use ages < N.
OPEN_WINDOWS = (("day", 1), ("day3", 3), ("week", 7))
# Guarded CTR floors per tab and window: day, day3, week, month.
CTR_FLOORS = {
    TAB_CLOTH: {"day": 5, "day3": 5, "week": 5, "month": 5},
    TAB_MALL: {"day": 3, "day3": 4, "week": 6, "month": 10},
}

# Sentinels used for missing values after joins.
MISSING_BUY = -1
MISSING_CLICK = 0
MISSING_DAY = 100
MISSING_GAP = -1
MISSING_RANK = -1
UNSEEN_PAIR_SCORE = -2.0
DEFAULT_FILL_SCORE = 0.05

# Cut-offs of the hit@k / revenue@k report.
HIT_KS = (1, 3, 5, 10, 15, 20, 25)

# Avatar attributes read from the ``wear`` text.
AVATAR_KEYS = ("Gender", "Tshirt", "Pants", "Hat", "Hair")

# New-item bands (days before the as-of day).
NEW_ITEM_RECENT_DAYS = 7
NEW_ITEM_BAND = (14, 7)

# Top sellers: the last three days, top one.
TOP_SELLER_DAYS = 3
TOP_SELLER_N = 1

# Factorisation and boosted-tree sizes.
MF_RANK = 10
MF_EPOCHS = 10
MF_BAND_DAYS = 7
GBT_STEP = 0.02
GBT_DEPTH = 4
GBT_LEAVES = 15
GBT_FEATURE_FRACTION = 0.4
GBT_SUBSAMPLE = 0.6
GBT_BAG_ROUNDS = 17
GBT_ROUNDS = 10_000
GBT_PATIENCE = 20
ITEM_RATE_PRIOR = 10
HOLDOUT_FRACTION = 0.2
HOLDOUT_SEED = 21

# Beta-binomial smoothing demo: start, tolerance, round cap.
SMOOTH_START = (1.0, 1.0)
SMOOTH_EPSILON = 1e-7
SMOOTH_MAX_ROUNDS = 1000
