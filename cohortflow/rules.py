"""Rule data: bands, lists, patterns and the cuisine taxonomy.

All classification operators take these as arguments; the values below are only defaults.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------
# FIXED VALUES. These must equal the upstream business rules for results to match; they are
# stated here as plain data, in their natural order.
# ---------------------------------------------------------------------------------------

# Bands are (low, high, label), both ends inclusive; None = open end. First match wins.
ORDER_COUNT_BANDS = [(0, 0, "0"), (1, 1, "1"), (2, 4, "2-4"), (5, 10, "5-10"), (11, None, "10+")]
RECENCY_BANDS = [(None, 45, "30-45"), (46, 60, "45-60"), (61, 90, "60-90"), (91, 120, "90-120")]
RECENCY_ELSE = "120+"
TX_COUNT_BANDS = [(0, 0, "0"), (1, 10, "1-10"), (11, 20, "11-20"), (21, 50, "21-50"), (51, None, "50+")]
LAST_SEEN_BANDS = [
    (0, 7, "0-7"), (8, 14, "8-14"), (15, 21, "15-21"), (22, 30, "22-30"), (31, 45, "31-45"),
    (46, 60, "46-60"), (61, 90, "61-90"), (91, 120, "91-120"),
]
LAST_SEEN_NULL = "n/a"
LAST_SEEN_ELSE = "120+"
USAGE_BANDS = [(None, 3, "Low"), (4, 9, "Medium"), (10, 24, "High")]
USAGE_ELSE = "Power"
# Spend: > 25 high, 15..24 medium, everything else (gap 24-25, NULL) low.
SPEND_RULES = [(">", 25, "high"), ("between", (15, 24), "medium")]
SPEND_ELSE = "low"
DISTANCE_RULES = [(">", 16, "high"), ("between", (12, 16), "medium"), ("<", 12, "low")]
DURATION_RULES = [(">", 20, "high"), ("between", (14, 20), "medium"), ("<", 14, "low")]
TRIP_COUNT_RULES = [(">", 8, "high"), ("between", (5, 8), "medium"), ("<", 5, "low")]
# Hour of day (local) buckets: [from, to) hours.
TIME_OF_DAY_RULES = [(6, 10, "Morning"), (10, 16, "Day"), (16, 20, "Evening")]
TIME_OF_DAY_ELSE = "Night"
TIME_OF_DAY_ORDER = ["Morning", "Day", "Evening", "Night"]

# Record filters: service area, completed trip outcome, completed booking status, delivered orders.
SERVICE_AREA_ID = 1
TRIP_OUTCOME_COMPLETED = 3
BOOKING_STATUS_COMPLETED = 6
DELIVERED_STATUS = "delivered"
LAPSED_SERVICE_CITIES = (1, 2)
OUTCOME_CITIES = (1,)
OUTCOME_CITIES_ALL = (1, 2)
B_ORDER_TYPE = "shops"
A_ORDER_TYPE = "food"
TAG_STATUS_ACTIVE = "active"
TAG_TYPE_CUISINE = "cuisine"
RECENT_DAYS = 30
LAPSE_MIN_DAYS = 30
GRADUATED_MIN_ORDERS = 5

# Services, places and the brand word of the second delivery service.
BASE_SERVICES = ("ride_hailing", "limo")
A_SERVICES = ("food",)
B_SERVICES = ("quik",)
HOME_CITY = "Dubai"
VALUE_COUNTRY = "united arab emirates"
B_BRAND_WORD = "quik"
SNAPSHOT_GRANULARITY = "city"
SNAPSHOT_DOMAIN = "food"
SNAPSHOT_LEVEL = "service"

# Valid ride rules.
RIDE_BUSINESS_TYPES = ["jv", "hala", "ride-hailing", "ridehailing", "ride hailing"]
VALUE_RIDE_BUSINESS_TYPES = ["ride hailing", "jv"]
EXCLUDED_PRODUCT_IDS = [1716, 1474, 1279, 1536, 1067, 368, 1723, 465, 1392]
EXCLUDED_PRODUCT_PATTERN = "%test%"

# Membership credits (one code is listed twice upstream; kept once here, same set).
CREDIT_TITLE = "marketing credits"
MEMBERSHIP_CREDIT_TYPES = [
    "careemplus", "careemplushala", "careemplusamman", "careemplus2", "careemplushala2",
    "careemplusnbdhala", "careemplusnbd",
]
CHILD_PRODUCTS = ["school rides", "kids", "careem kids", "hala kids", "hala juniors"]

# Membership type: ordered rules.
PAID_SUBSCRIPTION_TYPES = ["regular"]
PAID_PLAN_IDS = ["23", "39", "43", "55", "64"]
FREE_RENEWAL_PATTERN = "%free_renewal%"
TRIAL_COMMITMENT_PATTERN = "%trial%commitment%"
TRIAL_PATTERN = "%trial"
MEMBERSHIP_EVENT = "subscription_started"
MEMBERSHIP_AREAS = ["1", "21"]

# Demographics
GENDER_VALUES = ["female", "male"]
TOURIST_VALUES = ["tourist"]

# Saved place classes: ordered (class, name patterns, building-type patterns). First match wins;
# an unmatched name keeps itself.
PLACE_CLASSES = [
    ("work", ["%work%", "%office%", "%pwc%", "%hq%", "%mckinsey%"], ["%office%"]),
    ("sport", ["%gym%", "%yoga%", "%tennis%", "%football%", "%training%", "%swimming%", "%golf%",
               "%pilates%", "%basketball%"], []),
    ("school", ["%school%", "%university%", "%uni%", "%college%"], []),
    ("airport", ["%airport%", "%terminal%", "%dxb%", "%departures%", "%arrivals%", "%t1%", "%t2%",
                 "%t3%"], []),
    ("mall", ["%mall%", "%store%", "%emirates%", "%ikea%", "%shop%"], []),
    ("hotel", ["%hotel%", "%hôtel%", "%sheraton%", "%holiday inn%", "%premier inn%", "%hyatt%",
               "%radisson%", "%movenpick%", "%ibis%", "%novotel%", "%hilton%", "%marriott%",
               "%otel%"], []),
    ("hospital", ["%hospital%", "%clinic%", "%dentist%", "%nursery%"], []),
]
# Residential places are excluded after the best match is chosen: column -> NOT LIKE patterns.
RESIDENTIAL_EXCLUSIONS = {
    "sl_name": ["%home%", "%room%", "%house%", "%villa%", "%apartment%"],
    "sl_address_type": ["%apartment%"],
    "sl_building_type": ["%apartment%", "%villa%"],
    "sl_place_name": ["%villa%"],
}
PLACE_RADIUS_M = 100.0
EARTH_RADIUS_KM = 6371.009

# Cuisine taxonomy: group -> lower-cased tag names. 'smoothies ' carries a trailing blank on
# purpose (the source data has it); 'healthy juice' is listed twice upstream.
CUISINE_TAXONOMY = {
    "Asian": ["asian", "rice", "sushi", "noodles & ramen", "poké", "pan asian", "momos", "dumplings",
              "filipino", "afghan", "singaporean", "japanese", "vietnamese", "thai", "indonesian",
              "malaysian", "korean", "chinese", "indo-chinese", "nepali", "pan-asian"],
    "Middle Eastern & Arabic": ["middle eastern", "kebab", "doner", "shawerma", "syrian", "iranian",
                                "turkish", "kuwaiti", "palestinian", "lebanese", "emirati", "iraqi",
                                "saudi", "yemeni", "egyptian", "jordanian", "arabic", "mandi",
                                "manakish", "saj", "shawarma", "foul", "mansaf", "vine leaves",
                                "falafel"],
    "European": ["european", "french", "scandinavian", "british", "german", "continental"],
    "American": ["american", "tex-mex", "canadian", "bbq & grill"],
    "African": ["african", "afro-portuguese", "south african", "moroccan", "algerian"],
    "South Asian": ["sri lankan", "indian", "pakistani", "hyderabadi", "bengali", "gujarati", "kerala",
                    "north indian", "south indian", "biryani", "tandoor", "desi", "chettinad"],
    "Latin American": ["brazillian", "brazilian", "mexican", "burritos", "tacos", "caribbean"],
    "Mediterranean": ["greek", "pasta", "italian", "portuguese", "spanish", "mediterranean"],
    "Healthy & Specialty": ["healthy", "smoothies ", "healthy juice", "soup", "healthy food",
                            "gluten-free", "healthy juice", "acai", "smoothies", "salads", "bowls"],
    "Fast Food": ["fries", "sandwiches", "burger", "hot dog", "fried chicken", "wings", "fast food",
                  "pizza", "sandwiches & wraps", "wraps", "rolls", "grills"],
    "Desserts & Sweets": ["bakery & confectionery", "bakery", "pie", "kunafa", "desserts", "cakes",
                          "cookies", "pastries", "sweets", "ice cream", "crepes", "waffles",
                          "frozen yogurt", "donuts", "chocolates", "luqaimat", "pies"],
    "Beverages & Coffee": ["coffee", "hot beverages", "beverages", "soft drinks", "shakes", "juices",
                           "cocktails", "espresso", "tea"],
    "Cafeteria & Street Food": ["cafe", "cafeteria", "street food", "snacks", "kumpir"],
    "Seafood": ["seafood", "fish", "shrimps"],
    "Russian": ["uzbekistan", "russian", "uzbek"],
}
CUISINE_DEFAULT = "Other"

# Output labels.
ADOPTION_LABELS = ("rh-only", "rh-food", "rh-quik", "rh-food-quik")
MEMBERSHIP_STATUS_LABELS = ("Cplus Active", "Cplus Inactive")
COMMUTER_LABELS = {"Morning": "Morning Commuter", "Day": "Day Commuter", "Evening": "Evening Commuter",
                   "Night": "Night Commuter"}
PARENT_LABELS = ("Parent", "Non-Parent")
PROMO_LABELS = ("Promo Seeker", "Non-Promo Seeker")
CREDIT_USAGE_LABELS = ("cplus_promo_used", "non_cplus_promo_used")
DECAY_TAUS = (90, 60, 30, 10, 5)

# Missing-feature defaults.
MISSING_RECENCY_DAYS = 365

# Area scoring
WILSON_CONFIDENCE = 0.95
MIN_AREA_CUSTOMERS = 10  # strict: n > 10
HEX_EDGE_KM = 3.729  # about the 36 km2 cells of a resolution-6 hexagonal grid


def taxonomy_rows(taxonomy: dict[str, list[str]] | None = None) -> list[tuple[str, str]]:
    """(name, group) rows, de-duplicated; a name never sits in two groups."""
    seen: dict[str, str] = {}
    for group, names in (taxonomy or CUISINE_TAXONOMY).items():
        for name in names:
            if name in seen and seen[name] != group:
                raise ValueError(f"taxonomy name {name!r} in two groups")
            seen[name] = group
    return sorted(seen.items())
