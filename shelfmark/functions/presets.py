"""Ready-made labels, edges and curves to pass to the functions in ``derive``.

All of these are fixed values: results depend on them being exactly so.
"""

# Names of price levels.
PRICE_LABELS = {0: "Free", 1: "Budget", 2: "Moderate", 3: "Expensive", 4: "Luxury"}

# The second set of names, used in loading reports.
PRICE_REPORT_LABELS = {0: "Budget", 1: "Inexpensive", 2: "Moderate", 3: "Expensive", 4: "Very Expensive"}

# Rating buckets. Analyses leave values outside 1..5 unknown,
# charts put them into the end buckets (``clip=True``).
RATING_EDGES = [1, 2, 3, 4, 5]
RATING_LABELS = ["Poor (1–2)", "Average (2–3)", "Good (3–4)", "Excellent (4–5)"]

# The finer rating buckets (``closed_last=False``).
FINE_RATING_EDGES = [0.0, 3.5, 4.0, 4.5, 5.01]
FINE_RATING_LABELS = ["Poor", "Average", "Good", "Excellent"]

# Weight of each hour 0..23, first load score (8 hex digits,
# spread 15, centre 7, per 100, 1 digit).
HOUR_WEIGHTS = [
    0.05, 0.03, 0.02, 0.02, 0.02, 0.04, 0.10, 0.20, 0.30, 0.40, 0.55, 0.70,
    0.95, 1.00, 0.90, 0.75, 0.65, 0.70, 0.90, 1.00, 0.95, 0.80, 0.60, 0.30,
]

# Percent of each hour 0..23, second load score (4 hex digits,
# spread 140, centre 70, per 1000, 2 digits).
HOUR_PERCENT = [
    20, 15, 12, 10, 10, 12, 18, 30, 45, 60, 65, 70,
    80, 85, 75, 70, 75, 85, 90, 88, 80, 65, 50, 35,
]

# Place tags too general to say what a place is.
GENERIC_TAGS = [
    "point_of_interest", "establishment", "food", "store",
    "premise", "geocode", "locality", "political",
]

# Category of a place's first telling tag, "Other" for the rest.
TAG_CATEGORIES = {
    "cafe": "Cafe",
    "bakery": "Bakery",
    "bar": "Bar",
    "night_club": "Bar",
    "meal_takeaway": "Takeaway",
    "meal_delivery": "Takeaway",
    "fast_food_restaurant": "Fast Food",
    "pizza_restaurant": "Pizza",
    "seafood_restaurant": "Seafood",
    "chinese_restaurant": "Chinese",
    "indian_restaurant": "Indian",
    "italian_restaurant": "Italian",
    "japanese_restaurant": "Japanese",
    "korean_restaurant": "Korean",
    "thai_restaurant": "Thai",
    "middle_eastern_restaurant": "Middle Eastern",
    "hamburger_restaurant": "Burgers",
    "sandwich_shop": "Sandwiches",
    "ice_cream_shop": "Desserts",
    "restaurant": "Restaurant",
}

# Recommender settings and the share of training rows.
ALS_PARAMS = {"rank": 10, "maxIter": 10, "regParam": 0.1, "seed": 42}
TRAIN_PERCENT = 80
