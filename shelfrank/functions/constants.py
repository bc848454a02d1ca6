"""Values that must equal the reference's for equal results.

FIXED VALUES -- taken as stated by the reference, in its order. Do not edit.
"""

# Interaction types and their weights.
INTERACTION_WEIGHTS = {"view": 1, "click": 2, "add_to_cart": 3, "purchase": 5}

# Price buckets: price < 500 Budget, < 2000 Mid-Range, < 10000 Premium, else Luxury.
PRICE_BOUNDS = (500.0, 2000.0, 10000.0)
PRICE_LABELS = ("Budget", "Mid-Range", "Premium", "Luxury")

# Review sentiment from a 1..5 rating: >= 4 positive, == 3 neutral, otherwise negative.
SENTIMENT_LABELS = ("positive", "neutral", "negative")

# Timestamp formats.
INTERACTION_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
SESSION_HOUR_FORMAT = "yyyy-MM-dd-HH"
SESSION_ID_LENGTH = 12

# Fused matrix score: 0.7 * total_score + 0.3 * max_rating when a rating exists.
SCORE_WEIGHT = 0.7
RATING_WEIGHT = 0.3

# List sizes.
RECOMMENDATIONS_PER_USER = 5
POPULAR_PER_CATEGORY = 8
SIMILAR_PER_PRODUCT = 5
COMPLEMENTARY_PER_PRODUCT = 5
TOP_RATED_COUNT = 20
TOP_RATED_MIN_RATINGS = 50

# Factor model.
NUM_FACTORS = 20
MAX_ITERATIONS = 300
RANDOM_SEED = 42
ALPHA_W = 0.1
ALPHA_H = 0.1
TRAIN_FRACTION = 0.8

# Feed re-ranker.
FEED_SIZE = 14
FEED_PAD_BELOW = 6
DECAY_HALF_LIFE_HOURS = 48.0
SIMILAR_SHARE = 0.6
HISTORY_CAP = 50
HISTORY_SHOWN = 15
INFLUENCERS_SHOWN = 3
COLD_START_PER_CATEGORY = 3
COLD_START_SIZE = 10
CATEGORY_SECTION_PICKS = 4
MIN_PREFERRED_CATEGORIES = 2

# Baseline recommender: top products per user, picks from the top category, further picks.
BASELINE_TOP_PRODUCTS = 15
BASELINE_CATEGORY_PICKS = 2
BASELINE_OTHER_PICKS = 3

# Complementary sub-categories of the reference catalogue, source -> targets, in the stated order.
COMPLEMENTARY_SUBCATEGORIES = {
    "Smartphones": ["Headphones", "Smartwatches", "Tablets"],
    "Laptops": ["Headphones", "Tablets", "Smartwatches"],
    "Headphones": ["Smartphones", "Laptops", "Smartwatches"],
    "Tablets": ["Smartphones", "Laptops", "Headphones"],
    "Smartwatches": ["Smartphones", "Fitness", "Running"],
    "T-Shirts": ["Jeans", "Sneakers", "Jackets"],
    "Jeans": ["T-Shirts", "Sneakers", "Jackets"],
    "Sneakers": ["T-Shirts", "Jeans", "Running"],
    "Jackets": ["T-Shirts", "Jeans", "Sneakers", "Dresses"],
    "Dresses": ["Sneakers", "Jackets", "Makeup"],
    "Fiction": ["Non-Fiction", "Sci-Fi", "Comics"],
    "Non-Fiction": ["Self-Help", "Fiction"],
    "Sci-Fi": ["Fiction", "Comics"],
    "Self-Help": ["Non-Fiction", "Fitness", "Yoga"],
    "Comics": ["Fiction", "Sci-Fi"],
    "Cookware": ["Appliances", "Storage"],
    "Furniture": ["Decor", "Storage"],
    "Decor": ["Furniture", "Storage"],
    "Appliances": ["Cookware", "Storage"],
    "Storage": ["Cookware", "Furniture"],
    "Cricket": ["Fitness", "Running"],
    "Football": ["Fitness", "Running"],
    "Fitness": ["Yoga", "Running", "Smartwatches"],
    "Yoga": ["Fitness", "Self-Help"],
    "Running": ["Sneakers", "Fitness", "Smartwatches"],
    "Skincare": ["Haircare", "Makeup"],
    "Haircare": ["Skincare", "Grooming"],
    "Makeup": ["Skincare", "Fragrance", "Dresses"],
    "Fragrance": ["Makeup", "Grooming"],
    "Grooming": ["Skincare", "Haircare"],
}
