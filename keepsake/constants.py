"""Fixed values.

Column names, field positions, text tokens and learner settings that decide the results. They
are inputs to the studies, not tunables, and are kept together here.
"""

# --- Fixed values: churn study -------------------------------------------------------------

# Headerless churn file, in file order.
CHURN_DDL = """
    state string, account_length double, area_code double, phone string,
    int_plan boolean, vmail_plan boolean, vmail_message double,
    day_mins double, day_calls double, day_charge double,
    eve_mins double, eve_calls double, eve_charge double,
    night_mins double, night_calls double, night_charge double,
    int_mins double, int_calls double, int_charge double,
    custserve_calls double, label string
"""
CHURN_EXCLUDED = ("state", "area_code", "phone", "label")
CHURN_LABELS = ("False.", "True.")  # negative, positive

# Churn file with a header line.
CHURN_HEADER_LABEL = "Churn?"
CHURN_HEADER_DROPPED = ("State", "Area Code", "Phone", "Churn?")
CHURN_HEADER_FLAGS = ("Int'l Plan", "VMail Plan")

# --- Fixed values: renewal study -----------------------------------------------------------

# Headerless renewal file: column name -> position in the line.
RENEWAL_POSITIONS = {
    "nth_membership_period": 4,
    "Window": 20,
    "Usage_Days": 17,
    "Supercategory_Ratio": 80,
    "Intensity_Ratio": 77,
    "Product_Article": 81,
    "Overview_Detail": 82,
    "Email_Open_R": 86,
    "Email_Clicked_R": 87,
    "Browser_Researcher": 88,
}
RENEWAL_LABEL_POSITION = 78
RENEWAL_FEATURES = tuple(RENEWAL_POSITIONS)
RENEWAL_LABELS = ("Others", "Renewers")  # negative, positive

# Renewal file with a header line.
RENEWAL_HEADER_LABEL = "Target_Group"
RENEWAL_HEADER_CODE = "Target_Group_Code"
RENEWAL_POSITIVE_CODE = 3

# --- Fixed values: cells -------------------------------------------------------------------

YES, NO = "yes", "no"

# --- Fixed values: learners ----------------------------------------------------------------

MAX_CATEGORIES = 10
FOREST_DEPTH = 10
FOREST_BINS = 30
FOREST_TREES = {"churn": 15, "renewal": 5}

# Hidden layer widths; input width is the feature count, output width the class count.
NETWORK_HIDDEN = {
    "churn_wide": (50,),
    "churn_deep": (50, 50, 50, 50),
    "churn_custom": (50, 50, 50),
    "renewal_pair": (4, 4),
    "renewal_small": (3, 3),
}

# Held-out shares.
SHARE_FIFTH, SHARE_QUARTER, SHARE_THREE_TENTHS = 0.2, 0.25, 0.3

TOP_CORRELATIONS = 10
PREVIEW_ROWS = 20
