"""Parameters that map the analyses onto the driver's tables.

Fixed values (chosen for the test tables; see FIXTURES.md):
categories stand in for the retail categories, dates for the
analysis windows of the original scripts.
"""

# Category analogs (market segments).
CAT_A = "MACHINERY"  # first category of the pair ("men")
CAT_B = "FURNITURE"  # second category of the pair ("women")
CAT_SINGLE = "BUILDING"  # single-category growth analyses ("bookstore")
CAT_TREND = "HOUSEHOLD"  # total-trend category
CATS_THREE = ("AUTOMOBILE", "BUILDING", "HOUSEHOLD")

# Labels used in output column names.
LABEL_A = "men"
LABEL_B = "women"
LABEL_SINGLE = "bookstore"

# Cohort restriction by first start date.
COHORT_FROM = "1995-02-01"
COHORT_TO = "1999-12-31"

# Monthly spine for the sparse rolling windows.
MONTH_SPINE_FROM = "1996-01-01"
# 11 months earlier: the first month a trailing year reaches.
MONTH_LEAD_FROM = "1995-02-01"
MONTH_SPINE_TO = "2001-08-01"
SPARSE_MONTHS = (1, 7)

# Years lined up side by side.
OVERLAY_YEARS = (1995, 1996, 1997)
OVERLAY_FROM = "1995-01-01"
OVERLAY_TO = "1997-12-01"

# Periods picked by the retention pivot.
PIVOT_PERIODS = (0, 2, 4, 6)

# Days of the date dimension; wider than the data.
CALENDAR_FROM = "1992-01-01"
CALENDAR_TO = "2006-12-31"
# Daily spine of the trailing ranges.
DAY_SPINE_FROM = "1996-01-01"
DAY_SPINE_TO = "2001-08-01"
