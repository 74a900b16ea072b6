"""Values the results depend on, stated once.

Every constant below is a FIXED VALUE: it has to equal the source system's own
list, code, layout or rate, otherwise the produced tables differ.
"""

# Sentinels for values and keys that cannot be resolved.
UNKNOWN_VALUE = "Not Available"
UNKNOWN_REGION = "Other"
UNKNOWN_KEY = "-1"

# Category codes the brand files spell differently from the category files.
CATEGORY_CODE_FIXES = {"GROCERY": "GRCY", "TOYS": "TOY", "BOOKS": "BKS"}

# Misspelt product materials.
MATERIAL_FIXES = {"Coton": "Cotton", "Ruber": "Rubber", "Alumium": "Aluminium"}

# Quantities that arrive as words.
QUANTITY_WORDS = {"One": "1", "Two": "2", "Three": "3"}

# Display names of the sales channels.
CHANNEL_LABELS = {"web": "Website", "app": "Mobile"}

# Characters removed from, or swapped in, numeric text.
WEIGHT_UNIT = "g"
PRICE_SYMBOL = "$"
PERCENT_SYMBOL = "%"
DECIMAL_COMMA = ","
DECIMAL_POINT = "."
NOT_ALPHANUMERIC = r"[^a-zA-Z0-9]"
NOT_AMOUNT = r"[^0-9.\-]"

# Date and time layouts of the raw files.
CALENDAR_DATE_LAYOUT = "dd-MM-yyyy"
ORDER_DATE_LAYOUT = "yyyy-MM-dd"
ORDER_TIME_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm")
MONTH_NAME_LAYOUT = "MMMM"
DAY_NAME_LAYOUT = "EEEE"
WEEKEND_DAYS = ("Saturday", "Sunday")

# Sales region by country and state code.
REGION_BY_COUNTRY_STATE = {
    "India": {
        "MH": "West", "GJ": "West", "RJ": "West",
        "KA": "South", "TN": "South", "TS": "South", "AP": "South", "KL": "South",
        "UP": "North", "WB": "North", "DL": "North",
    },
    "Australia": {"VIC": "SouthEast", "WA": "West", "NSW": "East", "QLD": "NorthEast"},
    "United Kingdom": {
        "ENG": "England", "WLS": "Wales", "NIR": "Northern Ireland", "SCT": "Scotland",
    },
    "United States": {
        "MA": "NorthEast", "FL": "South", "NJ": "NorthEast", "CA": "West",
        "NY": "NorthEast", "TX": "South",
    },
    "United Arab Emirates": {"AUH": "Abu Dhabi", "DU": "Dubai", "SHJ": "Sharjah"},
    "Singapore": {"SG": "Singapore"},
    "Canada": {
        "BC": "West", "AB": "West", "ON": "East", "QC": "East", "NS": "East", "IL": "Other",
    },
}

# Rupees per unit of each currency, as text so that they stay exact.
INR_PER_UNIT_AS_OF = "2025-10-15"
INR_PER_UNIT = {
    "INR": "1.00",
    "AED": "24.18",
    "AUD": "57.55",
    "CAD": "62.93",
    "GBP": "117.98",
    "SGD": "68.18",
    "USD": "88.29",
}
