"""Fixed values that results depend on. Plain data, no logic."""

# Weights of the geo-economic distance score.
SCORE_BASE = 500.0
SCORE_DISTANCE = 4.0
SCORE_LOG_GDP = -28.0
SCORE_RATE = -0.7
SCORE_AGREEMENT = -16.0
SCORE_AGREEMENT_FLAG = -16.0

# First year in which tariff weights no longer scale an agreement.
TARIFF_WEIGHT_CUT_YEAR = 2017

# Bounds of the rolled-forward forecast, in log space and in value.
LOG_FORECAST_BOUNDS = (18.0, 24.0)
FORECAST_BOUNDS = (1e6, 1e11)

# Subtotal row over all products.
ALL_PRODUCTS = "All Products"
ALL_PRODUCTS_CODE = 99

# Country code to name.
COUNTRY_OF_ISO3 = {
    "CHN": "China",
    "HKG": "Hong Kong",
    "JPN": "Japan",
    "KOR": "South Korea",
    "MYS": "Malaysia",
    "SAU": "Saudi Arabia",
    "THA": "Thailand",
    "USA": "United States of America",
    "IDN": "Indonesia",
    "ARE": "United Arab Emirates",
    "IND": "India",
    "PHL": "Philippines",
    "VNM": "Vietnam",
    "AUS": "Australia",
    "TWN": "Taiwan",
    "DEU": "Germany",
}

# Spellings of a country in the source files, to the one name used here.
COUNTRY_SPELLINGS = {
    "USA": "United States of America",
    "United States": "United States of America",
    "Korea, Rep.": "South Korea",
    "Korea, Rep Of": "South Korea",
    "Rep. of Korea": "South Korea",
    "Hong Kong SAR, China": "Hong Kong",
    "China, Hong Kong SAR": "Hong Kong",
}

# Country to currency.
CURRENCY_OF_COUNTRY = {
    "China": "CNY",
    "Hong Kong": "HKD",
    "Japan": "JPY",
    "South Korea": "KRW",
    "Malaysia": "MYR",
    "Saudi Arabia": "SAR",
    "Singapore": "SGD",
    "Thailand": "THB",
    "United States": "USD",
    "United States of America": "USD",
}

# Two-digit commodity code to short product name.
PRODUCT_OF_CODE = {
    27: "Mineral Fuels & Oils",
    29: "Organic Chemicals",
    33: "Cosmetics & Fragrances",
    38: "Other Chemicals",
    39: "Plastics",
    71: "Jewellery & Precious Metals",
    83: "Base Metal Products",
    84: "Machinery & Boilers",
    85: "Electrical Equipment & AV Gear",
    90: "Optical & Medical Instruments",
    99: "All Products",
}

# Market totals that are not countries.
NOT_COUNTRIES = [
    "Total All Markets", "Asia", "Europe", "America", "Oceania", "Africa", "Other Markets Africa",
    "Other Markets Europe", "Other Markets Asia", "Other Markets America", "Other Markets Oceania",
    "Panama", "New Caledonia",
]

# Indicators kept by the indicator summary.
SUMMARY_INDICATORS = [
    "Import(US$ Mil)",
    "Export(US$ Mil)",
    "Imports (in US$ Mil)",
    "Exports (in US$ Mil)",
    "Trade (US$ Mil)-Top 5 Export Partner",
    "Trade (US$ Mil)-Top 5 Import Partner",
]

# Text that marks an unusable cell.
BAD_CELL = "..."

# Hyper-parameters tried by the searches.
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0]
LASSO_ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0]
FOREST_GRID = {"trees": [50, 75, 100], "depth": [5, 10, 15], "min_rows": [4, 6, 8]}
BOOST_GRID = {
    "trees": [50, 75, 100],
    "rate": [0.05, 0.1, 0.15],
    "depth": [2, 3, 4, 5],
    "subsample": [0.8, 1.0],
}
BOOST_DEFAULT = {"trees": 200, "depth": 5, "rate": 0.05, "subsample": 0.8}

# Product descriptions of the source files to the short names used in results.
PRODUCT_SHORT_NAMES = {
    "Chemical products n.e.c.": "Other Chemicals",
    "Electrical machinery and equipment and parts thereof; sound recorders and reproducers; television image and sound recorders and reproducers, parts and accessories of such articles": "Electrical Equipment & AV Gear",
    "Essential oils and resinoids; perfumery, cosmetic or toilet preparations": "Cosmetics & Fragrances",
    "Metal; miscellaneous products of base metal": "Base Metal Products",
    "Mineral fuels, mineral oils and products of their distillation; bituminous substances; mineral waxes": "Mineral Fuels & Oils",
    "Natural, cultured pearls; precious, semi-precious stones; precious metals, metals clad with precious metal, and articles thereof; imitation jewellery; coin": "Jewellery & Precious Metals",
    "Nuclear reactors, boilers, machinery and mechanical appliances; parts thereof": "Machinery & Boilers",
    "Optical, photographic, cinematographic, measuring, checking, medical or surgical instruments and apparatus; parts and accessories": "Optical & Medical Instruments",
    "Organic chemicals": "Organic Chemicals",
    "Plastics and articles thereof": "Plastics",
    "Machinery and mechanical appliances, boilers, nuclear reactors; parts thereof": "Machinery & Boilers",
}

# Countries whose votes are compared.
VOTING_COUNTRIES = [
    "China", "Japan", "South Korea", "Malaysia", "Saudi Arabia", "Thailand", "United States of America",
    "Singapore", "Indonesia", "Taiwan", "India", "Australia", "United Arab Emirates", "Vietnam", "Germany",
    "Philippines",
]

# Reporters of the tariff profile.
TARIFF_REPORTERS = ["HKG", "MYS", "SAU", "JPN", "CHN", "USA", "THA", "KOR"]

# Partners whose share of all trade is reported.
COVERAGE_PARTNERS = [
    "Thailand", "Malaysia", "United States", "China", "Hong Kong", "Japan", "South Korea", "Indonesia",
    "Taiwan", "India", "Saudi Arabia",
]
