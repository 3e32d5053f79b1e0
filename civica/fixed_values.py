"""Values that results depend on.

Fixed values: column names, labels, patterns, thresholds and colours below are
part of the data model and must stay as they are for results to agree.
"""

# The pair of names that identifies a place.
PLACE_KEYS = ["neighborhood", "district"]

# Rows of the election table that are not parties.
ELECTORS = "Electors"
PSEUDO_PARTIES = ["Electors", "Votants", "Vots vàlids"]

# Raw income columns ("neigh_name " ends in a space).
INCOME_ID = "_id"
INCOME_DISTRICT = "district_name"
INCOME_DISTRICT_CODE = "district_id"
INCOME_NEIGHBORHOOD = "neigh_name "
INCOME_RECORDS = "info"
INCOME_FIELDS = ["RFD", "pop", "year"]

# Raw election columns.
ELECTION_DISTRICT = "Nom_Districte"
ELECTION_DISTRICT_CODE = "Codi_Districte"
ELECTION_NEIGHBORHOOD = "Nom_Barri"

# Raw listing columns.
LISTING_CONSTANT_COLUMNS = ["country", "municipality", "province", "url", "thumbnail"]
LISTING_STRUCTS = ["parkingSpace", "detailedType", "suggestedTexts"]

# Lookup files with their (raw name, reconciled name) columns.
INCOME_DISTRICT_LOOKUP = ("income_lookup_district.json", "district", "district_reconciled")
INCOME_NEIGHBORHOOD_LOOKUP = (
    "income_lookup_neighborhood.json", "neighborhood", "neighborhood_reconciled")
RENT_DISTRICT_LOOKUP = ("rent_lookup_district.json", "di", "di_re")
RENT_NEIGHBORHOOD_LOOKUP = ("rent_lookup_neighborhood.json", "ne", "ne_re")

# Text pattern of the name normaliser.
NOT_WORD_OR_SPACE = r"[^\w\s]"

# Numeric columns of the correlation matrix.
MATRIX_COLUMNS = ["price", "priceByArea", "bathrooms", "size", "pop", "RFD"]

# Cleaning thresholds.
MAX_NULL_SHARE = 0.9
MIN_STDDEV = 0.1
MAX_TOP_SHARE = 0.95

# Model settings.
TRAIN_PERCENT = 70
MODEL_ITERATIONS = 10
MODEL_REGULARISATION = 0.1
MODEL_COLUMNS = ["neighborhood", "RFD", "price", "bathrooms", "size"]

# Dashboard colours and the steps of the correlation scale.
PARTY_COLOURS = {"PP": "#4e79a7", "CAT-JUNTS+": "#76b7b2", "PSC": "#e15759"}
CORRELATION_STEPS = (-1.0, 1.0, 7)
