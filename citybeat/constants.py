"""Fixed values that must equal the reference's for identical results.

They are stated plainly and in their natural order.
"""

# --- fixed values: taxi bins (left-closed [a, b)) ---------------------------
DISTANCE_EDGES = [0, 1, 2, 5, 10, 20, 10_000]
DISTANCE_LABELS = ["0-1", "1-2", "2-5", "5-10", "10-20", "20+"]
DURATION_EDGES = [0, 5, 10, 20, 30, 45, 10_000]
DURATION_LABELS = ["0-5", "5-10", "10-20", "20-30", "30-45", "45+"]
TIP_EDGES = [0, 5, 10, 15, 20, 25, 10_000]
TIP_LABELS = ["0-5%", "5-10%", "10-15%", "15-20%", "20-25%", "25%+"]
TIP_ZERO_LABEL = "0%"

# --- fixed values: taxi filters -------------------------------------------
DISTANCE_OPEN_RANGE = (0, 200)      # keep 0 < miles < 200
DURATION_OPEN_RANGE = (0, 600)      # keep 0 < minutes < 600
AIRPORT_RATECODES = [2, 3]
TOP_ZONES = 20
TOP_PAIRS = 20

# --- fixed values: weekday labels, Monday = 0 -------------------------------
DOW_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# --- fixed values: fare component groups ------------------------------------
COMPONENT_GROUPS = {
    "Base fare": ["base_fare"],
    "Tips": ["tip_amount"],
    "Tolls": ["tolls_amount"],
    "Taxes & funds": ["mta_tax", "sales_tax", "bcf"],
    "Surcharges": ["extra", "improvement_surcharge", "congestion_surcharge", "airport_fee"],
}

# --- fixed values: high-volume for-hire provider codes ------------------------
PROVIDER_NAMES = {
    "HV0002": "Juno",
    "HV0003": "Uber",
    "HV0004": "Via",
    "HV0005": "Lyft",
}

# --- fixed values: canonical trip fields and their source-column aliases -----
FIELD_ALIASES = {
    "pickup_datetime": ["tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime", "Pickup_datetime"],
    "dropoff_datetime": ["tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime", "DropOff_datetime"],
    "trip_distance": ["trip_distance", "trip_miles"],
    "trip_time": ["trip_time"],
    "base_fare": ["fare_amount", "base_passenger_fare"],
    "tip_amount": ["tip_amount", "tips"],
    "tolls_amount": ["tolls_amount", "tolls"],
    "extra": ["extra"],
    "mta_tax": ["mta_tax"],
    "improvement_surcharge": ["improvement_surcharge"],
    "congestion_surcharge": ["congestion_surcharge"],
    "airport_fee": ["airport_fee"],
    "ratecode": ["RatecodeID", "RateCodeID", "ratecodeid"],
    "PULocationID": ["PULocationID", "PUlocationID"],
    "DOLocationID": ["DOLocationID", "DOlocationID"],
    "shared_match_flag": ["shared_match_flag", "SR_Flag"],
    "shared_request_flag": ["shared_request_flag"],
    "provider": ["hvfhs_license_num"],
    "sales_tax": ["sales_tax"],
    "bcf": ["bcf"],
}

# --- fixed values: bike trips ----------------------------------------------
BIKE_DURATION_EDGES = [0, 5, 10, 20, 40, 10_000]   # right-closed (a, b], lowest included
BIKE_DURATION_LABELS = ["0-5 min", "5-10 min", "10-20 min", "20-40 min", "40+ min"]
BIKE_DURATION_RANGE = (0, 360)                      # keep 0 <= minutes <= 360
BLANK_TOKENS = ["", "NaT", "nan", "None"]
TOP_FLOWS = 50
TOP_STATIONS = 20
TOP_CORRIDORS = 15

# --- fixed values: reports --------------------------------------------------
DAY_LABELS = ["SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT"]
QUARTER_PATTERN = r"q[1-4]-\d{4}"
SECTION_DAY = "Day Of Week - Rejects"
SECTION_BOROUGH = "Borough - Rejects"
SECTION_BOARD = "Community Board - Rejects"
HEADER_LABEL = "Reject Reason"

# --- fixed values: isochrones -----------------------------------------------
MINUTES = [5, 10, 20, 30, 40]
POINTS_PER_RING = 96
EARTH_RADIUS_KM = 6371.0
CIRCLE_MODES = {"walking": 4.8, "cycling": 15.0, "driving": 30.0}

# --- fixed values: routes ---------------------------------------------------
TARGET_ROUTES = 10
CANDIDATE_LIMIT = 30
PAD_DEGREES = 0.02

# --- fixed values: street-network modes (km/h) --------------------------------
NETWORK_MODES = {"walking": 4.8, "cycling": 15.0, "driving": 25.0, "bus": 18.0, "subway": 30.0}
