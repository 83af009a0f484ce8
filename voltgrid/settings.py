"""Fixed values.

Every number and word list here is part of the definition of a result (a
threshold, a weight, a code list); the operators take them as parameters and
use these as defaults.
"""

from __future__ import annotations

from statistics import NormalDist

# --- fixed values: registration file layout (name, start, end), zero-based, half-open
REGISTRATION_LAYOUT = [
    ("registration_date", 0, 8),
    ("registration_class", 8, 9),
    ("brand", 17, 47),
    ("model", 47, 69),
    ("propulsion_code", 93, 94),
    ("engine_cc", 94, 99),
    ("province_code_vehicle", 152, 154),
    ("postal_code", 165, 170),
    ("first_reg_date", 170, 178),
    ("new_used", 178, 179),
    ("municipality", 197, 227),
    ("power_kw", 227, 234),
    ("co2_emissions", 237, 242),
    ("consumption_wh_km", 445, 449),
    ("ev_category", 453, 457),
    ("ev_range_km", 457, 463),
]
REGISTRATION_MIN_LENGTH = 200
REGISTRATION_DATE_FIELDS = ["registration_date", "first_reg_date"]
REGISTRATION_NUMBER_FIELDS = ["engine_cc", "power_kw", "co2_emissions", "consumption_wh_km", "ev_range_km"]

# --- fixed values: propulsion codes
PROPULSION_LABELS = {
    "1": "Gasoline",
    "2": "Diesel",
    "3": "Electric",
    "4": "Hybrid_gasoline",
    "5": "Hybrid_diesel",
    "6": "LPG",
    "7": "CNG",
    "8": "Hydrogen",
    "H": "Hybrid_rechargeable_gasoline",
    "I": "Hybrid_rechargeable_diesel",
    "K": "Hybrid_rechargeable_other",
    "L": "Other_alternative",
    "M": "Multi_fuel",
}
EV_LABELS = {"3": "Pure Electric", "H": "PHEV Gasoline", "I": "PHEV Diesel", "K": "PHEV Other"}
#: Which codes count as electric.  A second reading of the same files uses {"2"}.
EV_CODES = ("3", "H", "I", "K")
PURE_ELECTRIC_CODE = "3"
PLUG_IN_CODES = ("H", "I", "K")
RECHARGEABLE_CATEGORIES = ("BEV", "PHEV", "REEV")

# --- fixed values: series names
BEV = "BEV"
OTHER = "OTHER_RECHARGEABLE"
TOTAL = "TOTAL_RECHARGEABLE"
ALL_CARS = "TOTAL_ALL_CARS"
ELECTRIFIED = "ELECTRIFIED_TOTAL"
NORMAL_CARS = "NORMAL_CARS"
TARGET_SERIES = (BEV, OTHER)
MODELLED_SERIES = (BEV, OTHER, ALL_CARS, ELECTRIFIED)
DEMAND_METRIC = "CHARGING_DEMAND_EQUIVALENT"

# --- fixed values: validation and intervals
CV_INITIAL = 60
CV_STEP = 6
CV_HORIZON = 12
HOLDOUT_MONTHS = 12
SEASON = 12
ENSEMBLE_TOLERANCE = 1.05
METRIC_EPSILON = 1e-10
SCENARIO_Z = NormalDist().inv_cdf(0.5 + 0.30 / 2)
REFERENCE_Z = NormalDist().inv_cdf(0.5 + 0.95 / 2)

# --- fixed values: scenarios
SCENARIOS = ("pessimistic", "normal", "optimistic")
SCENARIO_OF_BOUND = {
    "point_forecast": "normal",
    "lower_scenario": "pessimistic",
    "upper_scenario": "optimistic",
}
FOCUS_YEAR = 2027
HYBRID_CHARGING_WEIGHT = 0.35
SENSITIVITY_WEIGHTS = (0.25, HYBRID_CHARGING_WEIGHT, 0.50)

# --- fixed values: macro drivers by year, in the order of DRIVERS
DRIVERS = (
    "gdp_growth",
    "inflation",
    "interest_rate",
    "fuel_price_index",
    "battery_pack_usd_per_kwh",
    "charging_support_index",
    "policy_score",
)
DRIVER_PATH = {
    2026: (2.3, 2.0, 1.9, 98.0, 102.0, 1.00, 1.00),
    2027: (2.0, 2.0, 2.1, 100.0, 98.0, 1.03, 1.00),
    2028: (1.8, 2.0, 2.1, 101.0, 95.0, 1.06, 1.01),
    2029: (1.7, 2.0, 2.1, 102.0, 92.0, 1.08, 1.01),
    2030: (1.6, 2.0, 2.2, 103.0, 90.0, 1.10, 1.02),
    2031: (1.5, 2.0, 2.2, 104.0, 88.0, 1.12, 1.02),
}
SCENARIO_DELTAS = {
    "pessimistic": (-0.7, 0.6, 0.5, -3.0, 6.0, -0.08, -0.05),
    "normal": (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    "optimistic": (0.5, -0.3, -0.3, 4.0, -4.0, 0.08, 0.05),
}
#: driver -> (weight, neutral level)
MACRO_WEIGHTS = {
    "gdp_growth": (0.015, 2.0),
    "inflation": (-0.008, 2.0),
    "interest_rate": (-0.015, 2.0),
    "fuel_price_index": (0.0015, 100.0),
    "charging_support_index": (0.080, 1.0),
    "policy_score": (0.100, 1.0),
}
MACRO_RAW_BOUNDS = (0.90, 1.10)
MACRO_BOUNDS = (0.85, 1.15)
SATURATION_CEILING = 750000.0
SATURATION_WEIGHT = 0.08
SATURATION_EXPONENT = 1.6
SATURATION_BOUNDS = (0.90, 1.00)
BATTERY_REFERENCE_PRICE = 108.0
BATTERY_PASS_THROUGH = {"pessimistic": 0.85, "normal": 1.00, "optimistic": 1.15}
BATTERY_SENSITIVITY = {BEV: 0.20, OTHER: 0.08}
BATTERY_BOUNDS = (0.95, 1.08)

# --- fixed values: network planning
ROAD_TYPES = ("Major Highway", "Secondary Highway")
#: longest prefix first
ROAD_WEIGHTS = {"AP": 3.0, "A": 2.5, "E": 2.0, "N": 1.5}
UNKNOWN_ROAD = "N-Unknown"
CANDIDATE_DEFAULT_WEIGHT = 1.5
STATION_DEFAULT_WEIGHT = 1.0
ROAD_LABEL_COLUMNS = ("label", "ref", "name", "NAME", "LABEL", "REF")
URBAN_BUFFER_M = 1_000.0
HIGHWAY_BUFFER_M = 500.0
FILL_SPACING_M = 175_000.0
FILL_EXCLUSION_M = 100_000.0
EXPAND_SHARE = 0.30
CHARGERS_PER_STATION = 4
KW_PER_CHARGER = 150
DEMAND_KW = CHARGERS_PER_STATION * KW_PER_CHARGER
BASE_BEV = 487_014
SUFFICIENT_KW = 720.0
MODERATE_KW = 480.0
DISTRIBUTOR_NAMES = {
    "Iberdrola i-DE": "i-DE",
    "Endesa e-distribución": "Endesa",
    "Viesgo": "Viesgo",
}
DEFAULT_DISTRIBUTOR = "i-DE"
SAMPLE_SIZE = 600
SAMPLE_SEED = 42
TOP_FLOWS = 40
CITY_CENTRE = (42.225, -8.720)
CITY_RADIUS_M = 4_000.0

# --- fixed values: bounding box of the area, degrees
LATITUDE_RANGE = (35.0, 44.5)
LONGITUDE_RANGE = (-9.5, 5.0)
EXCLUDED_CITIES = ("MADRID", "BARCELONA", "VALENCIA", "SEVILLA", "ZARAGOZA", "BILBAO", "MALAGA")

# --- fixed values: provinces (code, latitude, longitude, name)
PROVINCES = [
    ("01", 42.846, -2.673, "Araba/Álava"),
    ("02", 38.996, -1.858, "Albacete"),
    ("03", 38.504, -0.324, "Alicante"),
    ("04", 37.004, -2.097, "Almería"),
    ("05", 40.656, -4.697, "Ávila"),
    ("06", 38.879, -6.971, "Badajoz"),
    ("07", 39.569, 2.650, "Illes Balears"),
    ("08", 41.582, 2.173, "Barcelona"),
    ("09", 42.344, -3.697, "Burgos"),
    ("10", 39.475, -6.372, "Cáceres"),
    ("11", 36.516, -5.903, "Cádiz"),
    ("12", 39.986, -0.051, "Castellón"),
    ("13", 39.003, -3.917, "Ciudad Real"),
    ("14", 37.885, -4.779, "Córdoba"),
    ("15", 43.132, -8.414, "A Coruña"),
    ("16", 40.070, -2.137, "Cuenca"),
    ("17", 41.980, 2.821, "Girona"),
    ("18", 37.177, -3.599, "Granada"),
    ("19", 40.632, -3.167, "Guadalajara"),
    ("20", 43.309, -2.003, "Gipuzkoa"),
    ("21", 37.261, -6.945, "Huelva"),
    ("22", 42.136, -0.409, "Huesca"),
    ("23", 37.780, -3.785, "Jaén"),
    ("24", 42.599, -5.572, "León"),
    ("25", 41.615, 0.627, "Lleida"),
    ("26", 42.287, -2.540, "La Rioja"),
    ("27", 43.012, -7.556, "Lugo"),
    ("28", 40.417, -3.704, "Madrid"),
    ("29", 36.721, -4.421, "Málaga"),
    ("30", 37.992, -1.131, "Murcia"),
    ("31", 42.817, -1.643, "Navarra"),
    ("32", 42.335, -7.864, "Ourense"),
    ("33", 43.361, -5.859, "Asturias"),
    ("34", 41.993, -4.531, "Palencia"),
    ("35", 28.123, -15.436, "Las Palmas"),
    ("36", 42.430, -8.645, "Pontevedra"),
    ("37", 40.970, -5.664, "Salamanca"),
    ("38", 28.464, -16.252, "S.C. Tenerife"),
    ("39", 43.183, -3.988, "Cantabria"),
    ("40", 40.943, -4.109, "Segovia"),
    ("41", 37.389, -5.984, "Sevilla"),
    ("42", 41.763, -2.466, "Soria"),
    ("43", 41.119, 1.245, "Tarragona"),
    ("44", 40.346, -1.106, "Teruel"),
    ("45", 39.863, -4.027, "Toledo"),
    ("46", 39.470, -0.376, "Valencia"),
    ("47", 41.652, -4.724, "Valladolid"),
    ("48", 43.263, -2.935, "Bizkaia"),
    ("49", 41.500, -5.746, "Zamora"),
    ("50", 41.649, -0.889, "Zaragoza"),
    ("51", 35.889, -5.321, "Ceuta"),
    ("52", 35.292, -2.938, "Melilla"),
]

# --- fixed values: number-plate letters of each province
PLATE_LETTERS = {
    "01": "VI", "02": "AB", "03": "A", "04": "AL", "05": "AV", "06": "BA", "07": "IB", "08": "B",
    "09": "BU", "10": "CC", "11": "CA", "12": "CS", "13": "CR", "14": "CO", "15": "C", "16": "CU",
    "18": "GR", "19": "GU", "20": "SS", "21": "H", "22": "HU", "23": "J", "24": "LE", "25": "L",
    "26": "LO", "27": "LU", "28": "M", "29": "MA", "30": "MU", "31": "NA", "32": "OR", "33": "O",
    "34": "P", "35": "GC", "36": "PO", "37": "SA", "38": "TF", "40": "SG", "41": "SE",
    "42": "SO", "43": "T", "44": "TE", "45": "TO", "46": "V", "47": "VA", "48": "BI", "49": "ZA",
    "50": "Z", "51": "CE", "52": "ME",
}
