"""Fixed domain values. Each table below must hold exactly these values for
results to be right; they are stated plainly, in natural order."""

from __future__ import annotations

# Share of a full score that each matching condition adds.
WEIGHT_TEMPERATURE = 0.3
WEIGHT_HUMIDITY = 0.3
WEIGHT_RAINFALL = 0.2
WEIGHT_MOISTURE = 0.2
RISK_THRESHOLD = 0.6
DEFAULT_SOIL_MOISTURE = 50.0

# Disease rules, in table order (the order breaks ties).
# disease, temp_lo, temp_hi, hum_lo, hum_hi, rain_trigger, moist_lo, moist_hi, progression
DISEASE_RULES = [
    ("Potato___Early_blight", 20.0, 28.0, 80.0, 95.0, 5.0, 60.0, 85.0, "exponential"),
    ("Potato___Late_blight", 15.0, 22.0, 85.0, 100.0, 10.0, 70.0, 90.0, "fast_exponential"),
    ("Tomato_Bacterial_spot", 25.0, 30.0, 85.0, 100.0, 2.0, 50.0, 75.0, "linear"),
    ("Tomato_Early_blight", 24.0, 29.0, 80.0, 90.0, 5.0, 60.0, 80.0, "exponential"),
    ("Tomato_Late_blight", 17.0, 22.0, 85.0, 95.0, 10.0, 70.0, 90.0, "fast_exponential"),
    ("Tomato_Leaf_Mold", 21.0, 24.0, 85.0, 100.0, 0.0, 50.0, 70.0, "slow"),
    ("Tomato_Septoria_leaf_spot", 20.0, 25.0, 60.0, 80.0, 5.0, 50.0, 70.0, "linear"),
    ("Tomato_Spider_mites_Two_spotted_spider_mite", 27.0, 32.0, 30.0, 50.0, 0.0, 30.0, 50.0, "exponential"),
    ("Tomato__Target_Spot", 24.0, 28.0, 80.0, 90.0, 2.0, 50.0, 70.0, "linear"),
    ("Tomato__Tomato_YellowLeaf__Curl_Virus", 25.0, 32.0, 50.0, 70.0, 0.0, 40.0, 60.0, "slow"),
    ("Tomato__Tomato_mosaic_virus", 20.0, 28.0, 40.0, 70.0, 0.0, 50.0, 70.0, "slow"),
    ("Pepper__bell___Bacterial_spot", 25.0, 30.0, 85.0, 100.0, 2.0, 50.0, 75.0, "linear"),
]
RULE_COLUMNS = [
    "ordinal", "disease", "temp_lo", "temp_hi", "hum_lo", "hum_hi",
    "rain_trigger", "moist_lo", "moist_hi", "progression",
]

# Severity growth per day.
GROWTH_FACTOR = {"exponential": 1.1, "fast_exponential": 1.2}
GROWTH_STEP = {"linear": 0.05, "slow": 0.02}

# Upper |latitude| bound, base temperature, yearly swing.
CLIMATE_ZONES = [
    ("tropical", 23.5, 27.0, 5.0),
    ("subtropical", 35.0, 22.0, 10.0),
    ("temperate", 55.0, 15.0, 15.0),
    ("continental", 60.0, 10.0, 20.0),
    ("polar", 90.0, -5.0, 25.0),
]

# First day of year of each season band, northern and southern name.
SEASON_BANDS = [
    (80, 172, "spring", "fall"),
    (172, 264, "summer", "winter"),
    (264, 355, "fall", "spring"),
]
SEASON_REST = ("winter", "summer")

# Permissions of each role.
ROLE_PERMISSIONS = {
    "ADMIN": ["create_field", "delete_field", "manage_users", "run_simulation", "view_all_data"],
    "FARMER": ["view_own_data", "view_field", "export_data"],
    "RESEARCHER": ["view_all_data", "run_simulation", "access_hdfs"],
}

# Expected image classes.
EXPECTED_CLASSES = [
    "Pepper__bell___Bacterial_spot",
    "Pepper__bell___healthy",
    "Potato___Early_blight",
    "Potato___Late_blight",
    "Potato___healthy",
    "Tomato_Bacterial_spot",
    "Tomato_Early_blight",
    "Tomato_Late_blight",
    "Tomato_Leaf_Mold",
    "Tomato_Septoria_leaf_spot",
    "Tomato_Spider_mites_Two_spotted_spider_mite",
    "Tomato__Target_Spot",
    "Tomato__Tomato_YellowLeaf__Curl_Virus",
    "Tomato__Tomato_mosaic_virus",
    "Tomato_healthy",
]

# Allowed ranges per measured column (None = open end).
# column, lowest, highest
READING_RANGES = [
    ("moisture", 15.0, 95.0),
    ("ph", 5.5, 8.0),
    ("electrical_conductivity", 0.0, None),
    ("nitrogen", 0.0, None),
    ("phosphorus", 0.0, None),
    ("potassium", 0.0, None),
    ("humidity", 10.0, 100.0),
    ("wind_speed", 0.0, None),
    ("light_intensity", 0.0, None),
    ("clouds", 0.0, 100.0),
    ("wind_direction", 0.0, 359.0),
]
WEATHER_RANGES = [
    ("humidity", 20.0, 95.0),
    ("wind_speed", 0.0, None),
    ("clouds", 0.0, 100.0),
    ("wind_direction", 0.0, 359.0),
]

# Image file suffixes.
RAW_SUFFIXES = ["jpg", "jpeg", "png", "bmp", "tiff"]
PROCESSED_SUFFIXES = ["jpg", "png"]
SPLITS = ["train", "val", "test"]

# Split shares, copies per training image, augmentation ranges.
VAL_SHARE = 0.15
TEST_SHARE = 0.15
SPLIT_SEED = 42
AUGMENTED_COPIES = 3
ROTATION_RANGE = 15.0
BRIGHTNESS_RANGE = (0.8, 1.2)
TARGET_SIZE = (256, 256)

# Field defaults, sensor layout and sampling.
FIELD_DEFAULTS = {"area_hectares": 1.0, "crop_type": "mixed", "soil_type": "loam", "active": True}
SOIL_SENSORS_PER_FIELD = 5
SENSOR_BOX_DEGREES = 0.01
SLOT_HOURS = 3
ARCHIVE_THRESHOLD = 100
# Rainfall is added up in this type, so that totals do not depend on the order of rows.
RAIN_SUM = "decimal(28,9)"
FRESH_SECONDS = 3600
RETENTION_DAYS = 30
NITROGEN_LOW = 45.0
