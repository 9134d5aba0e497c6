"""Domain, thresholds, dictionaries and constants of the data model.

These must equal the published method for results to match and are kept together here.
"""

# Analysis grid: 0.01 degree cell centres, rows run north to south.
GRID_RES = 0.01
GRID_LON_MIN, GRID_LON_MAX = -3.30, 1.25
GRID_LAT_MIN, GRID_LAT_MAX = 4.70, 11.20
GRID_ROWS, GRID_COLS = 650, 455

# Wider station domain and start of the record.
REGION_BOX = {"lon_min": -9.0, "lon_max": 9.0, "lat_min": 4.0, "lat_max": 13.5}
FIRE_BOX = {"lon_min": -10.0, "lon_max": 10.0, "lat_min": 3.0, "lat_max": 15.5}
CITY_BOX = {"lon_min": -0.60, "lon_max": 0.75, "lat_min": 5.40, "lat_max": 6.15}
START_DATE = "2022-08-04"

# Concentration thresholds, ug/m3.
WHO_DAILY, NATIONAL_DAILY = 15.0, 35.0

# Sensor quality control.
PM_MIN, PM_MAX = 0.0, 1000.0
STUCK_RUN = 5
HAMPEL_SCALE, HAMPEL_FLOOR, HAMPEL_MIN_COUNT = 6 * 1.4826, 30.0, 6
DAY_MIN_HOURS, DAY_MIN_BLOCK = 12, 2

# Calibration.
PAIR_RADIUS_KM, MIN_PAIRS, MIN_CV_R2 = 10.0, 150, 0.30
REFERENCE_SIGMA, UNCALIBRATED_SIGMA, DEFAULT_RH = 0.10, 0.5, 75.0
PLANTOWER_MARKERS = ("airgradient", "iqair", "data354", "airqo", "aurassure", "miri", "habitat")
REFERENCE_PROVIDERS = ("StateAir Accra", "StateAir Abidjan", "StateAir Bamako", "AirNow", "US Embassy (AirNow)")
EXCLUDED_PROVIDERS = (("NG", "Aurassure"),)
LEGACY_LOCATIONS = (367215, 367216, 367217, 367218, 367219)
LEGACY_LABEL = "Clarity (legacy 2022-23)"
SENSOR_PARAMETERS = ("pm25", "relativehumidity", "temperature", "pm10", "pm1")

# Reference monitors outside the sensor archive: city, latitude, longitude, country.
REFERENCE_SITES = (
    ("Accra", 5.580642, -0.170724, "GH"),
    ("Abidjan", 5.360000, -4.008300, "CI"),
    ("Lome", 6.185167, 1.214166, "TG"),
    ("Ouagadougou", 12.304907, -1.497184, "BF"),
)

# City centres used by the product comparison: name, latitude, longitude.
CITY_CENTRES = (
    ("Accra", 5.6037, -0.1870), ("Kumasi", 6.6885, -1.6244), ("Tamale", 9.4075, -0.8533),
    ("Tema", 5.6698, -0.0166), ("Koforidua", 6.0941, -0.2591), ("Cape Coast", 5.1053, -1.2466),
    ("Sekondi-Takoradi", 4.9340, -1.7137), ("Wa", 10.0601, -2.5099), ("Ho", 6.6008, 0.4713),
    ("Sunyani", 7.3349, -2.3123), ("Bolgatanga", 10.7856, -0.8514), ("Techiman", 7.5909, -1.9390),
    ("Somanya", 6.1043, -0.0150),
)
CITY_RADIUS_KM = 15.0

# Lattices: composition step, weather step (degrees).
CAMS_STEP = (0.8, 0.8)
MET_STEP = (0.5, 0.625)
CAMS_VARS = ("cams_pm25", "cams_pm10", "cams_aod", "cams_dust", "cams_co", "cams_no2", "cams_pm25_max")
MET_VARS = ("t2m", "t2m_range", "rh", "qv2m", "td2m", "precip", "ws10", "u10", "v10", "ps", "ssrd", "cloud",
            "merra_aod", "blh")
DERIVED_VARS = ("log_cams_pm25", "cams_pm25_lag1", "cams_pm25_3d", "cams_dust_lag1", "dust_frac", "log_cams_dust",
                "precip_3d", "precip_lag1", "log_blh", "ventilation", "rh_lag1", "ws10_lag1", "merra_aod_3d",
                "wind_dir_sin", "wind_dir_cos")
FIRE_VARS = ("frp_25km", "frp_100km", "fire_upwind")
TIME_VARS = ("doy_sin", "doy_cos", "dow")
STATIC_VARS = ("elev", "elev_sd", "elev_rel_10km", "lc_tree", "lc_shrub", "lc_grass", "lc_crop", "lc_built", "lc_bare",
               "lc_water", "log_pop", "log_ntl", "road_density", "dist_road", "dist_coast", "lc_built_s3km",
               "lc_built_s10km", "log_pop_s3km", "log_pop_s10km", "log_ntl_s3km", "log_ntl_s10km",
               "road_density_s3km", "road_density_s10km", "lc_crop_s10km", "lc_tree_s10km", "lc_bare_s10km")
SCALE_VARS = ("krige_var", "dist_nearest_km", "n_obs_100km", "cams_pm25", "cams_dust", "dust_frac", "rh", "blh", "lat",
              "doy_sin", "doy_cos", "frp_100km")

# Kilometres per degree: flat-earth steps and the monitor search of the map.
KM_PER_DEG, KM_PER_DEG_MAP, EARTH_DIAMETER_KM, EARTH_RADIUS_KM = 111.32, 110.6, 12742.0, 6371.0

# Fire kernels.
FIRE_CELL, FIRE_LOCAL_KM, FIRE_REGIONAL_KM, FIRE_UPWIND_KM, FIRE_REACH_KM = 0.05, 10.0, 50.0, 150.0, 500.0

# Polar-orbiter model: inclination (deg), period (min), rotation (deg/min), half swath (deg), overpass windows (min).
ORBIT_INCLINATION, ORBIT_PERIOD, EARTH_ROTATION, SWATH_HALF_DEG = 98.72, 101.44, 360.0 / 1436.07, 13.6
OVERPASS_WINDOWS = ((-120, 300), (600, 1020))

# Weather stations: code -> (column, daily aggregate).
WEATHER_VARIABLES = {
    "te": ("t2m", "mean"), "rh": ("rh", "mean"), "pr": ("precip", "sum"), "ws": ("ws10", "mean"),
    "wd": ("wd", "circmean"), "wg": ("wgust", "max"), "ap": ("ps", "mean"), "ra": ("ssrd", "mean"),
    "vp": ("vp", "mean"),
}
SAMPLES_PER_DAY, MIN_COMPLETENESS = 288, 0.75

# Residual correlogram bins (km), kriging reach, offset shrinkage (pseudo-days).
CORRELOGRAM_BINS = (0, 2, 5, 10, 20, 35, 50, 75, 100, 150, 200, 300, 400)
KRIGE_REACH_KM, OFFSET_SHRINK = 300.0, 15.0

# Validation.
ERROR_DISTANCE_BINS = (0, 5, 15, 30, 60, 120, 250, 600)
LAMBDA_GRID = (0.0, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0)
LEARNERS = ("lgbm", "xgb_ratio", "catboost", "extratrees")

# Air-quality index (2024): upper bound and label; breakpoints (conc lo, conc hi, index lo, index hi).
AQI_CLASSES = ((9.0, "Good"), (35.4, "Moderate"), (55.4, "Unhealthy for sensitive groups"), (125.4, "Unhealthy"),
               (225.4, "Very unhealthy"))
AQI_TOP_CLASS = "Hazardous"
AQI_BREAKPOINTS = ((0, 9.0, 0, 50), (9.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 125.4, 151, 200),
                   (125.5, 225.4, 201, 300), (225.5, 325.4, 301, 500))

# Regions counted as north in the gradient series.
NORTH_REGIONS = ("Northern Region", "Savannah Region", "North East Region", "Upper East Region", "Upper West Region",
                 "Northern", "Savannah", "North East", "Upper East", "Upper West")

# Land cover codes.
LAND_COVER = {10: "tree", 20: "shrub", 30: "grass", 40: "crop", 50: "built", 60: "bare", 80: "water", 90: "wetland",
              95: "mangrove"}
