"""Domain constants: areas, classes, thresholds, windows, band codes."""

# Fixed values.
ROI = (22.0, 30.0, 36.0, 37.0)  # west, south, east, north
DELTA = (29.5, 30.5, 32.5, 31.5)
N_COAST = (25.0, 31.0, 35.0, 32.0)
OOD = (-10.0, 30.0, 12.0, 37.0)
NONE, DROUGHT, HEAT, COMPOUND, NODATA = 0, 1, 2, 3, 255
SPEI_MAX, TMAX_Z_MIN, VHI_MAX = -1.0, 2.0, 35.0
SEED = 20260519
CELL_DEG, SPLIT_RATIO, BUFFER_KM = 1.0, (0.70, 0.15, 0.15), 25.0
EARTH_KM = 6371.0088
TRAIN_YEARS, TEST_YEARS, OOD_TIME_YEARS = (2017, 2022), (2023, 2023), (2024, 2024)
KEEP_PROB = {0: 0.015, 1: 0.04, 2: 0.4, 3: 1.0}
CHANNELS = ("t2m", "tmax", "tmin", "precip", "swvl1", "e", "tp")
METEO_DAYS = 90
BANDS_S30 = {"blue": "B02", "green": "B03", "red": "B04", "nir": "B8A", "swir1": "B11", "swir2": "B12"}
BANDS_L30 = {"blue": "B02", "green": "B03", "red": "B04", "nir": "B05", "swir1": "B06", "swir2": "B07"}
HLS_FILL, FMASK_FILL, CLOUD_BITS = -9999, 255, 0b1110
NDVI_SCALE, LST_SCALE, KELVIN = 1e-4, 0.02, 273.15
PATCH, GATE, DOY_WINDOW = 224, (0.005, 0.08), 31
KB_PER_SAMPLE = 770
MEMBERS = ("train", "val", "test", "ood")
SINUSOIDAL_R = 6371007.181
