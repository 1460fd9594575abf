"""Fixed recode tables.

These are fixed values: each code must be exactly this for results to agree
with earlier ones.  Keys are in natural order.  Apart from the irregular entries
noted below they are the position of a value when the values are sorted by mean
label, so `operators.encode.fit_ranks` derives the same kind of table from data.
"""

# Hour of day -> position by mean label.
HOUR_RANK = {
    0: 5.0, 1: 4.0, 2: 3.0, 3: 1.0, 4: 0.0, 5: 2.0, 6: 6.0, 7: 12.0,
    8: 21.0, 9: 13.0, 10: 10.0, 11: 11.0, 12: 17.0, 13: 18.0, 14: 15.0, 15: 16.0,
    16: 20.0, 17: 23.0, 18: 22.0, 19: 19.0, 20: 14.0, 21: 9.0, 22: 8.0, 23: 7.0,
}

# Month -> position by mean label, counted from 1.
MONTH_RANK = {
    1: 1.0, 2: 2.0, 3: 4.0, 4: 6.0, 5: 8.0, 6: 11.0,
    7: 9.0, 8: 10.0, 9: 12.0, 10: 7.0, 11: 5.0, 12: 3.0,
}

# As MONTH_RANK, with fractional codes for January and February.
MONTH_RANK_FRACTIONAL = {
    1: 1.2, 2: 2.65, 3: 4.0, 4: 6.0, 5: 8.0, 6: 11.0,
    7: 9.0, 8: 10.0, 9: 12.0, 10: 7.0, 11: 5.0, 12: 3.0,
}

# Weather class -> code, counted from 0.
WEATHER_CODE = {1: 0.0, 2: 1.0, 3: 2.0, 4: 3.0}

# Temperature / 41 -> position by mean label.
TEMPERATURE_RANK = {
    0.02: 2.0, 0.04: 1.0, 0.06: 3.0, 0.08: 0.0, 0.1: 4.0, 0.12: 6.0, 0.14: 5.0, 0.16: 8.0, 0.18: 7.0, 0.2: 10.0,
    0.22: 9.0, 0.24: 11.0, 0.26: 12.0, 0.28: 13.0, 0.3: 14.0, 0.32: 15.0, 0.34: 16.0, 0.36: 17.0, 0.38: 20.0,
    0.4: 21.0, 0.42: 22.0, 0.44: 18.0, 0.46: 19.0, 0.48: 23.0, 0.5: 24.0, 0.52: 26.0, 0.54: 25.0, 0.56: 29.0,
    0.58: 31.0, 0.6: 32.0, 0.62: 27.0, 0.64: 33.0, 0.66: 34.0, 0.68: 28.0, 0.7: 35.0, 0.72: 37.0, 0.74: 40.0,
    0.76: 46.0, 0.78: 41.0, 0.8: 47.0, 0.82: 45.0, 0.84: 44.0, 0.86: 43.0, 0.88: 48.0, 0.9: 39.0, 0.92: 42.0,
    0.94: 30.0, 0.96: 36.0, 0.98: 49.0, 1.0: 38.0,
}

# Felt temperature / 50 -> position by mean label.
FELT_TEMPERATURE_RANK = {
    0.0: 2.0, 0.0152: 0.0, 0.0303: 1.0, 0.0455: 3.0, 0.0606: 5.0, 0.0758: 4.0, 0.0909: 10.0, 0.1061: 7.0,
    0.1212: 11.0, 0.1364: 8.0, 0.1515: 9.0, 0.1667: 6.0, 0.1818: 13.0, 0.197: 12.0, 0.2121: 14.0, 0.2273: 15.0,
    0.2424: 17.0, 0.2576: 16.0, 0.2727: 18.0, 0.2879: 20.0, 0.303: 23.0, 0.3182: 24.0, 0.3333: 29.0, 0.3485: 28.0,
    0.3636: 26.0, 0.3788: 27.0, 0.3939: 33.0, 0.4091: 34.0, 0.4242: 36.0, 0.4394: 31.0, 0.4545: 32.0, 0.4697: 39.0,
    0.4848: 40.0, 0.5: 41.0, 0.5152: 38.0, 0.5303: 42.0, 0.5455: 37.0, 0.5606: 22.0, 0.5758: 30.0, 0.5909: 35.0,
    0.6061: 43.0, 0.6212: 60.0, 0.6364: 47.0, 0.6515: 61.0, 0.6667: 49.0, 0.6818: 55.0, 0.697: 50.0, 0.7121: 57.0,
    0.7273: 64.0, 0.7424: 58.0, 0.7576: 63.0, 0.7727: 62.0, 0.7879: 52.0, 0.803: 59.0, 0.8182: 53.0, 0.8333: 45.0,
    0.8485: 51.0, 0.8636: 54.0, 0.8788: 46.0, 0.8939: 44.0, 0.9091: 56.0, 0.9242: 48.0, 0.9545: 21.0, 0.9848: 25.0,
    1.0: 19.0,
}

# Humidity / 100 -> position by mean label.  0.26 and 0.32 repeat
# the codes of 0.34 and 0.23.
HUMIDITY_RANK = {
    0.0: 2.0, 0.08: 11.0, 0.1: 15.0, 0.12: 3.0, 0.13: 0.0, 0.14: 1.0, 0.15: 9.0, 0.16: 56.0, 0.17: 86.0, 0.18: 83.0,
    0.19: 70.0, 0.2: 88.0, 0.21: 66.0, 0.22: 85.0, 0.23: 81.0, 0.24: 84.0, 0.25: 65.0, 0.26: 82.0, 0.27: 87.0,
    0.28: 67.0, 0.29: 77.0, 0.3: 80.0, 0.31: 79.0, 0.32: 81.0, 0.33: 68.0, 0.34: 82.0, 0.35: 72.0, 0.36: 78.0,
    0.37: 73.0, 0.38: 71.0, 0.39: 74.0, 0.4: 64.0, 0.41: 58.0, 0.42: 63.0, 0.43: 69.0, 0.44: 46.0, 0.45: 61.0,
    0.46: 62.0, 0.47: 44.0, 0.48: 57.0, 0.49: 52.0, 0.5: 48.0, 0.51: 54.0, 0.52: 50.0, 0.53: 51.0, 0.54: 53.0,
    0.55: 59.0, 0.56: 26.0, 0.57: 49.0, 0.58: 60.0, 0.59: 38.0, 0.6: 36.0, 0.61: 43.0, 0.62: 55.0, 0.63: 35.0,
    0.64: 41.0, 0.65: 37.0, 0.66: 45.0, 0.67: 30.0, 0.68: 40.0, 0.69: 31.0, 0.7: 32.0, 0.71: 24.0, 0.72: 34.0,
    0.73: 42.0, 0.74: 47.0, 0.75: 13.0, 0.76: 19.0, 0.77: 29.0, 0.78: 33.0, 0.79: 28.0, 0.8: 8.0, 0.81: 16.0,
    0.82: 23.0, 0.83: 25.0, 0.84: 20.0, 0.85: 39.0, 0.86: 4.0, 0.87: 12.0, 0.88: 17.0, 0.89: 22.0, 0.9: 27.0,
    0.91: 18.0, 0.92: 10.0, 0.93: 6.0, 0.94: 14.0, 0.96: 21.0, 0.97: 5.0, 1.0: 7.0,
}

# Wind speed / 67 -> bin of two neighbours by mean label; the
# lowest bin holds four.
WIND_BIN = {
    0.0: 3.0, 0.0896: 3.0, 0.1045: 5.0, 0.1343: 6.0, 0.1642: 8.0, 0.194: 9.0, 0.2239: 11.0, 0.2537: 12.0,
    0.2836: 13.0, 0.2985: 13.0, 0.3284: 9.0, 0.3582: 11.0, 0.3881: 14.0, 0.4179: 12.0, 0.4478: 10.0, 0.4627: 8.0,
    0.4925: 7.0, 0.5224: 10.0, 0.5522: 4.0, 0.5821: 5.0, 0.6119: 4.0, 0.6418: 2.0, 0.6567: 7.0, 0.6866: 1.0,
    0.7164: 2.0, 0.7463: 6.0, 0.7761: 1.0, 0.806: 1.0, 0.8358: 1.0, 0.8507: 14.0,
}

# The largest reading each weather column is divided by.
SCALE_MAX = {"temp": 41.0, "atemp": 50.0, "hum": 100.0, "windspeed": 67.0}

# Days per month used to put monthly totals on one footing.
MONTH_DAYS = {1: 31, 2: 28.5, 3: 31, 4: 30, 5: 31, 6: 30, 7: 31, 8: 31, 9: 30, 10: 31, 11: 30, 12: 31}

# A known hour to score by hand, label first, then the twelve features.
CHECK_ROW = (7.68305391, 1.0, 0.0, 1.0, 4.0, 0.0, 4.0, 1.0, 1.0, 0.26, 0.2576, 0.56, 0.1642)

# The row used to try the text sink, label first.
SINK_ROW = (28.6826451, 11, 0, 2, 1, 0, 31, 37, 41, 24)

# The two-column toy rows (number, word).
TOY_ROWS = ((4, "dog"), (8, "bat"), (10, "cat"), (64, "mouse"))
