"""Fixed values of the panel model. Each can be overridden by a function argument."""

from __future__ import annotations

# --- calendar -----------------------------------------------------------------
LOCAL_ZONE = "America/Chicago"      # zone of file stamps
FIXED_OFFSET_HOURS = -7             # timestamp_mst = UTC - 7 h, no DST
DATA_CUTOFF = "2023-05-15 00:00:00"  # earlier rows are known to be bad
TRAIN_LOOKBACK_DAYS = 365           # default start = now - 365 days

# --- windows and splits -------------------------------------------------------
INPUT_CHUNK = 168                   # past hours per training window
HORIZON = 120                       # forecast hours per training window
REVISION_BUFFER_HOURS = 168         # newest hours kept out of every split
BACKTEST_STRIDE = 25                # hours between backtest origins
ORIGIN_DAYS = 10                    # daily origins offered for review
FORECASTABLE_DAYS = 60              # how far back an origin may be chosen
DISPLAY_LOOKBACK_HOURS = 168

# --- prices -------------------------------------------------------------------
LOCATION_PATTERN = "PSCO_"
LOCATION_EXCLUDE = "_ARPA"
CLIP_QUANTILES = (0.0025, 0.9975)
PRICE_CLAMP = 200.0
NET_LOAD_GUARD = 1.0

# --- columns ------------------------------------------------------------------
ID = "unique_id"
TIME = "timestamp_mst"
TARGET = "LMP"
ROLLING_STEPS = (2, 3, 4, 5, 6)     # step i sums i + 1 rows
FUTURE_COLS = [
    "MTLF", "Wind_Forecast_MW", "Solar_Forecast_MW",
    "re_ratio", "re_diff",
    "load_net_re", "load_net_re_diff",
    "load_net_re_diff_rolling_2", "load_net_re_diff_rolling_3",
    "load_net_re_diff_rolling_4", "load_net_re_diff_rolling_6",
]
PAST_COLS = [
    "Averaged_Actual", "lmp_diff",
    "lmp_diff_rolling_2", "lmp_diff_rolling_3",
    "lmp_diff_rolling_4", "lmp_diff_rolling_6",
    "lmp_load_net_re",
]

# --- forecasts ----------------------------------------------------------------
QUANTILE_LEVELS = [0.01] + [i / 20 for i in range(1, 20)] + [0.99]
REPORT_QUANTILES = [0.1, 0.5, 0.9]
TARGET_COVERAGE = 0.8
SAMPLES_REQUEST = 500
SAMPLES_BACKTEST = 200
CI_WEIGHT = 0.25
TOP_TRIALS = 5
