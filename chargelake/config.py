"""Fixed values of the tariff model. They must stay as they are for right results."""

# fixed values: prices per kWh and utilisation thresholds
BASELINE_TARIFF = 15.0
SURGE_UTILISATION = 0.80
DISCOUNT_UTILISATION = 0.30
LOWEST_TARIFF = 9.0
HIGHEST_TARIFF = 30.0

# fixed values: hours of the day per tariff period, all others are off_peak
PEAK_HOURS = [8, 9, 10, 11, 17, 18, 19, 20]
SHOULDER_HOURS = [6, 7, 12, 13, 14, 15, 16, 21, 22]

# fixed values: time-of-use factor on the baseline tariff
PEAK_FACTOR = 1.1
OFF_PEAK_FACTOR = 0.9

# fixed values: demand response
ELASTICITY = -0.3
PRICING_DEMAND_BOUNDS = (0.2, 1.8)
EVALUATION_DEMAND_BOUNDS = (0.3, 1.5)

# fixed values: multiplier of each pricing tier
TIER_MULTIPLIERS = {
    "off_peak": 0.7,
    "low": 0.9,
    "normal": 1.0,
    "high": 1.2,
    "surge": 1.5,
}
TIER_STEP = 0.95

# fixed values: utilisation below which a tier ends
TIER_BOUNDS = {
    "off_peak": 0.30,
    "low": 0.50,
    "normal": 0.70,
    "high": 0.80,
    "surge": 1.00,
}

# fixed values: feature windows, in rows of the hourly table
LAGS = [1, 2, 6, 24]
ROLLING_ROWS = [1, 6, 24]
SEQUENCE_ROWS = 24

# fixed values: data split and seed
TRAIN_SHARE = 0.70
VALIDATION_SHARE = 0.15
SEED = 42

SESSION_SOURCE = "ACN"
GRID_SOURCE = "UrbanEV"
GRID_PREFIX = "UV_"
