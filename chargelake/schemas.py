"""Column types of the raw inputs and the names they get after cleaning."""

RAW_SESSION_DDL = (
    "_id STRING, sessionID STRING, stationID STRING, siteID STRING, clusterID STRING, "
    "spaceID STRING, userID STRING, connectionTime STRING, disconnectTime STRING, "
    "doneChargingTime STRING, kWhDelivered DOUBLE"
)

# fixed values: raw name -> clean name
SESSION_NAMES = {
    "connectionTime": "session_start",
    "disconnectTime": "session_end",
    "doneChargingTime": "charging_end",
    "kWhDelivered": "energy_kwh",
    "stationID": "station_id",
    "siteID": "site_id",
    "sessionID": "session_id",
    "userID": "user_id",
    "clusterID": "cluster_id",
    "spaceID": "space_id",
}

# fixed values: table of the grid data set -> measure it holds
GRID_MEASURES = {
    "volume": "volume_kwh",
    "occupancy": "active_chargers",
    "price": "price_per_kwh",
    "duration": "avg_duration_min",
}
GRID_TABLES = ["time", *GRID_MEASURES, "information"]

# fixed values: grid attribute -> clean name
GRID_ATTRIBUTES = {
    "count": "total_chargers",
    "fast_count": "fast_count",
    "slow_count": "slow_count",
    "area": "area",
    "lon": "longitude",
    "la": "latitude",
    "CBD": "is_cbd",
    "dynamic_pricing": "dynamic_pricing",
}
ATTRIBUTE_TYPES = {
    "count": "int", "fast_count": "int", "slow_count": "int", "area": "double",
    "lon": "double", "la": "double", "CBD": "int", "dynamic_pricing": "int",
}
