"""Declared schemas (never inferred)."""
from pyspark.sql import types as T

TRIPS = T.StructType([
    T.StructField("ride_id", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("ended_at", T.TimestampNTZType()),
    T.StructField("member_casual", T.StringType()),
    T.StructField("rideable_type", T.StringType()),
    T.StructField("start_station_id", T.StringType()),
    T.StructField("start_station_name", T.StringType()),
    T.StructField("end_station_name", T.StringType()),
    T.StructField("start_lat", T.DoubleType()),
    T.StructField("start_lng", T.DoubleType()),
])

# Raw CSV text: every column read as string, parsed afterwards so that bad
# values become NULL instead of failing the scan.
TRIPS_RAW = T.StructType([T.StructField(f.name, T.StringType()) for f in TRIPS.fields])

N_LAGS = 28
LAG_COLS = [f"lag_{i}" for i in range(1, N_LAGS + 1)]
CALENDAR_COLS = ["hour", "day_of_week", "is_weekend", "month"]
CATEGORICAL_COLS = CALENDAR_COLS + ["station_rank"]
MODEL_INPUTS = LAG_COLS + CATEGORICAL_COLS

HOURLY_CUBE = T.StructType([
    T.StructField("start_hour", T.TimestampNTZType()),
    T.StructField("start_station_id", T.StringType()),
    T.StructField("member_casual", T.StringType()),
    T.StructField("rideable_type", T.StringType()),
    T.StructField("count", T.LongType()),
])

FEATURES = T.StructType(
    [T.StructField("start_hour", T.TimestampNTZType()),
     T.StructField("station_id", T.StringType()),
     T.StructField("total_trips", T.LongType()),
     T.StructField("station_rank", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in LAG_COLS]
    + [T.StructField(c, T.IntegerType()) for c in CALENDAR_COLS])

# Columns of the forecast table.
PREDICTIONS = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("station_rank", T.IntegerType()),
    T.StructField("target_hour", T.TimestampType()),
    T.StructField("predicted_trips", T.DoubleType()),
    T.StructField("prediction_generated_at", T.TimestampType()),
])

# Field names of the monthly report document.
MONTHLY_STATS = T.StructType([
    T.StructField("summary", T.StructType([
        T.StructField("totalTrips", T.LongType()),
        T.StructField("avgDuration", T.DoubleType()),
        T.StructField("memberRatio", T.DoubleType()),
        T.StructField("peakHour", T.IntegerType()),
        T.StructField("fileName", T.StringType()),
    ])),
    T.StructField("topStationNames", T.MapType(T.StringType(), T.StringType())),
    T.StructField("hourlyDensity", T.ArrayType(T.StructType([
        T.StructField("hour", T.IntegerType()), T.StructField("type", T.StringType()),
        T.StructField("count", T.LongType())]))),
    T.StructField("rideableData", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()), T.StructField("count", T.LongType())]))),
    T.StructField("durationData", T.ArrayType(T.StructType([
        T.StructField("bin", T.IntegerType()), T.StructField("binLabel", T.StringType()),
        T.StructField("type", T.StringType()), T.StructField("count", T.LongType())]))),
    T.StructField("topRoutes", T.ArrayType(T.StructType([
        T.StructField("route", T.StringType()), T.StructField("count", T.LongType())]))),
    T.StructField("geoData", T.ArrayType(T.StructType([
        T.StructField("station", T.StringType()), T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()), T.StructField("count", T.LongType())]))),
    T.StructField("topStations", T.ArrayType(T.StructType([
        T.StructField("station", T.StringType()), T.StructField("count", T.LongType())]))),
])

# Field names of the metrics document (its rounding digits are in plans.training).
MODEL_METRICS = T.StructType([
    T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("mape", T.DoubleType()),
    T.StructField("champion_mae", T.DoubleType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("n_test", T.LongType()),
    T.StructField("n_features", T.IntegerType()),
    T.StructField("n_estimators", T.IntegerType()),
    T.StructField("top_features", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("promotion_status", T.StringType()),
    T.StructField("run_date", T.StringType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("champion_mae", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("path", T.StringType()),
])
