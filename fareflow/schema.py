"""Table layouts, as DDL strings Spark reads directly."""

# The trip CSV layout. Columns bind by position.
TRIP_COLUMNS = """
    vendorid STRING,
    tpep_pickup_datetime TIMESTAMP,
    tpep_dropoff_datetime TIMESTAMP,
    passenger_count INT,
    trip_distance DOUBLE,
    pickup_longitude DOUBLE,
    pickup_latitude DOUBLE,
    ratecodeid INT,
    store_and_fwd_flag STRING,
    dropoff_longitude DOUBLE,
    dropoff_latitude DOUBLE,
    payment_type INT,
    fare_amount DOUBLE,
    extra DOUBLE,
    mta_tax DOUBLE,
    tip_amount DOUBLE,
    tolls_amount DOUBLE,
    improvement_surcharge DOUBLE,
    total_amount DOUBLE
"""

# What the load adds. `year` and `month` are partition columns.
LAKE_COLUMNS = TRIP_COLUMNS + ", processed_at TIMESTAMP, year INT, month INT"

# The batch load adds one more partition level, the batch a row came with.
BATCH_LAKE_COLUMNS = LAKE_COLUMNS + ", batch_id STRING"

# The columns of the daily report, in order.
DAILY_REPORT = (
    "date",
    "total_trips",
    "total_revenue",
    "avg_cost_per_trip",
    "avg_distance_miles",
    "avg_duration_min",
    "avg_speed_mph",
    "avg_tip_percent",
    "calculated_at",
)

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# One row per file and attempt, with the lines of it that did not fit the layout, plus one `published` row per batch once the
# downstream jobs have covered it. Compaction adds a `merged` row for each batch it
# replaces and an `origin` row for each that those had replaced; both name the new batch.
LEDGER_COLUMNS = """
    path STRING,
    length BIGINT,
    modified_at TIMESTAMP,
    batch_id STRING,
    status STRING,
    error STRING,
    recorded_at TIMESTAMP,
    merged_into STRING,
    dropped BIGINT
"""

# What the daily measures are made of, by day and batch.
SUMS_COLUMNS = """
    bucket TIMESTAMP,
    trips BIGINT,
    revenue DOUBLE,
    miles DOUBLE,
    minutes DOUBLE,
    tips DOUBLE,
    tipped BIGINT,
    fares DOUBLE,
    batch_id STRING
"""
