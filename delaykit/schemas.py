"""One StructType per dataset; ``conform`` casts a DataFrame to any of them."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**types) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in types.items()])


FEATURES = _schema(
    ArrDelay=DoubleType,
    CRSArrTime=TimestampType,
    CRSDepTime=TimestampType,
    Carrier=StringType,
    DayOfMonth=IntegerType,
    DayOfWeek=IntegerType,
    DayOfYear=IntegerType,
    DepDelay=DoubleType,
    Dest=StringType,
    Distance=DoubleType,
    FlightDate=DateType,
    FlightNum=StringType,
    Origin=StringType,
)

BATCH_REQUEST = _schema(
    Carrier=StringType,
    DayOfMonth=IntegerType,
    DayOfWeek=IntegerType,
    DayOfYear=IntegerType,
    DepDelay=DoubleType,
    Dest=StringType,
    Distance=DoubleType,
    FlightDate=DateType,
    FlightNum=StringType,
    Origin=StringType,
    Timestamp=TimestampType,
)

# Message on the wire: dates and times are still text.
STREAM_REQUEST = _schema(
    UUID=StringType,
    Carrier=StringType,
    DayOfMonth=IntegerType,
    DayOfWeek=IntegerType,
    DayOfYear=IntegerType,
    DepDelay=DoubleType,
    Dest=StringType,
    Distance=DoubleType,
    FlightDate=StringType,
    FlightNum=StringType,
    Origin=StringType,
    Timestamp=StringType,
)

# Older message variant in which the sender already indexed the categories.
INDEXED_STREAM_REQUEST = StructType(
    STREAM_REQUEST.fields
    + _schema(
        Prediction=StringType,
        Carrier_index=DoubleType,
        Origin_index=DoubleType,
        Dest_index=DoubleType,
        Route_index=DoubleType,
    ).fields
)

# Scored request as stored; the response topic carries the same fields under
# their CamelCase names (see RESPONSE_NAMES).
RESPONSE_TABLE = _schema(
    uuid=StringType,
    origin=StringType,
    dest=StringType,
    carrier=StringType,
    route=StringType,
    flight_date=DateType,
    day_of_week=IntegerType,
    day_of_year=IntegerType,
    day_of_month=IntegerType,
    dep_delay=DoubleType,
    distance=DoubleType,
    prediction=DoubleType,
    timestamp=TimestampType,
)

DISTANCES = _schema(Origin=StringType, Dest=StringType, Distance=DoubleType)

# CamelCase name of a response field -> stored name.
RESPONSE_NAMES = {
    "UUID": "uuid",
    "Origin": "origin",
    "Dest": "dest",
    "Carrier": "carrier",
    "Route": "route",
    "FlightDate": "flight_date",
    "DayOfWeek": "day_of_week",
    "DayOfYear": "day_of_year",
    "DayOfMonth": "day_of_month",
    "DepDelay": "dep_delay",
    "Distance": "distance",
    "Prediction": "prediction",
    "Timestamp": "timestamp",
}

CATEGORY_COLUMNS = ["Carrier", "Origin", "Dest", "Route"]
NUMERIC_COLUMNS = ["DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear"]
