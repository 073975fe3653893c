"""Declared schemas of the tables the operators read and write."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


SNAPSHOTS = _struct(
    event_id=T.LongType(),
    station_id=T.IntegerType(),
    vehicle_id=T.IntegerType(),
    dateTime=T.TimestampNTZType(),
    nbBikes=T.IntegerType(),
    dirTag=T.StringType(),
    lat=T.DoubleType(),
    lon=T.DoubleType(),
    value=T.DoubleType(),
)

ROUTES = _struct(
    station_id=T.IntegerType(),
    station_name=T.StringType(),
    start_lat=T.DoubleType(),
    start_lon=T.DoubleType(),
    end_lat=T.DoubleType(),
    end_lon=T.DoubleType(),
)

TRIPS = _struct(trip_id=T.LongType(), station_id=T.LongType())

STOP_TIMES = _struct(trip_id=T.LongType(), stop_sequence=T.IntegerType(), stop_id=T.LongType())

STOPS = _struct(stop_id=T.LongType(), stop_lat=T.DoubleType(), stop_lon=T.DoubleType())

FREQUENCY_FACT = _struct(
    station_id=T.IntegerType(), startTime=T.TimestampNTZType(), freq=T.LongType()
)

TRAVEL_FACT = _struct(
    station_id=T.IntegerType(), startTime=T.TimestampNTZType(), travelTime=T.DoubleType()
)
