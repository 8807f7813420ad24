"""Fixed schemas of the pipeline's documents and tables."""

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)

# JSON paths of a station document and the column each becomes.
STATION_FIELDS = {
    "ID": "station_id",
    "AddressInfo.Title": "title",
    "AddressInfo.AddressLine1": "address",
    "AddressInfo.Town": "town",
    "AddressInfo.StateOrProvince": "state_or_province",
    "AddressInfo.Latitude": "latitude",
    "AddressInfo.Longitude": "longitude",
    "Connections": "connections",
    "StatusType.Title": "status",
    "StatusType.ID": "status_id",
    "DateLastStatusUpdate": "date_last_status_update",
    "DateCreated": "date_created",
}

_ID_TITLE = StructType([StructField("ID", IntegerType()), StructField("Title", StringType())])

# One element of a station's Connections array.
CONNECTION = StructType([
    StructField("ID", IntegerType()),
    StructField("ConnectionTypeID", IntegerType()),
    StructField("LevelID", IntegerType()),
    StructField("Amps", IntegerType()),
    StructField("Voltage", DoubleType()),
    StructField("PowerKW", DoubleType()),
    StructField("CurrentType", _ID_TITLE),
    StructField("Quantity", IntegerType()),
    StructField("ConnectionType", _ID_TITLE),
])

# Connection struct paths -> connector table columns.
CONNECTION_FIELDS = {
    "connection_type_id": "conn.ConnectionTypeID",
    "connection_type": "conn.ConnectionType.Title",
    "level_id": "conn.LevelID",
    "amps": "conn.Amps",
    "voltage": "conn.Voltage",
    "power_kw": "conn.PowerKW",
    "quantity": "conn.Quantity",
    "current_type": "conn.CurrentType.Title",
}

# Nested weather observation document.
OBSERVATION = StructType([
    StructField("coord", StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])),
    StructField("weather", ArrayType(StructType([StructField("main", StringType()),
                                                 StructField("description", StringType())]))),
    StructField("main", StructType([StructField("temp", DoubleType()), StructField("pressure", IntegerType()),
                                    StructField("humidity", IntegerType())])),
    StructField("visibility", IntegerType()),
    StructField("rain", StructType([StructField("1h", DoubleType())])),
    StructField("snow", StructType([StructField("1h", DoubleType())])),
    StructField("wind", StructType([StructField("speed", DoubleType())])),
    StructField("clouds", StructType([StructField("all", IntegerType())])),
    StructField("dt", LongType()),
])

# Flat bronze weather row (13 columns).
BRONZE_WEATHER = StructType([
    StructField("lat", DoubleType()), StructField("lon", DoubleType()),
    StructField("weather", StringType()), StructField("description", StringType()),
    StructField("temp", DoubleType()), StructField("pressure", IntegerType()),
    StructField("humidity", IntegerType()), StructField("visibility", IntegerType()),
    StructField("rain", DoubleType()), StructField("snow", DoubleType()),
    StructField("wind_speed", DoubleType()), StructField("clouds", IntegerType()),
    StructField("dt", LongType()),
])

# Columns of the station history.
STATIONS_TABLE = StructType([
    StructField("station_sk", LongType()), StructField("station_id", StringType()),
    StructField("title", StringType()), StructField("address", StringType()),
    StructField("town", StringType()), StructField("state_or_province", StringType()),
    StructField("latitude", DoubleType()), StructField("longitude", DoubleType()),
    StructField("weather_zone_lat", DoubleType()), StructField("weather_zone_lon", DoubleType()),
    StructField("status", StringType()), StructField("status_id", IntegerType()),
    StructField("date_created", TimestampNTZType()), StructField("date_last_status_update", TimestampNTZType()),
    StructField("valid_from", TimestampNTZType()), StructField("valid_to", TimestampNTZType()),
    StructField("is_current", BooleanType()), StructField("ingest_timestamp", TimestampNTZType()),
])
