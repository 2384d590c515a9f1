"""Column lists and read schemas of the two grains."""

from pyspark.sql import types as T

# Variables of a daily and of an hourly observation.
DAILY_VARIABLES = (
    "weather_code", "temperature_2m_max", "temperature_2m_min", "apparent_temperature_max",
    "apparent_temperature_min", "sunrise", "sunset", "daylight_duration", "sunshine_duration",
    "uv_index_max", "uv_index_clear_sky_max", "precipitation_sum", "rain_sum", "showers_sum",
    "snowfall_sum", "precipitation_hours", "precipitation_probability_max", "wind_speed_10m_max",
    "wind_gusts_10m_max", "wind_direction_10m_dominant", "shortwave_radiation_sum",
    "et0_fao_evapotranspiration",
)
DAILY_REQUESTED = (
    "weather_code", "temperature_2m_max", "temperature_2m_min", "apparent_temperature_max",
    "apparent_temperature_min", "daylight_duration", "sunshine_duration", "precipitation_sum",
    "rain_sum", "snowfall_sum", "precipitation_hours", "wind_speed_10m_max", "wind_gusts_10m_max",
    "wind_direction_10m_dominant", "shortwave_radiation_sum", "et0_fao_evapotranspiration",
)
HOURLY_VARIABLES = (
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "apparent_temperature",
    "precipitation_probability", "precipitation", "rain", "showers", "snowfall", "snow_depth",
    "weather_code", "pressure_msl", "surface_pressure", "cloud_cover", "cloud_cover_low",
    "cloud_cover_mid", "cloud_cover_high", "visibility", "evapotranspiration",
    "et0_fao_evapotranspiration", "vapour_pressure_deficit", "wind_speed_10m", "wind_speed_80m",
    "wind_speed_120m", "wind_speed_180m", "wind_direction_10m", "wind_direction_80m",
    "wind_direction_120m", "wind_direction_180m", "wind_gusts_10m", "temperature_80m",
    "temperature_120m", "temperature_180m", "soil_temperature_0cm", "soil_temperature_6cm",
    "soil_temperature_18cm", "soil_temperature_54cm", "soil_moisture_0_to_1cm",
    "soil_moisture_1_to_3cm", "soil_moisture_3_to_9cm", "soil_moisture_9_to_27cm",
    "soil_moisture_27_to_81cm", "uv_index", "uv_index_clear_sky", "is_day", "sunshine_duration",
    "cape", "shortwave_radiation", "shortwave_radiation_instant", "direct_radiation_instant",
)

STATION = T.StructField("station", T.StringType(), False)


def observations(ts: str, variables: tuple[str, ...], daily: bool) -> T.StructType:
    """Schema of an observation table: station, time axis, one double per variable."""
    kind = T.DateType() if daily else T.TimestampType()
    fields = [STATION, T.StructField(ts, kind)]
    return T.StructType(fields + [T.StructField(v, T.DoubleType()) for v in variables])


DAILY_SCHEMA = observations("date", DAILY_VARIABLES, daily=True)
HOURLY_SCHEMA = observations("datetime", HOURLY_VARIABLES, daily=False)

# One answer of the weather source: parallel arrays over a half-open axis.
RESPONSE_SCHEMA = T.StructType(
    [
        STATION,
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("interval_s", T.IntegerType()),
        T.StructField("variables", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
    ]
)
