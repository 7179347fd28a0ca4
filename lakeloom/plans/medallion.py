"""Bronze, silver and gold layers of market, weather and sales data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.times import ZULU_STAMP, stamp_in

# The nested schema of a coin's detail answer and the flat columns made of it.
COIN_CURRENCIES = ("usd", "chf")
COIN_PRICES = ("ath", "atl", "current_price", "market_cap", "total_volume")
# Measures of the daily market table.
MARKET_MEASURES = (
    ("avg", "current_price"), ("total", "market_cap"), ("avg", "market_cap_rank"),
    ("total", "fully_diluted_valuation"), ("total", "total_volume"), ("avg", "high_24h"),
    ("avg", "low_24h"), ("avg", "price_change_24h"), ("avg", "price_change_percentage_24h"),
    ("total", "market_cap_change_24h"), ("avg", "market_cap_change_percentage_24h"),
    ("avg", "circulating_supply"), ("avg", "total_supply"), ("avg", "max_supply"), ("avg", "ath"),
    ("avg", "ath_change_percentage"), ("avg", "atl"), ("avg", "atl_change_percentage"),
)
ROI = "times DOUBLE, currency STRING, percentage DOUBLE"


def markets_silver(bronze: DataFrame) -> DataFrame:
    """Return figures as text, file columns, load time and date out of the file path."""
    roi = lambda member: F.get_json_object("roi", f"$.{member}").alias(f"roi_{member}")
    with_file = bronze.select(
        "*",
        roi("times"),
        roi("currency"),
        roi("percentage"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
    )
    stamped = with_file.withColumn("load_timestamp", stamp_in(F.col("file_path"), *ZULU_STAMP))
    return stamped.withColumn("date", F.to_date("load_timestamp")).drop("_rescued_data", "_metadata", "roi")


def markets_silver_typed(bronze: DataFrame) -> DataFrame:
    """Return figures with their types, by a declared schema."""
    parsed = F.from_json(F.col("roi"), ROI)
    return bronze.withColumn("_roi", parsed).select(
        *[c for c in bronze.columns if c != "roi"],
        F.col("_roi.times").alias("roi_times"),
        F.col("_roi.currency").alias("roi_currency"),
        F.col("_roi.percentage").alias("roi_percentage"),
    )


def markets_gold(silver: DataFrame) -> DataFrame:
    """18 averages and totals per year, month and date; a total keeps the name ``total_volume``."""
    function = {"avg": F.avg, "total": F.sum}
    measures = []
    for kind, column in MARKET_MEASURES:
        name = column if column == "total_volume" else f"{kind}_{column}"
        measures.append(function[kind](column).alias(name))
    return silver.groupBy("year", "month", "date").agg(*measures)


def coins_silver(bronze: DataFrame) -> DataFrame:
    """17 flat columns of a coin's detail, for all coins in one pass."""
    data = F.col("market_data")
    prices = [
        data[price][currency].alias(f"{price}_{currency}")
        for price in COIN_PRICES
        for currency in COIN_CURRENCIES
    ]
    changes = [
        data["price_change_24h_in_currency"][c].alias(f"price_change_24h_{c}") for c in COIN_CURRENCIES
    ]
    return bronze.select(
        "id",
        "symbol",
        "name",
        *prices,
        data["price_change_24h"].alias("price_change_24h"),
        *changes,
        data["price_change_percentage_24h"].alias("price_change_percentage_24h"),
    )


def coins_gold(frames: list[DataFrame]) -> DataFrame:
    """All coins without duplicate rows."""
    return reduce(DataFrame.union, frames).distinct()


def _epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def weather_silver(bronze: DataFrame) -> DataFrame:
    """29 flat columns of a weather answer."""
    weather = F.get("weather", F.lit(0))
    main = ("Feels_Like", "Temp_Min", "Pressure", "Humidity", "Temp", "Temp_Max")
    return bronze.select(
        F.col("base").alias("Base"),
        F.col("clouds.all").alias("Clouds_All"),
        F.col("cod").alias("Cod"),
        F.col("coord.lon").alias("Coord_Lon"),
        F.col("coord.lat").alias("Coord_Lat"),
        _epoch(F.col("dt")).alias("Weather_TimeStamp"),
        F.col("id").alias("ID"),
        *[F.col(f"main.{m.lower()}").alias(f"Main_{m}") for m in main],
        F.col("name").alias("City"),
        F.col("sys.country").alias("Sys_Country"),
        F.col("sys.id").alias("Sys_ID"),
        _epoch(F.col("sys.sunrise")).alias("Sys_Sunrise"),
        _epoch(F.col("sys.sunset")).alias("Sys_Sunset"),
        F.col("sys.type").alias("Sys_Type"),
        F.col("timezone").alias("Timezone"),
        F.col("visibility").alias("Visibility"),
        *[
            weather[m.lower()].alias(f"Weather_0_{m}")
            for m in ("Icon", "Description", "Main", "ID")
        ],
        F.col("wind.speed").alias("Wind_Speed"),
        F.col("wind.deg").alias("Wind_Deg"),
        "LoadID",
        "LoadTimeStamp",
    )


def cities_silver(bronze: DataFrame) -> DataFrame:
    """City rows with state and country out of the answer map."""
    answer = lambda key: F.try_element_at("Response", F.lit(key))
    return bronze.select(
        "City",
        "Longitude",
        "Latitude",
        "Response",
        answer("state").alias("State"),
        answer("country").alias("Country"),
        "LoadID",
        "LoadTimeStamp",
    )


def weather_detailed(weather: DataFrame, cities: DataFrame) -> DataFrame:
    """Weather rows with the place of their city."""
    place = ("City", "Longitude", "Latitude", "State", "Country")
    return weather.join(cities.select(*place), "City").select(
        *place,
        "Clouds_All",
        "Weather_TimeStamp",
        "Main_Feels_Like",
        "Main_Temp_Min",
        "Main_Temp",
        "Main_Temp_Max",
        F.col("Sys_Sunrise").alias("Sunrise"),
        F.col("Sys_Sunset").alias("Sunset"),
        "Visibility",
        "Wind_Speed",
        "Wind_Deg",
    )


def weather_aggregated(weather: DataFrame) -> DataFrame:
    """Daily figures per city."""
    return weather.groupBy("City", F.to_date("Weather_TimeStamp").alias("Date")).agg(
        F.avg("Main_Temp").alias("Avg_Temperature"),
        F.max("Main_Temp_Max").alias("Max_Temperature"),
        F.min("Main_Temp_Min").alias("Min_Temperature"),
        F.avg("Wind_Speed").alias("Avg_Wind_Speed"),
        F.avg("Visibility").alias("Avg_Visibility"),
    )


def monthly_sales(raw: DataFrame, day: str, amount: str) -> DataFrame:
    """Sales per month; rows without a day are left out."""
    return (
        raw.filter(F.col(day).isNotNull())
        .groupBy(F.date_trunc("month", day).alias("month"))
        .agg(F.sum(amount).alias("total_sales"))
    )
