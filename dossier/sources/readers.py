"""Readers of landed files: registry CSV, page and place JSON, checkpoints, rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.functions.text import title_address_line, title_city, title_firm, title_law_school, title_name

#: Header of the registry file; all columns are text. Fixed values.
REGISTRY_COLUMNS = [
    "Registration Number", "First Name", "Middle Name", "Last Name", "Suffix", "Company Name", "Street 1", "Street 2", "City", "State",
    "Zip", "Country", "County", "Phone Number", "Year Admitted", "Law School", "Status",
]
#: Registry status -> our status; others pass through. Fixed values.
STATUSES = {
    "Currently registered": "Active",
    "Due to reregister within 30 days of birthday": "Active",
    "Suspended, currently registered": "Suspended",
    "Suspended, due to reregister": "Suspended",
    "Suspended, delinquent": "Suspended",
    "Delinquent": "Inactive",
    "Resigned": "Resigned",
    "Resigned from bar - disciplinary reason": "Resigned",
    "Disbarred": "Disbarred",
    "Incapacitated": "Inactive",
    "Deceased": "Deceased",
}
#: Statuses that are kept by default. Fixed values.
ACTIVE = ["Currently registered", "Due to reregister within 30 days of birthday", "Suspended, currently registered", "Suspended, due to reregister"]


def registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest file (by name) under ``path``, all text; a byte order mark in the header is cut. Files may be a glob."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in REGISTRY_COLUMNS])
    files = spark.read.format("binaryFile").load(path).select("path")  # names only: the column pruning leaves the contents unread
    newest = files.agg(F.max("path")).first()[0]
    if newest is None:
        return spark.createDataFrame([], schema)
    # Columns are taken by position with an explicit schema, so the mark in front of the first name does no harm.
    return spark.read.csv(newest, header=True, schema=schema, encoding="UTF-8", enforceSchema=True, mode="PERMISSIVE")


def registry_records(rows: DataFrame, active_only: bool = True) -> DataFrame:
    """Registry rows as raw records in title case: names and address put together, suffixes in upper case, rows without a name left out.

    The address reads "streets, Town, ST ZIP"; the country follows unless it is the home country.
    """
    clean = lambda c: F.coalesce(F.trim(c), F.lit(""))
    full = lambda c: F.nullif(c, F.lit(""))
    names = [full(title_name(clean(c))) for c in ("First Name", "Middle Name", "Last Name")]
    city, state, zip_ = title_city(clean("City")), F.upper(clean("State")), clean("Zip")
    town = F.when(city == "", None).when(state == "", city).otherwise(F.concat(city, F.lit(", "), F.concat_ws(" ", state, full(zip_))))
    lines = full(F.concat_ws(", ", full(title_address_line(clean("Street 1"))), full(title_address_line(clean("Street 2"))), town))
    country = F.when(~F.upper(clean("Country")).isin("", "UNITED STATES OF AMERICA"), F.initcap(clean("Country")))
    statuses = F.create_map(*[F.lit(x) for pair in STATUSES.items() for x in pair])
    kept = rows.where(clean("Status").isin(ACTIVE)) if active_only else rows
    out = kept.select(
        full(F.concat_ws(" ", *names, full(F.upper(clean("Suffix"))))).alias("full_name"),
        names[1].alias("middle_name"),
        full(clean("Registration Number")).alias("bar_number"),
        full(title_firm(clean("Company Name"))).alias("firm_name"),
        F.when(lines.isNotNull(), F.concat_ws(", ", lines, country)).alias("address"),
        full(clean("Phone Number")).alias("phone"),
        clean("Year Admitted").try_cast("int").alias("admission_year"),
        full(title_law_school(clean("Law School"))).alias("law_school"),
        F.coalesce(statuses[clean("Status")], clean("Status")).alias("license_status"),
    )
    return out.where("full_name is not null")


CHECKPOINT = "state string, last_page struct<lawyers:array<map<string,string>>>, lawyers array<map<string,string>>, timestamp string"


def checkpoint_records(spark: SparkSession, path: str) -> DataFrame:
    """(state, record) of checkpoint files in either shape, records at the top or under ``last_page``; broken files give no rows."""
    docs = spark.read.schema(CHECKPOINT).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return docs.select("state", F.explode(F.coalesce("last_page.lawyers", "lawyers")).alias("record"))


PLACE = (
    "place_id string, name string, formatted_address string, formatted_phone_number string, website string, rating double, user_ratings_total int, url string,"
    " geometry struct<location:struct<lat:double,lng:double>>, reviews array<struct<author_name:string,rating:int,text:string,time:long>>, photos array<struct<photo_reference:string,width:int,height:int>>"
)


def place_details(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Place payloads (JSON texts) as rows: at most five reviews and photos, no keys in links; payloads without an id are left out."""
    p = payloads.withColumn("p", F.from_json(column, PLACE)).where("p.place_id is not null")
    others = [c for c in payloads.columns if c != column]
    return p.select(
        *others, "p.place_id", "p.name", "p.formatted_address", F.col("p.formatted_phone_number").alias("formatted_phone"), "p.website",
        F.col("p.rating").alias("google_rating"), F.col("p.user_ratings_total").alias("google_review_count"),
        F.col("p.geometry.location.lat").alias("geo_lat"), F.col("p.geometry.location.lng").alias("geo_lng"),
        F.slice("p.reviews", 1, 5).alias("reviews"), F.slice("p.photos", 1, 5).alias("photos"), F.regexp_replace("p.url", r"([?&])key=[^&]*", "$1key=").alias("maps_url"),
    )


def rule_table(spark: SparkSession, rules: dict[str, dict], columns: dict[str, str], name: str = "name") -> DataFrame:
    """A configuration tree as a table: one row an entry, ``columns`` (name -> type) of it, null where an entry lacks one."""
    schema = T.StructType([T.StructField(name, T.StringType())] + [T.StructField(c, T._parse_datatype_string(t)) for c, t in columns.items()])
    return spark.createDataFrame([(key, *[entry.get(c) for c in columns]) for key, entry in rules.items()], schema)


def adaptive_buckets(df: DataFrame, name: str, cap: int) -> DataFrame:
    """(bucket, n): rows by the first two letters of a name, and by three where two letters have ``cap`` rows or more."""
    low = df.select(F.lower(F.trim(name)).alias("k")).where("k <> ''")
    three = low.groupBy(F.left("k", F.lit(2)).alias("two"), F.left("k", F.lit(3)).alias("three")).agg(F.count("*").alias("n"))
    two = three.groupBy("two").agg(F.sum("n").alias("all"))
    joined = three.join(two, "two")
    return joined.groupBy(F.when(F.col("all") >= cap, F.col("three")).otherwise(F.col("two")).alias("bucket")).agg(F.sum("n").alias("n"))


def cached(requests: DataFrame, cache: DataFrame, now: Column, hours: int) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of ``requests(cache_key)`` against the newest entry a key of ``cache(cache_key, response, created_at)`` no older than ``hours``."""
    fresh = cache.where(F.col("created_at") > now - F.make_dt_interval(hours=F.lit(hours))).groupBy("cache_key").agg(F.max_by("response", "created_at").alias("response"))
    return requests.join(fresh, "cache_key"), requests.join(fresh, "cache_key", "left_anti")
