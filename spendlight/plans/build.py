"""The whole job: raw CSV tables to a registered star schema and its marts.

    python -m spendlight.plans.build RAW_FOLDER OUTPUT_FOLDER [--database NAME]
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlight.functions import masked_key
from spendlight.operators import increments, marts, quality, star
from spendlight.operators.joins import broadcast_if_small
from spendlight.plans import mart_sql, versions
from spendlight.schemas import PRIMARY_KEYS, RAW, STAR, required_columns
from spendlight.session import build_session
from spendlight.sources import catalog, files


KEYS = T.StructType([STAR["dim_campaign"]["campaign_id"], STAR["dim_campaign"]["campaign_key"]])
BY_DATE = ("fact_campaign_daily", "mart_campaign_daily")
TOTALS = {"totals_by_campaign": increments.BY_CAMPAIGN, "totals_by_day": increments.BY_DAY}
# The totals hold every key of the fact, however old, in a row per campaign or day and channel.
TOTALS_FOREIGN_KEYS = [
    ("totals_by_campaign", "campaign_key", "dim_campaign"),
    ("totals_by_day", "date_key", "dim_date"),
]


def write_star(
    ad_events: DataFrame,
    conversions: DataFrame,
    campaigns: DataFrame,
    days: DataFrame,
    folder: str,
    users: DataFrame | None = None,
    known: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Write the star schema below ``folder`` and return it as read back.

    The campaign dimension is written first and the fact is built from the
    written table, so keys are assigned once. ``known`` are the campaign keys of
    earlier builds, which stay; ``users`` is a masked user dimension.
    """
    spark = ad_events.sparkSession
    base = folder.rstrip("/")
    files.write_parquet(star.campaign_dimension(campaigns, known), f"{base}/dim_campaign")
    files.write_parquet(star.date_dimension(days), f"{base}/dim_date")
    if users is not None:
        files.write_parquet(users, f"{base}/dim_users")
    dim_campaign = files.read_parquet(spark, f"{base}/dim_campaign", STAR["dim_campaign"])
    files.write_parquet(star.campaign_keys(dim_campaign, known), f"{base}/campaign_keys")
    # Where the written dimension is small, the cells meet it without another shuffle.
    fact = star.campaign_daily_fact(ad_events, conversions, broadcast_if_small(dim_campaign))
    files.write_by_date(fact, f"{base}/fact_campaign_daily", whole=True)
    return read_star(spark, folder)


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: files.read_parquet(spark, f"{folder.rstrip('/')}/{name}", schema) for name, schema in STAR.items()}


def register_star(spark: SparkSession, database: str, folder: str) -> None:
    """Register the star's folders as tables under their own names."""
    catalog.create_database(spark, database)
    for name, schema in STAR.items():
        partition = "date" if name == "fact_campaign_daily" else None
        catalog.register_parquet(spark, database, name, f"{folder.rstrip('/')}/{name}", schema, partition)


def write_totals(
    spark: SparkSession, whole: DataFrame, new: DataFrame, folder: str, database: str, version: str,
    dates: tuple[str, str] | None,
) -> dict[str, DataFrame]:
    """Write and register the totals that the marts are built from, and give them as read back.

    A build over some ``dates`` changes the totals of the published fact's version
    by these days: of the fact it reads the days as they were and as they are, ``new``.
    Without dates, or where that version has no totals, they are those of the
    ``whole`` fact.
    """
    before = catalog.published_version(spark, database, "fact_campaign_daily") if dates else None
    of_version = lambda name: f"`{database}`.`{catalog.versioned(name, before)}`"
    kept = {}
    for name, by in TOTALS.items():
        if before and spark.catalog.tableExists(of_version(name)):
            old = spark.table(of_version("fact_campaign_daily"))
            changed = old.where(F.col("date").between(*(F.lit(d).cast("date") for d in dates)))
            rows = increments.after(spark.table(of_version(name)), changed, new, by)
        else:
            rows = increments.totals(whole, by)
        path = f"{folder.rstrip('/')}/{name}"
        files.write_parquet(rows, path)
        catalog.register_parquet(spark, database, catalog.versioned(name, version), path, rows.schema)
        kept[name] = files.read_parquet(spark, path, rows.schema)
    return kept


def build_marts(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts of channels, campaigns and months, from the totals."""
    campaigns, days = tables["totals_by_campaign"], tables["totals_by_day"]
    return {
        "mart_channel_summary": marts.channel_summary(campaigns),
        "mart_campaign_summary": marts.campaign_summary(campaigns, tables["dim_campaign"]),
        "mart_monthly_summary": marts.monthly_summary(days, tables["dim_date"]),
    }


# Marts with a row per channel or per month and channel fit one CSV part.
SMALL_MARTS = {"mart_channel_summary", "mart_monthly_summary"}


def write_marts(spark: SparkSession, built: dict[str, DataFrame], folder: str, database: str, version: str) -> None:
    """Write each mart once as Parquet, register it as a version, and export it as CSV."""
    base = folder.rstrip("/")
    for name, mart in built.items():
        path = f"{base}/marts/{name}"
        files.write_parquet(mart, path)
        written = files.read_parquet(spark, path, mart.schema)
        catalog.register_parquet(spark, database, catalog.versioned(name, version), path, mart.schema)
        if name in SMALL_MARTS:
            order = [c for c in ("year", "month", "channel") if c in written.columns]
            files.export_csv(written.orderBy(*order), f"{base}/csv/{name}")
        else:
            files.write_csv(written, f"{base}/csv/{name}")


def write_days(
    spark: SparkSession, days: dict[str, DataFrame], folder: str, database: str, version: str,
    dates: tuple[str, str] | None,
) -> dict[str, DataFrame]:
    """Register a version of the tables by date, and give them whole.

    ``days`` are the rows of this run's dates, written below ``folder``. The
    other dates are those of the published version, whose folders the manifest of
    this one names.
    """
    output = folder.rstrip("/").rsplit("/", 1)[0]
    before = catalog.published_version(spark, database, "fact_campaign_daily") if dates else None
    old = versions.manifest(spark, output, before) if before else None
    places = {name: f"{folder.rstrip('/')}/{name}" for name in days}
    found = [versions.day_folders(spark, name, places[name], rows.schema) for name, rows in days.items()]
    new = found[0]
    for more in found[1:]:
        new = new.unionByName(more)
    first, last = dates or (None, None)
    versions.write_manifest(versions.merged_days(old, new, first, last), output, version)
    for name, rows in days.items():
        versions.register(spark, database, name, version, output, rows.schema, places[name])
    return {name: spark.table(f"`{database}`.`{catalog.versioned(name, version)}`") for name in days}


def check_star(tables: dict[str, DataFrame]) -> DataFrame:
    """Constraints of the star schema over all rows of the tables; references over the totals, which hold all keys."""
    reports = [
        quality.primary_keys(tables, PRIMARY_KEYS),
        quality.not_null_columns(tables, {name: required_columns(schema) for name, schema in STAR.items()}),
        quality.foreign_keys(tables, TOTALS_FOREIGN_KEYS),
        quality.metrics_reconcile(tables["fact_campaign_daily"]),
    ]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def published(spark: SparkSession, database: str) -> bool:
    return spark.catalog.tableExists(f"`{database}`.`fact_campaign_daily`")


def run(
    spark: SparkSession,
    raw_folder: str,
    output: str,
    database: str,
    salt: str,
    dates: tuple[str, str] | None = None,
    version: str | None = None,
) -> DataFrame:
    """Run every step on raw CSV tables and return the check report of the star schema; see ``update``.

    User ids of the users, ad events and conversions are masked with ``salt``
    before anything else sees them. An empty salt is refused: plain digests of
    ids are found by trying them.
    """
    if not salt:
        raise ValueError("a salt is needed to mask user ids")
    raw = {name: files.read_raw(spark, raw_folder, name) for name in RAW if name != "dim_advertisers"}
    users, ads, sold = (masked_key(raw[t], salt) for t in ("dim_users", "fact_ad_events", "fact_conversions"))
    days = raw["dim_time"].select("date_id")
    return update(spark, ads, sold, raw["dim_campaigns"], days, output, database, users, dates, version)


def update(
    spark: SparkSession,
    ad_events: DataFrame,
    conversions: DataFrame,
    campaigns: DataFrame,
    days: DataFrame,
    output: str,
    database: str,
    users: DataFrame | None = None,
    dates: tuple[str, str] | None = None,
    version: str | None = None,
) -> DataFrame:
    """Build and publish a version of the star schema and its marts; gives the check report.

    Each version writes a folder of its own below ``output`` and the published
    names show it once everything is written; one that fails before leaves the last
    as it was. With ``dates`` (first and last, included) only these days are read
    from the raw tables and written; the others stay in the folders they are in, and are
    not read: the marts and the check of references come from totals that change by these
    days, and the other checks read what is new.
    Campaigns keep the keys they once got. Versions that are no longer wanted
    go by ``versions.expire``.
    """
    version = version or uuid.uuid4().hex[:12]
    folder = f"{output.rstrip('/')}/{version}"
    if dates:
        first, last = (F.lit(d).cast("date") for d in dates)
        ad_events = ad_events.where(F.col("event_date").between(first, last))
        conversions = conversions.where(F.col("conversion_date").between(first, last))
    catalog.create_database(spark, database)
    known = spark.table(f"`{database}`.`campaign_keys`") if published(spark, database) else None
    tables = write_star(ad_events, conversions, campaigns, days, folder, users, known)
    plain = {"dim_campaign": STAR["dim_campaign"], "dim_date": STAR["dim_date"], "campaign_keys": KEYS}
    if users is not None:
        plain["dim_users"] = users.schema
    for name, schema in plain.items():
        catalog.register_parquet(spark, database, catalog.versioned(name, version), f"{folder}/{name}", schema)
    daily = marts.campaign_daily(tables["fact_campaign_daily"])
    files.write_by_date(daily, f"{folder}/mart_campaign_daily", whole=True)
    rows = {"fact_campaign_daily": tables["fact_campaign_daily"], "mart_campaign_daily": daily}
    whole = write_days(spark, rows, folder, database, version, dates)["fact_campaign_daily"]
    tables |= write_totals(spark, whole, tables["fact_campaign_daily"], folder, database, version, dates)
    built = build_marts(tables)
    write_marts(spark, built, folder, database, version)
    files.write_csv(daily, f"{folder}/csv/mart_campaign_daily")
    for name in [*plain, *TOTALS, *BY_DATE, *built]:
        catalog.publish(spark, database, name, version)
    report = check_star(tables)
    if users is not None:
        report = report.unionByName(quality.masked_ids(files.read_parquet(spark, f"{folder}/dim_users", users.schema)))
    return report


def run_sql_marts(spark: SparkSession, database: str, output: str) -> None:
    """Run the SQL marts on the registered tables and write their results."""
    for name in mart_sql.MARTS:
        files.write_parquet(mart_sql.run_mart_on_catalog(spark, name, database), f"{output.rstrip('/')}/sql/{name}")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("raw_folder", help="folder or URI with the raw CSV tables")
    parser.add_argument("output", help="folder or URI for the star schema and the marts")
    parser.add_argument("--database", default="spendlight")
    parser.add_argument("--salt", required=True, help="salt of the masks of user ids")
    parser.add_argument("--dates", nargs=2, metavar=("FIRST", "LAST"), help="read only these days again")
    args = parser.parse_args()
    spark = build_session("spendlight build")
    dates = tuple(args.dates) if args.dates else None
    run(spark, args.raw_folder, args.output, args.database, args.salt, dates).show(100, truncate=False)
    run_sql_marts(spark, args.database, args.output)


if __name__ == "__main__":
    main()
