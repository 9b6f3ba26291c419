"""Registered queries and their reference SQL.

``queries()`` maps a name to a function (spark, folder) -> DataFrame over the
tables in the folder; ``oracle_sql()`` gives the same result as DuckDB SQL.
Names ending in ``_b`` read order lines as several years of ad traffic, all
others read the event log as one month of it.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from functools import cached_property
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracles  # noqa: E402
from spendlight.functions import calendar_columns  # noqa: E402
from spendlight.operators import distinct, forecast, marts, periods, quality, reports, star  # noqa: E402
from spendlight.plans import build, mart_sql  # noqa: E402
from spendlight.schemas import (  # noqa: E402
    DIM_CAMPAIGN, DIM_DATE, FACT, FOREIGN_KEYS, PRIMARY_KEYS, RAW, required_columns,
)
from spendlight.session import scratch_dir  # noqa: E402
from spendlight.sources import adapters, files  # noqa: E402
from spendlight.streaming import closed, daily as stream  # noqa: E402

try:  # the one place that allows for a library without its text operators
    import corpus_pipeline
    from spendlight.llm import queries as text_queries
except ImportError:
    corpus_pipeline = text_queries = None

Query = Callable[[SparkSession, str], DataFrame]
Raw = Callable[[SparkSession, str], adapters.RawTables]


class Model:
    """The star schema and marts of one set of raw tables; all lazy, built on first use."""

    def __init__(self, raw: adapters.RawTables):
        self.raw = raw

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return star.campaign_dimension(self.raw.campaigns)

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.date_dimension(star.days_between(self.raw.span))

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_of_cells(self.raw.cells, self.dim_campaign)

    @property
    def star(self) -> dict[str, DataFrame]:
        return {"dim_date": self.dim_date, "dim_campaign": self.dim_campaign, "fact_campaign_daily": self.fact}

    @cached_property
    def channels(self) -> DataFrame:
        return marts.channel_summary(self.fact)

    @cached_property
    def campaigns(self) -> DataFrame:
        return marts.campaign_summary(self.fact, self.dim_campaign)

    @cached_property
    def monthly(self) -> DataFrame:
        return marts.monthly_summary(self.fact, self.dim_date)

    @cached_property
    def daily(self) -> DataFrame:
        return marts.campaign_daily(self.fact)

    @cached_property
    def kpis(self) -> DataFrame:
        return reports.overall_kpis(self.channels)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles at the edge of a query."""
    return df.withColumns(
        {f.name: F.expr(f"cast({f.name} as double)") for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    )


def _on(raw: Raw, result: Callable[[Model], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(result(Model(raw(spark, sf_dir))))


def _a(result: Callable[[Model], DataFrame]) -> Query:
    return _on(adapters.from_events, result)


def _b(result: Callable[[Model], DataFrame]) -> Query:
    return _on(adapters.from_lineitem, result)


def _once(result: Callable[[Model], DataFrame]) -> Query:
    """For results that read the star several times: over daily cells that are written once."""
    return _on(adapters.from_stored_events, result)


# --- files and catalog: written to a fresh shared folder, then read back ------


def _stored_star(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    raw = adapters.from_events(spark, sf_dir)
    folder = scratch_dir(spark, "star")
    return folder, build.write_star(
        raw.ad_events, raw.conversions, raw.campaigns, star.days_between(raw.span), folder
    )


def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.from_events(spark, sf_dir)
    path = scratch_dir(spark, "conversions")
    columns = RAW["fact_conversions"].fieldNames()
    files.write_csv(raw.conversions.select(columns), path)
    return files.read_csv(spark, path, RAW["fact_conversions"])


def scan_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_stored_star(spark, sf_dir)[1]["fact_campaign_daily"])


def partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _stored_star(spark, sf_dir)[1]["fact_campaign_daily"]
    return _plain(fact.where("date between date'2024-01-10' and date'2024-01-16'"))


def catalog_registered_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = _stored_star(spark, sf_dir)
    # A name of its own, so that calls at the same time don't meet.
    database = f"spendlight_{uuid.uuid4().hex[:12]}"
    build.register_star(spark, database, folder)
    return _plain(spark.table(f"{database}.fact_campaign_daily"))


# --- checks -------------------------------------------------------------------


def dq_row_counts(m: Model) -> DataFrame:
    spark = m.raw.cells.sparkSession
    least = {"campaigns": 32, "users": 100, "ad_events": 3000, "conversions": 195, "dim_date": 28, "dim_campaign": 32}
    least["fact_campaign_daily"] = 992
    # The cells know how many raw rows they are made of.
    counted = {
        "ad_events": m.raw.cells.selectExpr("coalesce(sum(ad_rows), 0) as n"),
        "conversions": m.raw.cells.selectExpr("coalesce(sum(orders), 0) as n"),
    }
    tables = {**m.star, "campaigns": m.raw.campaigns, "users": adapters.masked_users(spark, m.raw.folder)}
    return quality.row_counts(tables, least, counted)


def dq_domains(m: Model) -> DataFrame:
    dates = quality.domains(
        m.dim_date, {"quarter": (1, 4), "month": (1, 12), "day_of_week": (0, 6), "is_weekend": [0, 1]}, "dim_date"
    )
    campaigns = quality.domains(
        m.dim_campaign,
        {"channel": adapters.CHANNELS, "campaign_type": adapters.CAMPAIGN_TYPES, "status": adapters.STATUSES},
        "dim_campaign",
    )
    return dates.unionByName(campaigns)


def dq_totals_reconcile(m: Model) -> DataFrame:
    built = {"channel": m.channels, "campaign": m.campaigns, "monthly": m.monthly, "daily": m.daily}
    return quality.totals_reconcile(m.fact, built, marts.MEASURES)


def masked_user_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad events by the place of their user, joined on masked keys; orphans have no user."""
    places = adapters.masked_dimension(spark, sf_dir).select("user_id", "country_code", F.lit(1).alias("known"))
    per_user = adapters.masked_events(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"))
    return per_user.join(places, "user_id", "left").groupBy("country_code").agg(
        F.sum("n").alias("events"),
        F.count("*").alias("users"),
        F.sum(F.expr("if(known is null, n, 0)")).alias("orphans"),
    )


def dq_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that are neither ad traffic nor conversions; the ad tables leave them out."""
    types = {"event_type": ["view", "click", "purchase", "signup"]}
    return quality.domains(adapters.table(spark, sf_dir, "events"), types, "events")


def dq_money_on_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.from_lineitem(spark, sf_dir)
    costs = quality.money_on_grid(raw.ad_events, ["cost_usd"], "ad_events")
    return costs.unionByName(quality.money_on_grid(raw.conversions, ["conversion_value_usd"], "conversions"))


def traffic_by_event_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test events name no place; the region digit of their user stands for one."""
    place = F.expr("concat('g', cast(user_id % 5 as string))")
    return _plain(periods.traffic_by_geo(adapters.from_events(spark, sf_dir).ad_events.withColumn("geo", place)))


def dq_pk_duplicates_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapters.table(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], "lineitem")


def dq_pii_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    clear = adapters.users(spark, sf_dir).select(F.col("user_name").alias("raw_name"))
    return quality.masked_ids(adapters.masked_users(spark, sf_dir)).unionByName(quality.masked_ids(clear, "raw_name"))


# --- the rest -----------------------------------------------------------------


def calendar_scalars(m: Model) -> DataFrame:
    parts = calendar_columns("date_id")
    names = ["year", "month", "day_of_month", "quarter", "week_of_year", "day_of_week"]
    return star.days_between(m.raw.span).select(
        F.date_format("date_id", "yyyy-MM-dd").alias("date_text"),
        F.to_date(F.date_format("date_id", "yyyy/MM/dd"), "yyyy/MM/dd").alias("parsed"),
        *[parts[n].alias(n) for n in names],
    )


def short_hash_ids(m: Model) -> DataFrame:
    ads = m.raw.ad_events.selectExpr("event_id as id", "'ad_event' as kind")
    return ads.unionByName(m.raw.conversions.selectExpr("conversion_id as id", "'conversion' as kind"))


def roas_by_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.from_events(spark, sf_dir)
    return _plain(periods.roas_by_geo(raw.ad_events, raw.conversions, adapters.users(spark, sf_dir)))


def revenue_regression_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(adapters.from_stored_lineitem(spark, sf_dir))
    months = marts.monthly_totals(m.fact, m.dim_date)
    predicted = forecast.predict_revenue(forecast.fit_revenue_model(months), months)
    return _plain(predicted.withColumn("predicted_revenue_usd", F.round("predicted_revenue_usd", 2)))


def stream_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = stream.streaming_session(spark)
    # A stream takes a single file only as a glob.
    source = session.readStream.schema(adapters.SCHEMAS["events"]).parquet(f"{sf_dir}/events.parque[t]")
    folder = scratch_dir(spark, "stream")
    stream.start(adapters.contributions_of(source).drop("slot"), folder).awaitTermination()
    return _plain(stream.daily_metrics(spark, folder))


def _event_stream(session: SparkSession, sf_dir: str) -> DataFrame:
    # A stream takes a single file only as a glob.
    source = session.readStream.schema(adapters.SCHEMAS["events"]).parquet(f"{sf_dir}/events.parque[t]")
    return adapters.contributions_of(source).drop("slot")


def stream_closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the days that the watermark has closed, each emitted once."""
    session, folder = stream.streaming_session(spark), scratch_dir(spark, "closed")
    closed.start(_event_stream(session, sf_dir), folder).awaitTermination()
    return _plain(closed.read_closed(spark, folder))


def stream_roas_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert each time a campaign's ROAS so far falls below 1.0, on closed days."""
    session, folder = stream.streaming_session(spark), scratch_dir(spark, "alerts")
    closed.start(_event_stream(session, sf_dir), folder).awaitTermination()
    closed.start_alerts(session, folder).awaitTermination()
    return _plain(closed.read_alerts(spark, folder))


def dim_campaign_stable(m: Model) -> DataFrame:
    """The campaign dimension of a second build, when the paused campaigns are new: the others keep their keys."""
    first = star.campaign_dimension(m.raw.campaigns.where("status <> 'paused'"))
    return star.campaign_dimension(m.raw.campaigns, star.campaign_keys(first))


def rebuilt(table: str) -> Query:
    """A published table after a build without late conversions and one that reads the days from the 15th on again."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = adapters.from_events(spark, sf_dir)
        output, database = scratch_dir(spark, "versions"), f"spendlight_{uuid.uuid4().hex[:12]}"
        days, since = star.days_between(raw.span), F.lit("2024-01-15").cast("date")
        before = raw.conversions.where(F.col("conversion_date") < since)
        build.update(spark, raw.ad_events, before, raw.campaigns, days, output, database, version="v1")
        again = ("2024-01-15", "9999-12-31")
        build.update(
            spark, raw.ad_events, raw.conversions, raw.campaigns, days, output, database, dates=again, version="v2"
        )
        return _plain(spark.table(f"`{database}`.`{table}`"))

    return query


def distinct_campaigns_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns per channel and period, from the bitmaps of days alone, which are written once."""
    path = scratch_dir(spark, "bitmaps")
    fact = Model(adapters.from_events(spark, sf_dir)).fact
    files.write_parquet(distinct.key_bitmaps(fact, "date", "channel"), path)
    return distinct.campaigns_by_period(files.read_parquet(spark, path))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the channel mart, straight from the raw tables."""
    return queries()["mart_channel_summary"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {**ad_queries(), **(text_queries.queries() | {"pipeline": corpus_pipeline.run} if text_queries else {})}


def ad_queries() -> dict[str, Query]:
    return {
        # star schema
        "dim_date": _a(lambda m: m.dim_date),
        "dim_campaign": _a(lambda m: m.dim_campaign),
        "dim_campaign_stable": _a(dim_campaign_stable),
        "event_agg": _a(lambda m: star.event_rollup(m.raw.ad_events)),
        "conv_agg": _a(lambda m: star.conversion_rollup(m.raw.conversions)),
        "fact_campaign_daily": _a(lambda m: m.fact),
        "fact_campaign_daily_b": _b(lambda m: m.fact),
        "fact_zero_policy": _a(
            lambda m: star.fact_of_cells(m.raw.cells, m.dim_campaign, on_zero="zero")
        ),
        # marts
        "mart_channel_summary": _a(lambda m: m.channels),
        "mart_channel_summary_b": _b(lambda m: m.channels),
        "mart_campaign_summary": _a(lambda m: m.campaigns),
        "mart_campaign_summary_b": _b(lambda m: m.campaigns),
        "mart_monthly_summary": _a(lambda m: m.monthly),
        "mart_monthly_summary_b": _b(lambda m: m.monthly),
        "mart_campaign_daily": _a(lambda m: m.daily),
        "sql_mart_channel": _a(
            lambda m: mart_sql.run_mart(m.fact.sparkSession, "mart_channel_summary", {"fact_campaign_daily": m.fact})
        ),
        "sql_mart_campaign": _a(
            lambda m: mart_sql.run_mart(
                m.fact.sparkSession,
                "mart_campaign_summary",
                {"fact_campaign_daily": m.fact, "dim_campaign": m.dim_campaign},
            )
        ),
        "sql_mart_monthly": _a(
            lambda m: mart_sql.run_mart(
                m.fact.sparkSession, "mart_monthly_summary", {"fact_campaign_daily": m.fact, "dim_date": m.dim_date}
            )
        ),
        # reports
        "overall_kpis": _a(lambda m: m.kpis),
        "conversion_funnel": _a(lambda m: reports.conversion_funnel(m.kpis)),
        "roas_gauge": _a(lambda m: reports.roas_gauge(m.kpis)),
        "spend_share": _a(lambda m: reports.share_of_total(m.channels, "total_spend_usd", "spend_share_pct")),
        "revenue_share": _a(lambda m: reports.share_of_total(m.channels, "total_revenue_usd", "revenue_share_pct")),
        "channel_cards": _a(lambda m: reports.channel_cards(m.channels)),
        "channel_roas": _a(lambda m: reports.channel_roas(m.channels)),
        "channel_ranked": _a(lambda m: reports.channel_ranked(m.channels)),
        "roas_status": _a(lambda m: reports.roas_statuses(m.campaigns, "campaign_key")),
        "daily_trend": _a(lambda m: reports.daily_trend(m.daily)),
        "channel_daily_share": _a(lambda m: reports.channel_daily_share(m.daily)),
        "channel_daily_trend": _a(lambda m: reports.channel_daily_trend(m.daily)),
        "campaign_options": _a(lambda m: reports.campaign_options(m.campaigns)),
        "campaign_lookup": _once(lambda m: reports.campaign_lookup(m.campaigns, 1)),
        "campaign_daily_series": _once(lambda m: reports.campaign_daily_series(m.daily, 1)),
        "top5_roas": _a(lambda m: reports.ranked_by_roas(m.campaigns, 5)),
        "bottom5_roas": _a(lambda m: reports.ranked_by_roas(m.campaigns, 5, best=False)),
        "top10_roas": _a(lambda m: reports.ranked_by_roas(m.campaigns, 10)),
        "roas_filtered": _a(
            lambda m: reports.roas_filtered(m.fact, m.dim_campaign, "Meta", "prospecting", 20240101, 20240131)
        ),
        "roas_alerts": _a(lambda m: reports.roas_alerts(m.campaigns)),
        # periods and places
        "weekly_summary": _a(lambda m: periods.weekly_summary(m.fact)),
        "roas_vs_prior_month": _a(lambda m: periods.with_prior_month(m.monthly)),
        "roas_vs_prior_month_b": _b(lambda m: periods.with_prior_month(m.monthly)),
        "distinct_campaigns_by_period": distinct_campaigns_by_period,
        "roas_by_geo": roas_by_geo,
        "traffic_by_event_geo": traffic_by_event_geo,
        "traffic_by_device": _a(lambda m: periods.traffic_by_device(m.raw.ad_events)),
        "revenue_regression": _a(lambda m: forecast.revenue_line(reports.daily_trend(m.daily))),
        "revenue_regression_ml": revenue_regression_ml,
        # scalars and privacy
        "calendar_scalars": _a(calendar_scalars),
        "pii_masked_users": adapters.masked_users,
        "masked_user_join": masked_user_join,
        "short_hash_ids": _a(short_hash_ids),
        # quality
        "dq_row_counts": _once(dq_row_counts),
        "dq_pii_masked": dq_pii_masked,
        "dq_metric_reconcile": _once(lambda m: quality.metrics_reconcile(m.fact)),
        "dq_pk_duplicates": _once(lambda m: quality.primary_keys(m.star, PRIMARY_KEYS)),
        "dq_pk_duplicates_b": dq_pk_duplicates_b,
        "dq_not_null": _once(
            lambda m: quality.not_null_columns(
                m.star,
                {
                    "dim_date": required_columns(DIM_DATE),
                    "dim_campaign": required_columns(DIM_CAMPAIGN),
                    "fact_campaign_daily": FACT.fieldNames(),
                },
            )
        ),
        "dq_fk_orphans": _once(lambda m: quality.foreign_keys(m.star, FOREIGN_KEYS)),
        "dq_dropped_conversions": _a(lambda m: quality.dropped_cells(m.raw.cells)),
        "dq_domains": _once(dq_domains),
        "dq_totals_reconcile": _once(dq_totals_reconcile),
        "dq_orders_are_conversions": _once(
            lambda m: quality.orders_are_conversions(m.fact, m.raw.cells, m.raw.conversions)
        ),
        "dq_money_on_grid": dq_money_on_grid,
        "dq_event_types": dq_event_types,
        # files, catalog, stream
        "scan_csv_roundtrip": scan_csv_roundtrip,
        "scan_fact": scan_fact,
        "partition_pruned_scan": partition_pruned_scan,
        "catalog_registered_fact": catalog_registered_fact,
        "stream_daily_metrics": stream_daily_metrics,
        "stream_closed_days": stream_closed_days,
        "stream_roas_alerts": stream_roas_alerts,
        "incremental_fact": rebuilt("fact_campaign_daily"),
        "incremental_mart_channel": rebuilt("mart_channel_summary"),
        "incremental_mart_campaign": rebuilt("mart_campaign_summary"),
        "incremental_mart_monthly": rebuilt("mart_monthly_summary"),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query, where SQL can express it."""
    found = oracles.oracle_sql() | (text_queries.oracle_sql() if text_queries else {})
    if text_queries and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
