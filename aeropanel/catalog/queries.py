"""Registered queries: name -> (spark, sf_dir) -> DataFrame, all over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropanel.functions import columns
from aeropanel.operators import cities, day_parts, days, hourly, least_squares, ml, profile, selection, stats, tree_tables, trends
from aeropanel.operators import clean as cleaning
from aeropanel.operators import daily_index as index
from aeropanel.schema import INDEX_POLLUTANTS, POLLUTANTS, PROFILE_POLLUTANTS, SEASONS
from aeropanel.plans import documents, report
from aeropanel.session import scratch_path, tuned
from aeropanel.sources import driver_tables as given
from aeropanel.sources import readers, tables, writers
from aeropanel.streaming import hourly_stream as streaming

Query = Callable[[SparkSession, str], DataFrame]

PANEL = ["City", "Date", *POLLUTANTS, "AQI", "AQI_Bucket"]
SUB_INDICES = [f"SI_{p}" for p in INDEX_POLLUTANTS]


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.city_day(spark, sf_dir)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_panel(spark, sf_dir).drop("k")


def clean_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(raw_panel(spark, sf_dir), given.TIE_BREAK)


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.daily_index(raw_panel(spark, sf_dir), given.TIE_BREAK)


def text_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw panel as a file may hold it: dates and two readings as text, some of it malformed."""
    k = F.col("k")
    date = F.when(k % 53 == 0, "2020-13-45").when(k % 59 == 0, "n/a").otherwise(F.col("Date").cast("string"))
    level = F.when(k % 47 == 0, "NA").otherwise(F.col("NO2").cast("string"))
    target = F.when(k % 43 == 0, "None").otherwise(F.col("AQI").cast("string"))
    return raw_panel(spark, sf_dir).withColumns({"Date": date, "NO2": level, "AQI": target})


def table_of(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The frame written once and read back, for results that read it several times."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def over(source: Query, operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """Query that applies `operator` to `source`."""
    return lambda spark, sf_dir: operator(source(spark, sf_dir), *args, **kwargs)


def profile_queries() -> dict[str, Query]:
    return {
        "null_profile": over(panel, profile.null_profile),
        "overview": over(panel, profile.overview),
        "lost_values": over(text_panel, profile.lost_values),
        "cleaning_funnel": over(raw_panel, profile.cleaning_funnel, given.TIE_BREAK),
    }


def clean_queries() -> dict[str, Query]:
    return {
        "dates_parsed": lambda s, d: cleaning.with_numbers(cleaning.with_date(
            cleaning.null_negatives(text_panel(s, d), ["NO2"]))).drop("k"),
        "one_row_per_city_day": lambda s, d: cleaning.dedup_city_day(raw_panel(s, d), given.TIE_BREAK).drop("k"),
        "rows_with_target": over(panel, cleaning.require, "AQI"),
        "target_in_range": over(panel, cleaning.in_range, "AQI", 0, 1000),
        "negatives_to_null": over(panel, cleaning.null_negatives),
        "calendar_columns": lambda s, d: cleaning.with_calendar(panel(s, d)).select("City", "Date", "Year", "Month"),
        "season_column": lambda s, d: cleaning.with_season(cleaning.with_calendar(panel(s, d)))
        .select("City", "Date", "Season"),
        "clean_panel": lambda s, d: clean_panel(s, d).drop("k"),
    }


def trend_queries() -> dict[str, Query]:
    periods = (given.BASE_PERIOD, given.EVENT_PERIOD)
    return {
        "city_ranking": over(clean_panel, trends.city_ranking),
        "yearly": over(clean_panel, trends.yearly),
        "full_coverage": over(clean_panel, trends.full_coverage, given.N_YEARS),
        "yearly_fixed": over(clean_panel, trends.yearly_fixed, given.N_YEARS),
        "monthly": over(clean_panel, trends.monthly),
        "seasonal": over(clean_panel, trends.seasonal),
        "category_share": over(clean_panel, trends.category_share),
        "ordered_categories": lambda s, d: trends.ordered_categories(trends.category_share(clean_panel(s, d))),
        "city_month_matrix": over(clean_panel, trends.city_month_matrix, given.METROS),
        "diagnose": over(clean_panel, trends.diagnose, given.DIAGNOSED),
        "period_comparison": over(clean_panel, trends.period_comparison, *periods),
        "period_overall": over(clean_panel, trends.period_overall, *periods),
        "biggest_drops": lambda s, d: trends.biggest_drops(trends.period_comparison(clean_panel(s, d), *periods)),
        "national_mean": over(clean_panel, trends.national_mean),
        "corr_with_target": over(clean_panel, stats.corr_with_target),
        "corr_with_target_nulls_as_zero": over(clean_panel, stats.corr_with_target, nulls="zero"),
        "corr_matrix": over(clean_panel, stats.corr_matrix),
        "top_drivers": lambda s, d: stats.top_drivers(stats.corr_with_target(clean_panel(s, d))),
    }


def index_queries() -> dict[str, Query]:
    def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
        readings = index.to_long(daily_panel(spark, sf_dir), ("City", "Date", "k"))
        return index.sub_index_long(readings, tables.breakpoints(spark))

    def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The stored panel against a stored copy with days missing on either side, values gone and values changed."""
        stored = table_of(spark, index.stored_form(daily_panel(spark, sf_dir)), "stored")
        day = F.dayofmonth("Date")
        theirs = table_of(spark, stored.filter(day != 3).withColumns({
            "AQI": F.when(day == 5, None).otherwise(F.col("AQI")), "AQI_calc": F.col("AQI_calc") + F.when(day == 7, 2.0).otherwise(0.0)}), "copy")
        return index.reconcile_tables(stored.filter(day != 9), theirs)

    return {
        "sub_indices": lambda s, d: daily_panel(s, d).select("City", "Date", *SUB_INDICES),
        "sub_index_by_range_join": range_join,
        "index_values": lambda s, d: daily_panel(s, d).select("City", "Date", "AQI_calc"),
        "dominant_pollutant": lambda s, d: daily_panel(s, d).select("City", "Date", "AQI_calc", "Dominant"),
        "index_category": lambda s, d: daily_panel(s, d).select("City", "Date", "AQI_calc", "Bucket_calc"),
        "index_of_readings": lambda s, d: index.index_of(raw_panel(s, d))
        .select("City", "Date", "k", *SUB_INDICES, "AQI_calc", "Dominant", "Bucket_calc"),
        "index_check": over(daily_panel, index.index_check),
        "dominant_share": over(daily_panel, index.dominant_share),
        "recorded_vs_calculated": over(daily_panel, index.recorded_vs_calculated),
        "daily_output": over(daily_panel, index.daily_output),
        "gaps_filled": lambda s, d: index.daily_output(index.gaps_filled(daily_panel(s, d))),
        "reconcile_tables": reconciled,
        "reconcile": lambda s, d: index.reconcile(index.stored_form(daily_panel(s, d))),
        "index_breakdown": over(daily_panel, index.breakdown),
        "index_advice": lambda s, d: index.with_advice(daily_panel(s, d), "AQI_calc")
        .select("City", "Date", "AQI_calc", "category", "advice"),
    }


def hourly_queries() -> dict[str, Query]:
    def local_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
        instant = F.col("ts").cast("timestamp")
        return given.table(spark, sf_dir, "events").select(
            "event_id", columns.local_hour(instant, "UTC").alias("utc_hour"),
            columns.local_hour(instant, "Asia/Kolkata").alias("kolkata_hour"))

    return {
        "local_hour": local_hour,
        "hourly_arrays_flattened": lambda s, d: hourly.flatten_hourly(hourly.nest_hourly(given.hourly(s, d))),
        "dense_hours": over(given.hourly, hourly.densify_hours),
        "mean24": over(given.hourly, hourly.mean24),
        "mean8": over(given.hourly, hourly.mean8),
        "max8": over(given.hourly, hourly.max8),
        "rolling_index": over(given.hourly, hourly.rolling_index),
        "latest_index": over(given.hourly, hourly.latest_index, given.AS_OF),
        "trend24": over(given.hourly, hourly.trend24, given.AS_OF),
        "live_ranking": over(given.hourly, hourly.live_ranking, given.AS_OF),
    }


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because the file source takes a plain path to be a folder.
    schema = given.table(spark, sf_dir, "events").schema
    return given.readings(streaming.read_stream(spark, f"{sf_dir}/[e]vents.parquet", schema))


def stream_queries() -> dict[str, Query]:
    """Each runs its stream to the end and returns what it wrote."""

    def finished(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        streaming.run_to_parquet(stream, f"{path}/out", f"{path}/checkpoint", spark.sparkContext.defaultParallelism)
        return spark.read.parquet(f"{path}/out")

    def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finished(spark, streaming.closed_hours(streaming.stream_hourly(event_stream(spark, sf_dir))), "stream-hourly")

    def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "stream-closed")
        stores = spark.sparkContext.defaultParallelism
        hours = streaming.closed_hours(streaming.stream_hourly(event_stream(spark, sf_dir)))
        streaming.run_to_parquet(hours, f"{path}/out", f"{path}/checkpoint", stores)
        closed = streaming.read_stream(spark, f"{path}/out", spark.read.parquet(f"{path}/out").schema)
        return finished(spark, streaming.stream_rolling_index(closed), "stream-index")

    def late_runs(spark: SparkSession, sf_dir: str) -> tuple[str, streaming.Run]:
        """One kind of event arrives in a second run, after the watermark has passed most of it."""
        path = scratch_path(spark, "stream-late")
        events = given.table(spark, sf_dir, "events")
        is_late = F.col("event_type") == given.LATE_TYPE
        for part in (events.filter(~is_late), events.filter(is_late)):
            part.write.mode("append").parquet(f"{path}/in")
            arriving = given.readings(streaming.read_stream(spark, f"{path}/in", events.schema))
            run = streaming.run_to_parquet(
                streaming.closed_hours(streaming.stream_hourly(arriving)), f"{path}/out", f"{path}/checkpoint",
                spark.sparkContext.defaultParallelism)
        return f"{path}/out", run

    def late(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(late_runs(spark, sf_dir)[0])

    def late_count(spark: SparkSession, sf_dir: str) -> DataFrame:
        """How many hours of stations the late readings of the second run would have changed."""
        _, run = late_runs(spark, sf_dir)
        return tables.literal_rows(spark, [(run.late_station_hours,)], "late_station_hours long")

    def split_runs(spark: SparkSession, sf_dir: str) -> str:
        """The two runs of `late_runs` through the stream that tells late readings apart."""
        path = scratch_path(spark, "stream-split")
        events = given.table(spark, sf_dir, "events")
        is_late = F.col("event_type") == given.LATE_TYPE
        for part in (events.filter(~is_late), events.filter(is_late)):
            part.write.mode("append").parquet(f"{path}/in")
            marked = streaming.with_late(given.readings(streaming.read_stream(spark, f"{path}/in", events.schema)))
            streaming.run_to_parquet(marked, f"{path}/split", f"{path}/checkpoint", spark.sparkContext.defaultParallelism,
                                     streaming.write_split)
        return f"{path}/split"

    def late_set(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Every reading that came after its hour had closed."""
        return streaming.read_split(spark, split_runs(spark, sf_dir), late=True)

    def hours_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The closed hours of the readings that came in time."""
        on_time = streaming.read_on_time(spark, split_runs(spark, sf_dir))
        return finished(spark, streaming.closed_hours(streaming.stream_hourly(on_time)), "stream-on-time")

    return {"stream_hourly": hours, "stream_rolling_index": rolling, "stream_late_rows": late, "stream_late_count": late_count,
            "stream_late_rows_set": late_set, "stream_hours_on_time": hours_on_time}


def city_queries() -> dict[str, Query]:
    periods = (given.BASE_PERIOD, given.EVENT_PERIOD)

    def exploded(operator: Callable[[DataFrame], DataFrame], array: str, position: str) -> Query:
        """One row per array element; positions count from 1."""
        return lambda s, d: operator(clean_panel(s, d)).select("City", F.posexplode(array).alias("_at", "value")) \
            .select("City", (F.col("_at") + 1).alias(position), "value")

    def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
        return cities.with_state(cities.city_rank(clean_panel(spark, sf_dir)), given.city_states(spark, sf_dir))

    def period(spark: SparkSession, sf_dir: str) -> DataFrame:
        flat = cities.city_period(clean_panel(spark, sf_dir), *periods)
        pair = lambda c: [F.get(f"period.{c}", F.lit(i)).alias(f"{c}_{n}") for i, n in enumerate(("base", "event"))]
        return flat.select("City", F.col("period").isNotNull().alias("known"), *pair("aqi"), *pair("pm25"), *pair("no2"),
                           F.col("period.change_pct").alias("change_pct"))

    def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
        panel_table = table_of(spark, clean_panel(spark, sf_dir), "profiled")
        return cities.city_profiles(panel_table, given.city_states(spark, sf_dir), *periods)

    def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
        return cities.pollutants_long(cities.city_pollutants(clean_panel(spark, sf_dir)))

    def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
        return cities.category_share_long(cities.city_category_share(clean_panel(spark, sf_dir)))

    return {
        "city_rank": over(clean_panel, cities.city_rank),
        "city_rank_with_state": ranked,
        "city_base": over(clean_panel, cities.city_base),
        "city_display_dates": lambda s, d: cities.city_base(clean_panel(s, d))
        .select("City", columns.nice_date("first").alias("first"), columns.nice_date("last").alias("last")),
        "city_monthly_array": exploded(cities.city_monthly_array, "monthly", "Month"),
        "city_season_array": exploded(cities.city_season_array, "season", "slot"),
        "city_pollutants": levels,
        "city_category_share": shares,
        "city_yearly": lambda s, d: cities.city_yearly(clean_panel(s, d)).select("City", F.inline("yearly")),
        "city_extremes": over(clean_panel, cities.city_extremes),
        "city_period": period,
        "region_rollup": lambda s, d: cities.region_rollup(
            cities.city_base(clean_panel(s, d)), given.city_regions(s, d)),
        "city_profiles": profiles,
        "city_profile_values": lambda s, d: flat_profiles(profiles(s, d)),
        "poor_or_worse": lambda s, d: trends.poor_or_worse(trends.category_share(clean_panel(s, d))),
        "city_poor_or_worse": lambda s, d: trends.poor_or_worse(shares(s, d), ["City"]),
        "extreme_months": lambda s, d: cities.extreme_months(trends.monthly(clean_panel(s, d))),
        "city_extreme_months": lambda s, d: cities.extreme_months(cities.city_months(clean_panel(s, d)), ["City"]),
        "limit_exceedance": lambda s, d: cities.limit_exceedance(levels(s, d), tables.limits(s)),
        "period_changes": lambda s, d: cities.period_changes(trends.period_overall(clean_panel(s, d), *periods)),
    }


def flat_profiles(nested: DataFrame) -> DataFrame:
    """City profiles with a column per value; of the yearly means their number and the last one."""
    at = lambda c, n, name: [F.get(c, F.lit(i)).alias(f"{name}_{i + 1}") for i in range(n)]
    pair = lambda c: [F.get(f"period.{c}", F.lit(i)).alias(f"{c}_{n}") for i, n in enumerate(("base", "event"))]
    last = F.element_at("yearly", -1)
    return nested.select(
        "City", "state", "rank", "avg", "pm25", "days", "first", "last", *at("monthly", 12, "month"), *at("season", 4, "season"),
        *(F.col(f"pollutants.{p}").alias(f"mean_{p}") for p in PROFILE_POLLUTANTS), *at("buckets", 6, "bucket"),
        F.size("yearly").alias("years"), last["Year"].alias("last_year"), last["mean"].alias("last_mean"),
        "worst_day", "worst_aqi", "best_aqi", *pair("aqi"), *pair("pm25"), *pair("no2"),
        F.col("period.change_pct").alias("change_pct"))


def day_queries() -> dict[str, Query]:
    return {
        "busiest_date": over(daily_panel, days.busiest_date),
        "day_snapshot": lambda s, d: days.day_snapshot(daily_panel(s, d), given.DAY, raw_panel(s, d)),
        "day_summary": over(daily_panel, days.day_summary, given.DAY),
        "month_grid": lambda s, d: days.month_grid(daily_panel(s, d), *given.MONTH, raw_panel(s, d)),
        "year_calendar": over(daily_panel, days.year_calendar, given.CITY, given.YEAR),
        "year_calendar_recorded": over(daily_panel, days.year_calendar, given.CITY, given.YEAR, "recorded"),
        "city_year_days": over(daily_panel, days.city_year_days),
        "fullest_year": over(daily_panel, days.fullest_year),
        "city_year_stats": lambda s, d: days.city_year_stats(index.stored_form(daily_panel(s, d))),
        "city_day_lookup": lambda s, d: days.lookup(index.daily_output(daily_panel(s, d)), given.CITY, given.DAY),
    }


def file_queries() -> dict[str, Query]:
    """Each writes what the tables give to a new folder and returns what it reads back."""

    def csv_read(infer: bool) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            path = scratch_path(spark, "city-day-csv")
            in_file = panel(spark, sf_dir).withColumnsRenamed({"PM25": "PM2.5"})
            in_file.write.option("header", True).csv(path)
            return readers.read_city_day(spark, path, infer)
        return query

    def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
        return readers.normalize_columns(panel(spark, sf_dir).withColumnsRenamed({"PM25": "PM2.5"}))

    def ranking_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
        readers.register(clean_panel(spark, sf_dir), "aqi")
        return spark.sql("""
            SELECT City, round(mean(AQI), 1) AS avg_aqi, round(mean(PM25), 1) AS avg_pm25, count(1) AS days
            FROM aqi GROUP BY ALL ORDER BY avg_aqi DESC, City""")

    def clean_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "clean")
        writers.write_clean(clean_panel(spark, sf_dir).drop("k"), path)
        return readers.read_daily(spark, path)

    def daily_folder(spark: SparkSession, sf_dir: str) -> str:
        path = scratch_path(spark, "daily")
        writers.write_daily(daily_panel(spark, sf_dir), path)
        return path

    def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The panel as three feeds: the days before one, that day, delivered twice, and the days behind it."""
        path, rows, day = scratch_path(spark, "parts"), raw_panel(spark, sf_dir), F.lit(given.DAY).cast("date")
        feeds = {"before": F.col("Date").isNull() | (F.col("Date") < day), given.DAY: F.col("Date") == day, "behind": F.col("Date") > day}
        for feed in (*feeds, given.DAY):
            day_parts.add_feed(rows.filter(feeds[feed]), path, feed, given.TIE_BREAK)
        return day_parts.read_parts(spark, path)

    def years(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The indexed panel by years, one of which is computed and written once more from its own rows."""
        path, rows = scratch_path(spark, "years"), raw_panel(spark, sf_dir)
        day_parts.replace_years(daily_panel(spark, sf_dir), path)
        same_year = F.trunc("Date", "year") == F.trunc(F.lit(given.DAY).cast("date"), "year")
        day_parts.replace_years(index.daily_index(rows.filter(same_year), given.TIE_BREAK), path)
        return day_parts.read_years(spark, path)

    def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "daily-csv")
        export = writers.daily_export(daily_panel(spark, sf_dir))
        writers.export_daily_csv(daily_panel(spark, sf_dir), path)
        return readers.normalize_columns(spark.read.schema(export.schema).option("header", True).csv(path))

    def documents_json(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "documents")
        docs = writers.city_documents(daily_panel(spark, sf_dir))
        writers.write_json(docs, path)
        return writers.document_days(spark.read.schema(docs.schema).json(path))

    return {
        "daily_csv_read": csv_read(infer=False),
        "daily_csv_read_inferred": csv_read(infer=True),
        "normalized_columns": normalized,
        "city_ranking_sql": ranking_sql,
        "clean_parquet": clean_parquet,
        "daily_by_city_parquet": lambda s, d: readers.read_daily(s, daily_folder(s, d)),
        "city_day_lookup_stored": lambda s, d: days.lookup(
            readers.read_city_days(s, daily_folder(s, d), given.CITY, given.DAY), given.CITY, given.DAY),
        "one_city_parquet": lambda s, d: readers.read_city(s, daily_folder(s, d), given.CITY),
        "overview_of_feeds": over(parts, day_parts.overview, len(PANEL)),
        "yearly_of_feeds": over(parts, day_parts.yearly),
        "city_base_of_feeds": over(parts, day_parts.city_base),
        "city_ranking_of_feeds": over(parts, day_parts.city_ranking),
        "full_coverage_of_feeds": over(parts, day_parts.full_coverage, given.N_YEARS),
        "daily_by_year_parquet": years,
        "daily_csv_export": csv_export,
        "city_documents": documents_json,
    }


def parameters() -> report.Parameters:
    return report.Parameters(n_years=given.N_YEARS, metros=given.METROS, diagnosed=given.DIAGNOSED,
                             base=given.BASE_PERIOD, event=given.EVENT_PERIOD, order_by=given.TIE_BREAK)


def document_queries() -> dict[str, Query]:
    def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
        cleaned = table_of(spark, clean_panel(spark, sf_dir), "overviewed")
        return documents.overview_document(
            profile.overview(panel(spark, sf_dir)), cleaned, given.city_regions(spark, sf_dir),
            given.BASE_PERIOD, given.EVENT_PERIOD)

    def overview_values(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The overview with a column per value; of its lists the first entries."""
        nested = overview(spark, sf_dir)
        at = lambda c, n, name: [F.get(c, F.lit(i)).alias(f"{name}_{i + 1}") for i in range(n)]
        pair = lambda c: [F.get(f"period.{c}", F.lit(i)).alias(f"{c}_{n}") for i, n in enumerate(("base", "event"))]
        drop, top, region = F.get("period.biggest_drops", F.lit(0)), F.get("correlation", F.lit(0)), F.get("regions", F.lit(0))
        return nested.select(
            "records", "cities", "start", "end", "clean_records", "avg_aqi", "avg_pm25", *at("monthly", 12, "month"),
            *(F.col(f"season.`{s}`").alias(f"season_{i}") for i, s in enumerate(SEASONS, 1)), *at("buckets", 6, "bucket"),
            F.col("period.cities").alias("compared"), *pair("aqi"), *pair("pm25"), *pair("no2"),
            drop["City"].alias("drop_city"), drop["aqi_change_pct"].alias("drop_pct"),
            top["pollutant"].alias("top_pollutant"), top["corr"].alias("top_corr"), F.size("correlation").alias("correlated"),
            region["Region"].alias("top_region"), region["avg"].alias("top_region_avg"), region["cities"].alias("top_region_cities"))

    def dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
        daily = table_of(spark, daily_panel(spark, sf_dir).select("AQI", "AQI_Bucket", "AQI_calc", "Bucket_calc", "Dominant"), "checked")
        return documents.dashboard_document(
            overview(spark, sf_dir), index.index_check(daily), index.dominant_share(daily))

    def dashboard_values(spark: SparkSession, sf_dir: str) -> DataFrame:
        nested = dashboard(spark, sf_dir)
        first = F.get("dominant", F.lit(0))
        return nested.select(
            F.col("overview.records").alias("records"), "daily_check.*", F.size("dominant").alias("dominants"),
            first["Dominant"].alias("most_dominant"), first["days"].alias("most_days"), first["pct"].alias("most_pct"))

    def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The whole study without models -> each output and the rows read back from it."""
        path = scratch_path(spark, "report")
        written = report.run_report(
            spark, raw_panel(spark, sf_dir), path, parameters(), given.city_states(spark, sf_dir),
            given.city_regions(spark, sf_dir), with_models=False)
        parquet = {"one_per_day", "clean_city_day", "daily_aqi"}
        counts = [
            (spark.read.parquet(p) if name in parquet else spark.read.text(p))
            .agg(F.count("*").alias("lines")).select(F.lit(name).alias("output"), "lines")
            for name, p in written.items()]
        return reduce(DataFrame.union, counts)

    return {"overview_document": overview, "overview_values": overview_values, "dashboard_document": dashboard,
            "dashboard_values": dashboard_values, "report_outputs": outputs}


_fitted: dict[tuple, ml.Study] = {}


def _study(spark: SparkSession, sf_dir: str) -> ml.Study:
    """All four models; queries on their comparison share the last fit while session and files are the same."""
    files = given.table(spark, sf_dir, "orders").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    key = (spark.sparkContext.applicationId, sf_dir, *sorted(map(tuple, files.distinct().collect())))
    if key not in _fitted:
        _fitted.clear()
        _fitted[key] = ml.study(table_of(spark, clean_panel(spark, sf_dir), "studied"))
    return _fitted[key]


def model_queries() -> dict[str, Query]:
    def quality(kind: str) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            # written once: the medians alone read the rows several times
            rows, test = ml.split(table_of(spark, ml.ml_frame(clean_panel(spark, sf_dir)), "panel"))
            return ml.evaluate(ml.score(ml.train(rows, kind), test))
        return query

    def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, _ = ml.split(ml.ml_frame(clean_panel(spark, sf_dir)))
        found = selection.medians(rows, POLLUTANTS)
        return tables.literal_rows(spark, [(p, found[p]) for p in POLLUTANTS], "pollutant string, median double")

    def imputed(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
        rows, _ = ml.split(ml.ml_frame(clean_panel(spark, sf_dir)))
        values = vector_to_array("features")
        return ml.prepare(rows).transform(rows).select(
            "City", "Date", *more, *(F.get(values, F.lit(i)).alias(c) for i, c in enumerate(ml.IMPUTED)))

    def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, test = ml.split(ml.ml_frame(clean_panel(spark, sf_dir)))
        named = [df.select(F.lit(name).alias("part")) for name, df in (("train", rows), ("test", test))]
        return named[0].union(named[1]).groupBy("part").agg(F.count("*").alias("rows"))

    def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
        """What predicting the mean of a city's training rows is worth, by the metrics of the models."""
        rows, test = ml.split(ml.ml_frame(clean_panel(spark, sf_dir)))
        means = rows.groupBy("City").agg(F.avg("AQI").alias("prediction"))
        return ml.evaluate(test.join(means, "City"))

    def linear_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The residuals of the Gram-matrix fit on the training rows against every feature."""
        rows = table_of(spark, imputed(spark, sf_dir, "AQI"), "imputed")
        return least_squares.certificate(rows, least_squares.fit(rows, ml.IMPUTED, "AQI"), "AQI")

    def baseline_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Exactly half of the test days: recorded index and the mean of the city's training rows."""
        rows, test = ml.split(ml.ml_frame(clean_panel(spark, sf_dir)))
        means = rows.groupBy("City").agg(F.round(F.avg("AQI"), 6).alias("prediction"))
        return ml.actual_vs_predicted(test.join(means, "City"))

    def by_nodes(kind: str) -> Query:
        """Predictions of a model for the test rows from the table of its nodes, next to those of the library."""
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            fitted = _study(spark, sf_dir)
            model = fitted.models[kind]
            told = model.transform(fitted.test).select("City", "Date", F.col("prediction").alias("library"), *ml.IMPUTED)
            rows = table_of(spark, told, "scored")
            found = tree_tables.predictions(rows, tree_tables.node_table(model.stages[-1]), ml.IMPUTED, ["City", "Date"])
            return rows.select("City", "Date", "library").join(found, ["City", "Date"])
        return query

    def best_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
        fitted = _study(spark, sf_dir)
        return ml.score(fitted.models[fitted.best], fitted.test).select("City", "Date", "AQI", "prediction")

    def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ml.model_summary(_study(spark, sf_dir), tables.ad_hoc_rows(spark, [tables.EXAMPLE_ROW]))

    return {
        "ml_frame": lambda s, d: ml.ml_frame(clean_panel(s, d)),
        "baseline_metrics": baseline,
        "imputer_medians": medians,
        "imputed_features": imputed,
        "train_test_split": split_sizes,
        "linear_regression": quality("linear"),
        "decision_tree": quality("tree"),
        "random_forest": quality("forest"),
        "gradient_boosted_trees": quality("gbt"),
        "model_comparison": lambda s, d: ml.compare(_study(s, d).metrics),
        "linear_certificate": linear_certificate,
        "tree_nodes": lambda s, d: tree_tables.node_table(_study(s, d).models["tree"].stages[-1]),
        "tree_scores_by_nodes": by_nodes("tree"),
        "forest_scores_by_nodes": by_nodes("forest"),
        "boosted_scores_by_nodes": by_nodes("gbt"),
        "actual_vs_baseline": baseline_sample,
        "feature_importances": lambda s, d: ml.importances(_study(s, d).models["forest"]),
        "actual_vs_predicted": lambda s, d: ml.actual_vs_predicted(best_scores(s, d)),
        "scored_rows": best_scores,
        "model_summary": summary,
    }


def all_queries() -> dict[str, Query]:
    groups = (profile_queries() | clean_queries() | trend_queries() | index_queries() | hourly_queries()
              | stream_queries() | city_queries() | day_queries() | file_queries() | document_queries()
              | model_queries())
    return {name: lambda spark, sf_dir, query=query: query(tuned(spark), sf_dir) for name, query in groups.items()}
