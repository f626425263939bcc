"""The whole study in one run, from a raw panel to a folder of results.

The raw rows are read twice: once to remove the copies, which is the one shuffle of all columns, and once for counts of
what is in the file. The panel without copies is written as a table; both panels are derived from it without a shuffle
and every result reads only the columns it needs. Writing by city, the sorted CSV and the documents per city shuffle the
daily panel once each, as their order asks for. A lost executor costs no more than the tasks it ran.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from aeropanel.operators import cities, clean, daily_index, ml, profile, stats, trends
from aeropanel.operators.trends import Period
from aeropanel.plans import documents
from aeropanel.sources import tables, writers
from aeropanel.sources.readers import read_daily, storage_of


@dataclass(frozen=True)
class Parameters:
    """What the study is about; the defaults are those of the published one."""

    n_years: int = 6
    metros: Sequence[str] = tuple(tables.METROS)
    diagnosed: Sequence[str] = tuple(tables.DIAGNOSED)
    base: Period = tables.BASE_PERIOD
    event: Period = tables.EVENT_PERIOD
    order_by: Sequence[str] | None = None
    nulls: stats.Nulls = "skip"


@dataclass(frozen=True)
class Panels:
    unique: DataFrame
    clean: DataFrame
    daily: DataFrame


def build_panels(raw: DataFrame, path: str, order_by: Sequence[str] | None = None) -> Panels:
    """Writes the panel without copies to `path`/one_per_day and derives both panels from it."""
    spark = raw.sparkSession
    clean.one_per_day(raw, order_by).write.mode("overwrite").parquet(f"{path}/one_per_day")
    unique = read_daily(spark, f"{path}/one_per_day")
    return Panels(unique, clean.clean_rows(unique), daily_index.daily_rows(unique))


def result_tables(known: profile.RawProfile, panels: Panels, p: Parameters) -> dict[str, DataFrame]:
    """Every result of the study by name."""
    cleaned, daily = panels.clean, panels.daily
    shares = trends.category_share(cleaned)
    return {
        "overview": known.overview,
        "missing": known.missing,
        "funnel": profile.funnel_of(panels.unique, known.rows),
        "city_aqi": trends.city_ranking(cleaned),
        "yearly": trends.yearly(cleaned),
        "full_cities": trends.full_coverage(cleaned, p.n_years),
        "yearly_fixed": trends.yearly_fixed(cleaned, p.n_years),
        "monthly": trends.monthly(cleaned),
        "season": trends.seasonal(cleaned),
        "bucket": trends.ordered_categories(shares),
        "heat": trends.city_month_matrix(cleaned, p.metros),
        "diag": trends.diagnose(cleaned, p.diagnosed),
        "period": trends.period_comparison(cleaned, p.base, p.event),
        "period_overall": trends.period_overall(cleaned, p.base, p.event),
        "corr": stats.corr_with_target(cleaned, p.nulls),
        "corr_matrix": stats.corr_matrix(cleaned),
        "daily_check": daily_index.index_check(daily),
        "dominant": daily_index.dominant_share(daily),
        "reconcile": daily_index.reconcile(daily_index.stored_form(daily)),
    }


def run_report(
    spark: SparkSession, raw: DataFrame, out: str, parameters: Parameters | None = None,
    states: DataFrame | None = None, regions: DataFrame | None = None, with_models: bool = True,
    source: str | None = None,
) -> dict[str, str]:
    """Runs the study and writes it below `out` -> name of each output and its path.

    `source` is the path of the input, noted with the results.
    """
    p = parameters or Parameters()
    states = tables.city_states(spark) if states is None else states
    regions = tables.city_regions(spark) if regions is None else regions
    panels = build_panels(raw, out, p.order_by)

    writers.write_clean(panels.clean, f"{out}/clean_city_day")
    writers.write_daily(panels.daily, f"{out}/daily_aqi")
    panels = Panels(panels.unique, read_daily(spark, f"{out}/clean_city_day"), panels.daily)
    writers.export_daily_csv(panels.daily, f"{out}/daily_aqi_csv")
    writers.write_json(writers.city_documents(panels.daily), f"{out}/daily_aqi_web")

    known = profile.raw_profile(raw)
    results = result_tables(known, panels, p)
    if source:
        results["data_source"] = tables.literal_rows(
            spark, [(source, storage_of(source), [f"{out}/clean_city_day", f"{out}/daily_aqi"])],
            "path string, storage string, outputs array<string>")
    model = None
    if with_models:
        fitted = ml.study(panels.clean)
        example = tables.ad_hoc_rows(spark, [tables.EXAMPLE_ROW])
        model = ml.model_summary(fitted, example)
        results["metrics"] = ml.compare(fitted.metrics)
        results["importance"] = ml.importances(fitted.models["forest"])
    writers.write_results(results, f"{out}/results")

    overview = documents.overview_document(known.overview, panels.clean, regions, p.base, p.event, p.nulls)
    summary = documents.dashboard_document(overview, results["daily_check"], results["dominant"], model)
    writers.write_results({
        "summary": summary,
        "cities": cities.city_profiles(panels.clean, states, p.base, p.event),
        "breakpoints": tables.breakpoints(spark),
    }, f"{out}/dashboard")
    return {name: f"{out}/{name}" for name in (
        "one_per_day", "clean_city_day", "daily_aqi", "daily_aqi_csv", "daily_aqi_web",
        *(f"results/{n}" for n in results), "dashboard/summary", "dashboard/cities", "dashboard/breakpoints")}
