"""Geography: ZIP and county crosswalks, metro resolution, and the local macro board."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from quarterdeck.functions.keys import fips5, left_pad, zip5
from quarterdeck.functions.missing import present, to_number
from quarterdeck.functions.names import merge_synonyms
from quarterdeck.operators.series import quarter_end

# Accepted spellings of crosswalk columns.
CROSSWALK_SYNONYMS = {
    "zip": ["zip_code", "zipcode", "zip5", "results.zip"],
    "county_fips": ["county", "geoid", "county_geoid", "countyfips", "fips", "results.county_fips", "results.geoid"],
    "res_ratio": ["residential_ratio", "results.res_ratio"],
    "bus_ratio": ["business_ratio", "results.bus_ratio"],
    "oth_ratio": ["other_ratio", "results.oth_ratio"],
    "tot_ratio": ["total_ratio", "results.tot_ratio"],
}
RATIOS = ["res_ratio", "bus_ratio", "oth_ratio", "tot_ratio"]


def canonical_crosswalk(df: DataFrame) -> DataFrame:
    """Canonical names, five-digit codes, numeric ratios."""
    named = merge_synonyms(df, CROSSWALK_SYNONYMS)
    fixes = {c: to_number(c) for c in present(named.columns, RATIOS)}
    if "zip" in named.columns:
        fixes["zip"] = zip5("zip")
    if "county_fips" in named.columns:
        fixes["county_fips"] = fips5("county_fips")
    return named.withColumns(fixes)


def best_metro_per_zip(crosswalk: DataFrame) -> DataFrame:
    """The metro with the largest ratio per ZIP; the smallest code wins a tie."""
    best = F.min(F.struct((-F.coalesce("tot_ratio", F.lit(0.0))).alias("r"), F.col("cbsa_code"))).alias("b")
    rows = crosswalk.filter(F.col("cbsa_code").isNotNull() & (F.trim("cbsa_code") != ""))
    return rows.groupBy("zip").agg(best).select("zip", F.col("b.cbsa_code").alias("cbsa_code"), (-F.col("b.r")).alias("tot_ratio"))


def zip_coverage(county_map: DataFrame, crosswalk: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Counties of each region joined to their ZIPs, one row per (region, zip, county, year, quarter).

    The row kept among duplicates is the first by ``order``; a minimum over a struct finds it
    while aggregating, so a duplicated key never meets in one task unreduced.
    """
    rows = canonical_crosswalk(crosswalk)
    counties = county_map.withColumn("county_fips", fips5("fips")).select("region", "county_fips", "county", "state")
    joined = rows.join(counties, "county_fips")
    keys = ["region", "zip", "county_fips", "year", "quarter"]
    rest = [c for c in ("county", "state", *RATIOS) if c in joined.columns]
    first = F.min_by(F.struct(*rest), F.struct(*(order or rest)))
    return joined.groupBy(*keys).agg(first.alias("r")).select(*keys, "r.*")


def zip_summary(coverage: DataFrame) -> DataFrame:
    """Per region: distinct ZIPs and counties, sorted name lists, latest vintage.

    Lists hold distinct county and state names, which geography bounds.
    """
    names = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ", ")
    counts = coverage.groupBy("region").agg(
        F.count_distinct("zip").alias("zip_count"),
        F.count_distinct("county_fips").alias("unique_county_count"),
        F.max("year").alias("year"),
        F.max("quarter").alias("quarter"),
    )
    places = coverage.select("region", "county", "state").distinct()
    return counts.join(
        places.groupBy("region").agg(names("county").alias("counties"), names("state").alias("states")), "region"
    )


def coverage_checks(coverage: DataFrame, summary: DataFrame, county_map: DataFrame, regions: DataFrame) -> DataFrame:
    """Validation messages as rows (rule, level, subject, rows_affected); only broken rules appear."""
    rule = lambda df, name, level: df.select(F.lit(name).alias("rule"), F.lit(level).alias("level"), "subject", "rows_affected")
    none = F.lit("")
    count = lambda df: df.agg(F.count(F.lit(1)).alias("rows_affected")).withColumn("subject", none).filter("rows_affected > 0")
    per_region = coverage.groupBy("region").agg(F.count_distinct("zip").alias("n"))
    checks = [
        rule(count(coverage.limit(1).agg(F.count(F.lit(1)).alias("n")).filter("n = 0")), "empty_coverage", "ERROR"),
        rule(
            coverage.join(regions.select("region"), "region", "left_anti").groupBy(F.col("region").alias("subject")).agg(F.count(F.lit(1)).alias("rows_affected")),
            "unknown_region",
            "ERROR",
        ),
        rule(count(coverage.filter(F.col("zip").isNull() | (F.trim("zip") == ""))), "blank_zip", "ERROR"),
        rule(count(coverage.filter(F.length("zip") != 5)), "zip_length", "WARN"),
        rule(
            summary.join(per_region, "region").filter("zip_count <> n").select(F.col("region").alias("subject"), F.col("n").alias("rows_affected")),
            "summary_mismatch",
            "WARN",
        ),
        rule(count(county_map.filter(F.length("fips") != 5)), "fips_length", "ERROR"),
        rule(
            regions.join(per_region, "region", "left_anti").select(F.col("region").alias("subject"), F.lit(0).cast("long").alias("rows_affected")),
            "region_without_zip",
            "WARN",
        ),
    ]
    ratios = present(coverage.columns, RATIOS)
    if ratios:
        filled = coverage.agg(*[F.count(c).alias(c) for c in ratios], F.count(F.lit(1)).alias("_n"))
        checks.append(
            rule(
                filled.unpivot(["_n"], ratios, "subject", "v").filter("v = 0").select("subject", F.col("_n").alias("rows_affected")),
                "ratio_all_null",
                "WARN",
            )
        )
    return reduce(DataFrame.unionByName, checks)


def build_spine(
    requests: DataFrame, metros: DataFrame, zip_metros: DataFrame, county_metros: DataFrame, states: DataFrame
) -> DataFrame:
    """Resolve (geo_type, geo_value) requests to metros: code, ZIP, county, state fallback, unmatched.

    The four references are disjoint by kind, so they make one lookup with (kind, value) as its key, metro names joined in on
    their side. Every request takes part in one join, on its own kind and value, which is also what it was made distinct by:
    one shuffle in all, and no task gets the requests of other kinds under an empty key. One audit row per request has method, weight,
    coverage and quality. The references are keyed uniquely.
    """
    value = F.trim(F.col("geo_value"))
    base = requests.select(
        "geo_type",
        F.when(F.col("geo_type") == "state", F.upper(value)).otherwise(left_pad(value, 5)).alias("geo_value"),
    ).distinct()
    metro = metros.select("cbsa_code", F.struct("msa_name", F.col("state_fips").alias("fips"), "state_abbrev").alias("_metro"))

    def lookup(kind: str, rows: DataFrame, key: str, weight: Column = F.lit(None)) -> DataFrame:
        known = rows.filter(F.col("cbsa_code").isNotNull()).select(F.col(key).alias("_key"), "cbsa_code", weight.cast("double").alias("_ratio"))
        return known.join(metro, "cbsa_code", "left").select(F.lit(kind).alias("_kind"), "_key", F.col("cbsa_code").alias("_code"), "_ratio", "_metro")

    fallback = F.struct(F.lit(None).cast("string").alias("msa_name"), F.col("state_fips").alias("fips"), F.col("state_abbrev"))
    known = [
        lookup("cbsa", metros, "cbsa_code"),
        lookup("zip", zip_metros, "zip", F.col("tot_ratio")),
        lookup("county_fips", county_metros, "county_fips"),
        states.select(F.lit("state"), F.col("state_abbrev"), F.lit(None).cast("string"), F.lit(None).cast("double"), fallback),
    ]
    lookups = reduce(DataFrame.union, known)
    named = base.join(lookups, (F.col("geo_type") == F.col("_kind")) & (F.col("geo_value") == F.col("_key")), "left")
    kind, found = F.col("geo_type"), F.col("_code").isNotNull()
    method = (
        F.when((kind == "cbsa") & F.col("geo_value").rlike("^[0-9]{5}$"), "direct_cbsa")
        .when((kind == "zip") & found, "zip_to_cbsa")
        .when((kind == "county_fips") & found, "county_to_cbsa")
        .when(kind == "state", "state_fallback")
        .otherwise("unmatched")
    )
    staged = named.withColumn("mapping_method", method)
    hit = F.col("mapping_method") != "unmatched"
    weight = F.when(F.col("mapping_method") == "zip_to_cbsa", F.coalesce("_ratio", F.lit(1.0))).when(hit, 1.0).otherwise(0.0)
    quality = (
        F.when(F.col("mapping_method") == "direct_cbsa", "high")
        .when(F.col("mapping_method") == "zip_to_cbsa", "medium")
        .when(hit, "low")
        .otherwise("unmatched")
    )
    fips = F.when(F.col("mapping_method") == "county_to_cbsa", F.substring("geo_value", 1, 2)).otherwise(F.col("_metro.fips"))
    return staged.select(
        F.col("geo_type").alias("source_geo_type"),
        F.col("geo_value").alias("source_geo_value"),
        F.when(F.col("mapping_method") == "direct_cbsa", F.col("geo_value")).when(hit, F.col("_code")).alias("target_cbsa_code"),
        F.when(hit, F.col("_metro.msa_name")).alias("target_msa_name"),
        F.when(hit, fips).alias("state_fips"),
        F.when(kind == "state", F.col("geo_value")).when(hit, F.col("_metro.state_abbrev")).alias("state_abbrev"),
        "mapping_method",
        weight.alias("mapping_weight"),
        (weight * 100).alias("coverage_pct"),
        quality.alias("quality_flag"),
    )


def first_per_metro(spine: DataFrame) -> DataFrame:
    """One spine row per metro: best quality first, then by source."""
    rank = F.array_position(F.array(*[F.lit(q) for q in ("high", "medium", "low")]), F.col("quality_flag"))
    cols = [c for c in spine.columns if c != "target_cbsa_code"]
    first = F.min_by(F.struct(*cols), F.struct(rank, "source_geo_type", "source_geo_value"))
    kept = spine.filter(F.col("target_cbsa_code").isNotNull()).groupBy(F.col("target_cbsa_code").alias("cbsa_code"))
    return kept.agg(first.alias("r")).select("cbsa_code", "r.*")


def attach_spine(observations: DataFrame, spine: DataFrame, code: str = "cbsa_code") -> DataFrame:
    one = first_per_metro(spine).select(F.col("cbsa_code").alias(code), F.col("target_msa_name").alias("msa_name"), "state_abbrev")
    return observations.join(one, code, "left")


def metro_by_zip_prefix(rows: DataFrame, prefixes: DataFrame, zip_col: str = "zip", length: int = 3) -> DataFrame:
    """Left join on the leading digits of the ZIP."""
    return rows.withColumn("zip_prefix", F.substring(zip_col, 1, length)).join(prefixes, "zip_prefix", "left")


# --- local macro ----------------------------------------------------------------------


def by_metro(order: str = "date"):
    return W.partitionBy("cbsa_code").orderBy(order)


def per_capita(level: Column, population: Column, per: float = 1.0) -> Column:
    """Level per person (or per ``per`` persons); NULL unless the population is positive."""
    return F.when(population > 0, level / population * F.lit(per))


def invalid_population(population: DataFrame) -> DataFrame:
    """Observations that cannot be a denominator."""
    return population.filter(F.col("value") <= 0)


def gdp_metrics(gdp: DataFrame, population: DataFrame) -> DataFrame:
    """Per-capita and per-100k GDP with the latest population of each metro, and growth of the per-100k level."""
    latest = population.groupBy("cbsa_code").agg(F.max_by("value", "date").alias("_pop"))
    joined = gdp.join(latest.withColumn("_has", F.lit(True)), "cbsa_code", "left")
    level, pop = F.col("value"), F.col("_pop")
    wide = joined.withColumns(
        {
            "real_gdp_per_capita": per_capita(level, pop),
            "real_gdp_per_100k": per_capita(level, pop, 100000.0),
            "population_flag": F.when(F.col("_has").isNull(), "missing").when(pop > 0, "ok").otherwise("invalid"),
        }
    )
    growth = (F.try_divide(F.col("real_gdp_per_100k"), F.lag("real_gdp_per_100k").over(by_metro())) - 1) * 100
    names = ["real_gdp_per_capita", "real_gdp_per_100k", "real_gdp_per_100k_yoy_pct"]
    made = wide.withColumn(names[2], F.when(F.col("_has").isNotNull(), growth))
    units = {names[0]: "dollars_per_person", names[1]: "dollars_per_100k", names[2]: "pct"}
    pairs = [F.lit(x) for kv in units.items() for x in kv]
    long = made.unpivot(["cbsa_code", "date", "population_flag"], names, "metric_name", "value")
    # A metro without population gets flagged NULL levels, but no growth rows.
    keep = ~((F.col("population_flag") == "missing") & (F.col("metric_name") == names[2]))
    return long.filter(keep).withColumn("units", F.create_map(*pairs)[F.col("metric_name")])


def unemployment_metrics(rates: DataFrame) -> DataFrame:
    """Quarterly mean rate and its change over four quarters in percentage points."""
    quarterly = (
        rates.filter(F.col("value").isNotNull())
        .groupBy("cbsa_code", quarter_end("date").alias("date"))
        .agg(F.avg("value").alias("unemployment_rate_quarterly"))
    )
    change = F.col("unemployment_rate_quarterly") - F.lag("unemployment_rate_quarterly", 4).over(by_metro())
    wide = quarterly.withColumn("unemployment_change_pp", change)
    names = ["unemployment_rate_quarterly", "unemployment_change_pp"]
    long = wide.unpivot(["cbsa_code", "date"], names, "metric_name", "value")
    return long.filter((F.col("metric_name") == names[0]) | F.col("value").isNotNull()).withColumn(
        "units", F.when(F.col("metric_name") == names[0], "pct").otherwise("pp")
    )


def latest_values(long: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Latest known value of each metric per metro, side by side."""
    known = lambda m: (F.col("metric_name") == m) & F.col("value").isNotNull()
    return long.groupBy("cbsa_code").agg(
        *[F.max_by("value", F.when(known(m), F.col("date"))).alias(m) for m in metrics]
    )


def _latest_and_growth(df: DataFrame, level: str, growth: str) -> DataFrame:
    yoy = (F.try_divide(F.col("value"), F.lag("value").over(by_metro())) - 1) * 100
    rows = df.withColumn("_g", yoy)
    return rows.groupBy("cbsa_code").agg(F.max_by("value", "date").alias(level), F.max_by("_g", "date").alias(growth))


def board_latest(spine: DataFrame, gdp: DataFrame, rates: DataFrame, population: DataFrame) -> DataFrame:
    """One row per metro with latest levels, growth, stress flag, completeness and missing sources."""
    derived = gdp_metrics(gdp, population).select("cbsa_code", "date", "metric_name", "value")
    derived = derived.unionByName(unemployment_metrics(rates).select("cbsa_code", "date", "metric_name", "value"))
    metrics = [
        "real_gdp_per_capita",
        "real_gdp_per_100k",
        "real_gdp_per_100k_yoy_pct",
        "unemployment_rate_quarterly",
        "unemployment_change_pp",
    ]
    base = first_per_metro(spine).select(
        "cbsa_code", F.col("target_msa_name").alias("msa_name"), "state_abbrev", "state_fips", "mapping_method", "mapping_weight", "coverage_pct"
    )
    board = (
        base.join(_latest_and_growth(gdp, "real_gdp_level", "real_gdp_yoy_pct"), "cbsa_code", "left")
        .join(_latest_and_growth(population, "population", "population_yoy_pct"), "cbsa_code", "left")
        .join(latest_values(derived, metrics), "cbsa_code", "left")
        .withColumnsRenamed(
            {"unemployment_rate_quarterly": "unemployment_rate", "unemployment_change_pp": "unemployment_yoy_pp"}
        )
    )
    rising = F.coalesce("unemployment_yoy_pp", F.lit(0.0)) > 0.5
    falling = F.coalesce("real_gdp_yoy_pct", F.lit(0.0)) < 0
    sources = {"gdp": "real_gdp_level", "population": "population", "unemployment": "unemployment_rate"}
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(n)) for n, c in sources.items()]))
    gap = F.size("_missing")
    return (
        board.withColumn("_missing", missing)
        .withColumns(
            {
                "geo_level": F.lit("msa"),
                "macro_stress_flag": F.when(rising & falling, "STRESS").when(rising | falling, "WATCH").otherwise("OK"),
                "macro_data_completeness": F.when(gap == 0, "complete").when(gap == 3, "none").otherwise("partial"),
                "missing_sources": F.when(gap > 0, F.array_join("_missing", ",")),
            }
        )
        .drop("_missing")
    )


def board_panel(board: DataFrame, columns: Sequence[str], sort: str, n: int | None = None) -> DataFrame:
    """Selected board columns, largest first with NULL last; ``n`` makes it a top list."""
    panel = board.select(*columns).orderBy(F.col(sort).desc_nulls_last(), "cbsa_code")
    return panel if n is None else panel.limit(n)


def top_metros(board: DataFrame, n: int = 10) -> DataFrame:
    """Top metros by portfolio balance where there is any, else by GDP."""
    if "portfolio_balance" in board.columns:
        any_balance = board.agg(F.count("portfolio_balance") > 0).scalar()
        size = F.when(any_balance, F.col("portfolio_balance")).otherwise(F.col("real_gdp_level"))
    else:
        size = F.col("real_gdp_level")
    return board.withColumn("_size", size).orderBy(F.col("_size").desc_nulls_last(), "cbsa_code").limit(n).drop("_size")
