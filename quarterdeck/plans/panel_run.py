"""The whole panel derivation, from raw codes to ratios, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarterdeck.operators import flows, normalize, ratios


def exclusions(panel: DataFrame) -> DataFrame:
    """Codes, segments, excluded categories and their capped trailing-year losses."""
    df = normalize.map_segments(normalize.resolve_codes(panel))
    df = normalize.segment_flows(df)
    df = normalize.exclusion_losses(normalize.exclusion_balances(df))
    df = normalize.exclusion_totals(normalize.exclusion_quality(df))
    return normalize.apply_ceiling(normalize.excluded_ttm(df))


def derive_panel(panel: DataFrame) -> DataFrame:
    """Every derived metric of the panel. Needs one row per (CERT, REPDTE).

    All window steps partition by CERT, so the input's own distribution by CERT is reused
    from the first window to the last.
    """
    df = ratios.add_totals(exclusions(panel))
    df = ratios.add_velocity_inputs(normalize.apply_residuals(df))
    df = ratios.apply_ratios(
        df,
        [
            *ratios.TOP_RATIOS,
            *(ratios.CAPITAL_RATIOS if "RBCT1J" in df.columns else []),
            *ratios.LIQUIDITY_RATIOS,
            *ratios.PROFIT_RATIOS,
            *ratios.NORM_RATIOS,
        ],
    )
    df = ratios.normalized_yields(df)
    df = ratios.segment_ratios(df)
    df = normalize.past_due_shares(df)
    df = ratios.group_shares(df)
    df = flows.add_growth(df)
    df = df.withColumn("TTM_NCO_Rate", flows.ttm_rate("NTLNLS_Q", "LNLS"))
    df = flows.smoothed_past_due(df, ["TopHouse_PD30", "TopHouse_PD90"], "LNLS", "Past_Due_Rate")
    return ratios.add_aliases(df)
