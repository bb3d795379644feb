"""Healing, code resolution and availability queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.sql import with_ctes
from quarterdeck.operators import heal
from quarterdeck.plans.shapes import bank_panel, table

FIELDS = ["RCFD1545", "RCFDJJ04", "NACI"]


def holey_panel(spark, sf):
    """The panel with gaps: second-quarter cells NULL, third-quarter cells 0, one field not there at all."""
    df = bank_panel(spark, sf, ["LNLS", "RCFD1545", "RCFDJJ04"])
    quarter = F.quarter("REPDTE")
    gap = lambda c: F.when(quarter == 2, F.lit(None)).when(quarter == 3, F.lit(0.0)).otherwise(F.col(c))
    return df.select("CERT", "REPDTE", "LNLS", *[gap(c).alias(c) for c in ("RCFD1545", "RCFDJJ04")])


def heal_patch(spark, sf):
    healed = heal.heal_with_status(holey_panel(spark, sf), bank_panel(spark, sf, FIELDS))
    return healed.select("CERT", "REPDTE", "LNLS", *FIELDS, "RIC_SOURCE_AVAILABLE", "RIC_Source_Status")


def heal_gate(spark, sf):
    return heal.quarters_to_patch(holey_panel(spark, sf))


def heal_gated(spark, sf):
    main = holey_panel(spark, sf)
    # Only the quarters that fail the gate are patched, so the 0-cells of other quarters stay.
    return heal.heal(main, bank_panel(spark, sf, FIELDS), gate=heal.quarters_to_patch(main))


def attach_field(spark, sf):
    other = bank_panel(spark, sf, ["NACI"]).withColumn("REPDTE", F.col("REPDTE").cast("string"))
    return heal.attach_field(bank_panel(spark, sf, ["LNLS"]), other)


def operating_places(spark, sf):
    """Branches are the order countries of each supplier's lines."""
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("CERT"), "l_orderkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    branches = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("CERT", F.col("c_mktsegment").alias("STATE"))
    )
    return heal.operating_places(branches)


def attach_places(spark, sf):
    """The panel's rows with the order segments of each supplier's even orders; suppliers without one get NULL."""
    lines = table(spark, sf, "lineitem").filter("l_orderkey % 64 = 0").select(F.col("l_suppkey").alias("CERT"), "l_orderkey")
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    branches = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("CERT", F.col("c_mktsegment").alias("STATE"))
    return heal.attach_places(bank_panel(spark, sf, ["LNLS"]), branches)


def crosswalk_join(spark, sf):
    """Amounts keyed by a customer id, translated through the order crosswalk."""
    xwalk = table(spark, sf, "orders").select(F.col("o_orderkey").alias("IDRSSD"), F.col("o_custkey").alias("CERT"))
    raw = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("IDRSSD"), (F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents")
    )
    return heal.attach_codes(raw, xwalk).groupBy("CERT").agg(F.sum("cents").cast("double").alias("amount"))


def field_availability(spark, sf):
    df = bank_panel(spark, sf, ["LNLS", "LNAG", "RCFD1545"])
    thin = F.when((F.quarter("REPDTE") == 1) & (F.year("REPDTE") < 1998), F.col("LNLS"))
    df = df.withColumns({"THIN": thin, "NEVER": F.lit(None).cast("double")})
    return heal.field_availability(df, ["LNLS", "LNAG", "RCFD1545", "THIN", "NEVER", "NOT_THERE"])


QUERIES = {
    "heal_patch": heal_patch,
    "heal_gate": heal_gate,
    "heal_gated": heal_gated,
    "attach_field": attach_field,
    "operating_places": operating_places,
    "attach_places": attach_places,
    "crosswalk_join": crosswalk_join,
    "field_availability": field_availability,
}

_HOLES = """select CERT, REPDTE, LNLS,
 case quarter(REPDTE) when 2 then null when 3 then 0.0 else RCFD1545 end as RCFD1545,
 case quarter(REPDTE) when 2 then null when 3 then 0.0 else RCFDJJ04 end as RCFDJJ04 from panel"""
_GATE = f"""select REPDTE, (sum(case when coalesce(RCFD1545, 0) = 0 then 1 else 0 end) + sum(case when coalesce(RCFDJJ04, 0) = 0 then 1 else 0 end)) / (count(*) * 2) as missing_share
 from ({_HOLES}) group by REPDTE having missing_share > 0.5"""


def _healed(c):
    return f"coalesce(nullif(m.{c}, 0.0), nullif(p.{c}, 0.0), m.{c}, p.{c}) as {c}"


ORACLES = {
    "heal_patch": with_ctes(
        f"""select CERT, REPDTE, LNLS, RCFD1545, RCFDJJ04, NACI, cast(RCFDJJ04 is not null as integer) as RIC_SOURCE_AVAILABLE,
            case when RCFDJJ04 is not null then 'SUCCESS' else 'MISSING_DATA' end as RIC_Source_Status from (
            select m.CERT, m.REPDTE, m.LNLS, {_healed('RCFD1545')}, {_healed('RCFDJJ04')}, p.NACI from ({_HOLES}) m left join panel p on m.CERT = p.CERT and m.REPDTE = p.REPDTE)""",
        "panel",
    ),
    "heal_gate": with_ctes(_GATE, "panel"),
    "heal_gated": with_ctes(
        f"""select m.CERT, m.REPDTE, m.LNLS, {_healed('RCFD1545')}, {_healed('RCFDJJ04')}, p.NACI from ({_HOLES}) m
            left join (select * from panel where REPDTE in (select REPDTE from ({_GATE}))) p on m.CERT = p.CERT and m.REPDTE = p.REPDTE""",
        "panel",
    ),
    "attach_field": with_ctes("select CERT, REPDTE, LNLS, NACI from panel", "panel"),
    "operating_places": """select l_suppkey as CERT, string_agg(distinct c_mktsegment, ', ' order by c_mktsegment) as ALL_OPERATING_STATES
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by 1""",
    "attach_places": with_ctes(
        """select p.CERT, REPDTE, LNLS, ALL_OPERATING_STATES from panel p left join (select l_suppkey as CERT, string_agg(distinct c_mktsegment, ', ' order by c_mktsegment) as ALL_OPERATING_STATES
            from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey where l_orderkey % 64 = 0 group by 1) b on p.CERT = b.CERT""",
        "panel",
    ),
    "crosswalk_join": """select o_custkey as CERT, cast(sum(cast(round(l_extendedprice * 100) as bigint)) as double) as amount
        from lineitem join orders on l_orderkey = o_orderkey group by 1""",
    "field_availability": with_ctes(
        """select field, pct as coverage_pct, case when pct = 0 then 'empty' when pct < 25 then 'sparse' else 'available' end as availability from (
           select unnest(['LNLS', 'LNAG', 'RCFD1545', 'THIN', 'NEVER', 'NOT_THERE']) as field,
           unnest([count(LNLS) * 100.0 / count(*), count(LNAG) * 100.0 / count(*), count(RCFD1545) * 100.0 / count(*),
             count(case when quarter(REPDTE) = 1 and year(REPDTE) < 1998 then LNLS end) * 100.0 / count(*), 0.0, 0.0]) as pct from panel)""",
        "panel",
    ),
}
