"""Panel, series, loan, tracker and geography inputs derived from the star-schema tables.

Every shape reads whole tables and grows with them. Amounts are integers held in
doubles (1/10000 of a currency unit), so sums are exact in any order.

The field tables below are plain predicates over ``lineitem``: one scan and one
map-side-combined aggregate builds the whole panel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LINE_MEASURES = {
    # name: expression over lineitem, exact in 64-bit integers
    "v": "cast(round(l_extendedprice * 100) as bigint) * 100",
    "f": "cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint)",
    "t": "cast(round(l_extendedprice * 100) as bigint) * cast(round(l_tax * 100) as bigint)",
    "q": "cast(l_quantity as bigint) * 10000000",
    "p": "cast(l_quantity as bigint)",  # small numbers, for fields in percent
}

# panel column: (measure, predicate). Codes are public call-report and FDIC field names.
STOCK_FIELDS = {
    "LNLS": ("v", "true"),
    "LNCI": ("v", "l_linenumber = 1"),
    "LNRECONS": ("v", "l_linenumber = 2"),
    "LNRENROW": ("v", "l_linenumber = 3"),
    "LNREMULT": ("v", "l_linenumber = 4"),
    "LNRENROT": ("v", "l_linenumber = 5"),
    "LNRERES": ("v", "l_linenumber = 6"),
    "LNCRCD": ("v", "l_linenumber = 7 and l_returnflag = 'A'"),
    "LNAUTO": ("v", "l_linenumber = 7 and l_returnflag = 'N'"),
    "LNAG": ("v", "l_linenumber = 7 and l_returnflag = 'R'"),
    "LNCON": ("v", "l_linenumber = 7"),
    "RCFD1545": ("v", "l_linenumber = 6 and l_linestatus = 'O'"),
    "RCON1545": ("v", "l_linenumber = 6 and l_linestatus = 'F'"),
    "RCFDJ454": ("v", "l_linenumber = 5 and l_returnflag = 'N'"),
    "RCONJ451": ("v", "l_linenumber = 5 and l_returnflag = 'R'"),
    "RCON5367": ("v", "l_linenumber = 6 and l_returnflag = 'A'"),
    "RCON5368": ("v", "l_linenumber = 6 and l_returnflag = 'N'"),
    "RCFDJJ04": ("v", "l_linenumber = 2 and l_linestatus = 'O'"),
    "RCONJJ04": ("v", "l_linenumber = 2 and l_linestatus = 'F'"),
    "RCFDJJ05": ("v", "l_linenumber in (3, 4, 5)"),
    "RCFDJJ07": ("v", "l_linenumber = 1"),
    "RCFDJJ08": ("v", "l_linenumber = 7 and l_returnflag = 'A'"),
    "RCFDJJ09": ("v", "l_linenumber = 7 and l_returnflag <> 'A'"),
    "RCFDJJ12": ("f", "l_linenumber = 2 and l_linestatus = 'O'"),
    "RCFDJJ13": ("f", "l_linenumber in (3, 4, 5) and l_linestatus = 'O'"),
    "RCFDJJ14": ("f", "l_linenumber = 6 and l_linestatus = 'O'"),
    "RCFDJJ15": ("f", "l_linenumber = 1 and l_linestatus = 'O'"),
    "RCFDJJ16": ("f", "l_linenumber = 7 and l_returnflag = 'A'"),
    "RCFDJJ17": ("f", "l_linenumber = 7 and l_returnflag = 'N'"),
    "RCFDJJ22": ("f", "l_linenumber = 7 and l_returnflag = 'R'"),
    "LNATRES": ("f", "l_linestatus = 'O' and l_quantity > 5"),
    "RB2LNRES": ("f", "l_linestatus = 'O' and l_quantity > 10"),
    "ASSET": ("v", "l_linenumber <= 7"),
    "DEP": ("v", "l_linestatus = 'O'"),
    "EQ": ("q", "l_linestatus = 'F'"),
    "RBCT1J": ("q", "l_returnflag = 'A'"),
    "CHBAL": ("q", "l_linenumber = 1"),
    "CHBALNI": ("q", "l_linenumber = 2"),
    "RCFD1754": ("q", "l_linenumber = 3 and l_linestatus = 'O'"),
    "RCON1754": ("q", "l_linenumber = 3"),
    "RCFD1773": ("q", "l_linenumber = 4 and l_linestatus = 'O'"),
    "RCON1773": ("q", "l_linenumber = 4"),
    "RCFD3423": ("v", "l_linenumber = 5 and l_linestatus = 'O'"),
    "RCON3423": ("v", "l_linenumber = 5"),
    "NACI": ("f", "l_linenumber = 1 and l_returnflag = 'R'"),
    "NARECONS": ("f", "l_linenumber = 2 and l_returnflag = 'R'"),
    "NARENROW": ("f", "l_linenumber = 3 and l_returnflag = 'R'"),
    "NAREMULT": ("f", "l_linenumber = 4 and l_returnflag = 'R'"),
    "NARENROT": ("f", "l_linenumber = 5 and l_returnflag = 'R'"),
    "NARERES": ("f", "l_linenumber = 6 and l_returnflag = 'R'"),
    "NACRCD": ("f", "l_linenumber = 7 and l_returnflag = 'R' and l_linestatus = 'O'"),
    "NAAUTO": ("f", "l_linenumber = 7 and l_returnflag = 'R' and l_linestatus = 'F'"),
    "P3CI": ("f", "l_linenumber = 1 and l_returnflag = 'A' and l_linestatus = 'O'"),
    "P3RECONS": ("f", "l_linenumber = 2 and l_returnflag = 'A' and l_linestatus = 'O'"),
    "P3RENROW": ("f", "l_linenumber = 3 and l_returnflag = 'A' and l_linestatus = 'O'"),
    "P3REMULT": ("f", "l_linenumber = 4 and l_returnflag = 'A' and l_linestatus = 'O'"),
    "P3RENROT": ("f", "l_linenumber = 5 and l_returnflag = 'A' and l_linestatus = 'O'"),
    "P3RERES": ("f", "l_linenumber = 6 and l_returnflag = 'A' and l_linestatus = 'O'"),
    "P3CRCD": ("f", "l_linenumber = 7 and l_returnflag = 'A' and l_linestatus = 'O'"),
    "P3LNLS": ("f", "l_returnflag = 'A' and l_linestatus = 'O' and l_quantity > 10"),
    "P3ASTOT": ("f", "l_returnflag = 'A' and l_linestatus = 'O'"),
    "P9CI": ("f", "l_linenumber = 1 and l_returnflag = 'A' and l_linestatus = 'F'"),
    "P9RECONS": ("f", "l_linenumber = 2 and l_returnflag = 'A' and l_linestatus = 'F'"),
    "P9RENROW": ("f", "l_linenumber = 3 and l_returnflag = 'A' and l_linestatus = 'F'"),
    "P9REMULT": ("f", "l_linenumber = 4 and l_returnflag = 'A' and l_linestatus = 'F'"),
    "P9RENROT": ("f", "l_linenumber = 5 and l_returnflag = 'A' and l_linestatus = 'F'"),
    "P9RERES": ("f", "l_linenumber = 6 and l_returnflag = 'A' and l_linestatus = 'F'"),
    "P9CRCD": ("f", "l_linenumber = 7 and l_returnflag = 'A' and l_linestatus = 'F'"),
    "P9LNLS": ("f", "l_returnflag = 'A' and l_linestatus = 'F' and l_quantity > 10"),
    "P9ASTOT": ("f", "l_returnflag = 'A' and l_linestatus = 'F'"),
    # supplied as they are, not derived
    "ROA": ("p", "l_linenumber = 1 and l_quantity > 30"),
    "ROE": ("p", "l_linenumber = 2 and l_quantity > 30"),
    "NIMY": ("p", "l_linenumber = 3 and l_quantity < 15"),
    "EEFFR": ("p", "l_linenumber = 4 and l_quantity < 15"),
}

# Quarter flows; the panel carries them as running totals within the year.
FLOW_FIELDS = {
    "NTLNLS": ("t", "l_returnflag = 'N' and l_quantity > 3"),
    "NTCI": ("t", "l_linenumber = 1 and l_returnflag = 'N'"),
    "NTRECONS": ("t", "l_linenumber = 2 and l_returnflag = 'N'"),
    "NTRENROW": ("t", "l_linenumber = 3 and l_returnflag = 'N'"),
    "NTREMULT": ("t", "l_linenumber = 4 and l_returnflag = 'N'"),
    "NTRENROT": ("t", "l_linenumber = 5 and l_returnflag = 'N'"),
    "NTRERES": ("t", "l_linenumber = 6 and l_returnflag = 'N'"),
    "RIADB514": ("t", "l_linenumber = 7 and l_returnflag = 'N' and l_linestatus = 'O'"),
    "RIADB515": ("t", "l_linenumber = 7 and l_returnflag = 'N' and l_quantity > 40"),
    "RIADK205": ("t", "l_linenumber = 7 and l_returnflag = 'N' and l_linestatus = 'F'"),
    "ELNATR": ("t", "l_returnflag = 'R'"),
    "EINTEXP": ("t", "l_linestatus = 'F'"),
    "ILNDOM": ("t", "l_returnflag <> 'R'"),
    "EDEPDOM": ("t", "l_linestatus = 'O' and l_returnflag = 'A'"),
    "NETINC": ("t", "l_linestatus = 'O'"),
    "INTINC": ("t", "l_linenumber <= 4"),
    "INTEXP": ("t", "l_linenumber = 5"),
    "NONII": ("t", "l_linenumber = 6"),
    "NONIX": ("t", "l_linenumber = 7"),
}


ROWS_A_TASK = 300_000
DIRECT = 4  # so many tasks' rows are aggregated as they are read


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(rows: DataFrame) -> int | None:
    """Partitions of ``ROWS_A_TASK`` rows, but one a core at least. For a table of no more than ``DIRECT`` of them nothing: AQE decides.

    ``rows`` is a table as it is read, so that only the counts in its files are read. Whether rows are dealt depends on their number
    alone: with many cores a split of a file still holds millions of rows.
    """
    n = -(-rows.count() // ROWS_A_TASK)
    return max(n, rows.sparkSession.sparkContext.defaultParallelism) if n > DIRECT else None


def dealt(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """``df`` in ``n`` partitions by ``keys``; as it is without a number.

    Before an aggregate by the same keys no task holds more groups than its rows. A split of a file has rows of any group, so
    that the aggregate's map side would hold a row of all sums for almost every line.
    """
    return df.repartition(n, *keys) if n else df


def quarter_end(c: Column | str) -> Column:
    """Last day of the calendar quarter holding a date."""
    c = F.col(c) if isinstance(c, str) else c
    return F.last_day(F.add_months(F.date_trunc("quarter", c).cast("date"), 2))


def quarter_flows(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, n: int | None = None) -> DataFrame:
    """Entity x quarter with discrete flows and stocks. Only the columns asked for are aggregated. ``n`` comes from :func:`tasks`."""
    fields = {**STOCK_FIELDS, **FLOW_FIELDS}
    wanted = list(fields) if columns is None else columns
    lines = table(spark, sf_dir, "lineitem").withColumn("REPDTE", quarter_end("l_shipdate")).selectExpr(
        "l_suppkey as CERT",
        "REPDTE",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
        *[f"{expr} as {name}" for name, expr in LINE_MEASURES.items()],
    )
    sums = [
        F.expr(f"cast(sum(case when {fields[name][1]} then {fields[name][0]} end) as double) as {name}")
        for name in wanted
    ]
    return dealt(lines, n, "CERT", "REPDTE").groupBy("CERT", "REPDTE").agg(*sums)


def bank_panel(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The entity-quarter panel: stocks as they are, flows as year-to-date."""
    wanted = list(STOCK_FIELDS) + list(FLOW_FIELDS) if columns is None else columns
    # One shuffle by entity on the aggregated rows serves this window and every later one.
    n = tasks(table(spark, sf_dir, "lineitem"))
    base = quarter_flows(spark, sf_dir, wanted, n)
    base = dealt(base, n, "CERT") if n else base.repartition("CERT")
    running = "sum({0}) over (partition by CERT, year(REPDTE) order by REPDTE) as {0}"
    return base.selectExpr("CERT", "REPDTE", *[running.format(c) if c in FLOW_FIELDS else c for c in wanted])


def peer_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership bridge: one group per region, odd regions use the normalised view; a last group holds everybody."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    supplier = table(spark, sf_dir, "supplier")
    # 25 nations and 5 regions are fixed by the schema, so this lookup may be broadcast.
    places = F.broadcast(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    by_region = supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("r_name").alias("group_key"),
        F.col("s_suppkey").alias("CERT"),
        (F.col("r_regionkey") + 1).cast("int").alias("display_order"),
        (F.col("r_regionkey").isin(1, 3)).alias("use_normalized"),
    )
    everybody = supplier.select(
        F.lit("ALL").alias("group_key"),
        F.col("s_suppkey").alias("CERT"),
        F.lit(6).alias("display_order"),
        F.lit(False).alias("use_normalized"),
    )
    return by_region.unionByName(everybody)


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular daily series, one per supplier: (SeriesID, DATE, VALUE), unique per day."""
    lines = table(spark, sf_dir, "lineitem")
    n = tasks(lines)
    lines = lines.selectExpr("l_suppkey as SeriesID", "cast(l_shipdate as date) as DATE", f"{LINE_MEASURES['v']} as v")
    days = dealt(lines, n, "SeriesID", "DATE").groupBy("SeriesID", "DATE").agg(F.sum("v").cast("double").alias("VALUE"))
    return dealt(days, n, "SeriesID")


# The 13 product buckets, by customer segment and order status below.
PRODUCT_CASE = """
case c_mktsegment || o_orderstatus
  when 'AUTOMOBILEF' then 'LAL Diversified'   when 'AUTOMOBILEO' then 'LAL Highly Conc.'
  when 'AUTOMOBILEP' then 'LAL NFPs'          when 'BUILDINGF' then 'RESI'
  when 'BUILDINGO' then 'TL CRE'              when 'BUILDINGP' then 'TL CRE'
  when 'FURNITUREF' then 'TL Life Insurance'  when 'FURNITUREO' then 'TL Aircraft'
  when 'FURNITUREP' then 'TL Multicollateral' when 'HOUSEHOLDF' then 'TL Other Secured'
  when 'HOUSEHOLDO' then 'TL PHA'             when 'HOUSEHOLDP' then 'TL Multicollateral'
  when 'MACHINERYF' then 'TL SBL Diversified' when 'MACHINERYO' then 'TL SBL Highly Conc.'
  else 'TL Unsecured' end
"""

COLLATERAL_CASE = """
case o_orderpriority
  when '1-URGENT' then 'Marketable Securities account'
  when '2-HIGH' then 'Hedge Fund and Privately Held shares'
  when '3-MEDIUM' then 'UNSECURED personal guarantee'
  when '4-NOT SPECIFIED' then 'aircraft and fine art'
  else 'Other business assets' end
"""

# name: expression over orders joined with customer, valid in any SQL dialect used here
LOAN_FIELDS = {
    "LOAN_ID": "o_orderkey",
    "TL_FACILITY_DIGITS12": "case o_orderstatus when 'P' then cast(o_orderkey as varchar(20)) || '.0' when 'O' then cast(o_orderkey as varchar(20)) else 'nan' end",
    "FACILITY_ID": "case when o_orderpriority = '1-URGENT' then 'None' else cast(o_orderkey as varchar(20)) end",
    "ACCOUNT_NUMBER": "'001-' || cast(c_custkey as varchar(20))",
    "BORROWER": "c_name",
    "PRODUCT_BUCKET": PRODUCT_CASE,
    "IS_LAL_NFP": "case when c_acctbal < -500 then 'True' when c_acctbal < 0 then '1' when c_acctbal > 9000 then null else 'false' end",
    "FOCUS_LIST": "case when o_orderpriority = '5-LOW' then ' Non-Pass ' else 'Pass' end",
    "TXT_MSTR_FACIL_COLLATERAL_DESC": COLLATERAL_CASE,
    "SBL_PERC": "case when month(o_orderdate) = 1 then 'n/a' else cast(month(o_orderdate) * 8 as varchar(20)) end",
    "CREDIT_LII": "case when o_totalprice < 2000 then 'unknown' else cast(cast(round(o_totalprice * 100) as bigint) * 10 as varchar(30)) end",
    "BALANCE": "cast(cast(round(o_totalprice * 100) as bigint) * 5 as varchar(30))",
    "BOOK_DATE": "cast(o_orderdate as date)",
    "NEW_CAMP_YN": "case when year(o_orderdate) >= 2000 then 'Y' else 'N' end",
    "NEW_COMMITMENT_AMOUNT": "case when quarter(o_orderdate) = 1 then '2500000' when quarter(o_orderdate) = 2 then '0' else null end",
    "NEW_COMMITMENT_REASON": "case o_orderpriority when '1-URGENT' then 'NONE' when '2-HIGH' then 'nan' when '3-MEDIUM' then '' when '5-LOW' then 'Increase' else null end",
}

CREDIT_LOOKUP_FIELDS = {
    "ACCOUNT_NUMBER": "'001-' || lpad(cast(c_custkey as varchar(20)), 9, '0')",
    "OPERATING_COMPANY": "case when c_mktsegment = 'MACHINERY' or c_acctbal > 8000 then ' Yes' else 'No' end",
    "CHARITY_NON_PROFIT_ORGANIZATION": "case when c_nationkey in (3, 7) then 'YES' else 'no' end",
    "EXCEPTION_1": "case when c_nationkey = 1 then 'Yes' else 'No' end",
    "EXCEPTION_2": "case when c_nationkey = 2 then 'yes' else null end",
    "EXCEPTION_3": "case when c_acctbal between 100 and 300 then 'YES' else 'No' end",
    "EXCEPTION_4": "'No'",
}

RESERVE_LOOKUP_FIELDS = {
    "FACILITY_ACCOUNT_NUMBER": "cast(o_orderkey as varchar(20)) || '.0'",
    "PURPOSE_CODE_DESCRIPTION": "case o_orderpriority when '1-URGENT' then 'CORPORATE loan' when '2-HIGH' then 'corp purpose' else 'Personal' end",
    "ACCOUNT_RELATIONSHIP_CODE_DESCRIPTION": "case when o_totalprice > 400000 then 'Family Trust' when o_totalprice > 250000 then 'Limited Liability Co' when o_totalprice > 150000 then null else 'Individual' end",
}

PROPERTY_LOOKUP_FIELDS = {
    "FACILITY_ID": "cast(p_partkey as varchar(20))",
    "PROPERTY_TYPE": "case p_type when 'LARGE' then 'OFFICE tower' when 'SMALL' then 'Medical office' when 'PROMO' then null else 'Retail' end",
    "PROPERTY_NAME": "p_name",
}


def _project(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(expr).alias(name) for name, expr in fields.items()])


def loan_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan rows as an extract would land: text columns, uncleaned keys."""
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return _project(joined, LOAN_FIELDS)


def credit_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), CREDIT_LOOKUP_FIELDS)


def reserve_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), RESERVE_LOOKUP_FIELDS)


def property_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "part"), PROPERTY_LOOKUP_FIELDS)


TRACKER_FIELDS = {
    "DEAL_ID": "o_orderkey",
    "TRACKER_FILE_V": "'file ' || cast(c_custkey as varchar(20))",
    "RELATIONSHIP_NAME": "case when c_acctbal < 0 then '' when c_acctbal > 9500 then null else '  ' || lower(c_name) end",
    "PRODUCT_AREA": "c_mktsegment",
    "DEAL_TYPE": "o_orderpriority",
    "TRACKER_DATE": "cast(o_orderdate as date)",
    "GROSS_SIZE": "cast(cast(round(o_totalprice * 100) as bigint) as double)",
    "NET_SIZE": "cast(cast(round(o_totalprice * 100) as bigint) * 3 as double)",
    "FA_POLICY": "case when o_orderstatus = 'F' and c_acctbal > 5000 then 'Y' else '' end",
    "FA_PRICING": "case when o_orderpriority = '1-URGENT' then 'y' else null end",
    "DD_REVIEW": "case when o_orderstatus = 'P' then 'Y' else null end",
    "DD_SITE": "case when c_acctbal < 1000 then 'Y' else 'N' end",
    "NEW_CLIENT": "case when o_totalprice > 300000 then 'Y' else '' end",
}


def deal_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return _project(joined, TRACKER_FIELDS)
