"""Source, sink and text queries. Files are written by Spark to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.loans import flagged
from quarterdeck.catalog.sql import with_ctes
from quarterdeck.functions.names import find_column, normalize_names
from quarterdeck.functions import keys
from quarterdeck.functions.missing import with_missing
from quarterdeck.operators import eventtext
from quarterdeck.plans.shapes import LINE_MEASURES, bank_panel, dealt, loan_extract, table, tasks
from quarterdeck.session import scratch_path
from quarterdeck.sources import callreport, delimited, jsonrows, sinks


def typed_csv(spark, sf):
    """The raw extract through CSV and back with types; text in number columns becomes NULL."""
    path = scratch_path(spark, "extract")
    loan_extract(spark, sf).write.option("header", True).csv(path)
    df = delimited.read_typed(spark, path)
    return df.select(F.col("LOAN_ID").cast("long").alias("LOAN_ID"), "FACILITY_ID", "IS_LAL_NFP", "SBL_PERC", "CREDIT_LII", "BALANCE", "BOOK_DATE")


def _written(rows, heads, path, n):
    """Lines ``line`` as text files of one ``part`` each, in order of ``at``, behind the part's ``heads``.

    Of large tables (``n`` tasks, see ``shapes.tasks``) a part has as many files as keep a file to a task's rows, each with the heads.
    """
    pieces, keys = -(-n // 3) if n else 1, ["part", "piece"]
    body = rows.withColumn("piece", F.pmod(F.xxhash64("at"), F.lit(pieces)))
    heads = heads.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)).cast("array<long>")))
    lines = body.unionByName(heads.withColumn("at", F.col("at").cast("long") - 10))
    lines = lines.repartition(n, *keys) if n else lines.repartition(*keys)
    lines.sortWithinPartitions(*keys, "at").select(*keys, "line").write.partitionBy(*keys).text(path)
    return path


_TITLES = ["Extract, as of", "", "Key,Customer,Comment"]
_HEAD = "Key,Customer,Comment"


def titled_extract(spark, sf):
    """Customers' orders behind titles, in several files: cells with line breaks, commas and quotes, and rows equal to title and header."""
    orders = table(spark, sf, "orders").select(F.pmod("o_orderkey", F.lit(5)).alias("part"), F.col("o_orderkey").alias("at"), F.expr("""concat_ws(',', o_orderkey, concat('"C, ', o_custkey, '"'),
        case o_orderstatus when 'O' then concat('"', o_orderpriority, '\\n', '""', o_custkey, '""', '\\n\\nend"') when 'F' then o_orderpriority else '' end)""").alias("line"))
    listed = lambda rows: spark.range(5).select(F.col("id").alias("part"), F.posexplode(F.array(*[F.lit(x) for x in rows])).alias("at", "line"))
    orders = orders.unionByName(listed([_HEAD, _TITLES[0]]).withColumn("at", F.col("at").cast("long") - 5))
    heads = listed([*_TITLES, _HEAD])
    path = _written(orders, heads, scratch_path(spark, "titled"), tasks(table(spark, sf, "orders")))
    df = delimited.read_extract(spark, path, skip_rows=3)
    return df.select("Key", "Customer", "Comment")


def schedule_cells(spark, sf):
    """Schedules by return flag: codes, descriptions, quoted numbers with thousands commas, cells that are no numbers."""
    items = table(spark, sf, "lineitem")
    n, keys = tasks(items), ["l_returnflag", "l_orderkey"]
    value = lambda k: F.max(F.when(F.col("l_linenumber") == k, F.floor("l_extendedprice"))).alias(str(k))
    lines = dealt(items, n, *keys).groupBy(*keys).agg(*[value(k) for k in (1, 2, 3)])
    cell = lambda k: F.coalesce(F.concat(F.lit('"'), F.format_number(F.col(str(k)), 0), F.lit('"')), F.lit("n/a"))
    rows = lines.select(F.col("l_returnflag").alias("part"), F.col("l_orderkey").alias("at"), F.concat_ws("\t", F.concat(F.lit('"'), "l_orderkey", F.lit('"')), cell(1), cell(2), cell(3)).alias("line"))
    head = F.array(F.lit('"IDRSSD"\tRCFD1\t"RCFD2"\trcfd3'), F.lit("id\tone\ttwo\tthree"))
    heads = items.select(F.col("l_returnflag").alias("part")).distinct().select("part", F.posexplode(head).alias("at", "line"))
    path = _written(rows, heads, scratch_path(spark, "schedules"), n)
    return delimited.parse_schedule(spark, path)


def crosswalk_build(spark, sf):
    """A reporter file with ids that are no numbers, zeros and repeats, limited to the customers of one segment."""
    rows = table(spark, sf, "orders").selectExpr(
        "if(o_orderkey % 7 = 0, concat('x', o_orderkey), cast(o_orderkey as string)) as IDRSSD", "if(o_orderkey % 5 = 0, 0, o_custkey) as `FDIC Certificate Number`", "o_orderpriority as `Financial Institution Name`"
    )
    path = scratch_path(spark, "reporters")
    rows.unionByName(rows.filter("`FDIC Certificate Number` % 3 = 0")).write.option("header", True).option("sep", "\t").csv(path)
    wanted = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("CERT"))
    return callreport.build_crosswalk(spark, path, wanted)


def padded_nulls(spark, sf):
    """Null words that an earlier step has padded with zeros, next to real keys."""
    word = "case o_orderpriority when '1-URGENT' then 'nan' when '2-HIGH' then 'None' when '3-MEDIUM' then '' when '4-NOT SPECIFIED' then 'NaT00' else cast(o_custkey as string) end"
    padded = table(spark, sf, "orders").select("o_orderkey", F.lpad(F.expr(word), 12, "0").alias("raw"))
    return padded.select("o_orderkey", keys.drop_padded_nulls("raw").alias("key"), keys.drop_padded_nulls(F.when(F.col("o_orderkey") % 2 == 0, F.lit("  ")).otherwise(F.col("raw"))).alias("other"))


def tagged_sink(spark, sf):
    """The tagged extract written as CSV and loaded again."""
    path = scratch_path(spark, "tagged")
    sinks.write_extract(flagged(spark, sf), path)
    df = delimited.read_typed(spark, path)
    return df.select(F.col("LOAN_ID").cast("long").alias("LOAN_ID"), F.coalesce("FLAGS", F.lit("")).alias("FLAGS"), "FLAG_COUNT", "QUALIFIED")


def quarter_cache(spark, sf):
    """Panel codes stored by quarter, read for a range of quarters and the ids of one region."""
    root = scratch_path(spark, "cache")
    fields = ["RCFD1545", "RCFDJJ04", "LNAG"]
    sinks.by_period(bank_panel(spark, sf, fields), "REPDTE").write.partitionBy("REPDTE").option("header", True).csv(root)
    ids = table(spark, sf, "supplier").join(table(spark, sf, "nation").filter("n_regionkey = 2"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("CERT"))
    return callreport.read_quarter_cache(spark, root, fields, ids, "1996-03-31", "1999-12-31")


def result_tables(spark, sf):
    """Two result tables written by name and read back together."""
    panel = bank_panel(spark, sf, ["LNLS", "LNCI"])
    paths = sinks.write_tables({"panel": panel, "members": panel.select("CERT").distinct()}, scratch_path(spark, "tables"))
    return spark.read.parquet(paths["panel"]).join(spark.read.parquet(paths["members"]), "CERT").select("CERT", "REPDTE", "LNLS", "LNCI")


def merge_schedules(spark, sf):
    """Per supplier and order month, codes by line number; the return flag stands for the file order."""
    long = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("IDRSSD"),
        F.concat(F.lit("C"), F.col("l_linenumber").cast("string")).alias("code"),
        F.when(F.col("l_quantity") > 5, F.expr(LINE_MEASURES["v"]).cast("double")).alias("value"),
        F.struct("l_returnflag", "l_shipdate", "l_suppkey", "l_partkey", "l_extendedprice").alias("file_rank"),
    )
    return callreport.merge_schedules(long, [f"C{i}" for i in range(1, 8)])


JSON_DOC = """case event_type
 when 'click' then '{"year": 2024, "quarter": 1, "results": [{"zip": "' || event_id || '", "results": [{"tot_ratio": ' || value || '}, {"tot_ratio": 0.5, "quarter": 4}, 7]}]}'
 when 'view' then '[{"zip": "' || event_id || '", "tot_ratio": ' || value || '}, {"zip": "x", "results": []}]'
 when 'error' then '{"data": [{"zip": "' || event_id || '", "year": 2020}]}'
 when 'signup' then '{"year": 2021, "results": {"rows": [{"zip": "' || event_id || '"}]}}'
 else '{"zip": "' || event_id || '", "tot_ratio": ' || value || '}' end"""


def nested_json(spark, sf):
    """Five payload shapes, one per event."""
    docs = table(spark, sf, "events").select("event_id", F.expr(JSON_DOC).alias("doc"))
    flat = jsonrows.flatten_results(docs, "doc", ["zip", "year", "quarter", "tot_ratio"], ["event_id"], depth=3)
    return flat.withColumn("tot_ratio", F.col("tot_ratio").try_cast("double"))


def event_props(spark, sf):
    """The JSON properties of the raw events."""
    return jsonrows.flatten_results(table(spark, sf, "events"), "props", ["k"], ["event_id"], depth=1)


def clean_names(spark, sf):
    """Awkward headers cleaned, duplicates numbered, a column found by an alternate, an absent one added."""
    raw = table(spark, sf, "supplier").toDF("s key", "S-Key", "nation (id)", "Acct Bal $")
    df = with_missing(normalize_names(raw), ["NOT_THERE"])
    found = find_column(df.columns, "account balance", ["acct bal"]) or "ACCT_BAL_"
    return df.select("S_KEY", "S_KEY_1", "NATION_ID", F.col(found).alias("BALANCE"), "NOT_THERE")


LISTING = """case o_orderpriority when '1-URGENT' then ' 7:30 p.m.–8:00 p.m.' when '2-HIGH' then ' 8:05 p.m.' when '3-MEDIUM' then ' 11:15 a.m. - 1:05 p.m.' when '4-NOT SPECIFIED' then ' at noon' else ' 9:45 P.M.' end || ' ' || c_mktsegment || ' Hall'"""


def event_text(spark, sf):
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    day = F.when(F.col("o_orderstatus") == "P", F.lit("Soon")).otherwise(F.date_format("o_orderdate", "EEEE, MMMM d, yyyy"))
    df = joined.select("o_orderkey", F.concat(day, F.expr(LISTING)).alias("listing"), F.concat("c_mktsegment", F.lit(" Hall")).alias("place"))
    out = eventtext.extract_events(df, "listing")
    return out.select(
        "o_orderkey",
        "event_date",
        "starts_at",
        "ends_at",
        eventtext.matches_place("place", ["auto", "BUILDING"]).alias("wanted_place"),
        eventtext.with_borough("place", {"furniture hall": "Brooklyn", "machinery": "Queens"}).alias("place"),
    )


def event_text_documents(spark, sf):
    """Dated headers anywhere in whole documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return eventtext.extract_events(docs, "text").select("doc_id", "event_date", "starts_at", F.col("text").rlike(eventtext.DATE_PATTERN).alias("has_date_like"))


QUERIES = {
    "typed_csv": typed_csv,
    "crosswalk_build": crosswalk_build,
    "padded_nulls": padded_nulls,
    "titled_extract": titled_extract,
    "schedule_cells": schedule_cells,
    "tagged_sink": tagged_sink,
    "quarter_cache": quarter_cache,
    "result_tables": result_tables,
    "merge_schedules": merge_schedules,
    "nested_json": nested_json,
    "event_props": event_props,
    "clean_names": clean_names,
    "event_text": event_text,
    "event_text_documents": event_text_documents,
}

_DAY = "case when o_orderstatus <> 'P' then cast(o_orderdate as date) end"
_T = {"1-URGENT": ("19:30", "20:00"), "2-HIGH": ("20:05", "22:05"), "3-MEDIUM": ("11:15", "13:05"), "5-LOW": ("21:45", "23:45")}


def clock(i):
    times = " ".join(f"when '{p}' then {int(t[i][:2]) * 60 + int(t[i][3:])}" for p, t in _T.items())
    return f"{_DAY} + to_minutes(case o_orderpriority {times} end)"


_PADDED = "case o_orderpriority when '1-URGENT' then null when '2-HIGH' then null when '4-NOT SPECIFIED' then null when '3-MEDIUM' then '000000000000' else lpad(cast(o_custkey as varchar), 12, '0') end"
ORACLES = {
    "crosswalk_build": """select o_orderkey as IDRSSD, o_custkey as CERT from orders join customer on o_custkey = c_custkey
        where o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 and c_mktsegment = 'MACHINERY'""",
    "padded_nulls": f"select o_orderkey, {_PADDED} as key, case when o_orderkey % 2 <> 0 then {_PADDED} end as other from orders",
    "titled_extract": """select cast(o_orderkey as varchar) as Key, 'C, ' || o_custkey as Customer, case o_orderstatus when 'O' then o_orderpriority || chr(10) || '"' || o_custkey || '"' || chr(10) || chr(10) || 'end'
        when 'F' then o_orderpriority end as Comment from orders union all select 'Key', 'Customer', 'Comment' from range(5) union all select 'Extract', ' as of', null from range(5)""",
    "schedule_cells": "select l_orderkey as IDRSSD, 'RCFD' || l_linenumber as code, max(floor(l_extendedprice))::double as value from lineitem where l_linenumber <= 3 group by l_returnflag, l_orderkey, l_linenumber",
    "typed_csv": with_ctes(
        "select LOAN_ID, FACILITY_ID, case lower(IS_LAL_NFP) when 'true' then true when '1' then true when 'false' then false end as IS_LAL_NFP, try_cast(SBL_PERC as double) as SBL_PERC, try_cast(CREDIT_LII as double) as CREDIT_LII, try_cast(BALANCE as double) as BALANCE, BOOK_DATE from extract", "extract"
    ),
    "tagged_sink": with_ctes("select LOAN_ID, FLAGS, cast(FLAG_COUNT as bigint) as FLAG_COUNT, QUALIFIED from flagged", "flagged"),
    "quarter_cache": with_ctes(
        """select CERT, REPDTE, RCFD1545, RCFDJJ04, LNAG from panel where REPDTE between date '1996-03-31' and date '1999-12-31' and coalesce(RCFD1545, RCFDJJ04, LNAG) is not null
           and CERT in (select s_suppkey from supplier join nation on s_nationkey = n_nationkey where n_regionkey = 2)""",
        "panel",
    ),
    "result_tables": with_ctes("select CERT, REPDTE, LNLS, LNCI from panel", "panel"),
    "merge_schedules": "select IDRSSD, "
    + ", ".join(f"max(v) filter (l_linenumber = {i}) as C{i}" for i in range(1, 8))
    + f""" from (select l_orderkey as IDRSSD, l_linenumber, cast({LINE_MEASURES['v']} as double) as v from lineitem where l_quantity > 5
        qualify row_number() over (partition by l_orderkey, l_linenumber order by l_returnflag desc, l_shipdate desc, l_suppkey desc, l_partkey desc, l_extendedprice desc) = 1) group by 1""",
    "nested_json": """select event_id, cast(event_id as varchar) as zip, '2024' as year, '1' as quarter, value as tot_ratio from events where event_type = 'click' union all
        select event_id, cast(event_id as varchar), '2024', '4', 0.5 from events where event_type = 'click' union all
        select event_id, cast(event_id as varchar), null, null, value from events where event_type in ('view', 'purchase') union all
        select event_id, 'x', null, null, null from events where event_type = 'view' union all
        select event_id, cast(event_id as varchar), '2020', null, null from events where event_type = 'error' union all
        select event_id, cast(event_id as varchar), '2021', null, null from events where event_type = 'signup'""",
    "event_props": "select event_id, json_extract_string(props, '$.k') as k from events",
    "clean_names": "select s_suppkey as S_KEY, s_name as S_KEY_1, s_nationkey as NATION_ID, s_acctbal as BALANCE, cast(null as double) as NOT_THERE from supplier",
    "event_text": f"""select o_orderkey, {_DAY} as event_date, {clock(0)} as starts_at, {clock(1)} as ends_at, c_mktsegment in ('AUTOMOBILE', 'BUILDING') as wanted_place,
        c_mktsegment || ' Hall' || case c_mktsegment when 'FURNITURE' then ', Brooklyn' when 'MACHINERY' then ', Queens' else '' end as place from orders join customer on o_custkey = c_custkey""",
    "event_text_documents": r"""select doc_id, try_strptime(nullif(regexp_extract(text, '(\w+), (\w+) (\d+), (\d{4})', 2) || ' ' || regexp_extract(text, '(\w+), (\w+) (\d+), (\d{4})', 3) || ' ' || regexp_extract(text, '(\w+), (\w+) (\d+), (\d{4})', 4), '  '), '%B %d %Y')::date as event_date,
        cast(null as timestamp) as starts_at, regexp_matches(text, '(\w+), (\w+) (\d+), (\d{4})') as has_date_like from documents""",
}
