"""Landed files, nested JSON, text events, sinks and the patch stream."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from plan_nodes import ran
from quarterdeck.catalog import files
from quarterdeck.operators import eventtext, quality
from quarterdeck.plans import shapes
from quarterdeck.session import materialize, scratch_path
from quarterdeck.sources import callreport, delimited, jsonrows, lines, sinks, versions
from quarterdeck.streaming import landing


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


def test_title_rows_are_skipped(spark, folder):
    path = put(folder, "a.csv", 'Report\nof,today\n\nAccount Number,Name\n001-1,"Doe, J"\n001-2,Roe\n')
    rows = delimited.read_extract(spark, path, skip_rows=3).orderBy("`Account Number`").collect()
    assert [tuple(r) for r in rows] == [("001-1", "Doe, J"), ("001-2", "Roe")]


@pytest.fixture(params=[7, 64, 1 << 20])
def split_size(spark, request):
    """Files are read in splits of so many bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


HEAD = "Key,Name,Note"
BODY = [("1", "plain", "x"), ("2", "a\nb", "two\n\nbreaks"), ("Key", "Name", "Note"), ("3", 'says "yes",\nor no', None), ("4", "\nfirst", "last\n"), ("5", "é🙂\n漢", "z"), ("Title", None, None), ('5" pipe', 'x" y', '"",'), ("6", '"', '\n"\n')]


def written(row):
    return ",".join("" if c is None else '"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c for c in row)


@pytest.mark.parametrize("titles", [[], ["Title", "", 'said "so, here', 'and there"', HEAD]])
def test_cells_with_line_breaks_over_splits(spark, folder, split_size, titles):
    """Splits of a few bytes: quotes opened in one are closed in another, and rows equal to titles or the header stay."""
    rows = BODY * 6
    for name in ("a.csv", "b.csv"):
        put(f"{folder}/in", name, "\n".join([*titles, HEAD, *(written(r) for r in rows)]) + "\n\n")
    skip = len(titles)
    got = delimited.read_extract(spark, f"{folder}/in", skip_rows=skip)
    assert got.columns == ["Key", "Name", "Note"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows * 2))


def test_records_are_those_of_one_reader(spark, folder, split_size):
    """Random quotes, separators and line ends: the same records as reading the file from its start."""
    rng = random.Random(9)
    text = "".join(rng.choice(['"', '""', ",", "\n", "a", "b", '"a\nb"', ',"', '",']) for _ in range(900)) + '"\n'
    path = put(folder, "r.csv", text)
    want, inside, start, at_edge, out = [], False, 0, True, text.split("\n")[:-1]
    for n, line in enumerate(out):  # quotes open a cell at its start only
        if not inside:
            start, at_edge = n, True
        i = 0
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    inside, at_edge = False, False
            elif c == '"' and at_edge:
                inside = True
            else:
                at_edge = c == ","
            i += 1
        if not inside or n == len(out) - 1:
            want.append((start, "\n".join(out[start : n + 1])))
    got = sorted((r["line"], r["value"]) for r in lines.numbered_records(spark, path).collect())
    assert got == want


def test_line_numbers_over_splits(spark, folder, split_size):
    text = [f"line {i} " + "x" * (i * 37 % 50) for i in range(120)]
    path = put(folder, "n.txt", "\n".join(text) + "\n")
    got = {r["line"]: r["value"] for r in lines.numbered_lines(spark, path).collect()}
    assert got == dict(enumerate(text))


def test_files_without_open_quotes_are_not_shuffled(spark, folder):
    path = put(folder, "q.csv", "A,B\n" + '"1, ""x""",2\n' * 50)
    records = lines.numbered_records(spark, path)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and records.count() == 51


def test_odd_files(spark, folder):
    assert delimited.read_extract(spark, put(folder, "none.csv", "")).columns == []
    one = delimited.read_extract(spark, put(folder, "one.csv", "\n\n a ,a,,A\n"))
    assert one.columns == ["a", "a.1", "_c2", "A.2"] and one.count() == 0
    open_quote = delimited.read_extract(spark, put(folder, "open.csv", 'A,B\n1,"never\nclosed\n'))
    assert [r["A"] for r in open_quote.collect()] == ["1"]
    long_title = "\n" * 500 + "T\n" * 300
    late = delimited.read_extract(spark, put(folder, "late.csv", long_title + "A,B\n1,2\n"), skip_rows=800)
    assert [tuple(r) for r in late.collect()] == [("1", "2")]
    plain = put(folder, "plain.csv", "A,B\n1,x\nA,B\n")
    for option in (True, False):
        assert {tuple(r) for r in delimited.read_extract(spark, plain, line_breaks=option).collect()} == {("1", "x"), ("A", "B")}


def test_schedule_rows_equal_to_its_head_stay(spark, folder, split_size):
    path = put(folder, "RC.txt", "RSSDID\tC1\tCERT\n5\t1\t9\n" + "5\t1\t9\n" * 40 + "\n" + 'x\t3\t4\n6\t"1,500"\n')
    got = delimited.parse_schedule(spark, path).groupBy("IDRSSD", "code", "value").count().collect()
    assert {tuple(r) for r in got} == {(5, "C1", 1.0, 40), (5, "CERT", 9.0, 40), (6, "C1", 1500.0, 1)}


def test_schedules_by_either_key(spark, folder):
    by_cert = delimited.parse_schedule(spark, put(folder, "a.txt", "X\tFDIC Certificate Number\n\t\n1\t77\n"))
    assert by_cert.columns == ["CERT", "code", "value"] and [tuple(r) for r in by_cert.collect()] == [(77, "X", 1.0)]
    for text in ("", "A\tB\n", "A\tB\nx\ty\n1\t2\n"):
        assert delimited.parse_schedule(spark, put(folder, f"n{len(text)}.txt", text)).count() == 0


def test_types_skip_absent_columns(spark, folder):
    path = put(folder, "a.csv", "BALANCE,IS_LAL_NFP,OTHER\n12.5,true,x\nbad,?,y\n")
    df = delimited.read_typed(spark, path)
    assert dict(df.dtypes) == {"BALANCE": "double", "IS_LAL_NFP": "boolean", "OTHER": "string"}
    assert {tuple(r) for r in df.collect()} == {(12.5, True, "x"), (None, None, "y")}


def test_schedules(spark, folder):
    first = put(folder, "RI-C.txt", '"IDRSSD"\t"RCFD1"\tRCFD2\nid\tone\ttwo\n7\t"1,234"\t5\n8\tx\t\n')
    second = put(folder, "RC-N.txt", "IDRSSD\tRCFD2\nid\ttwo\n7\t9\n")
    parts = [delimited.parse_schedule(spark, p).withColumn("file_rank", F.lit(i)) for i, p in enumerate((first, second))]
    assert {tuple(r) for r in parts[0].drop("file_rank").collect()} == {(7, "RCFD1", 1234.0), (7, "RCFD2", 5.0)}
    merged = callreport.merge_schedules(parts[0].unionByName(parts[1]), ["RCFD1", "RCFD2"])
    assert [tuple(r) for r in merged.collect()] == [(7, 1234.0, 9.0)]
    assert callreport.schedule_rank("Schedule RCCI") == 0 and callreport.schedule_rank("Schedule RC-N") == 1


def test_crosswalk(spark, folder):
    path = put(folder, "por.txt", "IDRSSD\tFDIC Certificate Number\n1\t10\n2\t0\n3\t30\n")
    assert {tuple(r) for r in callreport.build_crosswalk(spark, path).collect()} == {(1, 10), (3, 30)}
    wanted = spark.createDataFrame([(30,)], "CERT long")
    assert [tuple(r) for r in callreport.build_crosswalk(spark, path, wanted).collect()] == [(3, 30)]


def flat(spark, payload, **options):
    df = spark.createDataFrame([(json.dumps(payload),)], "doc string")
    return sorted(tuple(r) for r in jsonrows.flatten_results(df, "doc", ["zip", "year"], **options).collect())


@pytest.mark.parametrize(
    "payload, want",
    [
        ([{"zip": "1"}, {"zip": "2"}], [("1", None), ("2", None)]),
        ({"data": [{"zip": "1", "year": 2020}]}, [("1", "2020")]),
        ({"data": {"results": [{"zip": "1"}]}, "year": 2021}, [("1", "2021")]),
        ({"results": {"rows": [{"zip": "1"}]}}, [("1", None)]),
        ({"year": 1, "results": [{"zip": "1", "results": [{"zip": "2"}, {"year": 3}, 7]}]}, [("1", "3"), ("2", "1")]),
        ({"results": [{"zip": "1", "results": []}]}, [("1", None)]),
        ({"zip": "9"}, [("9", None)]),
    ],
)
def test_nested_json(spark, payload, want):
    assert flat(spark, payload) == want


def test_deep_json_and_bounds(spark):
    payload = {"zip": "deep"}
    for _ in range(6):
        payload = {"results": [payload]}
    assert flat(spark, payload, depth=10) == [("deep", None)]
    with pytest.raises(ValueError):
        flat(spark, payload, depth=11)


def test_events_in_text(spark):
    texts = ["On Friday, June 13, 2025 7:30 p.m.–8:00 p.m. Hall", "Friday, June 13, 2025 at 8:05 PM", "Friday, Juno 13, 2025 8:05 PM", "none 8:05 PM", None]
    df = eventtext.extract_events(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text").orderBy("i")
    rows = [(r["event_date"], r["starts_at"], r["ends_at"]) for r in df.collect()]
    day = dt.date(2025, 6, 13)
    assert rows[0] == (day, dt.datetime(2025, 6, 13, 19, 30), dt.datetime(2025, 6, 13, 20, 0))
    assert rows[1] == (day, dt.datetime(2025, 6, 13, 20, 5), dt.datetime(2025, 6, 13, 22, 5))
    assert rows[2:] == [(None, None, None)] * 3


def test_sink_checks_columns_and_stores_by_period(spark, folder):
    df = spark.createDataFrame([(1, dt.date(2024, 3, 31), 2.0)], "CERT long, REPDTE date, LNLS double")
    with pytest.raises(ValueError):
        sinks.write_extract(df, os.path.join(folder, "x"))
    paths = sinks.write_tables({"panel": df, "other": df}, folder)
    assert os.path.isdir(os.path.join(paths["panel"], "REPDTE=2024-03-31"))
    assert spark.read.parquet(paths["other"]).count() == 1


def test_patch_stream_heals_touched_quarters(spark, folder):
    fields = ["LNLS"]
    panel, out, drop = (os.path.join(folder, n) for n in ("panel", "out", "drop"))
    days = [dt.date(2024, 3, 31), dt.date(2024, 6, 30)]
    rows = [(1, days[0], 0.0), (2, days[0], 5.0), (3, days[0], 0.0), (1, days[1], None)]
    spark.createDataFrame(rows, "CERT long, REPDTE date, LNLS double").write.partitionBy("REPDTE").parquet(panel)
    put(drop, "one.csv", "CERT,LNLS,REPDTE\n1,7.0,2024-03-31\n2,8.0,2024-03-31\n")
    run = lambda: landing.heal_stream(spark, drop, panel, out, os.path.join(folder, "ck"), fields).awaitTermination(120)
    now = lambda: landing.healed_panel(spark, panel, out, fields)
    assert run()
    assert {(r["CERT"], str(r["REPDTE"]), r["LNLS"]) for r in now().filter("REPDTE = '2024-03-31'").collect()} == {(1, "2024-03-31", 7.0), (2, "2024-03-31", 5.0), (3, "2024-03-31", 0.0)}
    put(drop, "two.csv", "CERT,LNLS,REPDTE\n1,9.0,2024-06-30\n")
    assert run()
    assert now().count() == 4 and now().filter("REPDTE = '2024-06-30'").first()["LNLS"] == 9.0
    put(drop, "three.csv", "CERT,LNLS,REPDTE\n3,6.0,2024-03-31\n")
    assert run()  # a later file for a healed quarter keeps what the first one healed
    assert {(r["CERT"], r["LNLS"]) for r in now().where("REPDTE = '2024-03-31'").collect()} == {(1, 7.0), (2, 5.0), (3, 6.0)}
    assert versions.replaced(spark, out).count() == 1


def landed(spark, rows):
    df = spark.createDataFrame(rows, "CERT long, REPDTE date, LNLS double")
    return df.withColumn("_landed", F.struct(F.current_timestamp().alias("at"), F.lit("f").alias("name")))


def test_a_job_that_dies_leaves_the_old_quarter(spark, folder, monkeypatch):
    """Killed after its rows are written and before its log is in place: readers see the old rows, and the batch can be made again."""
    panel, out = (os.path.join(folder, n) for n in ("panel", "out"))
    day, other = dt.date(2024, 3, 31), dt.date(2024, 6, 30)
    spark.createDataFrame([(1, day, None), (2, day, 5.0), (1, other, 3.0)], "CERT long, REPDTE date, LNLS double").write.partitionBy("REPDTE").parquet(panel)
    state = lambda: sorted((r["CERT"], str(r["REPDTE"]), r["LNLS"]) for r in landing.healed_panel(spark, panel, out, ["LNLS"]).collect())
    heal = lambda rows, mark: landing.heal_batch(spark, landed(spark, rows), panel, out, ["LNLS"], mark)
    assert heal([(1, day, 7.0)], "s#0")
    first = state()
    assert first == [(1, "2024-03-31", 7.0), (1, "2024-06-30", 3.0), (2, "2024-03-31", 5.0)]

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(versions, "point", die)
        with pytest.raises(RuntimeError, match="killed"):
            heal([(9, day, 1.0), (1, other, 4.0)], "s#1")
    assert os.path.isdir(f"{out}/rows/version=2") and state() == first
    assert heal([(1, day, 8.0), (2, other, 4.0)], "s#1") and state() == first  # own values win; the quarters are versions 2 now
    assert not heal([(1, day, 0.5)], "s#1") and state() == first  # the same batch is not made twice
    pointers = {str(r["REPDTE"]): r["version"] for r in versions.latest_versions(spark, out).collect()}
    assert pointers == {"2024-03-31": 2, "2024-06-30": 2}
    assert heal([], "s#2") and not heal([], "s#2") and state() == first


def test_a_reader_that_began_goes_on_with_its_version(spark, folder):
    root, day = os.path.join(folder, "t"), dt.date(2024, 3, 31)
    frame = lambda v: spark.createDataFrame([(1, v, day)], "CERT long, v double, REPDTE date")
    assert versions.read(spark, root, frame(0.0).schema).count() == 0
    versions.commit(spark, root, frame(1.0), frame(1.0).select("REPDTE"), "a")
    begun = versions.read(spark, root, frame(0.0).schema)
    versions.commit(spark, root, frame(2.0), frame(2.0).select("REPDTE"), "b")
    assert [r["v"] for r in begun.collect()] == [1.0]
    assert [r["v"] for r in versions.read(spark, root, frame(0.0).schema).collect()] == [2.0]


def test_of_two_patch_files_in_one_batch_the_later_counts(spark, folder):
    panel, out, drop = (os.path.join(folder, n) for n in ("panel", "out", "drop"))
    day = dt.date(2024, 3, 31)
    spark.createDataFrame([(1, day, None), (2, day, None)], "CERT long, REPDTE date, LNLS double").write.partitionBy("REPDTE").parquet(panel)
    put(drop, "b.csv", "CERT,LNLS,REPDTE\n1,9.0,2024-03-31\n2,8.0,2024-03-31\n")
    put(drop, "a.csv", "CERT,LNLS,REPDTE\n1,7.0,2024-03-31\n2,,2024-03-31\n")
    os.utime(os.path.join(drop, "b.csv"), (1_700_000_000, 1_700_000_000))
    assert landing.heal_stream(spark, drop, panel, out, os.path.join(folder, "ck"), ["LNLS"]).awaitTermination(120)
    assert {(r["CERT"], r["LNLS"]) for r in landing.healed_panel(spark, panel, out, ["LNLS"]).collect()} == {(1, 7.0), (2, 8.0)}


def test_a_null_of_a_child_counts(spark):
    """A key the child has wins, also with null; one it has not keeps the parent's."""
    payload = {"year": 1, "results": [{"zip": "1", "year": None}, {"zip": "2"}, {"zip": None, "year": 3, "results": [{"x": 1}, {"zip": "4", "year": None, "results": [{"zip": "5"}]}]}]}
    assert set(flat_rows(spark, payload)) == {("1", None), ("2", "1"), (None, "3"), ("5", None)}
    assert flat_rows(spark, {"zip": "9", "note": 'says "results"', "year": {"a": 1}}) == [("9", '{"a":1}')]


def flat_rows(spark, payload):
    df = spark.createDataFrame([(json.dumps(payload),)], "doc string")
    return [tuple(r) for r in jsonrows.flatten_results(df, "doc", ["zip", "year"]).collect()]


def test_the_last_folder_is_read(spark, folder):
    days = [dt.date(2023, 12, 31), dt.date(2024, 3, 31), dt.date(2024, 6, 30)]
    rows = spark.createDataFrame([(i, d) for d in days for i in range(3)], "CERT long, REPDTE date")
    path = sinks.write_tables({"panel": rows}, folder)["panel"]
    got = sinks.latest_partition(spark, path)
    assert {tuple(r) for r in got.collect()} == {(i, days[-1]) for i in range(3)}
    scan = next(t for n, t in ran(got) if n.startswith("Scan parquet"))
    assert "(REPDTE" in scan.split("PartitionFilters: ")[1] and "= 2024-06-30)]" in scan
    rows.filter("false").drop("REPDTE").coalesce(1).write.parquet(f"{path}/REPDTE=2024-09-30")
    assert {r["REPDTE"] for r in sinks.latest_partition(spark, path).collect()} == {days[-1]}
    spark.createDataFrame([(1, days[0])], "CERT long, REPDTE date").filter("CERT > 5").write.parquet(f"{folder}/plain")
    assert sinks.latest_partition(spark, f"{folder}/plain").count() == 0


def test_shared_folder_is_used(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "t").startswith(shared + "/t-")
    before = len(os.listdir(shared))
    assert materialize(spark.range(5)).count() == 5
    assert len(os.listdir(shared)) == before + 1


def test_formula_checks(spark):
    spec = quality._r("R", "a", "b", high=1.0)
    rows = [(1, 0.5, 1.0, 2.0), (2, 0.6, 1.0, 2.0), (3, 0.0, 1.0, 0.0), (4, 2.0, 4.0, 2.0), (5, None, None, 2.0)]
    df = spark.createDataFrame(rows, "CERT long, R double, a double, b double")
    got = {r["CERT"]: r for r in quality.validate_formulas(df, [spec], ["CERT"]).collect()}
    assert {k: r["row_pass"] for k, r in got.items()} == {1: True, 2: False, 3: True, 4: False, 5: True}
    assert got[4]["above_max"] and got[4]["matches"]


@pytest.mark.parametrize("name", ["schedule_cells", "titled_extract"])
def test_large_parts_are_written_in_pieces(spark, sf, folder, monkeypatch, name):
    """No file holds a third of the table, and the rows read back are the same."""
    want = sorted(map(tuple, files.QUERIES[name](spark, sf).collect()), key=str)
    monkeypatch.setattr(shapes, "ROWS_A_TASK", 60)
    monkeypatch.setattr(files, "scratch_path", lambda spark, label: f"{folder}/{label}")
    got = files.QUERIES[name](spark, sf)
    sizes = [r["count"] for r in spark.read.text(folder, recursiveFileLookup=True).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 20 and max(sizes) < sum(sizes) / 10
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_numbered_lines_are_not_shuffled(spark, folder):
    path = put(folder, "n.txt", "a\n" * 50)
    df = lines.numbered_lines(spark, path)
    assert df.count() == 50
    assert "strategy=broadcast" in df._jdf.queryExecution().optimizedPlan().toString()


def test_open_quotes_take_one_match(spark):
    """Every line of a quoted file is tested, so no text is built for it; long lines do not recurse."""
    odd = ['"a', 'a"', 'a,"b', '"a""', '"a"b"c",d', '"a,b",c', ',"', '","', 'x,"a""b"', "", '"', '"a,' * 100_001, '"a,b",' * 100_000]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, value string").withColumn("open", lines._opens(F.col("value"), ","))
    assert {r["i"] for r in found.where("open").collect()} == {0, 2, 3, 6, 10, 11}
    assert "regexp_replace" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
