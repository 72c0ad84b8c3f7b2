import json
import random
from multiprocessing.pool import ThreadPool
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hammerprice.operators.combine import align_full, union_all
from hammerprice.schemas import DOMAINS, MODEL_COLUMNS, PROCESSED, RAW, RAW_COLUMNS, SCORING
from hammerprice.session import scratch_root
from hammerprice.sources.commit_log import CommitLog
from hammerprice.sources.csv_files import (
    read_bad_records,
    read_processed_csv,
    read_raw_csv,
    scan_raw_csv,
    scans_by_header,
    write_csv,
)
from hammerprice.sources.metric_log import log_metrics, read_metrics
from hammerprice.sources.snapshots import SIGNALS, announce, announce_missing, land_raw_files, land_snapshot, latest_snapshots, read_latest
from hammerprice.sources.tables import load_config, read_split, records, write_splits, write_table


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_files_with_different_headers(spark, tmp_path):
    put(tmp_path / "a.csv", 'month,town,price\n2020-01,"BED,OK",1\n2020-02,"say ""x""",2\n')
    put(tmp_path / "b.csv", "town,month,price\nYISHUN,2020-03,NA\n")
    put(tmp_path / "sub" / "c.csv", "price,month\n4,2020-04\n")
    put(tmp_path / "d.csv", "town,month,price\nBISHAN,2020-05,5\n")
    assert len(scans_by_header(spark, str(tmp_path), header_per="file")) == 3
    got = read_raw_csv(spark, str(tmp_path), header_per="file").select("month", "town", "price").orderBy("month").collect()
    assert [tuple(r) for r in got] == [
        ("2020-01", "BED,OK", "1"), ("2020-02", 'say "x"', "2"), ("2020-03", "YISHUN", None), ("2020-04", None, "4"),
        ("2020-05", "BISHAN", "5"),
    ]
    kept = read_raw_csv(spark, str(tmp_path), missing=(), header_per="file").where("month = '2020-03'").first()
    assert kept["price"] == "NA"


def test_one_header_per_directory_is_checked(spark, tmp_path):
    put(tmp_path / "x" / "a.csv", "month,town\n2020-01,A\n")
    put(tmp_path / "y" / "a.csv", "town,month\nB,2020-02\n")
    got = read_raw_csv(spark, str(tmp_path), header_per="directory").orderBy("month").collect()
    assert [(r["month"], r["town"]) for r in got] == [("2020-01", "A"), ("2020-02", "B")]
    put(tmp_path / "x" / "b.csv", "town,month\nC,2020-03\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_raw_csv(spark, str(tmp_path), header_per="directory").collect()
    with pytest.raises(ValueError):
        read_raw_csv(spark, str(tmp_path), header_per="row")


def test_a_check_of_fields_does_not_parse_the_records_again(spark, tmp_path):
    put(tmp_path / "a.csv", "month,town,price\n2020-01,A,1\n2020-02,,2\n")
    got = read_raw_csv(spark, str(tmp_path)).where("month IS NOT NULL AND price IS NOT NULL AND coalesce(town, 'x') <> 'y'")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
    assert sorted(map(tuple, got.collect()), key=str) == [("2020-01", "A", "1"), ("2020-02", None, "2")]


def test_records_that_lose_fields_stop_the_job_or_are_set_aside(spark, tmp_path):
    put(tmp_path / "a.csv", 'month,town\n2020-01,A\n2020-02,B,EXTRA\n2020-03\n2020-04,"x, y"\n')
    with pytest.raises(Exception, match="surplus fields in record"):
        read_raw_csv(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="surplus fields in record"):
        read_raw_csv(spark, str(tmp_path)).select("month").collect()
    with pytest.raises(Exception, match="surplus fields in record"):
        read_raw_csv(spark, str(tmp_path)).count()
    kept = read_raw_csv(spark, str(tmp_path), bad_records="aside").orderBy("month").collect()
    assert [tuple(r) for r in kept] == [("2020-01", "A"), ("2020-03", None), ("2020-04", "x, y")]
    assert [tuple(r) for r in read_bad_records(spark, str(tmp_path)).collect()] == [("2020-02,B,EXTRA", "surplus fields")]


@pytest.mark.parametrize("columns", ["x,t", "t,x", "t"])
def test_line_breaks_stay_inside_fields(spark, tmp_path, columns):
    text = 'one\ntwo ""quoted""\r\nthree, four'
    cells = {"x": "1", "t": f'"{text}"'}
    put(tmp_path / "a.csv", columns + "\n" + ",".join(cells[c] for c in columns.split(",")) + "\n")
    row = read_raw_csv(spark, str(tmp_path), multi_line=True).collect()
    assert [r["t"] for r in row] == [text.replace('""', '"')]
    with pytest.raises(Exception, match="open quote in record"):
        read_raw_csv(spark, str(tmp_path)).collect()


def test_own_csv_is_read_back(spark, tmp_path):
    rows = [(1, 'a\nb "c", d'), (2, ""), (3, "plain"), (4, '"')]
    df = spark.createDataFrame(rows, "x int, t string")
    write_csv(df, str(tmp_path / "c"))
    got = read_processed_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted((r.x, r.t or "") for r in got.collect()) == rows
    with pytest.raises(Exception, match="open quote in record"):
        read_processed_csv(spark, str(tmp_path / "c"), df.schema, multi_line=False).collect()


def scans(df):
    """File scans in the plan of `df`."""
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [1024, 60])
def test_files_with_line_breaks_are_split(spark, tmp_path, split, newline):
    rng = random.Random(split)
    cell = lambda: "".join(rng.choice(["a", ",", '"', "\n", "été", "\r\n", "x y", ""]) for _ in range(rng.choice([1, 3, 8, 60])))
    want = []
    for part in range(4):
        rows = [(f"{part}-{i}", cell() if part else "plain", cell()) for i in range(50)]
        quoted = [",".join('"' + c.replace('"', '""') + '"' if set(c) & set('",\n\r') else c for c in row) for row in rows]
        (tmp_path / f"{part}.csv").write_bytes(newline.join(["key,first,a.b", *quoted, ""]).encode())
        want += rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = read_raw_csv(spark, str(tmp_path), missing=(), multi_line=True)
        assert df.rdd.getNumPartitions() > 8
        assert sorted((r.key, r.first or "", r["a.b"] or "") for r in df.collect()) == sorted(want)
        assert df.count() == len(want)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split * 3))
        with pytest.raises(Exception, match="cut otherwise"):
            df.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_quotes_within_a_field_hide_no_comma(spark, tmp_path):
    put(tmp_path / "a.csv", 'k,t\n1,x"y,z"\n2,"a,b"\n3,"a""b,c"\n4,x"y"\n')
    for multi_line in (False, True):
        bad = read_bad_records(spark, str(tmp_path), multi_line=multi_line).collect()
        assert [tuple(r) for r in bad] == [('1,x"y,z"', "surplus fields")]
        kept = read_raw_csv(spark, str(tmp_path), multi_line=multi_line, bad_records="aside").collect()
        assert sorted(map(tuple, kept)) == [("2", "a,b"), ("3", 'a"b,c'), ("4", 'x"y"')]


def test_text_is_scanned_once(spark, tmp_path):
    put(tmp_path / "a.csv", 'month,"to.wn"\n2020-01,"A, B"\n\n2020-02,NA\n')
    for multi_line in (False, True):
        df = read_raw_csv(spark, str(tmp_path), multi_line=multi_line)
        assert scans(df) == 1
        assert sorted((r["month"], r["to.wn"]) for r in df.collect()) == [("2020-01", "A, B"), ("2020-02", None)]


def test_a_quote_left_open_is_found_wherever_it_is(spark, tmp_path):
    put(tmp_path / "a.csv", 'k,t\n1,a\n2,"open\n3,b\n')
    put(tmp_path / "b.csv", 'k,t\n4,c\n')
    for multi_line, lost in ((False, '2,"open'), (True, '2,"open\n3,b')):
        with pytest.raises(Exception, match="open quote in record"):
            read_raw_csv(spark, str(tmp_path), multi_line=multi_line).count()
        bad = read_bad_records(spark, str(tmp_path), multi_line=multi_line).collect()
        assert [tuple(r) for r in bad] == [(lost, "open quote")]
    aside = read_raw_csv(spark, str(tmp_path), multi_line=True, bad_records="aside").collect()
    assert sorted(r.k for r in aside) == ["1", "4"]


def test_many_small_files_cost_one_header_read(spark, tmp_path):
    for i in range(300):
        put(tmp_path / f"f{i % 3}" / f"{i}.csv", f"month,town\n2020-01,T{i}\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        for header_per in ("directory", "file"):
            assert len(scans_by_header(spark, str(tmp_path), header_per=header_per)) == 1
        jobs = tracker.getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 20
    assert read_raw_csv(spark, str(tmp_path)).count() == 300


def test_name_filter_and_empty_location(spark, tmp_path):
    put(tmp_path / "a.csv", "x\n1\n")
    put(tmp_path / "b.csv.bak", "x\n2\n")
    put(tmp_path / "c.txt", "x\n3\n")
    assert sorted(r["x"] for r in union_all(scan_raw_csv(spark, str(tmp_path))).collect()) == ["1", "2"]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, str(tmp_path / "none"))


def test_processed_csv_and_splits(spark, tmp_path):
    row = ("Bedok", "2 Room", "Improved", 39, 44.0, 4170, "1-15", 250000.0)
    df = spark.createDataFrame([row], PROCESSED)
    write_table(df, str(tmp_path / "c"), "csv")
    assert tuple(read_processed_csv(spark, str(tmp_path / "c"), PROCESSED).first()) == row
    assert read_processed_csv(spark, str(tmp_path / "c"), PROCESSED, MODEL_COLUMNS).columns == MODEL_COLUMNS
    tagged = df.selectExpr("*", "'test' AS split")
    for file_format in ("parquet", "csv"):
        path = str(tmp_path / file_format)
        write_splits(tagged, path, file_format=file_format)
        assert tuple(read_split(spark, path, "test", file_format=file_format).first()) == row
    with pytest.raises(ValueError):
        write_splits(tagged, str(tmp_path / "o"), file_format="orc")


def test_literal_records_and_config(spark, tmp_path):
    got = records(spark, [{"town": "Bedok", "flat_age_years": 46}]).first()
    assert got["town"] == "Bedok" and got["flat_age_years"] == 46 and got["flat_type"] is None
    assert len(SCORING) == 7 and len(PROCESSED) == 8 and len(RAW_COLUMNS) == 11
    put(tmp_path / "c.json", json.dumps({"data_towns": ["Bedok"]}))
    assert load_config(spark, str(tmp_path / "c.json")) == {"data_towns": ["Bedok"]}
    pytest.importorskip("yaml")
    put(tmp_path / "c.yaml", "data_storey_range:\n  - '1-15'\n  - '16-30'\n")
    assert load_config(spark, str(tmp_path / "c.yaml")) == {"data_storey_range": ["1-15", "16-30"]}
    assert [len(v) for v in DOMAINS.values()] == [26, 7, 18, 3]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "land")
    old = spark.createDataFrame([("2020-01", "A"), ("2020-02", "gone")], "month string, town string")
    land_snapshot(old, root, "one", "2024-01-01")
    with pytest.raises(PySparkException):
        land_snapshot(old, root, "one", "2024-01-01")
    write_csv(old.where("town = 'A'").select("town", "month"), str(tmp_path / "raw"))
    land_raw_files(spark, str(tmp_path / "raw"), root, "one", "2024-01-08")
    land_snapshot(old.select("month").limit(1), root, "two", "2023-12-01")
    assert latest_snapshots(spark, root) == {"one": "2024-01-08", "two": "2023-12-01"}
    assert sorted(map(str, read_latest(spark, root).select("month", "town").collect())) == [
        "Row(month='2020-01', town='A')", "Row(month='2020-01', town=None)"
    ]


def test_newest_snapshots_are_found_without_listing(spark, tmp_path, monkeypatch):
    """Neither announcing nor reading lists folders, and what they touch grows with the logarithm at most."""
    root, touched = str(tmp_path), []
    monkeypatch.setattr(CommitLog, "numbers", lambda self: pytest.fail("listed"))
    for name in ("has", "read"):
        real = getattr(CommitLog, name)
        monkeypatch.setattr(CommitLog, name, lambda self, *args, real=real: touched.append(args) or real(self, *args))
    most = []
    for i in range(150):
        source, date = f"s{i % 3}", f"2024-{i:04d}" if i != 149 else "2023-0001"
        put(tmp_path / f"source={source}" / f"snapshot_date={date}" / "_SUCCESS", "")
        announce(spark, root, source, date)
        touched.clear()
        assert latest_snapshots(spark, root)[source] == (date if i != 149 else "2024-0146")
        most.append(len(touched))
    assert max(most[96:128]) <= max(most[:32]) + 8
    assert len(list((tmp_path / "landed").glob("[0-9]*.txt"))) == SIGNALS
    (tmp_path / "manifest" / f"state-{64:020d}.json").unlink()  # a writer that ended too early
    assert latest_snapshots(spark, root) == {"s0": "2024-0147", "s1": "2024-0148", "s2": "2024-0146"}
    monkeypatch.undo()
    put(tmp_path / "source=s1" / "snapshot_date=2024-0999" / "_SUCCESS", "")
    put(tmp_path / "source=s1" / "snapshot_date=2024-0999" / "a.csv", "x\n1\n")
    put(tmp_path / "source=new" / "snapshot_date=2020-0001" / "a.csv", "x\n1\n")
    assert announce_missing(spark, root) == 1 and latest_snapshots(spark, root)["s1"] == "2024-0999"


def test_snapshots_announced_at_once_are_all_entered(spark, tmp_path):
    root = str(tmp_path)
    for i in range(8):
        put(tmp_path / f"source=s{i}" / "snapshot_date=2024" / "_SUCCESS", "")
    with ThreadPool(8) as pool:
        pool.map(lambda i: announce(spark, root, f"s{i}", "2024"), range(8), chunksize=1)
    assert latest_snapshots(spark, root) == {f"s{i}": "2024" for i in range(8)}


def test_unfinished_snapshots_do_not_count(spark, tmp_path):
    root = tmp_path / "land"
    land_snapshot(spark.createDataFrame([("2020-01", "A")], "month string, town string"), str(root), "one", "2024-01-01")
    put(root / "source=one" / "snapshot_date=2024-02-01" / "part-0.csv", "month,town\n2020-02,B\n")
    put(root / "source=two" / "snapshot_date=2024-02-01" / "part-0.csv", "month,town\n2020-03,C\n")
    assert latest_snapshots(spark, str(root)) == {"one": "2024-01-01"}
    with pytest.raises(FileNotFoundError):
        announce(spark, str(root), "two", "2024-02-01")
    put(root / "source=two" / "snapshot_date=2024-02-01" / "_SUCCESS", "")
    announce(spark, str(root), "two", "2024-02-01")
    assert latest_snapshots(spark, str(root)) == {"one": "2024-01-01", "two": "2024-02-01"}


def test_metric_log(spark, tmp_path):
    path = str(tmp_path / "log")
    log_metrics(spark, path, "e", "r1", {"rmse": 1.23456}, {"numTrees": 125})
    log_metrics(spark, path, "e", "r2", {"rmse": 2.0})
    got = read_metrics(spark, path).orderBy("run_id").collect()
    assert [(r["run_id"], r["value"], r["params"]) for r in got] == [("r1", 1.235, {"numTrees": "125"}), ("r2", 2.0, {})]


def test_scratch_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert not configured or scratch_root(spark).startswith(configured)


def test_raw_schema_is_text_only():
    assert {f.dataType.simpleString() for f in RAW} == {"string"}


@pytest.mark.parametrize("renaming", [False, True])
def test_a_commit_number_is_taken_once(spark, tmp_path, renaming):
    log = CommitLog(spark, str(tmp_path / "log"))
    if renaming:
        log._local = None  # as on a distributed file system
    assert log.latest() is None
    assert log.commit(1, {"who": "a", "text": "é"}) and not log.commit(1, {"who": "b"})
    assert log.latest() == (1, {"who": "a", "text": "é"})
    assert log.commit(2, {"who": "c"}) and log.numbers() == [1, 2]
    assert not [f for f in (tmp_path / "log").iterdir() if "_aside" in f.name]


def test_hot_keys_on_both_sides_of_an_aligned_join(spark):
    rng = range(400)
    left = spark.createDataFrame([(1 if i % 3 == 0 else i, i) for i in rng] + [(None, -1)], "k int, a int")
    right = spark.createDataFrame([(1 if i % 4 == 0 else 2 * i, i) for i in rng] + [(None, -2)], "k int, b int")
    got = sorted(align_full([left, right]).collect(), key=str)
    want = sorted(left.join(right, "k", "full").select("k", "a", "b").collect(), key=str)
    assert got == want


def test_rows_with_very_many_copies_unfold(spark):
    many = spark.range(700).selectExpr("'x' AS k")
    got = align_full([many, many]).groupBy("k").count().collect()
    assert [tuple(r) for r in got] == [("x", 490_000)]


def test_scratch_can_be_dropped(spark):
    from hammerprice.session import drop_scratch, materialize

    kept = materialize(spark.range(3), "dropped")
    assert kept.count() == 3
    other = scratch_root(spark)
    drop_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FileNotFound|FILE_NOT_EXIST"):
        spark.read.parquet(f"{other}/none").count()


def test_records_with_surplus_fields_are_written_by_all_tasks(spark, small, tmp_path):
    from hammerprice.queries import QUERIES

    supplier = spark.read.parquet(f"{small}/supplier.parquet")
    supplier.repartition(4, "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    root = Path(scratch_root(spark).removeprefix("file://"))
    before = set(root.glob("csv-surplus-*"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task for each file
    try:
        found = QUERIES["csv_surplus_fields"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    (folder,) = set(root.glob("csv-surplus-*")) - before
    files = [f.read_text().splitlines() for f in folder.glob("part-*")]
    assert len(files) > 1 and all(lines[0] == "s_suppkey,s_name" for lines in files)
    assert sum(map(len, files)) - len(files) == supplier.count() == len(found)
