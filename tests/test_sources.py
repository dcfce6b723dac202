import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F

from skygalley import session
from skygalley.sources import lineage, readers, sinks
from skygalley.sources.schemas import RAW_DATASETS


def test_raw_csv_by_header(spark, tmp_path):
    """Files may order columns differently; personal data never comes through."""
    spec = RAW_DATASETS["sales"]
    headers = [h for h, _, _ in spec.columns]
    values = ["SESSION1", "7", "XY1", "A", "B", "2025-11-01T10:00:00", "T1", "Sale", "", "P1", "USD", "2.50", "1", "2.50", ""]
    one = dict(zip(headers, values)) | {"Staff ID": "9", "Staff Name": "N"}
    for i, order in enumerate((list(one), list(reversed(one)))):
        text = ",".join(order) + "\n" + ",".join(one[h] for h in order) + "\n"
        (tmp_path / f"sales_{i}.csv").write_text(text)
    df = readers.read_raw(spark, str(tmp_path), "sales")
    assert df.columns == spec.names and "Staff ID" not in df.columns
    first, second = df.collect()
    assert first == second
    assert (first.session_no, first.flight_no) == ("SESSION1", "XY1")
    # another layout: the personal columns stand elsewhere or are not there at all
    other = {h: one[h] for h in [*headers[3:], *headers[:3]]}
    (tmp_path / "sales_9.csv").write_text(",".join(other) + "\n" + ",".join(other.values()) + "\n")
    rows = readers.read_raw(spark, str(tmp_path), "sales").collect()
    assert len(rows) == 3 and len(set(rows)) == 1
    assert not {"9", "N"} & {str(v) for v in rows[0]}


def test_headers_come_from_a_job_over_the_files(spark, tmp_path):
    """One task a file, also for files with blanks and signs in their names, packed files and large ones."""
    for i in range(40):
        order = "a,b" if i % 3 else "b,a"
        (tmp_path / f"raw {i}%20+é.csv").write_text(f"{order}\n" + "1,2\n" * (200_000 if i == 7 else 3))
    (tmp_path / "raw empty.csv").write_text("")
    (tmp_path / "raw blank.csv").write_text("\n1,2\n")
    with gzip.open(tmp_path / "raw packed.csv.gz", "wt") as packed:
        packed.write("a,b\r\n1,2\r\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = readers._files_by_header(spark, f"{tmp_path}/raw*")
    assert {h: len(f) for h, f in found.items()} == {"a,b": 27, "b,a": 14}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    total = sum(spark.read.csv(files, header=True).count() for files in found.values())
    assert total == 39 * 3 + 200_000 + 1
    assert readers._files_by_header(spark, f"{tmp_path}/none*") == {}


def test_missing_header_is_an_error(spark, tmp_path):
    (tmp_path / "pax1.csv").write_text("Flight Number;Class\nXY1;Economy\n")
    with pytest.raises(ValueError, match="missing columns"):
        readers.read_raw(spark, str(tmp_path), "pax")


def test_mart_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "mart")
    spark.sql("select date'2025-12-01' as date, 1 as x").write.parquet(path)
    df = readers.read_mart_since(spark, path, "2025-11-01")
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2025-11-01)]" in (
        df._jdf.queryExecution().toString()
    )
    assert df.count() == 1


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    assert sorted(map(tuple, sinks.upsert(old, new, ["k"]).collect())) == [(1, "old"), (2, "new"), (3, "new")]
    assert sorted(map(tuple, sinks.insert_missing(old, new, ["k"]).collect())) == [
        (1, "old"),
        (2, "old"),
        (3, "new"),
    ]


def test_lineage(spark, tmp_path):
    def node(name, kind, parents):
        return {
            "resource_type": kind,
            "unique_id": f"model.{name}",
            "name": name,
            "schema": "mart",
            "original_file_path": f"models/marts/{name}.sql",
            "path": f"marts/{name}.sql",
            "description": "",
            "tags": ["daily"],
            "config": {"materialized": "table"},
            "depends_on": {"nodes": parents},
        }

    manifest = {
        "nodes": {
            "model.a": node("a", "model", []),
            "model.b": node("b", "model", ["model.a", "seed.c"]),
            "test.t": node("t", "test", ["model.b"]),
        }
    }
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps(manifest, indent=1))
    nodes = lineage.read_manifest(spark, str(path))
    got = {r.name: r for r in lineage.models(nodes).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].layer == "marts" and got["a"].tags == ["daily"]
    edges = sorted((r.from_node, r.to_node) for r in lineage.dependencies(nodes).collect())
    assert edges == [("model.a", "model.b"), ("seed.c", "model.b")]


def test_tables_go_where_the_cluster_says(spark):
    """``spark.checkpoint.dir`` wins; a folder of our own only where nothing names one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = session.shared_folder(spark)
    assert not named or folder == named
    assert spark.sparkContext.getCheckpointDir()
    one, two = session.new_table_root(spark), session.new_table_root(spark)
    assert one != two and one.startswith(folder.rstrip("/"))


def test_merge_replaces_touched_months_only(spark, tmp_path):
    import glob
    import os

    kinds = "k int, v string, day date"
    day = [datetime.date(2025, 11, 3), datetime.date(2025, 12, 5), datetime.date(2026, 1, 7)]
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(i, "old", day[i % 3]) for i in range(30)] + [(99, "old", None)], kinds)
    sinks.overwrite_by_month(old, path, "day")

    def files(month):
        return sorted(os.path.basename(f) for f in glob.glob(f"{path}/month_key={month}/*.parquet"))

    before = {m: files(m) for m in ("202511", "202512", "202601")}
    new = spark.createDataFrame([(1, "new", day[1]), (100, "new", day[1]), (99, "new", None)], kinds)
    got = {r.k: r.v for r in sinks.merge_by_month(spark, path, new, ["k"], "day").collect()}
    assert got == {**{i: "old" for i in range(30)}, 1: "new", 99: "new", 100: "new"}
    assert files("202511") == before["202511"] and files("202601") == before["202601"]
    assert files("202512") != before["202512"]
    again = spark.createDataFrame([(1, "third", day[1]), (200, "third", day[0])], kinds)
    got = {r.k: r.v for r in sinks.merge_by_month(spark, path, again, ["k"], "day", keep="old").collect()}
    assert got[1] == "new" and got[200] == "third" and len(got) == 33
    assert files("202601") == before["202601"]
    same = files("202511")
    assert sinks.merge_by_month(spark, path, again.limit(0), ["k"], "day").count() == 33 and files("202511") == same


def test_rows_without_a_key_do_not_meet(spark):
    from skygalley.operators import joins

    rows = spark.createDataFrame([(None if i % 3 else f"c{i % 5}", i) for i in range(900)], "card string, i int")
    cards = spark.createDataFrame([("c0", 10), ("c1", 11), (None, 12)], "card string, card_key int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = joins.map_key(rows.repartition(4), cards, "card", "card_key", "key")
        assert out.columns == ["card", "i", "key"] and out.count() == 900
        assert {r.key for r in out.where("card is null").select("key").distinct().collect()} == {None}
        assert out.where("key = 10").count() == out.where("card = 'c0'").count() > 0
        parts = [r["n"] for r in out.where("card is null").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(parts) < 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_wastage_is_read_back_from_parquet(spark, tmp_path):
    """``src_parquet`` lands what it reads: no other query writes that dataset."""
    from skygalley.registry import queries
    from skygalley.sources.driver_tables import DriverTables

    orders = [(k, 7, "O", 10.5, "1-URGENT") for k in (1, 2, 2)]
    lines = [(k, 4, n, 3.0, 9.25, 0.1, f, "O") for k in (1, 2, None) for n, f in ((1, "N"), (2, "N"), (3, "R"))]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_returnflag string, l_linestatus string",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    want = DriverTables(spark, str(tmp_path)).fixture("fx_wastage")
    for _ in range(2):
        got = queries()["src_parquet"](spark, str(tmp_path))
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 6


def test_lines_are_joined_once(spark, tmp_path):
    """Three datasets are projections of one landed join; copies and missing keys count as in a join of their own."""
    from skygalley.sources.driver_tables import DriverTables

    folder = str(tmp_path / "in")
    orders = [(k, 7, "O", 10.5, "1-URGENT") for k in (1, 2, 2, 18, None)]
    lines = [(k, p, n, 3.0, 9.25, d, f, "O") for k in (1, 2, 18, 5, None) for p, n, d, f in ((4, 1, 0.0, "N"), (5, 2, 0.1, "R"))]
    lines += lines[:3]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_returnflag string, l_linestatus string",
    ).write.parquet(f"{folder}/lineitem.parquet")
    landed, plain = DriverTables(spark, folder, str(tmp_path / "root")), DriverTables(spark, folder)
    for name in ("fx_sales", "fx_items_load", "fx_wastage"):
        got, want = landed.fixture(name), plain.fixture(name)
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 3
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert not (tmp_path / "root/raw/sales").exists()


def test_stored_months_are_not_shuffled_again(spark, tmp_path):
    from skygalley.config import WarehouseConfig
    from skygalley.plans.warehouse import Warehouse

    hinted = []
    frame = type(spark.range(1))
    hint = frame.hint
    rows = spark.range(40).selectExpr(
        "'F1' AS flight_number", "'2025/11/' || lpad(1 + id % 30, 2, '0') || ' 10:00' AS departure_date", "1 AS order_num",
        "'P' || id AS item_reference", "2 AS total_qty_loaded",
    )
    wh = Warehouse(spark, {"items_load": rows}, WarehouseConfig(), str(tmp_path))
    frame.hint = lambda self, name, *a: hinted.append(name) or hint(self, name, *a)
    try:
        assert wh.ref("stg_items_load").count() == 40
    finally:
        frame.hint = hint
    assert "rebalance" not in hinted


def test_stored_tables_are_compressed_well(spark, tmp_path):
    sinks.overwrite(spark.range(3), str(tmp_path / "t"))
    assert list((tmp_path / "t").glob("*.zstd.parquet"))


def test_tasks_stay_small_as_tables_grow(spark, tmp_path):
    """Spark's 128 MB a scan and as few tasks as cores made whole-row distincts spill; what the user set stays."""
    names = [
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
    ]
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.unset(name)
        (tmp_path / "lineitem.parquet").write_bytes(bytes(50 * session.INPUT_BYTES + 1))
        session.small_tasks(spark, str(tmp_path))
        assert [int(spark.conf.get(n)) for n in names] == [session.SCAN_BYTES, session.SHUFFLE_BYTES, 51]
        for name in names:
            spark.conf.set(name, "77")
        session.small_tasks(spark, str(tmp_path))
        assert [spark.conf.get(n) for n in names] == ["77", "77", "77"]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_partitions_follow_the_larger_folder_of_a_session(spark, tmp_path):
    """The number set for a small folder is no setting of the user: a larger one read later in the session raises it."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(initial, None)
    try:
        spark.conf.unset(initial)
        for name, blocks in (("small", 40), ("large", 90), ("small", 90)):
            (tmp_path / name).mkdir(exist_ok=True)
            (tmp_path / name / "t.parquet").write_bytes(bytes({"small": 40, "large": 90}[name] * session.INPUT_BYTES))
            session.small_tasks(spark, str(tmp_path / name))
            assert int(spark.conf.get(initial)) == blocks
    finally:
        spark.conf.unset(initial) if before is None else spark.conf.set(initial, before)


def test_filtered_dimensions_cut_large_scans(spark, tmp_path):
    """Scans of megabytes are cut by a Bloom filter before a shuffled join with a filtered table; the user's limits stay."""
    names = [f"spark.sql.optimizer.runtime.bloomFilter.{n}" for n in ("applicationSideScanSizeThreshold", "creationSideThreshold")]
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.unset(name)
        session.small_tasks(spark, str(tmp_path))
        found = [spark.conf.get(n).rstrip("b") for n in names]
        assert found == [str(session.FILTERED_BYTES), str(session.FILTER_BYTES)]
        for name in names:
            spark.conf.set(name, "77")
        session.small_tasks(spark, str(tmp_path))
        assert [spark.conf.get(n).rstrip("b") for n in names] == ["77", "77"]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
