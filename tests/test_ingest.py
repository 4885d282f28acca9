from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakekit.operators.joins import estimated_bytes
from lakekit.schemas import ERP_SCHEMAS
from lakekit.sources import files
from lakekit.streaming.chains import OrderLoad
from lakekit.streaming.ingest import (
    RESCUED,
    incremental_files,
    read_batches,
    rescue_monitor,
    rescue_unknown,
    write_batch,
)

VBAK = ERP_SCHEMAS["VBAK"]
HEADER = "VBELN,ERDAT,KUNNR,VKORG,VTWEG,SPART,NETWR,WAERK,AUART\n"
DRIFTED = (
    "VBELN,ERDAT,AUART,KUNNR,NETWR,WAERK,ZZREGION_NUEVA\n"
    "0000000999,20240101,TA,1000,9999.00,COP,ANTIOQUIA\n"
    "0000000998,20240102,TA,2000,8888.00,COP,CUNDINAMARCA\n"
)


def order(number, org="1000", amount="500.5", day="20240101"):
    return f"{number:010d},{day},0000000007,{org},10,01,{amount},COP,ZOR\n"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def ingest(spark, tmp_path, pattern="*.csv"):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "bronze")
    incremental_files(spark, landing, VBAK, str(tmp_path / "checkpoint"), target, pattern)
    return read_batches(spark, target, VBAK)


def test_padded_keys_survive(spark, tmp_path):
    put(tmp_path, "o.csv", HEADER + order(7))
    row = files.read_csv(spark, str(tmp_path / "o.csv"), VBAK).first()
    assert (row.VBELN, row.SPART, row.NETWR) == ("0000000007", "01", 500.5)


def test_each_file_is_taken_once(spark, tmp_path):
    put(tmp_path / "landing" / "batch_01", "vbak_01.csv", HEADER + "".join(order(i) for i in range(100)))
    assert ingest(spark, tmp_path).count() == 100
    assert ingest(spark, tmp_path).count() == 100
    put(tmp_path / "landing" / "batch_02", "vbak_02.csv", HEADER + "".join(order(i) for i in range(100, 150)))
    assert ingest(spark, tmp_path).count() == 150


def test_other_names_are_skipped(spark, tmp_path):
    put(tmp_path / "landing", "vbak_01.csv", HEADER + order(1))
    put(tmp_path / "landing", "part-0001.csv", HEADER + order(2))
    assert ingest(spark, tmp_path, "vbak_*.csv").count() == 1


def test_changed_header_is_rescued(spark, tmp_path):
    put(tmp_path / "landing" / "usual", "a.csv", HEADER + order(1))
    put(tmp_path / "landing" / "drift", "b.csv", DRIFTED)
    taken = {r.VBELN: r for r in ingest(spark, tmp_path).collect()}
    assert taken["0000000001"][RESCUED] is None
    assert taken["0000000999"][RESCUED] == '{"ZZREGION_NUEVA":"ANTIOQUIA"}'
    assert (taken["0000000999"].KUNNR, taken["0000000999"].NETWR) == ("1000", 9999.0)
    assert taken["0000000999"].VKORG is None
    assert taken["0000000998"]._source_file_name == "b.csv"


def test_values_that_do_not_fit_are_rescued(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER + order(1, amount="bad") + order(2))
    df = rescue_unknown(spark, [str(tmp_path / "a.csv")], VBAK)
    found = {r.VBELN: (r.NETWR, r[RESCUED]) for r in df.collect()}
    assert found == {"0000000001": (None, '{"NETWR":"bad"}'), "0000000002": (500.5, None)}
    assert rows(rescue_monitor(df)) == [(2, 1)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    df = spark.range(5)
    for _ in range(2):
        write_batch(df, str(tmp_path / "t"), 3)
    assert read_batches(spark, str(tmp_path / "t")).count() == 5


def test_chain_counts_an_order_once(spark, tmp_path):
    load = OrderLoad(str(tmp_path / "landing"), str(tmp_path / "work"))
    put(tmp_path / "landing" / "b1", "a.csv", HEADER + order(1, amount="100.0") + order(2, amount="50.0"))
    load.run(spark)
    put(tmp_path / "landing" / "b2", "b.csv", HEADER + order(2, amount="50.0") + order(3, amount="30.0"))
    load.run(spark)
    load.run(spark)
    sales = load.current_sales(spark).first()
    assert (sales.num_orders, sales.total_revenue, sales.avg_order_value) == (3, 180.0, 60.0)
    silver = read_batches(spark, load.silver)
    assert silver.count() == 3
    assert silver.first().ERDAT.isoformat() == "2024-01-01"


def test_a_missing_table_is_known_to_be_empty(spark, tmp_path):
    schema = spark.range(0).schema
    assert estimated_bytes(read_batches(spark, str(tmp_path / "none"), schema).where("_batch < 1").select("id")) < 100


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    """What a restart after a failure does: the same micro-batch a second time."""
    load = OrderLoad(str(tmp_path / "landing"), str(tmp_path / "work"))
    put(tmp_path / "landing" / "b1", "a.csv", HEADER + order(1) + order(2))
    load.run(spark)
    before = rows(load.current_sales(spark)), read_batches(spark, load.silver).count()
    load._batch(rescue_unknown(spark, [str(tmp_path / "landing" / "b1" / "a.csv")], VBAK), 0)
    assert (rows(load.current_sales(spark)), read_batches(spark, load.silver).count()) == before


def test_landing_the_newest(spark, tmp_path):
    df = spark.createDataFrame([(f"{i:010d}", i) for i in range(30)], "VBELN string, n int")
    landed = files.land_batch(df, str(tmp_path / "landing"), "b7", 5, newest_by="VBELN")
    assert landed.endswith("batch_b7")
    assert sorted(int(r.n) for r in spark.read.option("header", True).csv(landed).collect()) == [25, 26, 27, 28, 29]
    drawn = files.land_batch(df, str(tmp_path / "landing"), "b8", 5, seed=1)
    assert spark.read.option("header", True).csv(drawn).count() == 5


def test_strict_append_names_the_drift(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    df.write.parquet(path)
    files.append_strict(spark, df.select("v", "k"), path)
    assert spark.read.parquet(path).count() == 2
    try:
        files.append_strict(spark, df.withColumn("KOSTL", F.lit("x")), path)
    except files.SchemaDrift as drift:
        assert "KOSTL" in str(drift)
    else:
        raise AssertionError("drift was accepted")


def test_evolved_rows_have_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    files.append_evolving(spark.createDataFrame([(1,)], "k int"), path)
    files.append_evolving(spark.createDataFrame([(2, "CC001")], "k int, KOSTL string"), path)
    assert rows(files.read_evolved(spark, path)) == [(1, None), (2, "CC001")]
    stacked = files.union_evolved(spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2, "x")], "k int, z string"))
    assert rows(stacked) == [(1, None), (2, "x")]


def test_create_if_missing_leaves_the_first(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.create_if_missing(spark, path, lambda: spark.range(3)) == "created"
    assert files.create_if_missing(spark, path, lambda: spark.range(9)) == "existing"
    assert spark.read.parquet(path).count() == 3


def test_missing_source_is_a_row(spark, tmp_path):
    report = files.source_inventory(
        spark, {"a": lambda: spark.range(3).toDF("id"), "b": lambda: spark.read.parquet(str(tmp_path / "none"))}
    )
    assert rows(report) == [("a", 3, 1, "ok"), ("b", None, None, "missing")]


def test_layers():
    names = ["bkpf_bronze", "vbak_silver", "gold_sales_kpis", "kna1_gold", "budget"]
    assert [files.layer_of(n) for n in names] == ["BRONZE", "SILVER", "GOLD", "GOLD", "OTHER"]


def test_comments_travel_with_the_files(spark, tmp_path):
    path = files.write_documented(spark.range(1), str(tmp_path / "t"), {"id": "a key"})
    assert files.column_comments(spark.read.parquet(path)) == {"id": "a key"}


def test_binary_content_on_request(spark, tmp_path):
    put(tmp_path / "in", "x.bin", "abc")
    assert "content" not in files.binary_files(spark, str(tmp_path / "in")).columns
    assert bytes(files.binary_files(spark, str(tmp_path / "in"), content=True).first().content) == b"abc"


def test_catalog_table_with_comments(spark, tmp_path):
    files.create_documented_table(
        spark.range(3), "documented_orders", str(tmp_path / "t"), "Orders", {"id": "a key"}, {"layer": "gold", "team": "o'x"}
    )
    try:
        assert spark.table("documented_orders").count() == 3
        assert {c.name: c.description for c in spark.catalog.listColumns("documented_orders")} == {"id": "a key"}
        described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED documented_orders").collect()}
        assert described["Comment"] == "Orders"
        assert "layer=gold" in described["Table Properties"] and "team=o'x" in described["Table Properties"]
        assert "documented_orders" in files.catalog_tables(spark)
    finally:
        spark.sql("DROP TABLE documented_orders")


def test_empty_tables_are_counted(spark):
    report = files.source_inventory(spark, {"none": lambda: spark.range(0).toDF("id")})
    assert rows(report) == [("none", 0, 1, "ok")]
    layers = files.layer_inventory(spark, {"a_bronze": spark.range(0).toDF("id"), "b_bronze": spark.range(2).toDF("id")})
    assert rows(layers.where("table_name = 'ALL' and layer <> 'ALL'")) == [("BRONZE", "ALL", 2, 2)]


def test_ragged_lines_are_rescued_whole(spark, tmp_path):
    long, short = order(1).strip() + ",EXTRA\n", "0000000002,20240101\n"
    put(tmp_path, "a.csv", HEADER + long + short + order(3))
    found = {r.VBELN: r for r in rescue_unknown(spark, [str(tmp_path / "a.csv")], VBAK).collect()}
    assert "EXTRA" in found["0000000001"][RESCUED] and found["0000000001"].NETWR == 500.5
    assert found["0000000002"][RESCUED] is not None and found["0000000002"].AUART is None
    assert found["0000000003"][RESCUED] is None


class _Session:
    """As much of a session as naming a work folder needs."""

    def __init__(self, master, named=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_work_folders_follow_the_session():
    from lakekit.sources.workspace import fresh_dir

    session = _Session("spark://cluster:7077", "s3a://bucket/checkpoints/")
    first, second = fresh_dir(session, "run"), fresh_dir(session, "run")
    assert first.startswith("s3a://bucket/checkpoints/lakekit/run-") and first != second


def test_no_local_folder_on_a_cluster():
    import pytest

    from lakekit.sources.workspace import fresh_dir

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        fresh_dir(_Session("spark://cluster:7077"), "run")


def test_a_broken_table_is_not_an_empty_one(spark, tmp_path):
    schema = spark.range(1).schema
    assert read_batches(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "odd" / "_batch=1").mkdir(parents=True)
    pq.write_table(pa.table({"id": [1], "ID": [2]}), tmp_path / "odd" / "_batch=1" / "part.parquet")
    with pytest.raises(AnalysisException):
        read_batches(spark, str(tmp_path / "odd"), schema)
    with pytest.raises(AnalysisException):
        files.table_exists(spark, str(tmp_path / "odd"))
