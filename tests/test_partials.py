from __future__ import annotations

import os
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.operators.partials import PartialTable, completed_by, segments_after
from lakekit.sources.files import stage_csv
from lakekit.streaming.chains import OrderLoad

SCHEMA = T.StructType(
    [
        T.StructField("g", T.StringType()),
        T.StructField("h", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("amount", T.DecimalType(38, 2)),
        T.StructField("first", T.DateType()),
    ]
)
MERGES = {"n": F.sum, "amount": F.sum, "first": F.min}


def data_bytes(folder) -> int:
    return sum(
        os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    )


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_segments_hold_every_batch_once(fan):
    stored = set()
    for batch in range(300):
        stored |= {(0, batch)} | {(level, batch) for level in completed_by(batch, fan)}
        segments = segments_after(batch, fan)
        covered = [b for level, last in segments for b in range(last - fan**level + 1, last + 1)]
        assert covered == list(range(batch + 1))
        assert set(segments) <= stored
        assert all(sum(level == at for level, _ in segments) < fan for at in range(9))


def batch_of(spark, seed):
    rng = random.Random(seed)
    made = [
        (rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.randrange(9), Decimal(rng.randrange(10**6)) / 100, None)
        for _ in range(20)
    ]
    one_per_group = {(r[0], r[1]): r for r in made}
    return spark.createDataFrame(list(one_per_group.values()), SCHEMA)


def test_table_after_every_batch(spark, tmp_path):
    table = PartialTable(str(tmp_path), SCHEMA, ["g", "h"], MERGES, fan=2)
    assert table.last_batch(spark) == -1 and table.read(spark).count() == 0
    numbers = [0, 1, 2, 3, 5, 6, 7]  # batch 4 brought nothing and was not run
    batches = {i: batch_of(spark, i) for i in numbers}

    def merged(until):
        every = spark.createDataFrame([], SCHEMA)
        for i in numbers:
            every = every.unionByName(batches[i]) if i <= until else every
        return rows(every.groupBy("g", "h").agg(F.sum("n"), F.sum("amount").cast("decimal(38,2)"), F.min("first")))

    for i in numbers:
        table.add(batches[i], i)
        assert rows(table.read(spark)) == merged(i)
    table.add(batches[7], 7)  # again, after a failure
    assert table.last_batch(spark) == 7
    for i in numbers:
        assert rows(table.read(spark, after=i)) == merged(i)


def test_an_unfinished_batch_does_not_count(spark, tmp_path):
    table = PartialTable(str(tmp_path), SCHEMA, ["g", "h"], MERGES, fan=4)
    table.add(batch_of(spark, 1), 0)
    before = rows(table.read(spark))
    batch_of(spark, 2).write.parquet(table._segment(0, 1))  # stored, but the batch broke off
    assert rows(table.read(spark)) == before


def test_written_bytes_follow_the_batch(spark, tmp_path):
    """A large table and then small batches: what they write doesn't grow with the table."""
    table = PartialTable(str(tmp_path), SCHEMA, ["g", "h"], MERGES, fan=4)
    large = spark.range(50_000).selectExpr(
        "string(id) AS g", "int(id % 7) AS h", "1L AS n", "CAST(id AS decimal(38,2)) AS amount", "date'2024-01-01' AS first"
    )
    table.add(large, 0)
    whole = data_bytes(tmp_path)
    assert whole > 200_000
    for i in range(1, 3):
        table.add(large.limit(5), i)
    assert data_bytes(tmp_path) - whole < 20_000
    assert table.read(spark).agg(F.sum("n")).first()[0] == 50_010


HEADER = "VBELN,ERDAT,AUART,KUNNR,VKORG,VTWEG,SPART,NETWR,WAERK\n"


def test_sales_of_a_load_write_their_own_groups_only(spark, tmp_path):
    load = OrderLoad(str(tmp_path / "landing"), str(tmp_path / "work"), fan=3)
    sizes, seen = [], 0
    for i in range(5):
        days = 300 if i == 0 else 1
        lines = [
            f"{i}{n:05d},{2000 + n % 25}{1 + n % 12:02d}15,ZOR,7,{1000 + n},10,00,{n + 0.5},COP\n" for n in range(days * 10)
        ]
        folder = tmp_path / "landing" / f"b{i}"
        folder.mkdir(parents=True)
        (folder / "orders.csv").write_text(HEADER + "".join(lines))
        load.run(spark)
        now = data_bytes(tmp_path / "work" / "gold_sales")
        sizes.append(now - seen)
        seen = now
    assert max(sizes[1], sizes[3], sizes[4]) < sizes[0] / 3
    assert sizes[2] < sizes[0] * 1.5  # the fold of the first three
    assert load.current_sales(spark).agg(F.sum("num_orders")).first()[0] == 3040
    assert load.current_sales(spark, after=0).agg(F.sum("num_orders")).first()[0] == 3000


def test_landing_again_adds_nothing(spark, tmp_path):
    load = OrderLoad(str(tmp_path / "landing"), str(tmp_path / "work"), fan=2)
    orders = spark.createDataFrame(
        [(f"{i}", "20240105", "ZOR", "7", "1000", "10", "00", 10.25, "COP") for i in range(20)], HEADER.strip().split(",")
    )
    for name in ("b1", "b2", "b3"):
        stage_csv(orders, f"{load.landing}/{name}")
        load.run(spark)
    assert rows(load.current_sales(spark)) == [(2024, 1, "1000", "COP", 20, 205.0, 10.25)]
