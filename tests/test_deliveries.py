import pytest
from pyspark.sql import functions as F

from wearlens.contract import MACHINE_TYPES
from wearlens.operators import cleaning, deliveries
from wearlens.sources import committed, tables


def listed(df, id_col="unit_id"):
    return sorted(r[id_col] for r in df.collect())


def test_blocks_hold_every_id_once(spark):
    ids = [0, 1, 63, 64, 127, 5_000_000_000, -1, -64, -65, 1, 1, None]
    df = spark.createDataFrame([(i,) for i in ids], "unit_id long")
    blocks = deliveries.id_blocks(df)
    assert listed(deliveries.ids_of(blocks)) == sorted({i for i in ids if i is not None})
    other = spark.createDataFrame([(63,), (2,), (-65,), (None,)], "unit_id long")
    assert listed(deliveries.seen_before(other, blocks)) == [-65, 63]
    assert deliveries.seen_before(other.limit(0), blocks).isEmpty()


def test_an_id_of_an_earlier_delivery_fails_the_gate(spark, tmp_path, monkeypatch):
    rows = cleaning.clean(tables.telemetry(spark, "/root/testdata/sf0.001")).filter(F.col("type").isin(MACHINE_TYPES)).persist()
    table, index = str(tmp_path / "rows"), str(tmp_path / "ids")
    first, second = rows.filter("unit_id % 2 = 0"), rows.filter("unit_id % 2 = 1")
    assert deliveries.accept_delivery(first, table, index, "1")[0]
    n = first.count()

    mixed = second.unionByName(first.limit(3))
    accepted, failures = deliveries.accept_delivery(mixed, table, index, "2")
    assert not accepted and [(r.column, r.check, r.failures) for r in failures.collect()] == [("unit_id", "delivered_before", 3)]
    assert committed.read(spark, table).count() == n and listed(deliveries.ids_of(deliveries.merged(deliveries.known_ids(spark, index)))) == listed(first)

    # killed between the index and the rows: the rerun is not held against itself
    inner = committed.append
    with monkeypatch.context() as m:
        m.setattr(committed, "append", lambda df, path, key: inner(df, path, key) if path == index else (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            deliveries.accept_delivery(second, table, index, "2")
    assert deliveries.accept_delivery(second, table, index, "2")[0] and deliveries.accept_delivery(second, table, index, "2")[0]
    assert committed.read(spark, table).count() == rows.count()

    deliveries.compact(spark, index, "compacted")
    known = deliveries.known_ids(spark, index)
    assert listed(deliveries.ids_of(known)) == listed(rows) and known.count() == known.select("block").distinct().count()
    assert not deliveries.accept_delivery(first.limit(1), table, index, "3")[0]
    assert deliveries.accept_delivery(first, table, index, "1")[0]  # accepted long ago: nothing is written
    assert committed.read(spark, table).count() == rows.count()
