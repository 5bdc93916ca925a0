import os

from quern.shared import _own_folder, clear, cut, forget, ship


def test_cut_and_clear(spark):
    df = cut(spark.range(5), "five")
    assert df.count() == 5 and df.columns == ["id"]
    assert cut(spark.range(0), "none").count() == 0
    assert os.path.isdir(_own_folder(spark).removeprefix("file:"))
    clear(spark)
    assert not os.path.exists(_own_folder(spark).removeprefix("file:"))


def test_ship_once(spark):
    ship(spark)
    ship(spark)
    assert spark.sparkContext._quern_shipped


def test_forget(spark):
    df, other = cut(spark.range(3), "gone"), cut(spark.range(4), "kept")
    forget(df, spark.range(1))
    assert other.count() == 4 and not os.path.exists(df._quern_path.removeprefix("file:"))
