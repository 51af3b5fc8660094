import random

from pyspark.sql import functions as F

from pairworks.functions import pg
from pairworks.operators import windows


def rows(spark):
    """Group 0 holds most rows; sequence numbers have gaps, some leading values are null."""
    rng = random.Random(4)
    seqs = rng.sample(range(5000), 900)
    data = [(0 if i % 3 else i % 7, rng.choice([None, "a", "b", ""]), s, rng.choice([None, s])) for i, s in enumerate(seqs)]
    return spark.createDataFrame(data, "g int, p string, s long, v long")


def same(df, out, want):
    got = df.withColumn("want", want)
    assert got.where(~F.col(out).eqNullSafe(F.col("want"))).count() == 0 and got.count() == 900


def test_row_number_and_rank(spark):
    df = rows(spark)
    for span in (10, 700, 10**6):
        same(windows.row_number(df, ["g"], ["p"], "s", "n", span), "n", F.row_number().over(pg.ordered(["g"], "p", "s")))
    same(windows.row_number(df, ["g"], [], "s", "n", 100), "n", F.row_number().over(pg.ordered(["g"], "s")))
    same(windows.rank(df, ["g"], ["p"], "n"), "n", F.rank().over(pg.ordered(["g"], "p")))


def test_null_keys_dates_and_one_group(spark):
    """Rows without a key are a group; a group of all rows stays spread, whatever leads its order."""
    df = rows(spark).withColumn("g", F.when(F.col("g") > 0, F.col("g"))).withColumn("d", F.date_add(F.lit("2001-01-01").cast("date"), (F.col("s") % 50).cast("int")))
    same(windows.row_number(df, ["g"], ["d"], "s", "n", 50), "n", F.row_number().over(pg.ordered(["g"], "d", "s")))
    same(windows.rank(df, ["g"], ["d"], "n", 50), "n", F.rank().over(pg.ordered(["g"], "d")))
    same(windows.shift(df, ["g"], ["d"], "s", "v", 1, "n", 50), "n", F.lag("v", 1).over(pg.ordered(["g"], "d", "s")))
    price = df.withColumn("g", F.lit(1)).withColumn("price", F.col("s") * 1.5)
    parts = [r["count"] for r in windows.ranged(price, ["g"], ["price", "s"], 50).groupBy("_part").count().collect()]
    assert len(parts) >= 12 and max(parts) <= 150


def test_lag_and_lead(spark):
    df = rows(spark)
    for span in (3, 50, 10**6):
        for n in (1, 2, 5):
            same(windows.shift(df, ["g"], ["p"], "s", "v", n, "n", span), "n", F.lag("v", n).over(pg.ordered(["g"], "p", "s")))
            same(windows.shift(df, ["g"], ["p"], "s", "v", -n, "n", span), "n", F.lead("v", n).over(pg.ordered(["g"], "p", "s")))
