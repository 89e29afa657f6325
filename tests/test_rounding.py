"""The rounding of the registered queries' columns is that of ``round``, ties and large numbers included."""

import math
import random
import re

from pyspark.sql import functions as F

from panelcast.plans import catalog
from panelcast.plans.columns import spark_select


def test_rounded_columns_equal_round(spark):
    dice = random.Random(5)
    values = [0.0, -0.0, -1e-9, 0.1234565, 1.0000005, 2.5e-7, 0.5, 1.005, 2.675, -2.675, 1e10 + 0.3, 123456789012.345678, 1e300, float("inf"), float("nan"), None]
    values += [dice.uniform(-1, 1) * 10 ** dice.randint(-9, 13) for _ in range(3000)]
    values += [dice.randint(-(10**9), 10**9) / 2e6 for _ in range(1000)] + [math.nextafter(n + 0.0000005, n) for n in range(500)]
    rows = spark.createDataFrame([(i, v, v, v) for i, v in enumerate(values)], "id long, d double, e double, r double").coalesce(1)
    found = spark_select(rows, "id:i d:d e:e r:r").collect()
    expected = rows.select("id", *[F.round(c, n).alias(c) for c, n in (("d", 6), ("e", 2), ("r", 9))]).collect()
    for one, two in zip(found, expected, strict=True):
        for c in ("d", "e", "r"):
            same = one[c] == two[c] or one[c] is two[c] or (math.isnan(one[c]) and math.isnan(two[c]))
            assert same and (one[c] != 0 or math.copysign(1, one[c]) == 1)


def test_wide_rows_are_put_out_by_methods_that_are_compiled(spark, data):
    """The JVM interprets methods of more than 8,000 bytes: the fused code of the widest query stays below."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = catalog.queries()["direct_h1"](spark, data)._jdf.queryExecution()
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", execution.explainString(mode))]
        assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
