"""Write a multiplied (and optionally skewed) copy of the test tables.

    python tools/make_scaled_copy.py --src /root/testdata/sf0.1 --dst DIR --times 200 [--skew]

``conversations`` is copied ``--times`` times with ``conv_id`` offset by
1,000,000 per copy.  ``--skew`` then adds turns to one conversation until
it holds a third of all rows.  ``documents`` is linked, not copied.  Used
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--src", default="/root/testdata/sf0.1")
    ap.add_argument("--dst", required=True)
    ap.add_argument("--times", type=int, default=200)
    ap.add_argument("--skew", action="store_true")
    a = ap.parse_args()
    from pyspark.sql import functions as F

    from convforge.session import get_spark
    spark = get_spark("local[8]", extra={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    src = spark.read.parquet(f"{a.src}/conversations.parquet")
    copies = spark.range(a.times).withColumnRenamed("id", "k")
    # the copy-number table has `times` rows: a bounded broadcast
    big = (src.join(F.broadcast(copies))
           .select((F.col("conv_id") + F.col("k") * 1_000_000).alias("conv_id"), "turn", "role", "text"))
    if a.skew:
        n = big.count()
        hot = (big.limit(n // 2)
               .select(F.lit(7).cast("bigint").alias("conv_id"),
                       (F.monotonically_increasing_id() + 100).alias("turn"), "role", "text"))
        big = big.unionByName(hot)
    os.makedirs(a.dst, exist_ok=True)
    big.write.mode("overwrite").parquet(f"{a.dst}/conversations.parquet")
    link = f"{a.dst}/documents.parquet"
    if not os.path.exists(link):
        os.symlink(f"{a.src}/documents.parquet", link)
    print(spark.read.parquet(f"{a.dst}/conversations.parquet").count(), "rows")


if __name__ == "__main__":
    main()
