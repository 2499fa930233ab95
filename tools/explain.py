"""Print the formatted physical plan of registered queries: python tools/explain.py sf_dir name [name ...]"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flatwatch.plans.catalog import QUERIES  # noqa: E402
from flatwatch.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=16)
    for n in names:
        print("=" * 30, n)
        df = QUERIES[n](spark, sf)
        df.explain("formatted")
        if os.environ.get("RUN"):
            df.write.format("noop").mode("overwrite").save()
            print("-- after execution (AQE final plan):")
            df.explain()
