"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orevein.plans import registry  # noqa: E402
from orevein.session import local_session  # noqa: E402

HEADLINES = (
    "fim_itemsets", "fim_rules", "fim_projected_db", "text_extract_pages", "text_vocabulary", "text_weights_all",
    "clu_lloyd_sse", "clu_lloyd_i2", "clu_lloyd_e1", "clu_best_trial", "clu_quality_global",
    "dt_best_split", "dt_model", "dt_predict", "forest_vote", "eval_confusion",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # Starts the workers and compiles the first plans, so that the first query does not pay for them.
    registry.QUERIES["fim_baskets"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        # All rows and columns are computed; nothing is kept.
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
