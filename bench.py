"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
Arguments, if any, choose queries by name.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardstar.plans import catalog, standins  # noqa: E402
from wardstar.session import build_session  # noqa: E402

# The stored star, cleaned star and corpus are built by the first three entries.
HEADLINE = [
    "star_load",
    "star_clean",
    "corpus_build",
    "fact_by_year_category",
    "dedup_dimension",
    "repoint_facts",
    "validations",
    "star_denormalise",
    "event_documents",
    "profiles",
    "actor_counts",
    "category_list",
    "normalise_text",
    "extract_records",
    "flatten_records",
    "knn",
    "mmr",
    "keyword_match",
    "fuzzy",
    "hybrid",
    "hybrid_answers",
    "actor_debug",
    "corpus_stats",
]


def build(name: str, spark, folder: str) -> bool:
    made = {"star_load": standins.star, "star_clean": standins.clean_star, "corpus_build": standins.corpus}
    if name in made:
        made[name](spark, folder)
        return True
    return False


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start-up is not part of the first query
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        began = time.perf_counter()
        if not build(name, spark, folder):
            df = catalog.QUERIES[name](spark, folder)
            df.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
