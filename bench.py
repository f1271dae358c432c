"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores.
Further names on the command line replace the headline queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tenantry.plans import queries as registered
from tenantry.session import local_session

HEADLINE = (
    "extract_direct extract_one_hop extract_chain extract_bridge extract_manifest missing_references "
    "khop_nodes khop_edges path_enumeration graph_schema topological_levels simple_cycles foreign_key_inference "
    "footprint tenant_score tenant_rank pilot_pick "
    "anon_hash anon_names anon_contact anon_birth_date anon_table anon_tokenize consistency_map leak_scan pii_content_scan pii_redact "
    "null_profile referential_integrity business_rules cross_table duplicate_keys minimum_children findings_by_rule validation_outcome "
    "store_presence store_conflicts "
    "insert_append upsert upsert_latest merge_policies edge_upsert rollback versioned_load "
    "checksum_check fan_out_check row_differences run_rollup phase_breakdown top_warnings duration_texts migrate_tenant"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    all_queries = registered.queries()
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start the executors
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.monotonic()
        all_queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.monotonic() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": spark.sparkContext.defaultParallelism,
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
