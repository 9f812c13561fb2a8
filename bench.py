"""Bench: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS]. Prints one JSON line. Results are forced with the ``noop``
sink (full execution, nothing collected) or a collect for the small tables."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandlab.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "32")),
                          driver_memory=os.environ.get("BENCH_MEM", "16g"))
    from demandlab.plans import registry, registry_learners, registry_models

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def collect(df):
        return df.collect()

    plan = [
        ("aor", registry.QUERIES["aor"], noop),
        ("prices", registry.QUERIES["prices"], noop),
        ("daily_features", registry.QUERIES["daily_features"], noop),
        ("weekly", registry.QUERIES["weekly"], noop),
        ("design_matrix", registry_models.QUERIES["design_matrix"], noop),
        ("regression_panel", registry_models.QUERIES["regression_panel"], noop),
        ("ols", registry_models.QUERIES["ols"], collect),
        ("iv2sls", registry_models.QUERIES["iv2sls"], collect),
        ("dml_plr", registry_models.QUERIES["dml_plr"], collect),
        ("dml_pliv", registry_models.QUERIES["dml_pliv"], collect),
        ("dml_pliv_lasso", registry_learners.QUERIES["dml_pliv_lasso"], collect),
        ("bootstrap", registry_learners.QUERIES["bootstrap"], collect),
        ("elasticity_end_to_end", registry_learners.QUERIES["elasticity_design"], collect),
    ]
    # warm-up (JVM, class loading, parquet footers): not timed
    from demandlab.plans.panel_plan import warehouse
    warehouse(spark, sf_dir).dm_article.count()
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    sf_txt = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_txt)
    except ValueError:
        sf = sf_txt
    times, failed = {}, {}

    def line() -> str:
        out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}
        return json.dumps(out | ({"failed": failed} if failed else {}))

    for name, q, act in plan:
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            act(q(spark, sf_dir))
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - the other queries still count
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
        # what is known so far, should the run be stopped
        print(line(), file=sys.stderr, flush=True)
    print(line())


if __name__ == "__main__":
    main()
