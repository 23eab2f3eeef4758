"""Print the formatted physical plans of the headline batch jobs (mapping M2).

usage: python tools/explain_plans.py [sf_dir] [job ...]
Jobs: index stay portraits segment matrix window running flows
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellscope.operators import persona, portrait, segments, stay  # noqa: E402
from cellscope.operators.index import build_user_index  # noqa: E402
from cellscope.operators.sinks import write_hourly, write_table  # noqa: E402
from cellscope.session import build_session, scratch_path  # noqa: E402
from cellscope.sources import fixtures  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    spark = build_session()
    m = fixtures.m2(spark, sf_dir)
    base = scratch_path(spark, "explain")
    write_table(build_user_index(m.indexed_users), f"{base}/idx")
    idx = spark.read.parquet(f"{base}/idx")
    write_hourly(stay.region_hour_stay(m.signals, m.region_cell, idx), f"{base}/stay")
    write_table(portrait.portrait_bitmaps(m.user_info, idx), f"{base}/port")
    stay_bm = stay.read_stay_table(spark, f"{base}/stay")
    port_bm = spark.read.parquet(f"{base}/port")
    enriched = persona.enrich(m.signals, m.user_info, m.region_cell)
    jobs = {
        "index": lambda: build_user_index(m.indexed_users),
        "stay": lambda: stay.region_hour_stay(m.signals, m.region_cell, idx),
        "portraits": lambda: portrait.portrait_bitmaps(m.user_info, idx),
        "segment": lambda: segments.segment_count(stay_bm, port_bm, "1", "1995010200", 4),
        "matrix": lambda: segments.segment_matrix(
            stay.stay_rows(m.signals, m.region_cell, idx), portrait.portrait_rows(m.user_info, idx)),
        "matrix_and": lambda: segments.segment_matrix_and(stay_bm, port_bm),
        "window": lambda: persona.persona_window(enriched),
        "running": lambda: persona.persona_running(enriched),
        "flows": lambda: persona.region_flow(enriched),
    }
    for name, build in jobs.items():
        if wanted and name not in wanted:
            continue
        print(f"\n===== {name} =====")
        build().explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
