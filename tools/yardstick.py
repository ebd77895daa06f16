"""Time the SQL of the headline queries in DuckDB, over saved tables as in the benchmark.

    python tools/yardstick.py [--sf DIR] [--threads N]
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from postlake.registry.base import CTES, NEEDS, PARTS, with_expressions  # noqa: E402
from tools.check import connect  # noqa: E402

SAVED = ("post_src", "tok", "tag", "post", "post_tag", "plain", "dict_lines", "stats")


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.1")
    parser.add_argument("--threads", type=int, default=8)
    options = parser.parse_args()
    db = connect(options.sf)
    db.execute(f"SET threads = {options.threads}")
    setup = {}
    for name in SAVED:
        start = time.perf_counter()
        db.execute(f"CREATE TABLE {name} AS {with_expressions(CTES[name], NEEDS[name], frozenset(SAVED))}")
        setup[name] = round(time.perf_counter() - start, 3)
    seconds = {}
    for name in HEADLINE:
        sql, uses = PARTS[name]
        # A query that is a saved table builds that table anew, from the tables below it.
        built = {"tag_stats": {"stats"}, "tag_stats_from_posts": {"stats"}, "assign_tag_ids": {"tag", "tok"},
                 "build_post_tag": {"post_tag", "tok"}}.get(name, set())
        saved = frozenset(set(SAVED) - built - {"tok"})
        text = with_expressions(sql, uses, saved)
        best = None
        for _ in range(2):
            start = time.perf_counter()
            db.execute(f"CREATE OR REPLACE TEMP TABLE result AS {text}")
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
    print(json.dumps({"setup": setup, "queries": seconds, "value": round(sum(seconds.values()), 3)}))


if __name__ == "__main__":
    main()
