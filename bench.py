"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the cores. Derived tables (flat posts, tags, relation)
are written first and timed as their own entries; each query then runs to a sink that discards its
rows, the better of two runs counting after a warm-up on small data.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from postlake import fixtures as fx
from postlake.registry import QUERIES
from postlake.registry import inputs
from postlake.session import local_session

HEADLINE = (
    "dedup_by_id", "schema_fixed", "flatten_paths", "assign_tag_ids", "build_post_tag", "tag_stats",
    "tag_stats_from_posts", "rank_new_tags", "top20_new_tags", "collect_names", "search_intersect",
    "search_min_score", "build_post_dict", "caption", "media_manifest", "audit_artifacts",
    "load_tag_dictionary", "resolve_tag_alias", "tag_types", "structured_metadata",
    "lookup_batches_for_posts", "assign_tag_ids_words", "distinct_tagset", "id_window_coverage",
)
SMALL = "/root/testdata/sf0.001"


def drain(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def prepare(spark, sf_dir: str) -> dict[str, float]:
    steps = {
        "setup_flat_posts": lambda: fx.flat_posts(spark, sf_dir),
        "setup_post": lambda: fx.posts(spark, sf_dir),
        "setup_tag": lambda: fx.numbered(spark, sf_dir),
        "setup_post_tag": lambda: fx.post_tags(spark, sf_dir),
        "setup_tag_index": lambda: fx.tag_index(spark, sf_dir),
        "setup_tag_stats": lambda: fx.tag_stats(spark, sf_dir),
        "setup_lines": lambda: inputs.line_tree(spark, sf_dir),
        "setup_plain": lambda: inputs.plain_posts(spark, sf_dir),
        "setup_dictionary": lambda: inputs.dictionary_folder(spark, sf_dir),
    }
    return {name: round(timed(step), 3) for name, step in steps.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cores, shared=tempfile.mkdtemp(prefix="bench-"))
    prepare(spark, SMALL)
    for name in HEADLINE:
        drain(QUERIES[name](spark, SMALL))
    setup = prepare(spark, sf_dir)
    seconds = {
        name: round(min(timed(lambda: drain(QUERIES[name](spark, sf_dir))) for _ in range(2)), 3)
        for name in HEADLINE
    }
    print(json.dumps({
        "metric": "sum of headline query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "setup": setup,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
