"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: directory of the tables (default /root/testdata/sf0.1); BENCH_CPUS: local threads (default 8). Each query is
written to the noop sink, so that every row and column is made, and nothing is kept from run to run; the best of two runs
counts, as a cluster's JVMs are warm.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

os.environ.setdefault("PYSPARK_PYTHON", "python3")

from leafwork.plans import catalog  # noqa: E402
from leafwork.session import forget, session  # noqa: E402

try:
    from leafwork.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("leafwork.llm", "leafwork.llm.queries"):
        raise
    corpus = None

HEADLINE = (
    "section_paths", "section_tree", "reference_index", "acronym_definitions", "footnote_resolution", "table_continuations", "neighbour_context", "character_budget",
    "page_features", "indent_parents", "fuzzy_presence", "best_matches", "token_jaccard", "ngram_sets", "text_operators", "corpus_profile", "round_robin", "knn_cosine",
    "p1_pieces", "p2_found", "p2_paragraphs", "p3_found", "p4_found", "p5_found", "p6_found", "p6_clean", "p7_found", "p8_ids", "p9_containers", "p10_found", "p10_redacted",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries() | (corpus.queries() if corpus else {})
    seconds = {}
    for name in HEADLINE:
        if name not in queries:
            continue
        runs = []
        for _ in range(2):
            began = time.perf_counter()
            queries[name](spark, root).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
            spark.catalog.clearCache()
            forget()
        seconds[name] = round(min(runs), 3)
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(root).name}))
    spark.stop()


if __name__ == "__main__":
    main()
