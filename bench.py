"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query runs to its last row
into a sink that keeps nothing. One untimed query warms the JVM up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from boxlake.queries import QUERIES  # noqa: E402
from boxlake.session import create_session  # noqa: E402

HEADLINE = (
    "parse_labels", "train_ready", "build_bboxes", "box_features", "pad_targets", "make_batches", "dataset_stats",
    "match_anchors", "best_gt", "anchor_coverage", "decode_boxes", "score_filter", "nms", "predict",
    "focal_loss", "hard_negatives", "image_loss", "explode_detections", "hourly_predictions", "upload_filter",
    "early_stop", "plateau_lr", "letterbox_resize", "run_scoring",
)


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = create_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    drain(QUERIES["num_boxes"](spark, sf_dir))
    seconds = {}
    for name in names:
        start = time.perf_counter()
        drain(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
