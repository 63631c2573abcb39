"""Build a made-up corpus of a chosen size, clean it, store it and time the standing questions.

    python benchmarks/full_corpus.py --folder /some/empty/folder --scale 1872 [--hot]

Scale 1872 gives the 9.36 million patents of the published full-corpus run. With ``--hot`` one
organisation and one inventor hold about a third of all rows each.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from grantlens.functions.draws import uniform  # noqa: E402
from grantlens.plans import analysis, summaries  # noqa: E402
from grantlens.plans.refresh import build_warehouse  # noqa: E402
from grantlens.session import build_session  # noqa: E402
from grantlens.sources import synthetic, warehouse  # noqa: E402


def raw_tables(spark, scale: float, hot: bool) -> dict:
    keys = synthetic.numbered(spark, scale)
    # Sizes of the published corpus in proportion to its patents.
    patents = int(synthetic.BASE_PATENTS * scale)
    inventors, companies = max(1, int(patents * 0.455)), max(1, int(patents * 0.061))
    places = 20_000
    raw = {
        "patents": synthetic.patent_rows(keys, date(1976, 1, 1), date(2025, 9, 30)),
        "inventors": synthetic.inventor_rows(keys, inventors, places),
        "assignees": synthetic.assignee_rows(keys, companies),
        "locations": synthetic.location_rows(spark.range(places).toDF("key")),
        "cpc": synthetic.class_rows(keys),
    }
    if hot:
        drawn = uniform(F.col("patent_id"), "hot") < 0.33
        first = F.col("inventor_sequence") == 1
        raw["inventors"] = raw["inventors"].withColumn(
            "inventor_id", F.when(drawn & first, "inv-0").otherwise(F.col("inventor_id"))
        )
        raw["assignees"] = raw["assignees"].withColumn(
            "assignee_id", F.when(drawn, "org-0").otherwise(F.col("assignee_id"))
        )
    return raw


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--folder", required=True)
    parser.add_argument("--scale", type=float, default=200.0)
    parser.add_argument("--hot", action="store_true")
    parser.add_argument("--skip-summaries", action="store_true")
    parser.add_argument("--cpus", default="8")
    args = parser.parse_args()
    spark = build_session(
        "full-corpus",
        f"local[{args.cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "20g",
            "spark.sql.shuffle.partitions": "64",
            "spark.local.dir": f"{args.folder}/scratch",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    report: dict = {"scale": args.scale, "hot": args.hot}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        report[name] = round(time.perf_counter() - start, 2)
        print(name, report[name], file=sys.stderr, flush=True)
        return result

    def write_raw():
        for name, df in raw_tables(spark, args.scale, args.hot).items():
            df.write.mode("overwrite").parquet(f"{args.folder}/raw/{name}")

    timed("write_raw", write_raw)
    stored_raw = {
        n: spark.read.parquet(f"{args.folder}/raw/{n}")
        for n in ("patents", "inventors", "assignees", "locations", "cpc")
    }
    report["rows"] = timed(
        "clean_and_store", lambda: build_warehouse(stored_raw, f"{args.folder}/star")
    )
    star = warehouse.read_star(spark, f"{args.folder}/star")
    for name, question in analysis.QUESTIONS.items():
        timed(name, lambda: question(star).write.format("noop").mode("overwrite").save())
    if not args.skip_summaries:
        report["summary_rows"] = timed(
            "summaries", lambda: summaries.write_summaries(star, f"{args.folder}/summaries")
        )
    report["questions_total"] = round(sum(report[n] for n in analysis.QUESTIONS), 2)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
