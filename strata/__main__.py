"""spark-submit entry point: python -m strata INPUT_DIR OUTPUT_DIR"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from strata.plans import run, sales


def main() -> None:
    parser = argparse.ArgumentParser(prog="strata", description=__doc__)
    parser.add_argument("input", help="folder or URI that holds the three CSV extracts")
    parser.add_argument("output", help="folder or URI for the layers, the report and the answers")
    parser.add_argument("--multi-line", action="store_true", help="accept quoted line breaks")
    parser.add_argument("--drifting", action="store_true", help="unite files with different headers by name")
    args = parser.parse_args()
    # Master, memory and shuffle settings belong to spark-submit.
    builder = SparkSession.builder.appName("strata").config("spark.sql.session.timeZone", "UTC")
    spark = builder.getOrCreate()
    inputs = {t: f"{args.input.rstrip('/')}/{f}" for t, f in sales.INPUT_FILES.items()}
    result = run(spark, sales.PLAN, inputs, args.output, args.multi_line, args.drifting)
    print(f"report: {result.quality.path}")
    for name in result.analysis:
        print(f"{name}: {args.output.rstrip('/')}/analysis/{name}")
    spark.stop()


if __name__ == "__main__":
    main()
