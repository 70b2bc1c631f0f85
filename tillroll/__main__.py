"""spark-submit entry: segment the customers of a transaction table."""

import argparse
import logging

from tillroll.config import SegmentationConfig
from tillroll.plans.segmentation import run_segmentation
from tillroll.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tillroll", description=__doc__)
    parser.add_argument("source", help="file, folder or glob of transactions")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--archive-dir", default=SegmentationConfig.archive_dir)
    parser.add_argument("--export-dir", default=SegmentationConfig.export_dir)
    parser.add_argument("--id-type", default=SegmentationConfig.id_type, choices=["int", "bigint"])
    parser.add_argument("--no-raw-archive", action="store_true")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")

    spark = build_session()
    try:
        config = SegmentationConfig(
            source=args.source,
            source_format=args.format,
            archive_dir=args.archive_dir,
            export_dir=args.export_dir,
            id_type=args.id_type,
            archive_raw=not args.no_raw_archive,
        )
        run_segmentation(spark, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
