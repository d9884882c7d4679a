"""Batch job for spark-submit.

    spark-submit --py-files orderlens.zip orderlens/job.py --sources hdfs:///warehouse \
        --output hdfs:///profit --start 2022-06-01 --end 2022-08-31 --shuffle-partitions 40000

``--sources`` holds one Parquet folder per source table; instead, ``--table sessions=raw.sessions`` and so on name all
of them in the catalog, and ``--database`` names a database whose catalog also shows the results. Set ``spark.checkpoint.dir`` to a folder
all executors share. Shuffle partitions are an upper bound (adaptive execution merges small
ones), so size them for the largest input: bytes of order sessions / 200 MB.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from orderlens.params import DEFAULT_END, DEFAULT_ENTITIES, DEFAULT_START, BatchParams
from orderlens.plans.batch import run_batch
from orderlens.session import temporary, tune
from orderlens.sources.schemas import SOURCE_SCHEMAS
from orderlens.sources.tables import read_catalog_sources, read_sources


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--sources", help="folder of the source folders")
    source.add_argument("--table", action="append", default=[], metavar="SOURCE=TABLE", help="a source's name in the catalog")
    parser.add_argument("--database", help="database in which the results are named")
    parser.add_argument("--output", required=True)
    parser.add_argument("--entities", nargs="+", default=list(DEFAULT_ENTITIES))
    parser.add_argument("--start", default=str(DEFAULT_START))
    parser.add_argument("--end", default=str(DEFAULT_END))
    parser.add_argument("--shuffle-partitions", type=int)
    return parser.parse_args(argv)


def main(argv=None) -> None:
    args = arguments(argv)
    spark = tune(SparkSession.builder.appName("orderlens").getOrCreate())
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    params = BatchParams(args.entities, args.start, args.end)
    if args.table:
        sources = read_catalog_sources(spark, dict(text.split("=", 1) for text in args.table), params)
    else:
        sources = read_sources(spark, {name: f"{args.sources}/{name}" for name in SOURCE_SCHEMAS})
    with temporary(spark):
        made = run_batch(sources, params, args.output, database=args.database)
    print("rows after each join:", ", ".join(f"{place} {n}" for place, n in made.join_rows.items()))


if __name__ == "__main__":
    main()
