"""Command line: the N items most similar to one item of a JSON-lines catalog.

    python -m likewise --catalog catalog.jsonl --sku item-7 --num 10 [--master local[*]]

Prints the ids with their weights.  Without ``--master`` the session takes
its master and settings from the Spark configuration (``spark-defaults.conf``
or ``PYSPARK_SUBMIT_ARGS``), as on a cluster.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import (ItemNotFound, cached, flatten_attributes, read_catalog, top_k_similar,
               top_k_weights)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="likewise", description=__doc__.splitlines()[0])
    ap.add_argument("--catalog", required=True, help="JSON-lines file or folder")
    ap.add_argument("--sku", required=True, help="id of the requested item")
    ap.add_argument("--num", type=int, default=10, help="number of similar items")
    ap.add_argument("--master", default=None, help="Spark master when run locally")
    args = ap.parse_args(argv)
    if args.num < 0:
        ap.error("--num must not be negative")

    builder = SparkSession.builder.appName("likewise")
    if args.master:
        builder = builder.master(args.master).config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    try:
        catalog, rejects = read_catalog(spark, args.catalog)
        # Names, look-up and scoring all read the parsed catalog.
        with cached(catalog):
            flat = flatten_attributes(catalog)
            try:
                top = top_k_weights(top_k_similar(flat, args.sku, args.num))
            except ItemNotFound as err:
                print(err, file=sys.stderr)
                return 2
            top.orderBy("rank").show(args.num, truncate=False)
        bad = rejects.count()
        if bad:
            print(f"{bad} catalog lines were rejected (malformed or without id)",
                  file=sys.stderr)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
