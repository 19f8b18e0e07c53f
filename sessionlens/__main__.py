"""Command line: ``list`` queries, ``run`` one over a folder of tables, ``search`` vectors of a table by one of them."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.vectors import cosine
from .plans import catalog


def search(vectors: DataFrame, ident: int, top: int) -> DataFrame:
    """The ``top`` vectors nearest to the one of an id, itself left out; ties to smaller ids."""
    asked = vectors.filter(F.col("vec_id") == ident).select("embedding").limit(1).collect()
    if not asked:
        raise SystemExit(f"no vector {ident}")
    target = F.array(*[F.lit(float(x)) for x in asked[0]["embedding"]])
    scored = vectors.filter(F.col("vec_id") != ident).select("vec_id", cosine(F.col("embedding").cast("array<double>"), target).alias("score"))
    return scored.orderBy(F.desc("score"), "vec_id").limit(top)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m sessionlens", description=__doc__)
    to = p.add_subparsers(dest="command", required=True)
    to.add_parser("list")
    run = to.add_parser("run")
    run.add_argument("name", choices=sorted(catalog.QUERIES), metavar="name")
    near = to.add_parser("search")
    near.add_argument("ident", type=int)
    near.add_argument("--top", type=int, default=10)
    for s in (run, near):
        s.add_argument("--tables", required=True, help="folder of the Parquet tables")
        s.add_argument("--out", help="folder for the result as Parquet; without it, rows are shown")
        s.add_argument("--rows", type=int, default=20, help="rows that are shown")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    if a.command == "list":
        print("\n".join(sorted(catalog.QUERIES)))
        return
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    df = catalog.QUERIES[a.name](spark, a.tables) if a.command == "run" else search(spark.read.parquet(f"{a.tables}/embeddings.parquet"), a.ident, a.top)
    if a.out:
        df.write.mode("errorifexists").parquet(a.out)
    else:
        df.show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
