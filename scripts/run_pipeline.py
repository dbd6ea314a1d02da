"""Run both layer pipelines end to end from raw files.

The stand-in tables of a driver scale folder are first written as raw
dumps (header CSV for the ratings pipeline; gzip TSV parts with \\N tokens
and a repeated header line for the title pipeline) under the shared
scratch folder, then ingested from those files.

Usage: python scripts/run_pipeline.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def land_raw(spark, sf_dir: str, root: str) -> tuple[dict, dict]:
    from reelhouse.plans import standins as S
    from reelhouse.sources import files
    csvs = {}
    for name, df in (("ratings", S.ratings_raw(spark, sf_dir).select("userId", "movieId", "rating", "timestamp")),
                     ("movies", S.movies(spark, sf_dir)), ("links", S.links(spark, sf_dir))):
        path = f"{root}/raw/{name}"
        files.export_csv(df.select([F.col(c).cast("string") for c in df.columns]), path)
        csvs[name] = path
    dumps = {}
    for name, df in (("title_basics", S.title_basics(spark, sf_dir)), ("name_basics", S.name_basics(spark, sf_dir)),
                     ("title_ratings", S.title_ratings(spark, sf_dir)), ("title_crew", S.title_crew(spark, sf_dir)),
                     ("title_akas", S.title_akas(spark, sf_dir))):
        as_text = df.select([F.coalesce(F.col(c), F.lit("\\N")).alias(c) for c in df.columns])
        header = spark.range(1).select([F.lit(c).alias(c) for c in df.columns])
        files.export_csv(as_text.unionByName(header), f"{root}/dumps/{name}", compression="gzip", sep="\t")
        dumps[name] = f"{root}/dumps/{name}/*.csv.gz"
    return csvs, dumps


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from reelhouse.plans import pipelines as P
    from reelhouse.session import build_session, scratch_path
    from reelhouse.sources.catalog import table_report
    from reelhouse.sources.tables import ensure_database
    spark = build_session("local[8]", 8)
    root = scratch_path(spark, "pipeline_run")
    csvs, dumps = land_raw(spark, sf_dir, root)
    db = ensure_database(spark, f"rh_run_{uuid.uuid4().hex[:8]}", f"{root}/warehouse")
    metrics = P.ratings_pipeline_from_files(spark, csvs["ratings"], csvs["movies"], csvs["links"], db,
                                            P.RatingsPipelineConfig(export_dir=f"{root}/exports"))
    P.title_pipeline_from_dumps(spark, dumps, db, as_of_year=2025,
                                repartition=spark.sparkContext.defaultParallelism)
    table_report(spark, "", db).orderBy("table_name").show(50, truncate=False)
    print("run metrics (rmse):", metrics)
    spark.stop()


if __name__ == "__main__":
    main()
