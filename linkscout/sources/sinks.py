"""Writers of the result files. Every writer is one distributed write, partitioned by what readers filter on."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkscout.operators import outputs

MANIFESTS = "manifests"


class Run:
    """The files of one run, in a folder of its own until they are published together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.name = spark, path.rstrip("/"), f"runs/{uuid.uuid4().hex}"
        self.seen: dict[str, Observation] = {}

    def folder(self, table: str) -> str:
        return f"{self.path}/{self.name}/{table}"

    def watched(self, table: str, df: DataFrame) -> DataFrame:
        """The table, its rows counted while it is written. For use right before the writer, above any exchange."""
        self.seen[table] = Observation()
        return df.observe(self.seen[table], F.count(F.lit(1)).alias("rows"))

    def _place(self, *parts: str) -> tuple:
        target = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def publish(self) -> dict:
        """One step that makes the run the current one: its manifest appears, whole, under the next number."""
        tables = {table: {"folder": f"{self.name}/{table}", "rows": seen.get["rows"]} for table, seen in self.seen.items()}
        manifest = {"run": self.name, "tables": tables}
        draft, fs = self._place(self.name, "manifest.json")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        folder, _ = self._place(MANIFESTS)
        fs.mkdirs(folder)
        number = max([_number(s.getPath().getName()) for s in fs.listStatus(folder)], default=0)
        while True:
            number += 1
            # A rename does not replace a file, so of two runs that end at once one takes the number after.
            target, _ = self._place(MANIFESTS, f"{number:08d}.json")
            if not fs.exists(target) and fs.rename(draft, target):
                return manifest


def _number(name: str) -> int:
    stem = name.removesuffix(".json")
    return int(stem) if stem.isdigit() else 0


@contextmanager
def published(spark: SparkSession, path: str) -> Iterator[Run]:
    """Files written inside the block become visible together at its end; if it fails, the previous run stays the current one."""
    run = Run(spark, path)
    yield run
    run.publish()


def current(spark: SparkSession, path: str) -> dict:
    """Manifest of the last published run: its tables with folder and rows."""
    files = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/{MANIFESTS}/*.json")
    last = files.orderBy(F.col("path").desc()).select("content").first()
    return json.loads(bytes(last.content))


def current_folder(spark: SparkSession, path: str, table: str) -> str:
    return f"{path.rstrip('/')}/{current(spark, path)['tables'][table]['folder']}"


def write_csv(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).csv(path, header=True)


def candidate_order(all_ranked: DataFrame) -> DataFrame:
    """Candidate file. Not partitioned by site, as there may be millions of them; rows of a site stay together."""
    order = ("site_id", "fw_rank", "id")
    return outputs.candidate_file(all_ranked).repartitionByRange(*order).sortWithinPartitions(*order)


def write_candidate_file(all_ranked: DataFrame, path: str) -> None:
    write_plain_csv(candidate_order(all_ranked), path)


def write_report(ranked: DataFrame, path: str) -> None:
    outputs.sorted_report(ranked).write.mode("overwrite").parquet(path)


def write_rank_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """One table per candidate type, as a partition of one folder each."""
    for kind, sheet in sheets.items():
        sheet.write.mode("overwrite").parquet(f"{path.rstrip('/')}/candidate_type={kind}")


def write_planner_sheet(rows: DataFrame, path: str) -> None:
    """Import sheet of the network planner, one folder per search site's name."""
    write_csv(rows.withColumn("site", F.col("Site Name")), path, "site")


def write_plain_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_layers(ranked: DataFrame, sources: DataFrame, path: str) -> None:
    """Point and line layer with geometry as text."""
    outputs.candidate_points(ranked).write.mode("overwrite").parquet(f"{path.rstrip('/')}/candidates")
    outputs.spider_lines(ranked, sources).write.mode("overwrite").parquet(f"{path.rstrip('/')}/spider_lines")


def write_geojson_lines(points: DataFrame, path: str) -> None:
    """Point layer as one GeoJSON feature per line."""
    properties = F.struct(*[F.col(c) for c in points.columns if c not in ("shape", "long", "lat")])
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("long", "lat").alias("coordinates")).alias("geometry"),
        properties.alias("properties"),
    )
    points.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)
