"""Folders of small text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ldspark.plans.frame import Frame


def read_files(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """``path, text``: every file that matches, whole."""
    return (
        spark.read.text(
            folder, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=recursive
        )
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def load_frames(frames: DataFrame) -> dict[str, Frame]:
    """Frames by name. They are settings to plan with, so all of them are read by the driver."""
    return {r["name"]: Frame.from_json(r["text"]) for r in frames.select("name", "text").collect()}
