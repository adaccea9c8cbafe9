"""Channel selection from file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The file names that imaging rounds have.
NAME = r"^[^_]+_([0-9]+)\.0\.4_R000_([^_]+)_.*\.tiff?"


def parse_channels(files: DataFrame) -> DataFrame:
    """``ordinal, path, round, marker, channel`` of the files (``ordinal, path``) whose names fit.

    The marker is DAPI where the dye says so, else the fifth part of the name without its last hyphenated piece.
    """
    base = F.regexp_extract("path", "[^/]+$", 0)
    fit = files.withColumn("base", base).where(F.col("base").rlike(NAME))
    number = F.regexp_extract("base", NAME, 1).cast("int")
    dapi = F.upper(F.regexp_extract("base", NAME, 2)).contains("DAPI")
    marker = F.when(dapi, "DAPI").otherwise(F.regexp_replace(F.get(F.split("base", "_"), F.lit(4)), "-[^-]*$", ""))
    fit = fit.withColumns({"round": number, "marker": marker})
    return fit.select("ordinal", "path", "round", "marker", F.format_string("%03d_%s", "round", "marker").alias("channel"))


def dedupe_channels(parsed: DataFrame) -> DataFrame:
    """One row per channel name: of files that share one, the last in the listing."""
    last = F.max_by(F.struct("ordinal", "path", "round", "marker"), "ordinal").alias("last")
    return parsed.groupBy("channel").agg(last).select("last.ordinal", "last.path", "last.round", "last.marker", "channel")


def latest_round(channels: DataFrame) -> DataFrame:
    """``marker, channel, round, path`` of each marker's last round."""
    last = F.max_by(F.struct("channel", "round", "path"), "round").alias("last")
    return channels.groupBy("marker").agg(last).select("marker", "last.channel", "last.round", "last.path")


def first_dapi(channels: DataFrame) -> DataFrame:
    """Channels without the nuclear stain of later rounds; there is no stand-in for that of the first."""
    return channels.where((F.upper("marker") != "DAPI") | (F.col("channel") == "001_DAPI"))


def _listed(names: DataFrame | Sequence[str], column: str, like: DataFrame) -> DataFrame:
    """A list of names as a table of the column."""
    if isinstance(names, DataFrame):
        return names.select(column)
    return like.sparkSession.createDataFrame([(n,) for n in names], f"{column} string")


def _given(names: DataFrame | Sequence[str]) -> bool:
    return isinstance(names, DataFrame) or bool(names)


def select_channels(parsed: DataFrame, include=(), exclude=(), use=(), ignore=()) -> DataFrame:
    """One channel per marker.

    A marker with an included channel uses that, whatever else holds; other channels lose the excluded ones and all
    nuclear stains but the first, and the latest round is taken. ``use`` and ``ignore`` then choose among markers. All four
    are lists of names, or tables with a column ``channel`` (the first two) or ``marker``.
    """
    if parsed.isEmpty():
        raise ValueError("no file name fits")
    rest = channels = dedupe_channels(parsed)
    chosen = latest_round(channels.join(_listed(include, "channel", parsed), "channel", "left_semi"))
    if _given(exclude):
        rest = rest.join(_listed(exclude, "channel", parsed), "channel", "left_anti")
    rest = latest_round(first_dapi(rest)).join(chosen, "marker", "left_anti")
    out = chosen.unionByName(rest)
    if _given(use):
        out = out.join(_listed(use, "marker", parsed), "marker", "left_semi")
    return out.join(_listed(ignore, "marker", parsed), "marker", "left_anti") if _given(ignore) else out


def unknown_markers(parsed: DataFrame, use: DataFrame | Sequence[str]) -> DataFrame:
    """``marker``: those asked for that no file has."""
    return _listed(use, "marker", parsed).distinct().join(parsed.select("marker"), "marker", "left_anti")


def unused_files(parsed: DataFrame, selected: DataFrame) -> DataFrame:
    """Files that fit but were not selected."""
    return parsed.join(selected.select("path"), "path", "left_anti")


def missing_channels(selected: DataFrame, files: DataFrame) -> DataFrame:
    """Selected channels whose files are not in the listing."""
    return selected.join(files.select("path"), "path", "left_anti")


def require_channels(selected: DataFrame, files: DataFrame) -> DataFrame:
    """``selected``, if the listing has all of its files; one that is absent is an error."""
    if gone := missing_channels(selected, files).orderBy("channel").limit(5).collect():
        raise FileNotFoundError("selected files are absent: " + ", ".join(f"{r.channel} ({r.path})" for r in gone))
    return selected
