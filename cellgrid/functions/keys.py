"""What tells ROIs apart."""

from __future__ import annotations

from pyspark.sql import DataFrame


def roi_key(*dfs: DataFrame) -> list[str]:
    """``slide, roi`` where the tables carry a slide, as names of ROIs repeat from slide to slide; else ``roi``.

    Tables with and without a slide don't mix.
    """
    with_slide = {"slide" in df.columns for df in dfs}
    if len(with_slide) > 1:
        raise ValueError("some of the tables have a slide and others don't")
    return ["slide", "roi"] if with_slide == {True} else ["roi"]


def element_key(*dfs: DataFrame) -> list[str]:
    """An element of an ROI."""
    return [*roi_key(*dfs), "element"]


def typed_key(key: list[str]) -> str:
    """The key's columns in a schema."""
    return ", ".join(f"{k} string" for k in key)
