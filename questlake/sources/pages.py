"""Result pages landed as files: ``{"results": [...], "next": url or null}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlake.functions.variant import elements


def page_results(pages: DataFrame, page: str = "raw_data", output: str = "raw_data", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of ``results`` over all pages; pages without results give none.

    The explode is narrow. ``keep`` names columns of ``pages`` to carry along.
    """
    results: Column = F.variant_get(page, "$.results", "variant")
    return pages.select(*keep, F.explode(elements(results)).alias(output))
