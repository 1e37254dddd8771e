"""The flagship query: a day's raw listing report end to end.

part -> K12 report text (written in the shared folder) -> S1 blocks -> H10
fields -> D3 formatted -> F1-F10 clean ads -> A1+A4 price statistics per
room count with a grand-total row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import stats as ST
from .catalog import _part_report_ads


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _quarantine = _part_report_ads(spark, sf_dir)
    return ST.price_stats(clean, "room_count", "price_eur", with_total=True)
