"""Date folders of a layer partitioned by event date, and what they hold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tributary.sources.lake import child_folders, file_names

DATE_FOLDER = "event_date="
#: Name of the folder of rows without a date, as Spark writes it.
NULL_DATE = "__HIVE_DEFAULT_PARTITION__"


def date_files(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files of each date folder below ``path``, by the folder's value. Every
    write names its files anew, so other files mean another content."""
    folders = [n for n in child_folders(spark, path) if n.startswith(DATE_FOLDER)]
    return {
        n.removeprefix(DATE_FOLDER): files for n in folders if (files := sorted(file_names(spark, f"{path}/{n}")))
    }


def changed_dates(found: Mapping[str, list[str]], held: Mapping[str, dict]) -> tuple[list[str], list[str]]:
    """(dates whose files aren't those held, held dates that are gone)."""
    changed = sorted(d for d, files in found.items() if held.get(d, {}).get("files") != files)
    return changed, sorted(held.keys() - found.keys())


def on_dates(dates: Iterable[str], column: str = "event_date") -> Column:
    """Partition filter for date folders."""
    dates = sorted(dates)
    days = [dt.date.fromisoformat(d) for d in dates if d != NULL_DATE]
    found = F.col(column).isin(days) if days else F.lit(False)
    return found | F.col(column).isNull() if NULL_DATE in dates else found
