"""String expressions for standardising and naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: twelve digits before the extension. Delimited and Parquet landing files both match.
BATCH_NUMBER_PATTERN = r".*_(\d{12})\.(?:csv|parquet)$"


def is_blank(col: Column) -> Column:
    """True for NULL, empty and all-space values; never NULL itself."""
    return F.coalesce(F.trim(col.cast("string")) == "", F.lit(True))


def blank_to_null(col: Column) -> Column:
    return F.when(F.trim(col) != "", col)


def source_batch_nr(file_name: Column) -> Column:
    """The batch number in a landing file's name, or the empty string."""
    return F.regexp_extract(file_name, BATCH_NUMBER_PATTERN, 1)


def plain_path(uri: Column) -> Column:
    """A file's path without the escapes of its address; a plus sign stays one."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def landing_name(file_path: Column) -> Column:
    """The last segment of a file's path, or that of its folder when an engine wrote part files."""
    name = F.substring_index(file_path, "/", -1)
    folder = F.element_at(F.split(file_path, "/"), -2)
    return F.when(name.startswith("part-"), folder).otherwise(name)
