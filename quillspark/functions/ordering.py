"""Sort keys and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(text: Column, width: int = 20) -> Column:
    """Key that sorts runs of digits as numbers."""
    parts = F.regexp_extract_all(text, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda t: F.when(t.rlike(r"^\d"), F.lpad(F.regexp_replace(t, r"^0+(?=\d)", ""), width, "0")).otherwise(t)), "")


def unit_id(ve_id: Column, position: Column) -> Column:
    """``UT`` with the volume's number and a four-digit position from 1."""
    return F.format_string("UT%s_%04d", F.substring(ve_id, 3, 2**30), position)


def milestone_id(page: Column) -> Column:
    return F.format_string("P%d_B01", page)


def level_of(marks: list[Column]) -> Column:
    """Position of the first column that holds an X; 0 without one."""
    return F.array_position(F.array(*[F.coalesce(m, F.lit("")) for m in marks]), "X").cast("int")


def volume_from_folder(folder: Column, ie_id: Column) -> Column:
    return F.when(folder.startswith(F.concat(ie_id, F.lit("-"))), F.substr(folder, F.length(ie_id) + 2, F.lit(2**30)))
