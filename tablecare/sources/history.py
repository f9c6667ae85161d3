"""Copy of a change history, limited to known names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablecare.operators.merging import merge_keep_first

# Fixed value: a history id is 14 or 15 digits, an underscore and a name.
HISTORY_ID = "^[0-9]{14,15}_.+$"


def allowed_rows(history: DataFrame, names: DataFrame, id_column: str = "migration_id", name: str = "name") -> DataFrame:
    """History rows whose id is well formed and whose name is in ``names``."""
    shaped = history.where(F.col(id_column).rlike(HISTORY_ID))
    shaped = shaped.withColumn("_name", F.regexp_extract(id_column, "^[0-9]+_(.+)$", 1))
    return shaped.join(names.select(F.col(name).alias("_name")), "_name", "left_semi").select(*history.columns)


def copy_allowed(
    history: DataFrame, names: DataFrame, stored: DataFrame, id_column: str = "migration_id", name: str = "name"
) -> DataFrame:
    """``stored`` plus the allowed rows it lacks; a stored row stays as it is."""
    return merge_keep_first(stored, allowed_rows(history, names, id_column, name), [id_column], [id_column])
