"""Column expressions and small-table helpers shared by the operators."""

from rowmill.functions.columns import (
    binary_target,
    key_hash,
    match_flag,
    missing_condition,
    quoted,
    safe_ratio,
    within_tolerance,
)
from rowmill.functions.tables import (
    SMALL_ROWS,
    join_path,
    local_table,
    new_folder,
    remove_folders,
    require_columns,
    settled,
    shared_folder,
    small_table,
    stored,
)

__all__ = [
    "SMALL_ROWS",
    "binary_target",
    "join_path",
    "key_hash",
    "local_table",
    "match_flag",
    "missing_condition",
    "new_folder",
    "quoted",
    "remove_folders",
    "require_columns",
    "safe_ratio",
    "settled",
    "shared_folder",
    "small_table",
    "stored",
    "within_tolerance",
]
