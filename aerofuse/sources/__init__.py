from aerofuse.sources.files import listed_files, read_readable
from aerofuse.sources.places import box_ranges, files_of_box, read_box, write_by_place
from aerofuse.sources.readers import (
    between_dates,
    first_existing,
    flatten_landing,
    in_box,
    in_months,
    long_measurements,
    only_stations,
    pad_missing,
    read_table,
    read_unified,
    require_columns,
    schema_by_header,
    union_all,
    unify_layout,
    within_box,
    within_dates,
    within_months,
)
from aerofuse.sources.records import read_records
from aerofuse.sources.rules import (
    AEROSOL_RULES,
    STATION_RULES,
    WEATHER_RULES,
    Rule,
    ValidationError,
    check_schema,
    enforce,
    quarantine,
    violation_report,
)
from aerofuse.sources.sinks import (
    append_log,
    load_metrics,
    project_available,
    save_metrics,
    write_table,
)

__all__ = [
    "AEROSOL_RULES",
    "STATION_RULES",
    "WEATHER_RULES",
    "Rule",
    "ValidationError",
    "append_log",
    "between_dates",
    "box_ranges",
    "check_schema",
    "enforce",
    "files_of_box",
    "first_existing",
    "flatten_landing",
    "in_box",
    "in_months",
    "listed_files",
    "load_metrics",
    "long_measurements",
    "only_stations",
    "pad_missing",
    "project_available",
    "quarantine",
    "read_box",
    "read_readable",
    "read_records",
    "read_table",
    "read_unified",
    "require_columns",
    "save_metrics",
    "schema_by_header",
    "union_all",
    "unify_layout",
    "within_box",
    "within_dates",
    "within_months",
    "violation_report",
    "write_by_place",
    "write_table",
]
