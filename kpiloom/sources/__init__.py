from kpiloom.sources.kpi import kpi_schema, normalize_nan, parse_ts, read_kpi_csv, rename_sources, sort_kpi
from kpiloom.sources.sinks import (
    global_row_number,
    load_model,
    read_baselines,
    record_cases,
    save_model,
    write_baselines,
    write_cases,
)

__all__ = [
    "kpi_schema", "normalize_nan", "parse_ts", "read_kpi_csv", "rename_sources", "sort_kpi",
    "global_row_number", "load_model", "read_baselines", "record_cases", "save_model",
    "write_baselines", "write_cases",
]
