from .artefacts import load_model, load_specs, save_model, save_specs
from .bounds import file_bounds, read_trailing, write_by_time
from .forecast_json import POINT_SCHEMA, nest_forecast, read_forecast, unnest_forecast, write_forecast
from .tabular import (
    read_legacy,
    read_panel,
    read_report,
    read_upload,
    write_invalid,
    write_panel,
    write_report,
)

__all__ = [
    "POINT_SCHEMA",
    "file_bounds",
    "load_model",
    "load_specs",
    "nest_forecast",
    "read_forecast",
    "read_legacy",
    "read_panel",
    "read_report",
    "read_trailing",
    "read_upload",
    "save_model",
    "save_specs",
    "unnest_forecast",
    "write_by_time",
    "write_forecast",
    "write_invalid",
    "write_panel",
    "write_report",
]
