from .jobs import (
    accuracy_job,
    forecast_job,
    refresh_job,
    report_job,
    select_ensemble,
    tune_job,
    upload_job,
)

__all__ = [
    "accuracy_job",
    "forecast_job", "refresh_job", "report_job", "select_ensemble", "tune_job", "upload_job",
]
