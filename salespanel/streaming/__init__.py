from .corrections import latest_revisions, run_monthly_corrected, stream_monthly_corrected
from .uploads import stream_monthly, stream_uploads, stream_uploads_once, upload_stream

__all__ = [
    "latest_revisions", "run_monthly_corrected", "stream_monthly", "stream_monthly_corrected",
    "stream_uploads", "stream_uploads_once", "upload_stream",
]
