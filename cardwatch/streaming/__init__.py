from .ingest import landing_stream, start_ingest

__all__ = ["landing_stream", "start_ingest"]
