"""perron: rail-timetable ETL and analytics as plain Spark DataFrame jobs."""

from perron.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
