"""keelson: a PySpark-native ingestion and change-data engine.

Records come in as JSON pages, files or streams; they are typed by column
expressions, read incrementally by a cursor and applied to target tables as
append, SCD type 1, SCD type 2, delete feeds or snapshot comparison. Every
operator is a function from DataFrame(s) to a DataFrame; only the modules in
``keelson.streaming`` and ``keelson.plans.ingest`` write.
"""

from keelson.session import build_session, shuffle_partitions_for, work_dir

__all__ = ["build_session", "shuffle_partitions_for", "work_dir"]
