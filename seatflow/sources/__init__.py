"""Readers: parquet tables, timetable texts, weather documents, vehicle snapshots."""
