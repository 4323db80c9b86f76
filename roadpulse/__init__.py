"""Vehicle-telemetry analytics as plain PySpark jobs.

Every function takes DataFrames (or a session and a path) and returns
DataFrames; nothing here starts a session or sets a master.
"""
