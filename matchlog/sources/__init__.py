"""Inputs and outputs: text logs, the rendered test log, parquet tables, sinks."""
