"""Operators; each takes and returns DataFrames or Columns and runs nothing itself."""
