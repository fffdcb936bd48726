"""DataFrame operators; each takes and returns DataFrames, batch or streaming."""
