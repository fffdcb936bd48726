"""The warehouse jobs: each builds its result DataFrames from its input DataFrames."""
