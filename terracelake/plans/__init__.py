"""The jobs: three conversions of raw data and four analyses."""
