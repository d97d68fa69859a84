"""Writers: Parquet folders, JSON reports and catalog tables."""
