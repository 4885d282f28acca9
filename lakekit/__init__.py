"""lakekit: lakehouse analytics jobs for ERP-style data, as functions from DataFrames to DataFrames."""
