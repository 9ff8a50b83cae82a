"""Reading publishers' files and tables into DataFrames."""
