"""Sources: JSON lines, key lists, dictionaries and catalog tables as DataFrames."""
