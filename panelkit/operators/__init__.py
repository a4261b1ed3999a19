"""Panel, split, metric, decision and explanation operators on DataFrames."""
