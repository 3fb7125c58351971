"""Tables printed in long paginated reports, as DataFrames: page text to facts, checks and answers."""
