"""Jobs built from the operators: cleaning, the query contract, checks."""
