"""Column functions: parameters, keys, rules, rates, calendar."""
