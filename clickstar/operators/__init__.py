"""DataFrame-to-DataFrame transformations: stage, dimensions, facts, marts, merge, checks."""
