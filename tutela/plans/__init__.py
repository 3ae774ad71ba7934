"""The warehouse: staging, rules, dimensions, facts, marts, analyses, metrics."""
