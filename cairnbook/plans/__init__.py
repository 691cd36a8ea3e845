"""The warehouse: dimensions, facts, marts, metrics, and the queries over them."""
