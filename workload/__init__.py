"""The given tables bound to the three domains, and the queries over them."""
