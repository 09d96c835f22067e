"""Stand-in inputs on the given tables, the registered queries and their reference SQL."""
