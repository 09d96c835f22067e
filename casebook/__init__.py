"""Project and document intelligence as Spark table-to-table transformations."""
