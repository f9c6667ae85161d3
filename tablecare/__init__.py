"""Table-care jobs for Spark: copy, repair, merge, search and audit tables of any size."""
