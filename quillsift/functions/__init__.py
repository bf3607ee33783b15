"""Functions from columns to a column; all are built-in Spark expressions."""
