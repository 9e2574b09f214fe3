"""millrace: DataFrame operators for cleaning, reporting, text counts,
streaming totals, clustering and line fitting on Spark."""
