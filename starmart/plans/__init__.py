"""Jobs and reports: cleaning, validation, warehouse, views, queries, measures."""
