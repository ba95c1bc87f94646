"""Landing feeds: fixture views, file readers with audit columns, catalog tables."""
