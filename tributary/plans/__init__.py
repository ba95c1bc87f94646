"""End-to-end plans: the medallion pipeline and the registered queries."""
