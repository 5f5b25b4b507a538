"""Sources: audit-log CSV, tables with audit columns, XES logs."""
