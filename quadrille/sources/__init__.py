"""Sources: files and services as rows, rows as statements."""
