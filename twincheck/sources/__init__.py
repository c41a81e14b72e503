"""Where tables, catalogs, configurations and files come from."""
