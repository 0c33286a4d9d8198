"""Where tables and change logs are read from."""
