"""Reading and writing: landing files, layer tables, configuration, logs and extracts."""
