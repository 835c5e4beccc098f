"""The end-to-end jobs, from files to files."""
