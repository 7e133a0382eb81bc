"""Named queries over the archive tables and their SQL."""
