"""CSV snapshots in, typed rows out."""
