"""Where tables, snapshots, metrics and models come from and go to."""
