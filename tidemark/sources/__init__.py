"""Where events come from and where they are kept: names, cuts, scans, stream tables, catalog."""
