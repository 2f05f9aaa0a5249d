"""Raw JSON scans, table writers and file inventories."""
