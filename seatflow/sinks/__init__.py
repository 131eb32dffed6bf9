"""Writers: keyed tables, splits, hourly files, reports and documents."""
