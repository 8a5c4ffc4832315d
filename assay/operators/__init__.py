"""DataFrame to DataFrame operators, usable with `DataFrame.transform`."""
