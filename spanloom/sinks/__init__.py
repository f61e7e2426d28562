"""Writers of master tables, signals and offsets."""
