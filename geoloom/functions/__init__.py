"""Column functions: geometry codecs, predicates, coordinates, cells and time."""
