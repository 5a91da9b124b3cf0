"""Column functions: types and their lattice, casts, masks, names."""
