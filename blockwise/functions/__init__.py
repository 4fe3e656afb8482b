"""Column -> Column builders: normalisation, slope, geometry."""
