"""The flight model: how the generic operators refine flight records."""
