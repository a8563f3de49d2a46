"""Column expressions shared by the operators and the feature stages."""
