"""Layer loads, cube and KPI queries composed from the operators."""
