"""screenloom: a PySpark-native analytics engine for large single-cell perturbation screens."""
