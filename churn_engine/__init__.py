"""PySpark-native churn features, training sets, scoring and evaluation over event logs."""
