"""DataFrame operators: each is a function DataFrame -> DataFrame or an ML Estimator."""
