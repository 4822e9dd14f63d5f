"""Out-of-fold model jobs, parameter searches and feature importance on Spark ML."""
