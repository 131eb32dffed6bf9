"""Transit-occupancy analytics on Spark: lazy DataFrame operators and batch jobs."""
