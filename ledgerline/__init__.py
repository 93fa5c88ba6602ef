"""Management-report building blocks and jobs, written as Spark DataFrame plans."""
